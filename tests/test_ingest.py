import datetime as dt

import pytest
from conftest import rows, write_gz
from pyspark.sql import types as T

from hitlake.plans.publish import STEPS
from hitlake.streaming.ingest import ingest

SCHEMA = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("date_time", T.TimestampType()),
        T.StructField("browser", T.LongType()),
    ]
)


def hit(n, day, browser=1):
    return f"{n}\t2024-01-0{day} 10:00:00\t{browser}"


def run(spark, root, **options):
    lookups = {"browser": spark.createDataFrame([(1, "A")], "id bigint, name string")}
    query = ingest(
        spark,
        str(root / "incoming"),
        str(root / "lake"),
        str(root / "checkpoint"),
        lookups,
        SCHEMA,
        [("browser", "browser")],
        **options,
    )
    query.awaitTermination()
    return rows(spark.read.parquet(str(root / "lake")).select("n", "browser_id", "browser", "date"))


def day(n):
    return dt.date(2024, 1, n)


@pytest.mark.parametrize("options", [{}, {"max_files": 1, "tasks": 2}])
def test_each_file_once_and_late_hits_to_their_day(spark, tmp_path, options):
    incoming = tmp_path / "incoming"
    write_gz(incoming / "01-suite_20240101-000000.tsv.gz", [hit(1, 1), "", "\t\t", hit(2, 1, 7)])
    write_gz(incoming / "01-suite_20240102-000000.tsv.gz", [hit(3, 2)])
    (incoming / "suite_2024-01-01.txt").write_text("9\t2024-01-09 00:00:00\t1")
    first = [(1, 1, "A", day(1)), (2, 7, None, day(1)), (3, 1, "A", day(2))]
    assert run(spark, tmp_path, **options) == first
    assert run(spark, tmp_path, **options) == first
    write_gz(incoming / "01-suite_20240105-000000.tsv.gz", [hit(4, 1)])
    assert run(spark, tmp_path, **options) == [*first, (4, 1, "A", day(1))]


def test_files_are_archived(spark, tmp_path):
    for i in (1, 2, 3):
        write_gz(tmp_path / "incoming" / f"01-suite_2024010{i}-000000.tsv.gz", [hit(i, i)])
        run(spark, tmp_path, archive=str(tmp_path / "processed"))
    moved = [p.name for p in (tmp_path / "processed").rglob("*.tsv.gz")]
    left = [p.name for p in (tmp_path / "incoming").glob("*.tsv.gz")]
    assert sorted(moved + left) == [f"01-suite_2024010{i}-000000.tsv.gz" for i in (1, 2, 3)]
    # Archiving lags one batch, so the newest file stays.
    assert "01-suite_20240101-000000.tsv.gz" in moved and "01-suite_20240103-000000.tsv.gz" in left


def test_replayed_batch_is_skipped(spark, tmp_path):
    write_gz(tmp_path / "incoming" / "01-suite_20240101-000000.tsv.gz", [hit(1, 1)])
    once = run(spark, tmp_path)
    # As after a crash between the batch's write and the stream's commit.
    for commit in (tmp_path / "checkpoint" / "commits").iterdir():
        commit.unlink()
    assert run(spark, tmp_path) == once == [(1, 1, "A", day(1))]


@pytest.mark.parametrize("step", STEPS)
def test_a_stop_after_any_step_of_a_batch(spark, tmp_path, step):
    def stop(done):
        if done == step:
            raise RuntimeError("stopped here")

    write_gz(tmp_path / "incoming" / "01-suite_20240101-000000.tsv.gz", [hit(1, 1), hit(2, 2)])
    with pytest.raises(Exception, match="stopped here"):
        run(spark, tmp_path, stop=stop)
    assert run(spark, tmp_path) == [(1, 1, "A", day(1)), (2, 1, "A", day(2))]
    write_gz(tmp_path / "incoming" / "01-suite_20240103-000000.tsv.gz", [hit(3, 3)])
    assert run(spark, tmp_path) == [(1, 1, "A", day(1)), (2, 1, "A", day(2)), (3, 1, "A", day(3))]


def test_hits_delivered_again(spark, tmp_path):
    """Within a batch, in a later batch, in a later run, after a replay; late ones and those without a key stay."""
    incoming, options = tmp_path / "incoming", {"dedupe_on": ["n"], "max_files": 1}
    write_gz(incoming / "01-suite_20240105-000000.tsv.gz", [hit(1, 5), hit(1, 5), hit("", 5), hit("", 5)])
    write_gz(incoming / "02-suite_20240105-000000.tsv.gz", [hit(1, 5), hit(2, 1), hit("", 5)])
    alone = (None, 1, "A", day(5))
    first = sorted([(1, 1, "A", day(5)), (2, 1, "A", day(1)), *[alone] * 3], key=str)
    assert run(spark, tmp_path, **options) == first
    # As after a crash between the last batch's write and the stream's commit.
    newest = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    for commit in (tmp_path / "checkpoint" / "commits").glob(f"*{newest}*"):
        commit.unlink()
    write_gz(incoming / "03-suite_20240105-000000.tsv.gz", [hit(2, 1), hit(3, 5)])
    assert run(spark, tmp_path, **options) == sorted([*first, (3, 1, "A", day(5))], key=str)


def test_stream_and_load_agree(spark, tmp_path):
    from conftest import write_bundle

    from hitlake.plans.load import load

    incoming = tmp_path / "incoming"
    for i in (1, 2, 3):
        write_gz(incoming / f"01-suite_2024010{i}-000000.tsv.gz", [hit(10 * i + j, i, j % 3) for j in range(5)])
    write_bundle(incoming / "suite_20240101-000000-lookup_data.tar.gz", {"browser.tsv": b"1\tA"})
    streamed = run(spark, tmp_path)
    target = str(tmp_path / "loaded")
    roles = [("browser", "browser")]
    load(spark, str(incoming), target, str(tmp_path / "ledger"), SCHEMA, roles, include_open=True)
    assert rows(spark.read.parquet(target).select("n", "browser_id", "browser", "date")) == streamed


def test_names_per_batch_gate_and_table(spark, tmp_path):
    incoming = tmp_path / "incoming"
    names = [(1, "A")]

    def lookups(session):
        return {"browser": session.createDataFrame(names, "id bigint, name string")}

    def go(**options):
        paths = [str(tmp_path / name) for name in ("incoming", "lake", "checkpoint")]
        ingest(spark, *paths, lookups, SCHEMA, [("browser", "browser")], table="streamed_hits", **options).awaitTermination()

    write_gz(incoming / "01-suite_20240101-000000.tsv.gz", [hit(1, 1)])
    go()
    names[:] = [(1, "B")]
    write_gz(incoming / "01-suite_20240102-000000.tsv.gz", [hit(2, 2)])
    go(unique=True)
    found = rows(spark.table("streamed_hits").select("n", "browser", "date"))
    assert found == [(1, "A", day(1)), (2, "B", day(2))]
    names.append((1, "C"))
    write_gz(incoming / "01-suite_20240103-000000.tsv.gz", [hit(3, 3)])
    with pytest.raises(Exception, match="more than once"):
        go(unique=True)
    assert spark.table("streamed_hits").count() == 2
    spark.sql("DROP TABLE streamed_hits")
