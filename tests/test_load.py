import datetime as dt
from pathlib import Path

import pytest
from conftest import rows, write_bundle, write_gz
from pyspark.sql import types as T

import hitlake.plans.load as job
import hitlake.plans.publish as publishing
from hitlake.operators.enrich import enrich
from hitlake.plans.ledger import read_ledger
from hitlake.plans.load import Checksum, IncompleteLoad, LoadReport, check_sums, load
from hitlake.plans.publish import STEPS
from hitlake.sources.landing import classify, list_landing
from hitlake.sources.manifest import ManifestNames, manifest_days, read_manifests

SCHEMA = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("date_time", T.TimestampType()),
        T.StructField("browser", T.LongType()),
    ]
)
ROLES = [("browser", "browser")]
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def hit(n, day, browser=1):
    return f"{n}\t2024-01-0{day} 10:00:00\t{browser}"


@pytest.fixture()
def feed(tmp_path):
    incoming = tmp_path / "incoming"
    write_gz(incoming / "01-suite_20240101-000000.tsv.gz", [hit(1, 1), hit(2, 1, 9), "\t\t"])
    write_gz(incoming / "01-suite_20240101-010000.tsv.gz", [hit(3, 1, 2)])
    # A file can hold hits of another day.
    write_gz(incoming / "01-suite_20240102-000000.tsv.gz", [hit(4, 2), hit(5, 1)])
    write_gz(incoming / "01-suite_20240103-000000.tsv.gz", [hit(6, 3)])
    write_bundle(incoming / "suite_20240101-000000-lookup_data.tar.gz", {"browser.tsv": b"1\tOld"})
    write_bundle(incoming / "suite_20240102-000000-lookup_data.tar.gz", {"browser.tsv": b"1\tA\n2\tB\n"})
    (incoming / "suite_2024-01-01.txt").write_text("manifest")
    return tmp_path


CLOSED = [
    (1, 1, "A", D1),
    (2, 9, None, D1),
    (3, 2, "B", D1),
    (4, 1, "A", D2),
    (5, 1, "A", D1),
]


def run(spark, feed, **options):
    return load(spark, str(feed / "incoming"), str(feed / "lake"), str(feed / "ledger"), SCHEMA, ROLES, **options)


def lake(spark, feed):
    return rows(spark.read.parquet(str(feed / "lake")).select("n", "browser_id", "browser", "date"))


def test_closed_days_once(spark, feed):
    assert run(spark, feed) == LoadReport(3, 5, 5)
    assert lake(spark, feed) == CLOSED
    names = {r["path"].rsplit("/", 1)[1]: r["feed_date"] for r in read_ledger(spark, str(feed / "ledger")).collect()}
    assert names == {
        "01-suite_20240101-000000.tsv.gz": "20240101",
        "01-suite_20240101-010000.tsv.gz": "20240101",
        "01-suite_20240102-000000.tsv.gz": "20240102",
        "suite_2024-01-01.txt": None,
        "suite_20240101-000000-lookup_data.tar.gz": None,
    }
    assert run(spark, feed) == LoadReport(0, 0, 0)
    assert lake(spark, feed) == CLOSED


def test_next_run_takes_the_day_that_has_closed_and_late_files(spark, feed):
    run(spark, feed)
    write_gz(feed / "incoming" / "01-suite_20240104-000000.tsv.gz", [hit(8, 4)])
    write_gz(feed / "incoming" / "02-suite_20240101-230000.tsv.gz", [hit(7, 1)])
    assert run(spark, feed) == LoadReport(2, 2, 2)
    assert lake(spark, feed) == sorted([*CLOSED, (6, 1, "A", D3), (7, 1, "A", D1)], key=str)


@pytest.mark.parametrize("options", [{"page_size": 1}, {"files": 4}, {"task_bytes": 1}, {"unique": True}])
def test_shape_options_do_not_change_the_result(spark, feed, options):
    assert run(spark, feed, **options).files == 3
    assert lake(spark, feed) == CLOSED


def test_open_day_on_request_and_given_lookups(spark, feed):
    given = {"browser": spark.createDataFrame([(1, "mine")], "id bigint, name string")}
    assert run(spark, feed, include_open=True, lookups=given) == LoadReport(4, 6, 6)
    assert {r[2] for r in lake(spark, feed)} == {"mine", None}


def test_table_is_kept_up_to_date(spark, feed):
    try:
        run(spark, feed, table="load_hits")
        assert spark.table("load_hits").count() == 5
        assert spark.table("load_hits").columns == ["n", "date_time", "browser_id", "browser", "date"]
        write_gz(feed / "incoming" / "01-suite_20240104-000000.tsv.gz", [hit(8, 4)])
        run(spark, feed, table="load_hits")
        assert spark.sql("SELECT n FROM load_hits WHERE date = '2024-01-03'").first()["n"] == 6
    finally:
        spark.sql("DROP TABLE IF EXISTS load_hits")


class Stopped(RuntimeError):
    pass


def stop_after(step, times=1):
    """A load that goes down when ``step`` is done for the ``times``-th time."""
    left = [times]

    def stop(done):
        left[0] -= done == step
        if done == step and not left[0]:
            raise Stopped(step)

    return stop


@pytest.mark.parametrize("page_size", [1, 10_000])
@pytest.mark.parametrize("step", STEPS)
def test_a_stop_after_any_step_loses_and_doubles_nothing(spark, feed, step, page_size):
    table = f"stopped_{step}_{page_size}"
    try:
        with pytest.raises(Stopped):
            run(spark, feed, stop=stop_after(step), table=table, page_size=page_size)
        # What is not published cannot be seen.
        assert step != "staged" or not (feed / "lake" / "date=2024-01-01").exists()
        run(spark, feed, table=table, page_size=page_size)
        assert lake(spark, feed) == CLOSED
        assert rows(spark.table(table).select("n", "browser_id", "browser", "date")) == CLOSED
        marked = [r["path"] for r in read_ledger(spark, str(feed / "ledger")).collect()]
        assert len(marked) == len(set(marked)) == 5
        assert not list((feed / "lake" / "_loads").iterdir())
        assert run(spark, feed, table=table) == LoadReport(0, 0, 0)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_a_stop_while_files_are_moved(spark, feed, monkeypatch):
    real, left = publishing.move, [1]

    def move(*args):
        left[0] -= 1
        if left[0] < 0:
            raise Stopped("move")
        return real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(publishing, "move", move)
        with pytest.raises(Stopped):
            run(spark, feed)
    assert run(spark, feed) == LoadReport(0, 0, 0)
    assert lake(spark, feed) == CLOSED


def test_a_manifest_cut_off_is_no_manifest(spark, feed):
    with pytest.raises(Stopped):
        run(spark, feed, stop=stop_after("published"))
    (manifest,) = (feed / "lake" / "_loads").glob("*/manifest.json")
    whole = manifest.read_bytes()
    for place in manifest.parent.glob(".*.crc"):
        place.unlink()
    manifest.write_bytes(whole[: len(whole) // 2])
    assert run(spark, feed) == LoadReport(3, 5, 5)
    assert lake(spark, feed) == CLOSED


def test_a_published_file_that_is_gone_is_an_error(spark, feed):
    with pytest.raises(Stopped):
        run(spark, feed, stop=stop_after("published"))
    next((feed / "lake" / "_loads").rglob("date=2024-01-02/*.parquet")).unlink()
    with pytest.raises(publishing.LostFile):
        run(spark, feed)


def test_a_manifest_is_created_once(spark, feed):
    with pytest.raises(Stopped):
        run(spark, feed, stop=stop_after("published"))
    (folder,) = (feed / "lake" / "_loads").iterdir()
    with pytest.raises(FileExistsError):
        publishing.publish(spark, str(feed / "lake"), folder.name)


def test_dedupe_on_hits_that_are_delivered_again(spark, feed):
    run(spark, feed)
    write_gz(feed / "incoming" / "02-suite_20240101-000000.tsv.gz", [hit(1, 1), hit(9, 1)])
    assert run(spark, feed, dedupe_on=("n",)).rows_written == 1
    assert lake(spark, feed) == sorted([*CLOSED, (9, 1, "A", D1)], key=str)


def test_repeated_lookup_ids(spark, feed):
    write_bundle(
        feed / "incoming" / "suite_20240109-000000-lookup_data.tar.gz", {"browser.tsv": b"1\tA\n1\tB\n"}
    )
    with pytest.raises(ValueError, match="more than once"):
        run(spark, feed, unique=True)
    assert read_ledger(spark, str(feed / "ledger")).count() == 0
    report = run(spark, feed)
    assert (report.rows_read, report.rows_written) == (5, 8)


def test_no_bundle(spark, tmp_path):
    write_gz(tmp_path / "incoming" / "01-suite_20240101-000000.tsv.gz", [hit(1, 1)])
    with pytest.raises(ValueError, match="no lookup bundle"):
        run(spark, tmp_path)


def test_the_gate():
    one, other = Checksum(2, 30, 7), Checksum(2, 31, 7)
    check_sums(one, one, exact=True)
    check_sums(one, Checksum(3, 40, 9), exact=False)
    for read, written, exact in ((one, Checksum(1, 10, 3), False), (one, Checksum(3, 40, 9), True), (one, other, True)):
        with pytest.raises(IncompleteLoad):
            check_sums(read, written, exact)


def spoiled(change, **options):
    return lambda hits, *args: enrich(change(hits), *args, **options)


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize(
    "change",
    [
        lambda hits: hits.where("n <> 2"),
        lambda hits: hits.where("n <> 2").unionAll(hits.where("n = 3")),  # one lost, another doubled
    ],
)
def test_a_load_that_loses_hits_fails(spark, feed, monkeypatch, change, shuffled):
    monkeypatch.setattr(job, "enrich", spoiled(change, **({"broadcast_bytes": 0} if shuffled else {})))
    with pytest.raises(IncompleteLoad):
        run(spark, feed, unique=True)
    assert read_ledger(spark, str(feed / "ledger")).count() == 0
    monkeypatch.undo()
    assert run(spark, feed, unique=True) == LoadReport(3, 5, 5)
    assert lake(spark, feed) == CLOSED


@pytest.mark.parametrize("shuffled", [False, True])
def test_a_write_that_loses_hits_fails(spark, feed, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(job, "enrich", lambda *a, **k: enrich(*a, **k, broadcast_bytes=0))
    real = publishing.write_hits

    def lossy(hits, path, **options):
        real(hits, path, **options)
        next(Path(path).rglob("*.parquet")).unlink()

    with monkeypatch.context() as patch:
        patch.setattr(publishing, "write_hits", lossy)
        with pytest.raises(IncompleteLoad, match="files hold"):
            run(spark, feed)
    assert run(spark, feed) == LoadReport(3, 5, 5)
    assert lake(spark, feed) == CLOSED


def test_checksums_of_a_load(spark, feed):
    report = run(spark, feed, page_size=1)
    assert report.read == report.written and report.read.rows == 5
    lines = spark.createDataFrame([(hit(*x),) for x in ((1, 1), (2, 1, 9), (3, 1, 2), (4, 2), (5, 1))], "v string")
    hashes = [r[0] for r in lines.selectExpr("xxhash64(v)").collect()]
    assert report.read.total == sum(hashes)


def test_only_touched_partitions_are_shown(spark, feed):
    try:
        run(spark, feed, table="touched_hits")
        write_gz(feed / "lake" / "date=2023-01-01" / "part-0.txt.gz", ["never listed"])
        write_gz(feed / "incoming" / "01-suite_20240104-000000.tsv.gz", ["8\t\t1", hit(9, 4)])
        write_gz(feed / "incoming" / "01-suite_20240105-000000.tsv.gz", [hit(10, 5)])
        run(spark, feed, table="touched_hits")
        shown = {r[0] for r in spark.sql("SHOW PARTITIONS touched_hits").collect()}
        days = {f"date={d}" for d in (D1, D2, D3, "2024-01-04", "__HIVE_DEFAULT_PARTITION__")}
        assert {s.replace("date=null", "date=__HIVE_DEFAULT_PARTITION__") for s in shown} == days
        assert spark.table("touched_hits").where("n IN (8, 9)").count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS touched_hits")


def listed(*files):
    head = "Manifest-Version: 1.0\r\nData-Files: 1\r\n\r\n"
    return head + "\r\n".join(f"Data-File: {p.name}\r\nFile-Size: {size}\r\nRecord-Count: 3\r\n" for p, size in files)


def test_days_closed_by_their_manifests(spark, feed):
    """Day 1 is whole, day 2 has a file that is short, day 3 one that is missing; day 1 also has one not listed."""
    incoming = feed / "incoming"
    of = {d: sorted(incoming.glob(f"*_2024010{d}-*.tsv.gz")) for d in (1, 2, 3)}
    whole = [(p, p.stat().st_size) for p in of[1]]
    (incoming / "suite_2024-01-01.txt").write_text(listed(*whole))
    (incoming / "suite_2024-01-02.txt").write_text(listed((of[2][0], of[2][0].stat().st_size + 1)))
    (incoming / "suite_2024-01-03.txt").write_text(listed((of[3][0], of[3][0].stat().st_size), (of[3][0].with_name("01-suite_20240103-010000.tsv.gz"), 9)))
    write_gz(incoming / "01-suite_20240101-230000.tsv.gz", [hit(7, 1)])
    files = classify(list_landing(spark, str(incoming)))
    days = manifest_days(files, read_manifests(spark, files))
    assert rows(days.select("feed_date", "n_listed", "n_missing", "closed")) == [("20240101", 2, 0, True), ("20240102", 1, 1, False), ("20240103", 2, 1, False)]
    assert run(spark, feed, manifests=ManifestNames()).files == 2
    assert lake(spark, feed) == CLOSED[:3]
    # The newest day closes as soon as it is whole.
    late = of[3][0].with_name("01-suite_20240103-010000.tsv.gz")
    write_gz(late, [hit(8, 3)])
    (incoming / "suite_2024-01-03.txt").write_text(listed((of[3][0], of[3][0].stat().st_size), (late, late.stat().st_size)))
    assert run(spark, feed, manifests=ManifestNames()).rows_written == 2
    assert run(spark, feed, manifests=ManifestNames(per_day=2)).files == 0
    assert lake(spark, feed) == sorted([*CLOSED[:3], (6, 1, "A", D3), (8, 1, "A", D3)], key=str)


def test_manifests_without_files(spark, feed):
    files = classify(list_landing(spark, str(feed / "incoming")))
    assert read_manifests(spark, files).count() == 0  # the fixture's manifest lists nothing
    assert read_manifests(spark, files.where("kind = 'data'")).count() == 0
    assert run(spark, feed, manifests=ManifestNames()) == LoadReport(0, 0, 0)


def test_files_without_hits(spark, tmp_path):
    write_gz(tmp_path / "incoming" / "01-suite_20240101-000000.tsv.gz", ["", "\t\t", "x\tx\tx"])
    write_gz(tmp_path / "incoming" / "01-suite_20240102-000000.tsv.gz", [])
    write_gz(tmp_path / "incoming" / "01-suite_20240103-000000.tsv.gz", [hit(1, 2)])
    lookups = {"browser": spark.createDataFrame([(1, "A")], "id bigint, name string")}
    assert run(spark, tmp_path, lookups=lookups, page_size=1) == LoadReport(2, 0, 0)
    assert run(spark, tmp_path, lookups=lookups) == LoadReport(0, 0, 0)
