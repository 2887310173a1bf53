import pytest
from conftest import rows, write_bundle, write_gz
from pyspark.sql import types as T

import hitlake.sources.landing as landing_module
from hitlake.plans.ledger import mark_done, read_ledger, seal, sealable, sealed_days
from hitlake.plans.load import load
from hitlake.sources.landing import classify, list_unsealed

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("date_time", T.TimestampType()), T.StructField("browser", T.LongType())])


def put(root, day, hour, n):
    write_gz(root / f"2024-01-0{day}" / f"01-suite_2024010{day}-{hour:02}0000.tsv.gz", [f"{n}\t2024-01-0{day} 10:00:00\t1"])


@pytest.fixture()
def root(tmp_path):
    root = tmp_path / "in[1]"
    for day in range(1, 6):
        put(root, day, 0, day)
    (root / "odd").mkdir()
    (root / "odd" / "note.txt").write_text("x")
    (root / "_temporary").mkdir()
    (root / "empty.txt").write_text("")
    write_bundle(root / "suite_20240105-000000-lookup_data.tar.gz", {"browser.tsv": b"1\tA"})
    return root


def ends(frame):
    return sorted(row["path"].rsplit("/", 1)[1] for row in frame.collect())


def test_sealed_days_are_not_listed(spark, root, tmp_path, monkeypatch):
    ledger = str(tmp_path / "ledger")
    everything = list_unsealed(spark, str(root), sealed_days(read_ledger(spark, ledger)))
    assert len(ends(everything)) == 7
    files = classify(everything)
    mark_done(files.where("feed_date IN ('20240101', '20240102', '20240104')"), ledger)
    days = sealable(files, read_ledger(spark, ledger), keep=2)
    assert rows(days) == [("20240101",), ("20240102",)]
    seal(days, ledger)
    put(root, 1, 5, 9)  # comes too late to be seen
    asked = []
    listing = landing_module.list_landing
    monkeypatch.setattr(landing_module, "list_landing", lambda session, paths: asked.extend(paths) or listing(session, paths))
    found = list_unsealed(spark, str(root), sealed_days(read_ledger(spark, ledger)))
    assert ends(found) == [f"01-suite_2024010{d}-000000.tsv.gz" for d in (3, 4, 5)] + ["note.txt", "suite_20240105-000000-lookup_data.tar.gz"]
    assert not any("2024-01-01" in path or "2024-01-02" in path for path in asked)


def test_all_sealed_and_empty(spark, tmp_path):
    root = tmp_path / "incoming"
    put(root, 1, 0, 1)
    sealed = spark.createDataFrame([("20240101",), ("20240101",)], "feed_date string")
    assert list_unsealed(spark, str(root), sealed).collect() == []
    assert list_unsealed(spark, str(root), sealed).columns == ["path", "length", "modificationTime"]
    assert len(ends(list_unsealed(spark, str(root), sealed.limit(0)))) == 1


def test_the_newest_day_is_never_sealed(spark):
    with pytest.raises(ValueError, match="at least 1"):
        sealable(None, None, keep=0)


def test_a_load_seals_and_goes_on(spark, root, tmp_path):
    def run():
        return load(spark, str(root), str(tmp_path / "lake"), str(tmp_path / "ledger"), SCHEMA, [("browser", "browser")], day_folder=landing_module.DAY_FOLDER, seal_after=2)

    assert run().rows_written == 4
    assert rows(sealed_days(read_ledger(spark, str(tmp_path / "ledger")))) == [("20240101",), ("20240102",), ("20240103",)]
    put(root, 4, 7, 40)
    put(root, 6, 0, 6)
    assert run().rows_written == 2
    assert rows(spark.read.parquet(str(tmp_path / "lake")).select("n")) == sorted([(n,) for n in (1, 2, 3, 4, 40, 5)], key=str)
    days = read_ledger(spark, str(tmp_path / "ledger")).where("path LIKE 'sealed day %'")
    assert rows(days.select("feed_date")) == [("20240101",), ("20240102",), ("20240103",), ("20240104",)]
