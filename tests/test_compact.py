import datetime as dt

import pytest
from conftest import rows

import hitlake.plans.compact as compaction
from hitlake.plans.compact import Miscounted, compact, file_bins
from hitlake.plans.lake import write_hits
from hitlake.plans.publish import STEPS, recover

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


@pytest.fixture()
def lake(spark, tmp_path):
    """Three loads: one date has three files, one has two, hits without a date have two, one date has one."""
    path = str(tmp_path / "lake")
    for n, days in enumerate([[D1, D2, None], [D1, D2, None], [D1, dt.date(2024, 1, 3)]]):
        data = [(10 * n + k, day) for k, day in enumerate(days)]
        frame = spark.createDataFrame(data, "n bigint, date date")
        write_hits(frame if n else frame.selectExpr("n", "'first' AS extra", "date"), path)
    return path


def held(spark, path):
    return rows(spark.read.option("mergeSchema", "true").parquet(path).select("n", "extra", "date"))


def files(path):
    import pathlib

    return sorted(p.parent.name for p in pathlib.Path(path).rglob("*.parquet"))


def test_small_files_become_one_per_date(spark, lake):
    before = held(spark, lake)
    assert compact(spark, lake) == (7, 3)
    assert held(spark, lake) == before and len(before) == 8
    assert files(lake) == ["date=2024-01-01", "date=2024-01-02", "date=2024-01-03", "date=__HIVE_DEFAULT_PARTITION__"]
    assert compact(spark, lake) == (0, 0)


def test_bins_are_bounded(spark, lake):
    for n in range(6):
        write_hits(spark.createDataFrame([(100 + n, D1)], "n bigint, date date"), lake)
    sizes = [r["length"] for r in file_bins(spark, lake).collect()]
    size = 2 * max(sizes) + 2
    bins = [r for r in file_bins(spark, lake, size).groupBy("folder", "bin").agg({"length": "sum", "*": "count"}).collect()]
    assert len([r for r in bins if r["folder"] == f"date={D1}"]) > 1
    assert all(r["sum(length)"] < 1.5 * size and r["count(1)"] > 1 for r in bins)
    # Nothing is small.
    assert file_bins(spark, lake, min(sizes)).isEmpty()


@pytest.mark.parametrize("step", STEPS)
def test_a_stop_after_any_step(spark, lake, step):
    before = held(spark, lake)

    def stop(done):
        if done == step:
            raise RuntimeError("stopped")

    with pytest.raises(RuntimeError, match="stopped"):
        compact(spark, lake, page_size=1, stop=stop)
    recover(spark, lake)
    assert held(spark, lake) == before
    compact(spark, lake)
    assert held(spark, lake) == before and len(files(lake)) == 4


def test_lost_rows_are_noticed(spark, lake, monkeypatch):
    before = held(spark, lake)
    real = compaction.stage
    with monkeypatch.context() as patch:
        patch.setattr(compaction, "stage", lambda hits, *a, **k: real(hits.where("n <> 0"), *a, **k))
        with pytest.raises(Miscounted):
            compact(spark, lake)
    assert held(spark, lake) == before
    assert compact(spark, lake) == (7, 3)


def test_no_lake(spark, tmp_path):
    assert compact(spark, str(tmp_path / "none")) == (0, 0)
