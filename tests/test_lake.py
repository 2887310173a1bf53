import datetime as dt
import shutil

import pytest
from conftest import rows
from pyspark.sql import DataFrameWriter

from hitlake.plans.lake import (
    add_columns,
    business_join,
    hits_on,
    not_loaded,
    refresh,
    register,
    write_hits,
)

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def hits(spark, *data):
    return spark.createDataFrame(list(data), "n bigint, date date")


def files(path, date):
    return list((path / f"date={date}").glob("*.parquet"))


@pytest.fixture()
def table(spark, request):
    name = f"t_{abs(hash(request.node.name))}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_append_keeps_what_is_there(spark, tmp_path):
    lake = tmp_path / "lake"
    write_hits(hits(spark, (1, D1), (2, D2)), str(lake))
    write_hits(hits(spark, (3, D1), (4, None)), str(lake))
    assert rows(spark.read.parquet(str(lake))) == [(1, D1), (2, D2), (3, D1), (4, None)]
    assert files(lake, "__HIVE_DEFAULT_PARTITION__")


def test_files_per_date(spark, tmp_path):
    many = spark.range(4000, numPartitions=16).selectExpr(
        "id AS n", "date_add(DATE '2024-01-01', int(id % 2)) AS date"
    )
    for files_given, most in ((4, 4), (1, 1), (None, 1)):
        lake = tmp_path / f"lake{files_given}"
        write_hits(many, str(lake), files=files_given)
        assert spark.read.parquet(str(lake)).count() == 4000
        assert 1 <= len(files(lake, D1)) <= most
        assert 1 <= len(files(lake, D2)) <= most


def test_a_big_date_is_split(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64KB")
    try:
        many = spark.range(200_000, numPartitions=8).selectExpr(
            "id AS n", "IF(id % 1000 = 0, DATE '2024-01-02', DATE '2024-01-01') AS date"
        )
        lake = tmp_path / "lake"
        write_hits(many, str(lake))
        assert len(files(lake, D1)) > 2
        assert len(files(lake, D2)) == 1
        assert spark.read.parquet(str(lake)).count() == 200_000
    finally:
        spark.conf.set(size, before)


def test_register_and_refresh(spark, tmp_path, table):
    lake = tmp_path / "la'ke"
    first = hits(spark, (1, D1), (2, D2))
    write_hits(first, str(lake))
    register(spark, table, str(lake), first)
    register(spark, table, str(lake), first)
    assert spark.table(table).count() == 0
    refresh(spark, table)
    assert rows(spark.table(table)) == [(1, D1), (2, D2)]
    write_hits(hits(spark, (3, D3)), str(lake))
    assert spark.table(table).count() == 2
    refresh(spark, table)
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == [f"date={d}" for d in (D1, D2, D3)]
    shutil.rmtree(lake / f"date={D1}")
    refresh(spark, table, sync=True)
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == [f"date={d}" for d in (D2, D3)]


def test_one_day_reads_one_partition(spark, tmp_path, table):
    first = hits(spark, (1, D1), (2, D2))
    write_hits(first, str(tmp_path / "lake"))
    register(spark, table, str(tmp_path / "lake"), first)
    refresh(spark, table)
    assert rows(hits_on(spark, table, "2024-01-02")) == [(2, D2)]
    found = spark.sql(f"SELECT * FROM {table} WHERE date = '2024-01-02'")
    assert rows(found) == [(2, D2)]
    for query in (found, hits_on(spark, table, "2024-01-02")):
        assert "PartitionFilters: [isnotnull(date" in query._jdf.queryExecution().toString()


def test_new_columns(spark, tmp_path, table):
    lake = str(tmp_path / "lake")
    first = hits(spark, (1, D1))
    write_hits(first, lake)
    register(spark, table, lake, first)
    wider = spark.createDataFrame([(2, "x", D1)], "n bigint, extra string, date date")
    assert add_columns(spark, table, wider) == ["extra"]
    assert add_columns(spark, table, wider) == []
    write_hits(wider, lake)
    refresh(spark, table)
    assert rows(spark.table(table).select("n", "extra", "date")) == [(1, None, D1), (2, "x", D1)]


def test_not_loaded(spark, tmp_path):
    kind = "high string, low string, date date"
    lake = str(tmp_path / "lake")
    new = spark.createDataFrame(
        [("1", "1", D1), ("1", "2", D1), ("1", None, D1), (None, None, None), ("1", "1", D2)], kind
    )
    assert rows(not_loaded(new, lake, ["high", "low"])) == rows(new)
    write_hits(spark.createDataFrame([("1", "1", D1), ("1", None, D1), (None, None, None)], kind), lake)
    assert rows(not_loaded(new, lake, ["high", "low"])) == [
        ("1", "1", D2),
        ("1", "2", D1),
        ("1", None, D1),
        (None, None, None),
    ]


def test_hits_without_identity_are_always_new(spark, tmp_path):
    lake = str(tmp_path / "lake")
    new = spark.range(4000).selectExpr("IF(id % 4 = 0, id, NULL) AS k", "id AS n", "DATE '2024-01-01' AS date")
    write_hits(new.where("k IS NULL OR k < 2000"), lake)
    left = not_loaded(new, lake, ["k"])
    assert rows(left.select("n")) == rows(new.where("k >= 2000 OR k IS NULL").select("n"))


def test_business_join(spark):
    lake = spark.createDataFrame([(1, D1), (1, D1), (2, D1), (3, D2), (9, D2)], "user bigint, date date")
    customers = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b")], "key bigint, segment string")
    out = business_join(lake, customers, "user", "key", ["segment"], "user")
    assert rows(out) == [("a", D1, 3, 2), ("b", D2, 1, 1)]


def test_dates_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """A task keeps the files of a few dates open; with more dates than that nothing is lost or cut up."""
    seen, own = [], DataFrameWriter.parquet
    number = lambda: spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(int(number())), own(self, path)))
    data = [(n, None if n % 9 == 8 else D1 + dt.timedelta(days=n % 9)) for n in range(900)]
    write_hits(hits(spark, *data).coalesce(1), str(tmp_path), clustered=True)
    assert seen[0] > 1 and number() == "0"
    assert rows(spark.read.parquet(str(tmp_path)).select("n", "date")) == sorted(data, key=str)
    assert all(len(files(tmp_path, D1 + dt.timedelta(days=n))) == 1 for n in range(8))
