import datetime as dt

import pytest
from conftest import rows, write_gz
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlake.sources.hits import drop_empty, read_hits, read_hits_spread, with_date
from hitlake.storage import literal_path

SCHEMA = T.StructType(
    [
        T.StructField("a", T.StringType()),
        T.StructField("sh", T.ShortType()),
        T.StructField("l", T.LongType()),
        T.StructField("date_time", T.TimestampType()),
        T.StructField("bo", T.BooleanType()),
    ]
)
FIRST = dt.datetime(2024, 1, 1, 0, 0, 5)
MIDNIGHT = dt.datetime(2024, 1, 1)

GOLDEN = {
    "a\t1\t2\t2024-01-01 00:00:05\ttrue": ("a", 1, 2, FIRST, True),
    "b\t99999999\t2\t2024-01-01 00:00:05\ttrue": ("b", None, 2, FIRST, True),
    "c\t1": ("c", 1, None, None, None),
    "d\t1\t2\t2024-01-02 23:59:59\tY\textra": ("d", 1, 2, dt.datetime(2024, 1, 2, 23, 59, 59), None),
    '"q\tz"\t1\t2\t2024-01-01 01:00:00\tfalse': ("q\tz", 1, 2, dt.datetime(2024, 1, 1, 1), False),
    "e\\\tf\t1\t2\t2024-01-01 00:00:00\ttrue": ("e\\", None, 1, None, None),
    "g\t\t5\tbad\t": ("g", None, 5, None, None),
    '""\t3\t\t\t': (None, 3, None, None, None),
    'h"x\t3\t4\t2024-01-01 00:00:00\ttrue': ('h"x', 3, 4, MIDNIGHT, True),
}
EMPTY = ["\t\t\t\t", "", '""\t""\t\t\t', "\tbad\t\t\t", "\t\t\t\tx"]


@pytest.fixture()
def feed(tmp_path):
    path = tmp_path / "01-suite_20240101-000000.tsv.gz"
    write_gz(path, [*GOLDEN, *EMPTY])
    return str(path)


def scans(spark, feed):
    return {
        "file": read_hits(spark, feed, SCHEMA),
        "spread": read_hits_spread(spark, [feed], 3, SCHEMA),
    }


@pytest.mark.parametrize("scan", ["file", "spread"])
def test_golden_rows(spark, feed, scan):
    raw = scans(spark, feed)[scan]
    assert raw.schema == SCHEMA
    assert rows(drop_empty(raw)) == sorted(GOLDEN.values(), key=str)
    # Blank lines never become rows; rows without any value do, and drop_empty takes them out.
    assert raw.count() == len(GOLDEN) + 3


def test_many_files_in_one_read(spark, tmp_path):
    paths = [tmp_path / f"01-suite_2024010{i}-000000.tsv.gz" for i in (1, 2)]
    for i, path in enumerate(paths):
        write_gz(path, [f"x{i}\t{i}\t{i}\t\t"])
    expected = [("x0", 0, 0, None, None), ("x1", 1, 1, None, None)]
    assert rows(read_hits(spark, [str(p) for p in paths], SCHEMA)) == expected
    assert rows(read_hits_spread(spark, [str(p) for p in paths], 2, SCHEMA)) == expected


def test_corrupt_column_keeps_the_line(spark, feed):
    raw = read_hits(spark, feed, SCHEMA, corrupt_column="_bad").cache()
    bad = {row["_bad"] for row in raw.where("_bad IS NOT NULL").collect()}
    assert "\tbad\t\t\t" in bad and "g\t\t5\tbad\t" in bad
    assert "a\t1\t2\t2024-01-01 00:00:05\ttrue" not in bad
    raw.unpersist()


def test_drop_empty_on_some_columns(spark):
    frame = spark.createDataFrame([(1, None, None), (2, 1, None)], "k int, a int, b int")
    assert rows(drop_empty(frame, ["a", "b"])) == [(2, 1, None)]


def test_date_is_the_wall_clock_day(spark, feed):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Pacific/Auckland", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", other)
            dated = with_date(read_hits(spark, feed, SCHEMA).where("a = 'd'"))
            assert dated.selectExpr("string(date)").first()[0] == "2024-01-02"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_unused_columns_are_not_parsed(spark, feed):
    plan = read_hits(spark, feed, SCHEMA).select("a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:string>" in plan


def test_listed_paths_are_literal(spark, tmp_path):
    odd, other = tmp_path / "x[1]_20240101-000000.tsv.gz", tmp_path / "x1_20240101-000000.tsv.gz"
    write_gz(odd, ["odd\t\t\t\t"])
    write_gz(other, ["other\t\t\t\t"])
    assert [r["a"] for r in read_hits_spread(spark, [literal_path(str(odd))], 1, SCHEMA).collect()] == ["odd"]


def test_days_go_to_their_own_tasks(spark, tmp_path):
    sizes = {"20240101": 300, "20240102": 10}
    paths = []
    for day, n in sizes.items():
        paths.append(tmp_path / f"01-suite_{day}-000000.tsv.gz")
        # Copies of one line: they still part over the tasks.
        write_gz(paths[-1], [f"{day}\t1\t1\t\t"] * n)
    hits = read_hits_spread(spark, [str(p) for p in paths], {"20240101": 3, "20240102": 1}, SCHEMA)
    found = hits.groupBy("a", F.spark_partition_id().alias("task")).count()
    assert rows(found) == [("20240101", 0, 100), ("20240101", 1, 100), ("20240101", 2, 100), ("20240102", 3, 10)]


def test_file_of_an_unknown_day_is_still_read(spark, tmp_path):
    write_gz(tmp_path / "01-suite_20240109-000000.tsv.gz", ["x\t1\t1\t\t"])
    hits = read_hits_spread(spark, [str(tmp_path)], {"20240101": 2}, SCHEMA)
    assert rows(hits) == [("x", 1, 1, None, None)]
