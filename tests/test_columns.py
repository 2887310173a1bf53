import datetime as dt

import pytest
from conftest import rows, write_bundle, write_gz
from pyspark.sql import types as T

from hitlake.plans.load import load
from hitlake.sources.bundle import read_headers
from hitlake.sources.columns import aligned, headers_by_day, merged, positioned, wider
from hitlake.sources.landing import classify, list_landing

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("date_time", T.TimestampType()), T.StructField("browser", T.LongType())])


def bundle(root, day, header=None):
    members = {"browser.tsv": b"1\tA\n2\tB"} | ({"column_headers.tsv": header.encode()} if header else {})
    write_bundle(root / f"suite_{day}-000000-lookup_data.tar.gz", members)


def test_widening():
    short, long, text, whole = T.ShortType(), T.LongType(), T.StringType(), T.IntegerType()
    assert wider(short, long) == wider(long, short) == long and wider(whole, short) == whole
    assert wider(long, T.DoubleType()) == text and wider(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.NullType(), short) == wider(short, T.NullType()) == short
    both = merged([T.StructType().add("a", short).add("b", text), T.StructType().add("c", long).add("a", long)])
    assert [(f.name, f.dataType) for f in both] == [("a", long), ("b", text), ("c", long)]


def test_positions():
    found = positioned(["Browser", "new", "n"], SCHEMA)
    assert [(f.name, f.dataType) for f in found] == [("browser", T.LongType()), ("new", T.StringType()), ("n", T.LongType())]
    with pytest.raises(ValueError, match="twice"):
        positioned(["n", "N"], SCHEMA)


def test_alignment(spark):
    frame = spark.createDataFrame([("x", 1, "y")], "extra string, n short, odd string")
    out = aligned(frame, SCHEMA)
    assert out.columns == ["n", "date_time", "browser", "extra", "odd"] and rows(out) == [(1, None, None, "x", "y")]
    assert out.schema["n"].dataType == T.LongType()


def test_headers(spark, tmp_path):
    bundle(tmp_path, "20240102", "n\tdate_time\r\n")
    bundle(tmp_path, "20240104", "\nbrowser\tn")
    bundle(tmp_path, "20240105")
    files = classify(list_landing(spark, str(tmp_path)))
    paths = [r["path"] for r in files.collect()]
    assert sorted(read_headers(spark, paths).values()) == [("browser", "n"), ("n", "date_time")]
    got = headers_by_day(spark, files, ["20240101", "20240102", "20240103", "20240104", "20240106"])
    one, two = ("n", "date_time"), ("browser", "n")
    assert got == {"20240101": one, "20240102": one, "20240103": one, "20240104": two, "20240106": two}
    assert headers_by_day(spark, files.where("kind = 'data'"), ["20240101"]) == {"20240101": None}
    assert read_headers(spark, []) == {}


def test_a_feed_that_changes(spark, tmp_path):
    root = tmp_path / "in"
    bundle(root, "20240101", "n\tdate_time\tbrowser")
    write_gz(root / "01-suite_20240101-000000.tsv.gz", ["1\t2024-01-01 10:00:00\t1"])
    bundle(root, "20240102", "browser\tcolour\tdate_time\tn")
    write_gz(root / "01-suite_20240102-000000.tsv.gz", ["2\tred\t2024-01-02 10:00:00\t2", "\tonly\t\t", "\t\t\t"])
    bundle(root, "20240103", "date_time\tn")
    write_gz(root / "01-suite_20240103-000000.tsv.gz", ["2024-01-03 10:00:00\t3"])
    paths = [str(tmp_path / name) for name in ("in", "lake", "ledger")]
    try:
        load(spark, *paths, SCHEMA, [("browser", "browser")], include_open=True, header_member="column_headers.tsv", table="changing_hits", page_size=1)
        found = rows(spark.table("changing_hits").select("n", "browser", "colour", "date"))
    finally:
        spark.sql("DROP TABLE IF EXISTS changing_hits")
    expected = [(1, "A", None, dt.date(2024, 1, 1)), (2, "B", "red", dt.date(2024, 1, 2)), (3, None, None, dt.date(2024, 1, 3)), (None, None, "only", None)]
    assert found == sorted(expected, key=str)
