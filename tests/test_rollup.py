import pytest
from conftest import rows

from hitlake.plans.rollup import merged_visitors, visitor_sketches


def test_exact_below_the_sketch(spark):
    hits = [(d, v) for d in range(4) for v in ("a", "b", f"only{d}", None)] + [(9, None)]
    frame = spark.createDataFrame(hits, "date int, who string")
    daily = visitor_sketches(frame, "who")
    assert rows(merged_visitors(daily, ["date"])) == sorted([*((d, 4, 3) for d in range(4)), (9, 1, 0)], key=str)
    assert rows(merged_visitors(daily)) == [(17, 6)]
    assert rows(merged_visitors(daily.where("date in (1, 2)"))) == [(8, 4)]


def test_error_above_the_sketch(spark):
    frame = spark.range(60_000).selectExpr("CAST(id % 6 AS INT) AS date", "id % 40000 AS who")
    (n_hits, found), = rows(merged_visitors(visitor_sketches(frame, "who", size=10), size=10))
    assert n_hits == 60_000 and found != 40_000
    assert found == pytest.approx(40_000, rel=5 / 1024**0.5)


def test_no_hits(spark):
    empty = visitor_sketches(spark.createDataFrame([], "date int, who string"), "who")
    assert rows(merged_visitors(empty, ["date"])) == [] and merged_visitors(empty).first()["hits"] == 0
