import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from hitlake.operators.as_of_join import as_of_join


def brute(hits, history):
    out = []
    for n, key, time in hits:
        found = [(t, v) for k, t, v in history if k is not None and t is not None and k == key and time is not None and t <= time]
        out.append((n, key, time, max(found)[1] if found else None))
    return out


def frames(spark, hits, history):
    return spark.createDataFrame(hits, "n bigint, user string, at int"), spark.createDataFrame(history, "who string, since int, plan string")


@pytest.mark.parametrize("tasks", [1, 3, 40])
@pytest.mark.parametrize("batch", [3, 10_000])
def test_last_known_rows(spark, tasks, batch):
    draw = random.Random(tasks)
    # Half of the hits are of one key; some keys have no history, some a gap of many ranges before their hits.
    hits = [(n, draw.choice(["hot", "hot", "a", "b", "c", "none", None]), draw.choice([None, *range(60)])) for n in range(800)]
    history = [(k, t, f"{k}{t}") for k in ("hot", "a", "c", "unseen") for t in draw.sample(range(60), 7)]
    history += [("b", 0, "b0"), (None, 3, "x"), ("a", None, "y")]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = as_of_join(*frames(spark, hits, history), "user", "who", "at", "since", ["plan"], tasks)
        assert out.columns == ["n", "user", "at", "plan"]
        assert rows(out) == sorted(brute(hits, history), key=str)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_one_key_and_time_is_spread(spark):
    hits = spark.range(4000).selectExpr("id AS n", "'hot' AS user", "5 AS at")
    history = spark.createDataFrame([("hot", 5, "now"), ("hot", 6, "later")], "who string, since int, plan string")
    out = as_of_join(hits, history, "user", "who", "at", "since", ["plan"], 8)
    assert out.where("plan = 'now'").count() == 4000
    path = out.inputFiles()
    assert len({name for name in path}) >= 6  # the tasks that held hits


def test_nothing_on_either_side(spark):
    hits, history = frames(spark, [(1, "a", 3)], [("a", 1, "x")])
    join = lambda one, other: as_of_join(one, other, "user", "who", "at", "since", ["plan"], 4)
    assert rows(join(hits, history.where("false"))) == [(1, "a", 3, None)]
    assert rows(join(hits.where("false"), history)) == []
    with pytest.raises(ValueError, match="already"):
        as_of_join(hits.withColumn("plan", F.lit(1)), history, "user", "who", "at", "since", ["plan"])
