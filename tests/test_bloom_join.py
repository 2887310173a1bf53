import pytest
from conftest import rows
from pyspark.sql import functions as F

from hitlake.operators.bloom_join import bloom_join_lookup, id_filter, n_blocks_for, split_by_ids
from hitlake.operators.lookup_join import join_lookup


def lookup_of(spark, n, step=1):
    return spark.range(0, n * step, step).select("id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))


def shuffled_rows(frame):
    """Rows that went through the shuffles of a plan that has run."""

    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(plan.plan())
        if kind == "BroadcastExchangeExec":
            return 0
        own = plan.metrics().get("shuffleRecordsWritten").get().value() if kind == "ShuffleExchangeExec" else 0
        children = plan.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(frame._jdf.queryExecution().executedPlan())


def test_same_rows_as_the_plain_join(spark):
    keys = spark.range(4000).select("id", F.when(F.col("id") % 5 != 0, F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).cast("bigint").alias("key"))
    lookup = lookup_of(spark, 500, 3).unionAll(spark.createDataFrame([(9, "again"), (None, "no id"), (12, None)], "id bigint, name string"))
    ours = bloom_join_lookup(keys, lookup, "key", "found", 8)
    plain = join_lookup(keys, lookup, "key", "found", False, 8)
    assert ours.columns == plain.columns
    assert rows(ours) == rows(plain)


def test_no_id_is_missed_and_few_misses_pass(spark):
    lookup, n_blocks = lookup_of(spark, 40_000), n_blocks_for(40_000)
    blocks = id_filter(lookup, n_blocks)
    assert [len(r["words"]) for r in blocks.collect()] == [512] * n_blocks
    may, never = split_by_ids(spark.range(140_000), "id", blocks, n_blocks)
    assert may.where("id < 40000").count() == 40_000
    assert may.count() + never.count() == 140_000
    assert may.count() < 40_000 + 100_000 * 0.02


def test_misses_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits, lookup = spark.range(0, 100_000).select(F.col("id").alias("key")), lookup_of(spark, 2000)
        found = [f(hits, lookup) for f in (lambda h, k: bloom_join_lookup(h, k, "key", "n", 8), lambda h, k: join_lookup(h, k, "key", "n", False, 8))]
        for frame in found:
            assert len(frame.collect()) == 100_000
        assert shuffled_rows(found[0]) < 10_000 < 100_000 <= shuffled_rows(found[1])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_sides_and_text_ids(spark):
    empty = spark.createDataFrame([], "id string, name string")
    hits = spark.createDataFrame([("a",), (None,), ("",)], "key string")
    assert rows(bloom_join_lookup(hits, empty, "key", "n")) == rows(hits.selectExpr("key", "NULL", "NULL"))
    named = spark.createDataFrame([("a", "A"), ("", "E")], "id string, name string")
    assert {tuple(r) for r in bloom_join_lookup(hits, named, "key", "n").collect()} == {("a", "a", "A"), (None, None, None), ("", "", "E")}
    assert bloom_join_lookup(hits.limit(0), named, "key", "n").count() == 0


def test_size_and_types_are_checked(spark):
    assert n_blocks_for(0) == 1
    assert n_blocks_for(1 << 20) * 4096 == 2 << 20
    assert n_blocks_for(1 << 20, max_bytes=1 << 20) * 4096 == 1 << 20
    assert n_blocks_for(1 << 20, max_bytes=1 << 19) is None
    assert bloom_join_lookup(spark.range(5).toDF("key"), lookup_of(spark, 3), "key", "n", max_bytes=0).count() == 5
    with pytest.raises(ValueError, match="int but the lookup's id is bigint"):
        bloom_join_lookup(spark.range(3).selectExpr("cast(id AS int) AS key"), lookup_of(spark, 3), "key", "n")
