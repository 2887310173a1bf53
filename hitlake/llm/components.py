"""Connected components of an edge list, by large-star and small-star steps over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlake.storage import scratch_path


def _stored(edges: DataFrame) -> DataFrame:
    path = scratch_path(edges.sparkSession, "edges")
    edges.write.parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node that can be reached.

    Each step halves the distance to the root at least, so the number of steps grows with the logarithm of the
    longest path.  A node's neighbours are never gathered: only their minimum is.
    """
    edges = _stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = _stored(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = _stored(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
