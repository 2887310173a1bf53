"""Visitors per day that add up: one mergeable sketch of distinct visitors per group, merged for any range.

A sketch keeps the ``2 ** size`` smallest hashes of the visitors it has seen.  Up to that many visitors its count is
exact; above, its relative standard error is about ``1 / sqrt(2 ** size)``.  Sketches are built by partial aggregates,
so a day that holds a third of all hits is a few sketches by the time it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Exact up to 65,536 visitors; at most 512 KB a group.
SIZE = 16


def visitor_sketches(hits: DataFrame, visitor: str, by: Sequence[str | Column] = ("date",), size: int = SIZE) -> DataFrame:
    """Per group: ``hits`` and ``visitors``, a sketch.  Store it; hits without a visitor count as hits alone."""
    return hits.groupBy(*by).agg(F.count(F.lit(1)).alias("hits"), F.theta_sketch_agg(visitor, size).alias("visitors"))


def merged_visitors(sketches: DataFrame, by: Sequence[str | Column] = (), size: int = SIZE) -> DataFrame:
    """Sums of hits and counts of distinct visitors over the groups of stored sketches; ``size`` is that of the sketches."""
    merged = F.theta_sketch_estimate(F.theta_union_agg("visitors", size))
    return sketches.groupBy(*by).agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("hits"), merged.alias("visitors"))
