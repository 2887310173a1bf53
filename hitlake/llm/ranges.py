"""Rows dealt out in order of an integer key: ranges of about equal counts, each sorted, none in one task alone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A row without a key comes before all others.
NO_KEY = -(1 << 63)


def in_order(rows: DataFrame, key: str, text: str, parts: int, tail: bool = False) -> DataFrame:
    """(range, tail, key, text), each range a partition of its own and sorted by key, then text.

    Ranges ascend with the key.  With ``tail``, each range ends with a copy of the first row of the next one (of the
    first range, after the last), marked by ``tail``.  Only the bounds and first keys, one per range, pass the driver.
    """
    chosen = rows.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    place = F.coalesce("key", F.lit(NO_KEY))
    cuts = chosen.select(place.cast("double").alias("k")).approxQuantile("k", [n / parts for n in range(1, parts)], 0.2 / parts)
    bounds = np.array(sorted({int(c) for c in cuts}), np.int64)

    @F.pandas_udf("int")
    def number(places: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in places:
            yield pd.Series(np.searchsorted(bounds, some.to_numpy(), "right").astype(np.int32))

    placed = chosen.withColumn("range", number(place) if len(bounds) else F.lit(0))
    if tail:
        firsts = dict(chosen.select(place.alias("k")).withColumn("range", number("k") if len(bounds) else F.lit(0)).groupBy("range").agg(F.min("k")).collect())
        order = sorted(firsts)
        ahead = [(firsts[order[n]], order[n - 1]) for n in range(len(order))]  # the first row of all goes after the last
        homes = F.broadcast(rows.sparkSession.createDataFrame(ahead, "first bigint, home int"))  # a row for each range
        copies = placed.join(homes, place == F.col("first")).select(F.col("home").alias("range"), F.lit(1).alias("tail"), "key", "text")
        placed = placed.select("range", F.lit(0).alias("tail"), "key", "text").unionAll(copies)
    else:
        placed = placed.select("range", F.lit(0).alias("tail"), "key", "text")
    ranges = len(bounds) + 1
    return placed.repartitionById(ranges, "range").sortWithinPartitions("range", "tail", F.col("key").asc_nulls_first(), "text")
