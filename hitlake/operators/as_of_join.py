"""As-of join: each hit with the last row of a history that its key had by the hit's time.

Both sides are sorted together by key and time and cut into ranges of about equal rows, so a key that holds a large
part of all hits is spread over many tasks.  A task carries the last row of the history forward within its range.  Hits
at the beginning of a range can belong to a row of an earlier one: the last row of each range, one row per task, is
handed on to the ranges after it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlake.storage import scratch_path


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, side, hit, found) to hits with what is found in this range, and one row for those after it."""
    part = TaskContext.get().partitionId()
    first = last_key = last_found = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key, side, hit, found = (batch.column(name) for name in ("key", "side", "hit", "found"))
        first = key[0] if first is None else first
        changes = np.append(True, pc.invert(pc.equal(key[1:], key[:-1])).to_numpy(zero_copy_only=False))
        begin = np.maximum.accumulate(np.where(changes, np.arange(n), 0))  # of the row's key, within the batch
        known = np.maximum.accumulate(np.where(side.to_numpy() == 0, np.arange(n), -1))
        place = np.where(known >= begin, known, -1)
        values = found
        if last_found is not None:
            values = pa.concat_arrays([found, last_found])
            if key[0].equals(last_key):
                place = np.where((begin == 0) & (place < 0), n, place)
        is_hit = side.to_numpy() == 1
        chosen = place[is_hit]
        made = values.take(pa.array(np.where(chosen < 0, 0, chosen), mask=chosen < 0))
        own = key.filter(pa.array(is_hit))
        is_open = pc.and_(pa.array(chosen < 0), pc.equal(own, first))
        count = int(is_hit.sum())
        yield pa.RecordBatch.from_arrays([pa.array([part] * count, pa.int32()), pa.array([False] * count, pa.bool_()), is_open, own, hit.filter(pa.array(is_hit)), made], ["part", "last", "open", "key", "hit", "found"])
        if known[-1] >= 0:
            last_key, last_found = key[int(known[-1])], found.slice(int(known[-1]), 1)
            empty = pa.nulls(1, hit.type)
    if last_found is not None:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([True]), pa.array([False]), pa.array([last_key.as_py()], last_key.type), empty, last_found], ["part", "last", "open", "key", "hit", "found"])


def as_of_join(
    hits: DataFrame,
    history: DataFrame,
    hit_key: str,
    history_key: str,
    hit_time: str,
    history_time: str,
    columns: Sequence[str],
    tasks: int | None = None,
) -> DataFrame:
    """Every hit once, with ``columns`` of its key's last row of ``history`` at or before its time, else NULL.

    Of several rows of one key and time, any one is taken, the same in every run.  A hit without key or time finds
    nothing, and a row of the history without them is never found.  Rows that share key and time, however many, are
    spread as well.  Keys must be of one type, times too.
    """
    spark = hits.sparkSession
    clash = set(columns) & set(hits.columns)
    if clash:
        raise ValueError(f"hits have columns of these names already: {sorted(clash)}")
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = F.struct(*[F.col(f"`{c}`") for c in hits.columns])
    wanted = F.struct(*[F.col(f"`{c}`") for c in columns])
    hit_type = T.StructType([hits.schema[c] for c in hits.columns])
    found_type = T.StructType([T.StructField(c, history.schema[c].dataType) for c in columns])
    key_type = hits.schema[hit_key].dataType
    placed = F.col(hit_key).isNotNull() & F.col(hit_time).isNotNull()
    ours = hits.where(placed).select(F.col(hit_key).alias("key"), F.col(hit_time).alias("time"), F.lit(1).alias("side"), F.xxhash64(*hits.columns).alias("hash"), every.alias("hit"), F.lit(None).cast(found_type).alias("found"))
    known = history.where(F.col(history_key).isNotNull() & F.col(history_time).isNotNull())
    theirs = known.select(F.col(history_key).cast(key_type).alias("key"), F.col(history_time).alias("time"), F.lit(0).alias("side"), F.xxhash64(*columns).alias("hash"), F.lit(None).cast(hit_type).alias("hit"), wanted.alias("found"))
    order = ["key", "time", "side", "hash"]
    rows = ours.unionAll(theirs).repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("key", "side", "hit", "found")
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("last", T.BooleanType()), T.StructField("open", T.BooleanType()), T.StructField("key", key_type), T.StructField("hit", hit_type), T.StructField("found", found_type)])
    path = scratch_path(spark, "as-of")
    rows.mapInArrow(_carried, schema).write.parquet(path)
    stored = spark.read.schema(schema).parquet(path)

    # One row per task: what the ranges before each range end with.
    ends = {row["part"]: row for row in stored.where("last").select("part", "key", "found").collect()}
    carry, handed = None, []
    for part in range(tasks):
        if carry is not None:
            handed.append((part, carry["key"], carry["found"]))
        carry = ends.get(part, carry)
    before = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("key", key_type), T.StructField("before", found_type)])
    handed = F.broadcast(spark.createDataFrame(handed, before))
    closed = stored.where("NOT last AND NOT open").select("hit", "found")
    late = stored.where("NOT last AND open").drop("found").join(handed, ["part", "key"], "left").select("hit", F.col("before").alias("found"))
    out = closed.unionAll(late).select("hit.*", *[F.col("found")[c].alias(c) for c in columns])
    return out.unionAll(hits.where(~placed).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in found_type]))
