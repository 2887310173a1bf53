"""Left outer lookup joins that hold up whatever the size of the lookup and the spread of the keys.

A lookup whose measured size is within a bound is broadcast: the hits are not shuffled at all.  A larger
one is joined by shuffle.  There, keys that hold far more than a task's fair share of the hits (NULL,
which never matches, is usually one) are spread over several tasks, and just those keys' lookup rows
are repeated to meet them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20

# Longest lookup to carry inside an expression.
INLINE_ROWS = 1000

# Rough cost of one row in a broadcast hash table, beyond its values.
_ROW_BYTES = 48

# A key is hot when it holds this many times a shuffle task's fair share of the rows.
_HOT_FACTOR = 4


@dataclass(frozen=True)
class Lookup:
    """A lookup of ``id``, ``name`` with its measured size.

    ``names`` is its whole content where it is short and its ids are unique.
    """

    frame: DataFrame
    n_bytes: int
    names: Mapping[int, str] | None = None
    unique: bool = False


def prepare(lookups: Mapping[str, DataFrame], unique: bool = False, inline_rows: int = 0) -> dict[str, Lookup]:
    """Measure lookups, all in one job with partial aggregates; ``unique`` fails on a repeated id.

    Lookups of up to ``inline_rows`` rows are fetched too, so that they can be used without a join.
    """
    parts = []
    for label, lookup in lookups.items():
        texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in ("id", "name")]
        row_bytes = (texts[0] + texts[1] + F.lit(_ROW_BYTES)).cast("bigint")
        sizes = lookup.select("id", row_bytes.alias("b"), F.lit(1).cast("bigint").alias("n"))
        if unique:
            sizes = sizes.groupBy("id").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
        parts.append(
            sizes.agg(
                F.lit(label).alias("label"),
                F.coalesce(F.sum("b"), F.lit(0)).alias("n_bytes"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                # A NULL id never matches, so its copies do no harm.
                F.max(F.when(F.col("id").isNotNull(), F.col("n"))).alias("copies"),
            )
        )
    measured = {row["label"]: row for row in reduce(DataFrame.unionAll, parts).collect()}
    for label, row in measured.items():
        if unique and (row["copies"] or 1) > 1:
            raise ValueError(f"lookup {label!r} holds an id more than once; it would multiply rows")
    short = [label for label, row in measured.items() if row["n_rows"] <= inline_rows]
    names = _fetch({label: lookups[label] for label in short})
    return {label: Lookup(lookups[label], row["n_bytes"], names.get(label), unique) for label, row in measured.items()}


def _fetch(lookups: Mapping[str, DataFrame]) -> dict[str, Mapping[int, str]]:
    """The content of short lookups, except those that repeat an id or have ids that are no integers."""
    plain = {k: v for k, v in lookups.items() if isinstance(v.schema["id"].dataType, T.IntegralType)}
    if not plain:
        return {}
    parts = [v.where("id IS NOT NULL").select(F.lit(k).alias("label"), "id", "name") for k, v in plain.items()]
    ids: dict[str, list] = {label: [] for label in plain}
    for row in reduce(DataFrame.unionAll, parts).collect():
        ids[row["label"]].append((row["id"], row["name"]))
    # An id whose name is NULL reads like a miss.
    return {
        label: {key: name for key, name in found if name is not None}
        for label, found in ids.items()
        if len({key for key, _ in found}) == len(found)
    }


def _hot_keys(hits: DataFrame, key: str, tasks: int) -> DataFrame | None:
    """Keys above the hot threshold with the number of tasks to spread each over.

    One pass over the key column, counting before the shuffle.
    """
    total = Observation()
    keys = hits.select(F.col(key).alias("_hot")).observe(total, F.count(F.lit(1)).alias("n"))
    counts = keys.groupBy("_hot").agg(F.count(F.lit(1)).alias("n"))
    # No more than this many keys can each be above the threshold.
    top = counts.orderBy(F.desc("n")).limit(max(1, tasks // _HOT_FACTOR)).collect()
    if not top:
        return None
    share = total.get["n"] / tasks
    rows = [(row["_hot"], ceil(row["n"] / share)) for row in top if row["n"] > share * _HOT_FACTOR]
    if not rows:
        return None
    schema = T.StructType([T.StructField("_hot", hits.schema[key].dataType), T.StructField("_salts", T.IntegerType())])
    return hits.sparkSession.createDataFrame(rows, schema)


def _salt(hits: DataFrame, salts: Column) -> Column:
    """A number below ``salts`` per row that stays the same when a lost task is run again.

    The partition number parts equal copies of one row; the row hash parts rows within a partition.
    """
    hashable = [f.name for f in hits.schema if not _has_map(f.dataType)]
    return F.pmod(F.xxhash64(*hashable) + F.spark_partition_id(), salts).cast("int")


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind)


def spread_join(
    hits: DataFrame,
    lookup: DataFrame,
    key: str,
    id: str,
    tasks: int | None = None,
    keys: DataFrame | None = None,
    how: str = "left",
) -> DataFrame:
    """Left (outer or anti) join by shuffle, with hot keys of ``hits`` spread over tasks.

    Hot keys are found by counting ``key`` in ``keys``, a cheaper frame with the same key values, or
    else in ``hits``.
    """
    if tasks is None:
        tasks = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = _hot_keys(hits if keys is None else keys, key, tasks)
    if hot is None:
        return hits.join(lookup, F.col(key) == F.col(id), how)
    # ``hot`` has at most tasks / _HOT_FACTOR rows, so it is safe to broadcast.
    marked = hits.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), "left").drop("_hot")
    left = marked.withColumn("_salt", _salt(hits, F.coalesce("_salts", F.lit(1)))).drop("_salts")
    repeats = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = (
        lookup.join(F.broadcast(hot), F.col(id).eqNullSafe(F.col("_hot")), "left")
        .withColumn("_meet", F.explode(repeats))
        .drop("_hot", "_salts")
    )
    same = (F.col(key) == F.col(id)) & (F.col("_salt") == F.col("_meet"))
    return left.join(right, same, how).drop("_salt", "_meet")


def join_lookup(
    hits: DataFrame,
    lookup: DataFrame,
    key: str,
    name: str,
    small: bool,
    tasks: int | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Left outer join of ``hits`` with ``lookup(id, name)``; adds the found name as column ``name``.

    ``key`` has the type of the lookup's id already, see :func:`lookup_key`.  ``small`` says that the
    lookup's size was measured to be within the broadcast bound.  Misses keep their row with a NULL name;
    an id that occurs twice gives two rows.  The matched id stays as ``<name>_match``.
    """
    match = f"{name}_match"
    side = lookup.select(F.col("id").alias(match), F.col("name").alias(name))
    if small:
        return hits.join(F.broadcast(side), F.col(key) == F.col(match), "left")
    return spread_join(hits, side, key, match, tasks, keys)
