"""The lake: a Parquet table partitioned by ``date``, its catalog entry, and queries on it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlake.storage import exists


#: Dates that a task writes at once; only the hits of any further ones are sorted by date.
OPEN_DATES = 4
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _dates_at_once(spark: SparkSession) -> Iterator[None]:
    """Tasks keep ``OPEN_DATES`` files open, unless the session has a number of its own.

    Spark otherwise sorts all rows of a task by date before it writes them: rows of hundreds of columns, of which a
    sort holds many times the bytes that the files take.
    """
    own = spark.conf.get(_WRITERS, "0")
    if own != "0":
        yield
        return
    spark.conf.set(_WRITERS, str(OPEN_DATES))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, own)


def write_hits(hits: DataFrame, target: str, files: int | None = None, clustered: bool = False) -> None:
    """Append hits to the lake at ``target``.

    ``files`` writes from that many tasks, so at most that many files per date touched.  By default Spark
    brings the rows of a date together, and sizes the tasks at run time: small dates share a task, a big
    date is split over several.  ``clustered`` leaves the rows where they are; use it when few dates are
    in play and the input is already spread well.

    Always append: a file's hits can belong to other days than the file, so an overwrite by partition
    would delete rows that earlier loads put there.
    """
    if files is not None:
        hits = hits.repartition(files)
    elif not clustered:
        hits = hits.hint("rebalance", F.col("date"))
    with _dates_at_once(hits.sparkSession):
        hits.write.mode("append").partitionBy("date").parquet(target)


def register(spark: SparkSession, table: str, target: str, hits: DataFrame) -> None:
    """Create the external table for a lake, with the columns of ``hits``; its partitions come from :func:`refresh`."""
    columns = [field for field in hits.schema if field.name != "date"]
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in columns)
    place = target.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl}, `date` DATE) USING PARQUET "
        f"PARTITIONED BY (`date`) LOCATION '{place}'"
    )


def refresh(spark: SparkSession, table: str, sync: bool = False) -> None:
    """Make new partitions visible.  ``sync`` also drops those whose folder is gone."""
    spark.sql(f"MSCK REPAIR TABLE {table} {'SYNC' if sync else 'ADD'} PARTITIONS")
    spark.catalog.refreshTable(table)


def add_partitions(spark: SparkSession, table: str, dates: Sequence[str | None], most: int = 1000) -> None:
    """Make the partitions of the given dates visible, without a look at any other.

    None stands for hits without a date.  Beyond ``most`` dates one full :func:`refresh` is cheaper.
    """
    if len(dates) > most:
        refresh(spark, table)
        return
    for begin in range(0, len(dates), 100):
        wanted = ["PARTITION (`date` = " + ("NULL" if day is None else f"DATE '{day}'") + ")" for day in dates[begin : begin + 100]]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(wanted)}")
    spark.catalog.refreshTable(table)


def add_columns(spark: SparkSession, table: str, hits: DataFrame) -> list[str]:
    """Add the columns of ``hits`` that the table lacks; files written before read as NULL there."""
    known = {field.name.lower() for field in spark.table(table).schema}
    new = [field for field in hits.schema if field.name.lower() not in known]
    if new:
        ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ddl})")
    return [field.name for field in new]


def hits_on(spark: SparkSession, table: str, date: str) -> DataFrame:
    """The hits of one day; reads only that day's partition."""
    return spark.table(table).where(F.col("date") == F.lit(date).cast("date"))


def business_join(
    hits: DataFrame, other: DataFrame, hit_key: str, other_key: str, by: Sequence[str], visitor: str
) -> DataFrame:
    """Hits and visitors per ``by`` columns of a business table and ``date``.

    Hits are counted per key, visitor and date before the join, so a key with very many hits is a few
    rows by the time it is shuffled.
    """
    group = list(dict.fromkeys([hit_key, visitor, "date"]))
    counted = hits.groupBy(*group).agg(F.count(F.lit(1)).alias("_hits"))
    joined = counted.join(other.select(other_key, *by), F.col(hit_key) == F.col(other_key))
    return joined.groupBy(*by, "date").agg(
        F.sum("_hits").alias("hits"), F.countDistinct(visitor).alias("visitors")
    )


def not_loaded(hits: DataFrame, target: str, keys: Sequence[str]) -> DataFrame:
    """Hits whose ``keys`` the lake does not hold on the same date yet.

    A hit with a NULL among its keys is not identified, so it always counts as new; a NULL date equals
    another.  Only the dates that the hits touch are read from the lake, and only the keys.  The hits are
    read more than once: also for their dates.
    """
    spark = hits.sparkSession
    if not exists(spark, target):
        return hits
    # One row per calendar day in the batch.
    touched = [row["date"] for row in hits.select("date").distinct().collect()]
    there = F.col("date").isin([day for day in touched if day is not None])
    if None in touched:
        there = there | F.col("date").isNull()
    columns = ["date", *keys]
    known = reduce(and_, [F.col(c).isNotNull() for c in keys], F.lit(True))
    lake = spark.read.schema(hits.select(*columns).schema).parquet(target)
    seen = lake.where(there).where(known).select(*[F.col(c).alias(f"_seen_{c}") for c in columns]).distinct()
    same = [F.col(c) == F.col(f"_seen_{c}") for c in keys]
    new = hits.where(known).join(seen, reduce(and_, same, F.col("date").eqNullSafe(F.col("_seen_date"))), "left_anti")
    # Hits without an identity stay out of the join: they may be many.
    return new.unionAll(hits.where(~known))
