"""The hit feed: tab-separated, gzipped, one fixed schema, no header."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlake.sources.landing import FEED_NAMES
from hitlake.sources.schema import hit_schema

# The feed's delimiter, quote and encoding.
TSV_OPTIONS = {"sep": "\t", "quote": '"', "encoding": "UTF-8"}


def read_hits(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Scan hit files.  A bad field is NULL; ``corrupt_column`` keeps the line of a row that had one.

    Only the columns a query needs are parsed, but a gzipped file is one task.
    """
    schema = hit_schema() if schema is None else schema
    reader = spark.read.options(**TSV_OPTIONS)
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(paths if isinstance(paths, str) else list(paths))


def parse_hits(lines: DataFrame, schema: T.StructType | None = None, line_hash: str | None = None) -> DataFrame:
    """Parse raw lines (``value``) as :func:`read_hits` would; works on streams too.

    ``line_hash`` adds a column with a hash of the raw line, which identifies a hit in checksums.

    The parsed row comes out of a generator, so that each line is parsed once however many of its
    columns are used: a filter on many columns is not pushed below it.
    """
    schema = hit_schema() if schema is None else schema
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    options = {key: value for key, value in TSV_OPTIONS.items() if key != "encoding"}
    filled = lines.where(F.col("value").rlike(r"[^\x00-\x20]"))
    identity = [F.xxhash64("value").alias(line_hash)] if line_hash else []
    return filled.select(*identity, F.inline(F.array(F.from_csv("value", ddl, options))))


def spread_lines(lines: DataFrame, tasks: int) -> DataFrame:
    """Deal lines out to ``tasks`` tasks.

    A line's number in its file decides, so a lost task deals the same way again, and copies of one line
    do not meet in one task.  ``lines`` must come straight from a file scan.
    """
    slot = F.pmod(F.monotonically_increasing_id(), F.lit(tasks)).cast("int")
    return lines.withColumn("_slot", slot).repartitionById(tasks, "_slot").drop("_slot")


def _spread_by_day(lines: DataFrame, tasks: Mapping[str, int], day_pattern: str) -> DataFrame:
    first, slots = 0, []
    for day, n in sorted(tasks.items()):
        slots.append((day, first, n))
        first += n
    # One row per day of the batch: small by construction.
    days = F.broadcast(lines.sparkSession.createDataFrame(slots, "_day string, _first int, _n int"))
    numbered = lines.select(
        "value",
        F.monotonically_increasing_id().alias("_number"),
        F.regexp_extract("_metadata.file_path", day_pattern, 1).alias("_day"),
    )
    slot = F.col("_first") + F.pmod(F.col("_number"), F.col("_n")).cast("int")
    dealt = numbered.join(days, "_day", "left").select("value", slot.alias("_slot"))
    return dealt.repartitionById(first, "_slot").drop("_slot")


def read_hits_spread(
    spark: SparkSession,
    paths: Sequence[str],
    tasks: int | Mapping[str, int],
    schema: T.StructType | None = None,
    day_pattern: str = FEED_NAMES.day_pattern,
    line_hash: str | None = None,
) -> DataFrame:
    """Scan hit files for a full load: parse in ``tasks`` tasks rather than one per gzipped file.

    ``tasks`` can be given per feed day, as the file name tells it.  A task then holds one day's lines,
    and many days can be loaded at once without each task writing a little of every day.

    Raw lines are much smaller than parsed rows of hundreds of mostly empty columns, so the lines are
    what is shuffled; decompression alone stays with the file's task.
    """
    lines = spark.read.text(list(paths))
    spread = spread_lines(lines, tasks) if isinstance(tasks, int) else _spread_by_day(lines, tasks, day_pattern)
    return parse_hits(spread, schema, line_hash)


def drop_empty(hits: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which every column (of ``subset``) is NULL."""
    return hits.dropna(how="all", subset=list(subset) if subset else None)


def with_date(hits: DataFrame, column: str = "date_time") -> DataFrame:
    """Add ``date``, the wall-clock day of a timestamp: the lake's partition column."""
    return hits.withColumn("date", F.col(column).cast("date"))
