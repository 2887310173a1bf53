"""Columns by name: feeds whose columns move, come and go, told by the header in each delivery's bundle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlake.sources.bundle import read_headers
from hitlake.sources.hits import read_hits_spread
from hitlake.sources.landing import FEED_NAMES, FeedNames

#: From narrow to wide: each type holds every value of those before it.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def wider(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that keeps the values of both: whole numbers by size, else text."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if one in _WHOLE and other in _WHOLE:
        return max(one, other, key=_WHOLE.index)
    if {type(one), type(other)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    return T.StringType()


def merged(schemas: Iterable[T.StructType]) -> T.StructType:
    """The columns of all schemas in order of first sight, each as wide as any of them has it."""
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            kinds[field.name] = wider(kinds.get(field.name, field.dataType), field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def positioned(header: Sequence[str], known: T.StructType) -> T.StructType:
    """The schema of files with this header: known columns by name, whatever their place, and others as text."""
    if len({name.lower() for name in header}) != len(header):
        raise ValueError(f"a header names a column twice: {header}")
    kinds = {field.name.lower(): field for field in known}
    found = [kinds.get(name.lower()) for name in header]
    return T.StructType([T.StructField(f.name if f else name, f.dataType if f else T.StringType()) for name, f in zip(header, found, strict=True)])


def aligned(hits: DataFrame, schema: T.StructType) -> DataFrame:
    """``hits`` with the columns of ``schema``: missing ones are NULL, all are cast to its types; others come last."""
    there = {name.lower(): name for name in hits.columns}
    columns = [F.col(f"`{there[f.name.lower()]}`").cast(f.dataType).alias(f.name) if f.name.lower() in there else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    known = {f.name.lower() for f in schema}
    return hits.select(*columns, *[F.col(f"`{name}`") for name in hits.columns if name.lower() not in known])


def headers_by_day(spark: SparkSession, landing: DataFrame, days: Iterable[str], names: FeedNames = FEED_NAMES, member: str = "column_headers.tsv") -> dict[str, tuple[str, ...] | None]:
    """For each feed day the header that holds for its files: that of the newest bundle up to that day, else of the first.

    A bundle's day stands in its name like that of a file.  None where no bundle has a header: the files then follow
    the fixed schema.
    """
    found = landing.where("kind = 'lookup'").select("path", F.regexp_extract("path", r"_(\d{8})[-_][^/]*$", 1).alias("day"))
    bundles = sorted((row["day"], row["path"]) for row in found.collect())  # one a delivery
    held = read_headers(spark, [path for _, path in bundles], member)
    having = [(day, held[path]) for day, path in bundles if path in held]
    out: dict[str, tuple[str, ...] | None] = {}
    for day in days:
        before = [header for of, header in having if of <= day]
        out[day] = before[-1] if before else having[0][1] if having else None
    return out


def read_hits_by_header(
    spark: SparkSession,
    files: Mapping[str, Sequence[str]],
    headers: Mapping[str, Sequence[str] | None],
    tasks: Mapping[str, int],
    schema: T.StructType,
    day_pattern: str = FEED_NAMES.day_pattern,
    line_hash: str | None = None,
) -> DataFrame:
    """Scan the files of several feed days, each day by its own header, into the columns of ``schema``.

    Columns that only headers name come after those, as text.  Days that share a header are one scan, so the number of
    scans is that of the changes of the feed.
    """
    groups: dict[tuple[str, ...] | None, list[str]] = {}
    for day in sorted(files):
        header = headers.get(day)
        groups.setdefault(tuple(header) if header else None, []).append(day)
    schemas = {header: positioned(header, schema) if header else schema for header in groups}
    whole = merged([schema, *schemas.values()])
    parts = []
    for header, days in groups.items():
        paths = [path for day in days for path in files[day]]
        hits = read_hits_spread(spark, paths, {day: tasks[day] for day in days}, schemas[header], day_pattern, line_hash)
        parts.append(aligned(hits, whole))
    return reduce(lambda a, b: a.unionByName(b), parts)
