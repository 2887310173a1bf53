"""The lookup bundle: a gzipped tar of small ``id<TAB>name`` tables."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlake.functions.keys import try_integer
from hitlake.storage import literal_path

_BATCH_LINES = 8192


def _member_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream the lines of every regular file in each archive; undecodable bytes are left out."""

    def flush(member: str, lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"member": pa.array([member] * len(lines), pa.string()), "line": pa.array(lines, pa.string())}
        )

    for batch in batches:
        for content in batch.column("content"):
            archive = tarfile.open(fileobj=io.BytesIO(content.as_py()), mode="r|gz")
            for member in archive:
                if not member.isfile():
                    continue
                lines: list[str] = []
                for raw in archive.extractfile(member):
                    lines.append(raw.decode("utf-8", "ignore").removesuffix("\n"))
                    if len(lines) == _BATCH_LINES:
                        yield flush(member.name, lines)
                        lines = []
                if lines:
                    yield flush(member.name, lines)


def extract_lines(archives: DataFrame) -> DataFrame:
    """The lines of every regular file in the archives of a ``content`` column: ``member``, ``line``."""
    return archives.select("content").mapInArrow(_member_lines, "member string, line string")


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the bundle at a path: ``member``, ``line``."""
    return extract_lines(spark.read.format("binaryFile").load(path))


def _headers(member: str):
    """The first line that holds more than blanks of one member of each archive, by the archive's path."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, lines = [], []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for found in _member_lines([pa.RecordBatch.from_pydict({"content": pa.array([content.as_py()], pa.binary())})]):
                    named = zip(found.column("member").to_pylist(), found.column("line").to_pylist(), strict=True)
                    line = next((line for name, line in named if name.rsplit("/", 1)[-1] == member and line.strip()), None)
                    if line is not None:
                        paths.append(path)
                        lines.append(line.strip("\r\n"))
                        break
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "line": pa.array(lines, pa.string())})

    return apply


def parse_lines(lines: DataFrame, line: str = "line", lenient: bool = False) -> DataFrame:
    """Turn ``id<TAB>name`` lines into ``id``, ``name``; other columns stay.

    Lines that do not hold exactly two fields are skipped.  An id that is not an integer fails the job,
    whatever the session's ANSI setting; ``lenient`` skips that line instead.
    """
    fields = F.split(F.col(line), "\t")
    parsed = lines.withColumn("_f", fields).where(F.size("_f") == 2)
    number = try_integer(F.col("_f")[0])
    if not lenient:
        problem = F.concat(F.lit("lookup id is not an integer: "), F.col("_f")[0])
        number = F.coalesce(number, F.raise_error(problem).cast("bigint"))
    parsed = parsed.withColumn("id", number).withColumn("name", F.col("_f")[1])
    return parsed.drop("_f", line).where("id IS NOT NULL")


def read_lookups(spark: SparkSession, path: str, tables: Iterable[str], lenient: bool = False) -> DataFrame:
    """The named tables of a bundle as one frame ``table``, ``id``, ``name``, read in one pass."""
    members = [f"{table}.tsv" for table in dict.fromkeys(tables)]
    lines = read_bundle(spark, path).where(F.col("member").isin(members))
    parsed = parse_lines(lines, lenient=lenient)
    return parsed.select(F.regexp_replace("member", r"\.tsv$", "").alias("table"), "id", "name")


def lookup_table(lookups: DataFrame, table: str) -> DataFrame:
    """One table of :func:`read_lookups`, as ``id``, ``name``."""
    return lookups.where(F.col("table") == table).select("id", "name")


def as_lookup(frame: DataFrame, id: str | Column, name: str | Column) -> DataFrame:
    """Use any frame as a lookup: its id as a long and its name."""
    id = F.col(id) if isinstance(id, str) else id
    name = F.col(name) if isinstance(name, str) else name
    return frame.select(id.cast("bigint").alias("id"), name.alias("name"))


def read_headers(spark: SparkSession, paths: Iterable[str], member: str = "column_headers.tsv") -> dict[str, tuple[str, ...]]:
    """The column names that each bundle's header member gives, by bundle; bundles without one are left out.

    One short line of each bundle passes the driver.
    """
    paths = list(paths)
    if not paths:
        return {}
    archives = spark.read.format("binaryFile").load([literal_path(path) for path in paths])
    found = archives.select("path", "content").mapInArrow(_headers(member), "path string, line string").collect()
    return {row["path"]: tuple(name.strip() for name in row["line"].split("\t")) for row in found}
