"""Compaction of a lake's small files: packed into bins per date, rewritten by tasks, swapped through a load manifest."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitlake.plans.publish import finish, new_load_id, publish, recover, stage
from hitlake.storage import exists

#: Bytes of a file that needs no compaction, about.
FILE_BYTES = 128 << 20

_PLACE = r"([^/]+/[^/]+)$"  # folder of the date and file


def file_bins(spark: SparkSession, target: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """The small files of a lake in bins that are worth a file each: ``folder``, ``place``, ``length``, ``bin``.

    A file is small below half of ``file_bytes``.  A bin holds two files of one date or more, and little more than
    ``file_bytes``.  Names and sizes only are read; a window takes the files of one date.
    """
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet").load(target)
    small = files.select(F.regexp_extract("path", _PLACE, 1).alias("place"), "length").where(F.col("length") < file_bytes // 2)
    small = small.select(F.regexp_extract("place", r"^([^/]+)/", 1).alias("folder"), "place", "length").where("folder LIKE 'date=%'")
    before = F.sum("length").over(Window.partitionBy("folder").orderBy("length", "place")) - F.col("length")
    binned = small.withColumn("bin", F.floor(before / file_bytes).cast("int"))
    together = F.count("*").over(Window.partitionBy("folder", "bin"))
    return binned.withColumn("_n", together).where("_n > 1").drop("_n")


def _pages(bins: DataFrame, page_size: int) -> Iterator[list[list[str]]]:
    """Whole bins as lists of places, about ``page_size`` files at a time."""
    rows = bins.orderBy("folder", "bin", "place").toLocalIterator()
    page, size = [], 0
    for _, held in groupby(rows, key=lambda row: (row["folder"], row["bin"])):
        page.append([row["place"] for row in held])
        size += len(page[-1])
        if size >= page_size:
            yield page
            page, size = [], 0
    if page:
        yield page


class Miscounted(RuntimeError):
    """The rewritten files do not hold the rows of the old ones; the old ones stay."""


def compact(
    spark: SparkSession,
    target: str,
    file_bytes: int = FILE_BYTES,
    page_size: int = 10_000,
    stop: Callable[[str], None] = lambda step: None,
) -> tuple[int, int]:
    """Rewrite the small files of each date as few; returns how many files went and how many came.

    Each page of bins is published like a load: stopped anywhere, it is dropped or finished by the next start, and the
    lake holds each row once.  A reader that lists a date while files are swapped can meet rows of both.  Files with
    fewer columns get the others as NULL.  Loads and compactions take turns.
    """
    recover(spark, target)
    if not exists(spark, target):
        return 0, 0
    lake, gone, come = target.rstrip("/"), 0, 0
    for page in _pages(file_bins(spark, target, file_bytes), page_size):
        places = [place for held in page for place in held]
        # One row per file of the page.
        slots = spark.createDataFrame([(place, n) for n, held in enumerate(page) for place in held], "_place string, _slot int")
        old = spark.read.options(basePath=target, mergeSchema="true").parquet(*[f"{lake}/{place}" for place in places])
        rows = old.withColumn("date", F.col("date").cast("date")).withColumn("_place", F.regexp_extract("_metadata.file_path", _PLACE, 1))
        rows = rows.join(F.broadcast(slots), "_place").drop("_place").repartitionById(len(page), "_slot").drop("_slot")
        load_id = new_load_id()
        staged = stage(rows, target, load_id, clustered=True)
        if spark.read.parquet(staged).count() != old.count():  # told by footers
            raise Miscounted(f"load {load_id}")
        stop("staged")
        manifest = publish(spark, target, load_id, replaced=places)
        stop("published")
        finish(spark, target, manifest, stop)
        gone, come = gone + len(places), come + len(manifest.files)
    return gone, come
