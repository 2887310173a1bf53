"""The landing area: which files are there, what each one is, and which day it belongs to."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlake.storage import list_top, literal_path


@dataclass(frozen=True)
class FeedNames:
    """How file names tell kind and day.  The defaults are the feed's own names."""

    # Suffixes and name layout of the feed's files.
    data_suffix: str = ".tsv.gz"
    bundle_suffix: str = "lookup_data.tar.gz"
    day_pattern: str = r"_(\d{8})-\d{6}\.tsv\.gz$"


FEED_NAMES = FeedNames()

# The day in the name of a day folder, such as 2024-01-05, 20240105 or date=2024-01-05.
DAY_FOLDER = r"(?:^|=)(\d{4})-?(\d{2})-?(\d{2})$"


def list_landing(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Every file below ``root`` (one or several): ``path``, ``length``, ``modificationTime``.

    File contents are never opened: Spark prunes the ``content`` column from the scan.  It skips files
    of no bytes, which hold no hits (a gzipped file is never empty).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", "length", "modificationTime")


def list_unsealed(spark: SparkSession, root: str, sealed: DataFrame, day_folder: str = DAY_FOLDER) -> DataFrame:
    """The files of a landing area of day folders, without those of sealed days; the columns of :func:`list_landing`.

    ``day_folder`` finds a day, as one or more groups, in a folder's name; ``sealed`` holds ``feed_date``.  The root is
    looked at by one call that returns its folders and its own files (bundles, manifests).  Folders of sealed
    days are never opened; the others, and folders that name no day, are listed by Spark, in tasks when there are many.
    The driver so holds the names of days and the files of unsealed ones, however long the feed has run.
    """
    folders, files = list_top(spark, root)
    done = {row["feed_date"] for row in sealed.select("feed_date").distinct().collect()}
    unsealed = []
    for path in folders:
        day = re.search(day_folder, path.rsplit("/", 1)[1])
        if day is None or "".join(day.groups()) not in done:
            unsealed.append(path)
    # Names that Spark itself would skip.
    paths = [literal_path(path) for path in unsealed + files if not path.rsplit("/", 1)[1].startswith((".", "_"))]
    if not paths:
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return list_landing(spark, paths)


def classify(files: DataFrame, names: FeedNames = FEED_NAMES) -> DataFrame:
    """Add ``kind`` (``data``, ``lookup`` or ``other``) and ``feed_date`` (data files only)."""
    path = F.col("path")
    kind = (
        F.when(path.endswith(names.data_suffix), "data")
        .when(path.endswith(names.bundle_suffix), "lookup")
        .otherwise("other")
    )
    # A data file whose name holds no day must not slip through unseen.
    day = F.regexp_extract(path, names.day_pattern, 1)
    day = F.when(day != "", day).otherwise(
        F.raise_error(F.concat(F.lit("data file without a day in its name: "), path))
    )
    return files.withColumn("kind", kind).withColumn("feed_date", F.when(F.col("kind") == "data", day))


def day_batches(files: DataFrame) -> DataFrame:
    """Data files per day, as counts and bounds rather than lists, so that no day is held in one row."""
    return (
        files.where("kind = 'data'")
        .groupBy("feed_date")
        .agg(
            F.count("path").alias("n_files"),
            F.min("path").alias("first_path"),
            F.max("path").alias("last_path"),
            F.sum("length").alias("n_bytes"),
        )
    )


def closed_files(files: DataFrame, include_open: bool = False, landing: DataFrame | None = None) -> DataFrame:
    """Data files of every day but the newest, which may still be filling.  A lone day is not closed.

    The newest day is that of ``landing`` where given: of ``files`` alone, a late file's day would seem open.
    """
    data = files.where("kind = 'data'")
    if include_open:
        return data
    every = data if landing is None else landing.where("kind = 'data'")
    return data.where(F.col("feed_date") < every.agg(F.max("feed_date")).scalar())


def closed_days(files: DataFrame, include_open: bool = False) -> DataFrame:
    """The distinct days that :func:`closed_files` covers."""
    return closed_files(files, include_open).select("feed_date").distinct()


def bundles(files: DataFrame) -> DataFrame:
    """The newest lookup bundle by name: one row, NULL when there is none."""
    return files.where("kind = 'lookup'").agg(F.max("path").alias("path"))


def latest_bundle(files: DataFrame) -> str:
    """Path of the newest lookup bundle; fails when there is none."""
    path = bundles(files).first()["path"]
    if path is None:
        raise ValueError("no lookup bundle in the landing area")
    return path


def removable(files: DataFrame) -> DataFrame:
    """Files other than data that are no longer needed: all but the last by name."""
    rest = files.where("kind <> 'data'")
    return rest.where(F.col("path") < rest.agg(F.max("path")).scalar())


def file_pages(files: DataFrame, page_size: int = 10_000):
    """Walk data files in day order, as lists of rows; the driver holds one page at a time.

    Each page starts after the last ``(feed_date, path)`` of the one before, so there is no bound on
    the number of files or days.
    """
    order = ["feed_date", "path"]
    columns = files.select(*order, "length")
    page = columns.orderBy(*order).limit(page_size).collect()
    while page:
        yield page
        if len(page) < page_size:
            return
        day, path = page[-1]["feed_date"], page[-1]["path"]
        later = (F.col("feed_date") > day) | ((F.col("feed_date") == day) & (F.col("path") > path))
        page = columns.where(later).orderBy(*order).limit(page_size).collect()
