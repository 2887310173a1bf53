"""Manifests of the feed: which files a delivery consists of, and whether all of them have landed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlake.storage import literal_path
from hitlake.sources.landing import FEED_NAMES, FeedNames

_FILES = "manifest string, name string, length bigint, records bigint"


@dataclass(frozen=True)
class ManifestNames:
    """How manifests are named and written.

    A manifest is text in blocks that blank lines end; each line is ``key: value``.  A block with ``file_key`` lists
    a data file.
    """

    # The manifest's name and keys.
    suffix: str = ".txt"
    file_key: str = "Data-File"
    size_key: str = "File-Size"
    records_key: str = "Record-Count"
    #: Manifests that a day has in all: 1 where one lists the whole day, 24 where each hour has its own.
    per_day: int = 1


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*?)[^/]*$", 1)


def read_manifests(spark: SparkSession, landing: DataFrame, names: ManifestNames = ManifestNames()) -> DataFrame:
    """The data files that the manifests of a listing name: ``manifest``, ``name``, ``length``, ``records``.

    A listed file without a size has a NULL ``length``.  Manifests are read by tasks, a few thousand in one scan.
    """
    # Names of manifests: one a day or hour.
    paths = [row["path"] for row in landing.where(F.col("path").endswith(names.suffix)).select("path").collect()]
    if not paths:
        return spark.createDataFrame([], _FILES)
    texts = spark.read.format("binaryFile").load([literal_path(path) for path in paths])
    return parse_manifests(texts.select(F.col("path").alias("manifest"), F.decode("content", "UTF-8").alias("value")), names)


def parse_manifests(texts: DataFrame, names: ManifestNames = ManifestNames()) -> DataFrame:
    """The same from whole texts (``manifest``, ``value``).  Line ends may be those of any system."""

    def value(key: str) -> Column:
        found = F.regexp_extract("block", rf"(?m)^{key}:[ \t]*([^\r\n]*?)[ \t]*$", 1)
        return F.when(found != "", found)

    blocks = texts.select("manifest", F.explode(F.split(F.regexp_replace("value", r"\r\n?", "\n"), r"\n[ \t]*\n")).alias("block"))
    listed = blocks.select(
        "manifest",
        value(names.file_key).alias("name"),
        value(names.size_key).try_cast("bigint").alias("length"),
        value(names.records_key).try_cast("bigint").alias("records"),
    )
    return listed.where("name IS NOT NULL")


def manifest_days(landing: DataFrame, listed: DataFrame, names: FeedNames = FEED_NAMES, per_day: int = 1) -> DataFrame:
    """Per day that manifests list: ``feed_date``, ``n_listed``, ``n_missing`` (not there in full), ``n_manifests``, ``closed``.

    A file is there in full when the folder of its manifest holds it with the listed size (any, if none is listed).
    A day is closed when all of its manifests and all of their files are.
    """
    wanted = listed.select(
        "manifest",
        F.concat(_folder(F.col("manifest")), F.col("name")).alias("path"),
        F.col("length").alias("_length"),
        F.regexp_extract("name", names.day_pattern, 1).alias("feed_date"),
    )
    there = landing.where("kind = 'data'").select("path", F.col("length").alias("_there"))
    found = wanted.join(there, "path", "left")
    whole = F.col("_there").isNotNull() & (F.col("_length").isNull() | (F.col("_length") == F.col("_there")))
    days = found.groupBy("feed_date").agg(
        F.countDistinct("path").alias("n_listed"),
        F.countDistinct(F.when(~whole, F.col("path"))).alias("n_missing"),
        F.countDistinct("manifest").alias("n_manifests"),
    )
    return days.withColumn("closed", (F.col("n_missing") == 0) & (F.col("n_manifests") >= per_day))


def listed_files(landing: DataFrame, listed: DataFrame, names: FeedNames = FEED_NAMES, per_day: int = 1) -> DataFrame:
    """The landing's data files of closed days that a manifest lists; others wait until one does."""
    days = manifest_days(landing, listed, names, per_day).where("closed").select("feed_date")
    wanted = listed.select(F.concat(_folder(F.col("manifest")), F.col("name")).alias("path")).distinct()
    data = landing.where("kind = 'data'").join(days, "feed_date", "left_semi")
    return data.join(wanted, "path", "left_semi").select(*landing.columns)
