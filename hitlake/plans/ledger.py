"""The ledger: an append-only table of the landing files that were dealt with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlake.storage import exists

# What a ledger row of a sealed day has in place of a file's path, before the day.
SEAL = "sealed day "

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("feed_date", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger at a path; empty when nothing was ever marked."""
    if exists(spark, ledger):
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger does not name."""
    return files.join(ledger, "path", "left_anti")


def mark_done(files: DataFrame, ledger: str) -> None:
    """Append files (``path``, ``feed_date``) to the ledger.  Call it only after their rows are written."""
    done = files.select("path", F.col("feed_date").cast("string"), F.current_timestamp().alias("loaded_at"))
    done.write.mode("append").parquet(ledger)


def sealed_days(ledger: DataFrame) -> DataFrame:
    """``feed_date`` of the days that were sealed."""
    return ledger.where(F.startswith("path", F.lit(SEAL))).select("feed_date").distinct()


def sealable(files: DataFrame, ledger: DataFrame, keep: int = 7) -> DataFrame:
    """``feed_date`` of listed days that can be sealed: no data file is pending, and ``keep`` or more newer days are there.

    Days are counted among ``files``, which hold the newest ones always, as ``keep`` is at least 1.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1: the newest day tells which days are closed")
    data = files.where("kind = 'data'")
    days = data.select("feed_date").distinct()
    # Days are few; their order needs one task.
    newest = days.select("feed_date", F.row_number().over(Window.orderBy(F.desc("feed_date"))).alias("nth"))
    still = pending(data, ledger).select("feed_date").distinct()
    return newest.where(F.col("nth") > keep).select("feed_date").join(still, "feed_date", "left_anti")


def seal(days: DataFrame, ledger: str) -> None:
    """Mark days (``feed_date``) as sealed: their folders are not listed again, so a file that comes later is not seen."""
    rows = days.select(F.concat(F.lit(SEAL), F.col("feed_date")).alias("path"), "feed_date", F.current_timestamp().alias("loaded_at"))
    rows.coalesce(1).write.mode("append").parquet(ledger)
