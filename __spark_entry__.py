
from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlake.operators.as_of_join import as_of_join
from hitlake.operators.bloom_join import bloom_join_lookup
from hitlake.operators.enrich import enrich, list_lookup
from hitlake.plans.compact import compact
from hitlake.plans.lake import add_columns, business_join, hits_on, not_loaded, refresh, register, write_hits
from hitlake.plans.ledger import mark_done, pending, read_ledger, seal, sealable, sealed_days
from hitlake.plans.load import load
from hitlake.plans.publish import STEPS, finish, publish, stage
from hitlake.plans.rollup import merged_visitors, visitor_sketches
from hitlake.sources.bundle import as_lookup, extract_lines, parse_lines
from hitlake.sources.hits import drop_empty, read_hits, read_hits_spread, with_date
from hitlake.sources.landing import (
    FeedNames,
    bundles,
    classify,
    closed_days,
    day_batches,
    list_landing,
    list_unsealed,
    removable,
)
from hitlake.sources.manifest import listed_files, manifest_days, parse_manifests
from hitlake.sources.schema import DEFAULT_ROLES, hit_schema
from hitlake.storage import literal_path, remove, scratch_path, write_bytes
from hitlake.streaming.ingest import ingest

try:  # The training-data operators are an optional part.
    import corpus_pipeline
    from hitlake.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # Left out, or installed without its extras (see pyproject.toml).
    if missing.name not in ("corpus_pipeline", "hitlake.llm", "tokenizers", "sentencepiece", "xxhash", "zstandard"):
        raise
    llm_queries = None

# ---------------------------------------------------------------------------------------------------
# Inputs derived from the given tables
# ---------------------------------------------------------------------------------------------------

# `events` exported as a hit feed: Spark names the files, so kind and day are told by these patterns.
EXPORT_NAMES = FeedNames(data_suffix=".csv.gz", day_pattern=r"feed_day=(\d{8})/")

FEED_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("date_time", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("nation", T.LongType()),
    ]
)

# Text of each lookup key of the standard feed, drawn from `events`; in SQL and Spark alike.
_TEXT_KEYS = {
    "plugins": "CASE WHEN event_type = 'click' THEN '1,2' ELSE CAST(user_id % 30 AS {text}) END",
    "ref_domain": "CASE WHEN event_type = 'view' THEN 'site.example' ELSE CAST(event_id % 40 AS {text}) END",
}


def _standard_key(at: int, column: str, text: str) -> str:
    return _TEXT_KEYS.get(column, f"(user_id + {at}) % 30").format(text=text)


_made: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, make: Callable[[str], None]) -> str:
    """Path of a table derived from ``sf_dir``, made once per application and shared by the queries."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _made:
        path = scratch_path(spark, label)
        make(path)
        _made[key] = path
    return _made[key]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_lookup(_table(spark, sf_dir, "nation"), "n_nationkey", "n_name")


def _daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return with_date(events, "ts").drop("ts")


def _archive(members: dict[str, list[str]]) -> bytes:
    packed = io.BytesIO()
    with tarfile.open(fileobj=packed, mode="w:gz") as archive:
        for name, lines in members.items():
            body = "\n".join(lines).encode()
            info = tarfile.TarInfo(name)
            info.size = len(body)
            archive.addfile(info, io.BytesIO(body))
    return packed.getvalue()


def _write_feed(spark: SparkSession, sf_dir: str, path: str, late: bool = False) -> None:
    """`events` as gzipped TSV files per day.  ``late`` puts every fifth hit into the file of the next day."""
    file_day = F.date_add("ts", (F.col("event_id") % 5 == 0).cast("int")) if late else F.col("ts")
    feed = _table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("date_time"),
        "user_id",
        "event_type",
        "value",
        (F.col("user_id") % 30).alias("nation"),
        F.date_format(file_day, "yyyyMMdd").alias("feed_day"),
    )
    writer = feed.hint("rebalance", F.col("feed_day")).write.partitionBy("feed_day")
    writer.options(sep="\t", compression="gzip").csv(path)


def _feed(spark: SparkSession, sf_dir: str) -> str:
    """`events` as a landing area: gzipped TSV files per day, and a bundle that holds `nation`."""

    def make(path: str) -> None:
        _write_feed(spark, sf_dir, path)
        bundle = _nation_bundle(spark, sf_dir, ["nation"])
        write_bytes(spark, f"{path}/suite_20240101-000000-lookup_data.tar.gz", bundle)

    return _once(spark, sf_dir, "feed", make)


def _nation_bundle(spark: SparkSession, sf_dir: str, tables: Iterable[str]) -> bytes:
    """A lookup bundle in which each table holds `nation`, which has 25 rows at every scale."""
    nations = _nations(spark, sf_dir).collect()
    lines = [f"{row['id']}\t{row['name']}" for row in nations]
    return _archive({f"{table}.tsv": lines for table in tables})


def _standard_feed(spark: SparkSession, sf_dir: str) -> str:
    """`events` as the standard feed of 680 columns, with all of its lookups."""

    def make(path: str) -> None:
        keys = {key: _standard_key(at, key, "STRING") for at, (_, key) in enumerate(DEFAULT_ROLES)}
        given = {"hitid_low": "event_id", "pagename": "event_type", "date_time": "ts", **keys}
        columns = [f"{given.get(name, repr(''))} AS {name}" for name in hit_schema().names]
        events = _table(spark, sf_dir, "events").withColumn("_day", F.date_format("ts", "yyyyMMdd").cast("int"))
        # Shuffle and sort the few source columns, not the wide rows; as a number the day keeps that order in the write.
        feed = events.hint("rebalance", F.col("_day")).sortWithinPartitions("_day").selectExpr(*columns, "_day AS feed_day")
        writer = feed.write.partitionBy("feed_day").options(sep="\t", compression="gzip", emptyValue="")
        writer.csv(path)
        bundle = _nation_bundle(spark, sf_dir, {table for table, _ in DEFAULT_ROLES})
        write_bytes(spark, f"{path}/suite_20240101-000000-lookup_data.tar.gz", bundle)

    return _once(spark, sf_dir, "standard-feed", make)


def _lake(spark: SparkSession, sf_dir: str) -> str:
    """`events` as a lake, registered as a table; returns the table's name."""

    def make(path: str) -> None:
        write_hits(_daily_events(spark, sf_dir), path)

    path = _once(spark, sf_dir, "lake", make)
    table = f"hit_data_{path.rsplit('-', 1)[1]}"
    if not spark.catalog.tableExists(table):
        register(spark, table, path, _daily_events(spark, sf_dir))
        refresh(spark, table)
    return table


def _names(spark: SparkSession, sf_dir: str, extras: bool = False) -> DataFrame:
    """A listing as the feed would leave it: one file per hour and, with ``extras``, bundle and manifest per day."""
    # One row per hour ('yyyy-MM-dd HH') goes on; the paths of an hour follow from it.
    hours = _table(spark, sf_dir, "events").select(F.substring(F.col("ts").cast("string"), 1, 13).alias("h")).distinct()
    date, hour = F.substring("h", 1, 10), F.substring("h", 12, 2)
    day = F.replace(date, F.lit("-"), F.lit(""))
    paths = [F.concat(F.lit("incoming/01-suite_"), day, F.lit("-"), hour, F.lit("0000.tsv.gz"))]
    if extras:
        paths.append(F.concat(F.lit("incoming/suite_"), day, F.lit("-000000-lookup_data.tar.gz")))
        paths.append(F.concat(F.lit("incoming/suite_"), date, F.lit(".txt")))
    listing = hours.select(F.explode(F.array(*paths)).alias("path")).distinct()
    return classify(listing.withColumn("length", F.lit(0).cast("bigint")))


# ---------------------------------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------------------------------


def landing_listing(spark, sf_dir):
    files = classify(list_landing(spark, _feed(spark, sf_dir)), EXPORT_NAMES)
    return day_batches(files).where("n_files > 0 AND n_bytes > 0").select("feed_date")


def landing_days_listed(spark, sf_dir):
    """What is listed, and how many hits it holds, after all days but three of every seven were loaded and those before the last five sealed."""
    feed, ledger = _feed(spark, sf_dir), scratch_path(spark, "sealed-ledger")
    files = classify(list_landing(spark, feed), EXPORT_NAMES)
    mark_done(files.where("kind = 'data' AND cast(feed_date AS int) % 7 > 2"), ledger)
    seal(sealable(files, read_ledger(spark, ledger), keep=5), ledger)
    listed = classify(list_unsealed(spark, feed, sealed_days(read_ledger(spark, ledger))), EXPORT_NAMES)
    paths = [literal_path(row["path"]) for row in listed.where("kind = 'data'").select("path").collect()]
    lines = spark.read.text(paths).select(F.regexp_extract(F.input_file_name(), EXPORT_NAMES.day_pattern, 1).alias("feed_date"))
    return lines.groupBy("feed_date").agg(F.count("*").alias("n_hits"))


def landing_feed_date(spark, sf_dir):
    return _names(spark, sf_dir).select("path", "feed_date")


def landing_batch_by_date(spark, sf_dir):
    return day_batches(_names(spark, sf_dir)).drop("n_bytes")


def landing_closed_dates(spark, sf_dir):
    days = closed_days(_names(spark, sf_dir))
    return days.select(F.to_date("feed_date", "yyyyMMdd").alias("date"))


def landing_latest(spark, sf_dir):
    return bundles(_names(spark, sf_dir, extras=True))


def landing_removable(spark, sf_dir):
    return removable(_names(spark, sf_dir, extras=True)).select("path")


def ledger_pending(spark, sf_dir):
    def make(path: str) -> None:
        mark_done(_names(spark, sf_dir).where("feed_date < '20240110'"), path)

    ledger = _once(spark, sf_dir, "ledger", make)
    return pending(_names(spark, sf_dir), read_ledger(spark, ledger)).select("path")


def lookup_line_parse(spark, sf_dir):
    full = F.concat(F.col("p_partkey").cast("string"), F.lit("\t"), F.col("p_name"))
    line = F.when(F.col("p_partkey") % 5 == 0, F.col("p_name")).otherwise(full)
    return parse_lines(_table(spark, sf_dir, "part").select(line.alias("line")))


def lookup_bundle_scan(spark, sf_dir):
    """Each batch of `part` is packed into an archive inside its task; the archives are then scanned."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = _archive({"part.tsv": batch.column("line").to_pylist()})
            yield pa.RecordBatch.from_pydict({"content": pa.array([content], pa.binary())})

    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), F.col("p_name")).alias("line")
    archives = _table(spark, sf_dir, "part").select(line).mapInArrow(pack, "content binary")
    return parse_lines(extract_lines(archives).where("member = 'part.tsv'")).select("id", "name")


def hits_tsv_scan(spark, sf_dir):
    hits = read_hits(spark, f"{_feed(spark, sf_dir)}/feed_day=*", FEED_SCHEMA)
    return hits.select("event_id", "user_id", "event_type", "value")


def hits_spread_scan(spark, sf_dir):
    tasks = spark.sparkContext.defaultParallelism
    hits = read_hits_spread(spark, [f"{_feed(spark, sf_dir)}/feed_day=*"], tasks, FEED_SCHEMA)
    return drop_empty(hits).select("event_id", "user_id", "event_type", "value")


def hits_drop_all_null(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("a"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("b"),
    )
    return drop_empty(rows, ["a", "b"])


def hits_with_date(spark, sf_dir):
    return _daily_events(spark, sf_dir)


def lookup_left_join(spark, sf_dir):
    hits = _table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    some = _nations(spark, sf_dir).where("id < 20")
    named = enrich(hits, {"nation": some}, [("nation", "nation")], unique=True)
    return named.withColumn("nation_id", F.col("nation_id").cast("bigint"))


def lookup_fanout(spark, sf_dir):
    hits = _table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("nation"))
    nations = _nations(spark, sf_dir)
    return enrich(hits, {"nation": nations.unionAll(nations.where("id < 5"))}, [("nation", "nation")])


def lookup_chain(spark, sf_dir):
    hits = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier")
    )
    lookups = {
        "part": as_lookup(_table(spark, sf_dir, "part"), "p_partkey", "p_name"),
        "supplier": as_lookup(_table(spark, sf_dir, "supplier"), "s_suppkey", "s_name"),
    }
    return enrich(hits, lookups, [("part", "part"), ("supplier", "supplier")])


def lookup_spread_join(spark, sf_dir):
    """A third of the orders share one key and some have none; nothing is broadcast but the hot keys."""
    key = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey"))
    hits = _table(spark, sf_dir, "orders").select("o_orderkey", key.cast("bigint").alias("customer"))
    customers = as_lookup(_table(spark, sf_dir, "customer"), "c_custkey", "c_name")
    return enrich(hits, {"customer": customers}, [("customer", "customer")], broadcast_bytes=0)


def lookup_bloom_join(spark, sf_dir):
    """Nine of ten keys miss, some are NULL; a filter of the lookup's ids spares the misses the shuffle."""
    key = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).cast("bigint")
    hits = _table(spark, sf_dir, "orders").select("o_orderkey", key.alias("customer_id"))
    customers = as_lookup(_table(spark, sf_dir, "customer").where("c_custkey % 10 = 0"), "c_custkey", "c_name")
    return bloom_join_lookup(hits, customers, "customer_id", "customer").drop("customer_match")


def lookup_string_key(spark, sf_dir):
    raw = F.when(F.col("event_type") == "click", (F.col("user_id") % 30).cast("string"))
    hits = _table(spark, sf_dir, "events").select("event_id", raw.otherwise(F.col("event_type")).alias("key"))
    named = enrich(hits, {"nation": _nations(spark, sf_dir)}, [("nation", "key")])
    return named.withColumnRenamed("key", "key_name")


def lookup_two_roles(spark, sf_dir):
    hits = _table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("home"), (F.col("s_suppkey") % 40).alias("other")
    )
    named = enrich(hits, {"nation": _nations(spark, sf_dir)}, [("nation", "home"), ("nation", "other")])
    return named.select("s_suppkey", "home", "other")


def _event_lists(spark, sf_dir):
    parts = [(F.col("user_id") % 25).cast("string"), (F.col("event_id") % 40).cast("string"), F.lit("x")]
    return _table(spark, sf_dir, "events").select(F.col("event_id").alias("k"), F.concat_ws(",", *parts).alias("names"))


def list_lookup_inline(spark, sf_dir):
    named = list_lookup(_event_lists(spark, sf_dir), "names", _nations(spark, sf_dir))
    return named.select("k", F.concat_ws(",", "names").alias("names"))


def list_lookup_joined(spark, sf_dir):
    named = list_lookup(_event_lists(spark, sf_dir), "names", _nations(spark, sf_dir), inline_rows=0)
    return named.select("k", F.concat_ws(",", "names").alias("names"))


def lake_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "roundtrip")
    write_hits(_daily_events(spark, sf_dir), path)
    return spark.read.parquet(path)


def show_partitions(spark, sf_dir):
    return spark.sql(f"SHOW PARTITIONS {_lake(spark, sf_dir)}")


def partition_query(spark, sf_dir):
    return hits_on(spark, _lake(spark, sf_dir), "2024-01-05")


def limit_query(spark, sf_dir):
    table = _lake(spark, sf_dir)
    return spark.sql(f"SELECT event_id, user_id, event_type FROM {table} ORDER BY event_id LIMIT 10")


def business_join_query(spark, sf_dir):
    hits = spark.table(_lake(spark, sf_dir))
    return business_join(hits, _table(spark, sf_dir, "customer"), "user_id", "c_custkey", ["c_mktsegment"], "user_id")


def replay_dedupe(spark, sf_dir):
    """A replay of all events over a lake that already holds all but the views."""

    def make(path: str) -> None:
        write_hits(_daily_events(spark, sf_dir).where("event_type <> 'view'"), path)

    lake = _once(spark, sf_dir, "partial-lake", make)
    return not_loaded(_daily_events(spark, sf_dir), lake, ["event_id"])


def daily_load(spark, sf_dir):
    target, ledger = scratch_path(spark, "load"), scratch_path(spark, "load-ledger")
    roles = [("nation", "nation")]
    load(spark, _feed(spark, sf_dir), target, ledger, FEED_SCHEMA, roles, names=EXPORT_NAMES, unique=True)
    return spark.read.parquet(target).select("event_id", "event_type", "value", "nation_id", "nation", "date")


def standard_load(spark, sf_dir):
    """The whole daily load at the feed's full width, with its twelve lookup roles."""
    target, ledger = scratch_path(spark, "standard-load"), scratch_path(spark, "standard-ledger")
    load(spark, _standard_feed(spark, sf_dir), target, ledger, names=EXPORT_NAMES, include_open=True)
    keys = [key for _, key in DEFAULT_ROLES]
    ids = [f"{k}_id" if k in _TEXT_KEYS else F.col(f"{k}_id").cast("bigint").alias(f"{k}_id") for k in keys]
    return spark.read.parquet(target).select("hitid_low", "pagename", "date", *ids, *keys)


def stream_ingest(spark, sf_dir):
    target, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    lookups = {"nation": _nations(spark, sf_dir)}
    roles = [("nation", "nation")]
    feed = _feed(spark, sf_dir)
    ingest(spark, feed, target, checkpoint, lookups, FEED_SCHEMA, roles, pattern="*.csv.gz").awaitTermination()
    return spark.read.parquet(target).select("event_id", "nation_id", "nation", "date")


def load_counts(spark, sf_dir):
    """Rows that a load read from the closed days and wrote to the lake."""
    target, ledger = scratch_path(spark, "counted"), scratch_path(spark, "counted-ledger")
    roles = [("nation", "nation")]
    report = load(spark, _feed(spark, sf_dir), target, ledger, FEED_SCHEMA, roles, names=EXPORT_NAMES, unique=True)
    return spark.createDataFrame([(report.rows_read, report.rows_written)], "n_read bigint, n_written bigint")


def late_file_of_closed_day(spark, sf_dir):
    """A load that finds only the files of one day pending, and newer days in the landing area."""
    feed = _feed(spark, sf_dir)
    target, ledger = scratch_path(spark, "late"), scratch_path(spark, "late-ledger")
    files = classify(list_landing(spark, feed), EXPORT_NAMES)
    mark_done(files.where("kind = 'data' AND feed_date <> '20240103'"), ledger)
    load(spark, feed, target, ledger, FEED_SCHEMA, [("nation", "nation")], names=EXPORT_NAMES)
    return spark.read.parquet(target).select("event_id", "nation_id", "nation", "date")


def stream_late_hits(spark, sf_dir):
    """A stream whose files hold hits of the day before, read through the catalog."""
    path, target = scratch_path(spark, "late-feed"), scratch_path(spark, "late-stream")
    table = f"hit_data_{uuid.uuid4().hex}"
    _write_feed(spark, sf_dir, path, late=True)
    names = lambda session: {"nation": _nations(session, sf_dir)}
    options = {"pattern": "*.csv.gz", "unique": True, "table": table}
    ingest(spark, path, target, f"{target}-checkpoint", names, FEED_SCHEMA, [("nation", "nation")], **options).awaitTermination()
    return spark.table(table).select("event_id", "nation_id", "nation", "date")


def stream_archive(spark, sf_dir):
    """The lake after a stream of several batches that moves files away behind it."""
    path, target = scratch_path(spark, "archived-feed"), scratch_path(spark, "archived-stream")
    _write_feed(spark, sf_dir, path)
    lookups = {"nation": _nations(spark, sf_dir)}
    options = {"pattern": "*.csv.gz", "archive": scratch_path(spark, "archive"), "max_files": 10}
    ingest(spark, path, target, f"{target}-checkpoint", lookups, FEED_SCHEMA, [("nation", "nation")], **options).awaitTermination()
    return spark.read.parquet(target).select("event_id", "nation_id", "nation", "date")


def stream_dedupe(spark, sf_dir):
    """A stream over a feed that delivers each file twice."""
    path, target = scratch_path(spark, "twice-feed"), scratch_path(spark, "once-stream")
    for again in ("first", "second"):
        _write_feed(spark, sf_dir, f"{path}/{again}")
    lookups = {"nation": _nations(spark, sf_dir)}
    options = {"pattern": "*.csv.gz", "max_files": 20, "dedupe_on": ["event_id"]}
    ingest(spark, path, target, f"{target}-checkpoint", lookups, FEED_SCHEMA, [("nation", "nation")], **options).awaitTermination()
    return spark.read.parquet(target).select("event_id", "nation_id", "nation", "date")


def visitor_rollup(spark, sf_dir):
    """Visitors per week and kind of hit, from sketches stored per date."""
    path = scratch_path(spark, "visitor-sketches")
    visitor_sketches(_daily_events(spark, sf_dir), "user_id", ["date", "event_type"]).write.parquet(path)
    week = F.trunc("date", "week").alias("week")
    return merged_visitors(spark.read.parquet(path), [week, "event_type"])


def sync_partitions(spark, sf_dir):
    """The partitions of a lake after the folder of one day was removed."""
    path, table = scratch_path(spark, "synced"), f"hit_data_{uuid.uuid4().hex}"
    events = _daily_events(spark, sf_dir)
    write_hits(events, path)
    register(spark, table, path, events)
    refresh(spark, table)
    remove(spark, f"{path}/date=2024-01-05")
    refresh(spark, table, sync=True)
    return spark.sql(f"SHOW PARTITIONS {table}")


def new_columns(spark, sf_dir):
    """A lake whose later hits have a column that the earlier ones lack."""
    path, table = scratch_path(spark, "widened"), f"hit_data_{uuid.uuid4().hex}"
    events = _daily_events(spark, sf_dir)
    earlier, later = events.where("event_type <> 'view'").drop("value"), events.where("event_type = 'view'")
    write_hits(earlier, path)
    register(spark, table, path, earlier)
    write_hits(later, path)
    add_columns(spark, table, later)
    refresh(spark, table)
    return spark.table(table).select("event_id", "event_type", "value", "date")


class _Stopped(RuntimeError):
    pass


def crash_recovery(spark, sf_dir):
    """A backlog loaded by one load after another, each of which stops after another step."""
    target, ledger = scratch_path(spark, "stopped"), scratch_path(spark, "stopped-ledger")
    for step in STEPS:

        def stop(done: str, step: str = step) -> None:
            if done == step:
                raise _Stopped(step)

        with suppress(_Stopped):
            load(spark, _feed(spark, sf_dir), target, ledger, FEED_SCHEMA, [("nation", "nation")], names=EXPORT_NAMES, page_size=4, stop=stop)
    load(spark, _feed(spark, sf_dir), target, ledger, FEED_SCHEMA, [("nation", "nation")], names=EXPORT_NAMES)
    return spark.read.parquet(target).select("event_id", "event_type", "value", "nation_id", "nation", "date")


def load_checksums(spark, sf_dir):
    """Rows that a load read and wrote, and whether both are the same multiset."""
    target, ledger = scratch_path(spark, "summed"), scratch_path(spark, "summed-ledger")
    report = load(spark, _feed(spark, sf_dir), target, ledger, FEED_SCHEMA, [("nation", "nation")], names=EXPORT_NAMES, page_size=10)
    found = (report.read.rows, report.written.rows, report.read == report.written)
    return spark.createDataFrame([found], "n_read bigint, n_written bigint, same boolean")


def manifest_closed_days(spark, sf_dir):
    """Days told closed by manifests: on some a file is missing, on some one is short, on some one is not listed."""
    hours = _table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("t")).agg(F.count("*").alias("length"))
    week, odd = F.dayofmonth("t") % 7, F.hour("t") == 5
    name = F.concat(F.lit("01-suite_"), F.date_format("t", "yyyyMMdd-HH"), F.lit("0000.tsv.gz"))
    block = F.concat(F.lit("Data-File: "), name, F.lit("\nFile-Size: "), F.col("length").cast("string"), F.lit("\n"))
    manifest = F.concat(F.lit("incoming/suite_"), F.date_format("t", "yyyy-MM-dd"), F.lit(".txt"))
    # One manifest a day: it lists at most 24 files.
    texts = hours.where(~((week == 3) & odd)).groupBy(manifest.alias("manifest")).agg(F.array_join(F.sort_array(F.collect_list(block)), "\n").alias("value"))
    landed = hours.where(~((week == 1) & odd)).withColumn("length", F.col("length") - ((week == 2) & odd).cast("int"))
    landing = classify(landed.select(F.concat(F.lit("incoming/"), name).alias("path"), "length"))
    days = manifest_days(landing, parse_manifests(texts))
    files = listed_files(landing, parse_manifests(texts)).groupBy("feed_date").agg(F.count("*").alias("n_loaded"))
    return days.join(files, "feed_date", "left").select("feed_date", "n_listed", "n_missing", "closed", F.coalesce("n_loaded", F.lit(0)).alias("n_loaded"))


def compacted_lake(spark, sf_dir):
    """A lake written by five loads, one of them with fewer columns, after its small files were packed."""
    target = scratch_path(spark, "compacted")
    events = _daily_events(spark, sf_dir)
    for part in range(5):
        some = events.where(F.col("event_id") % 5 == part)
        write_hits(some.drop("value") if part == 4 else some, target)
    compact(spark, target, page_size=40)
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value", "date")


def business_as_of(spark, sf_dir):
    """Each hit with its customer's last order by then; a third of the hits are of one customer."""
    key = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")).cast("bigint")
    hits = _table(spark, sf_dir, "events").select("event_id", key.alias("customer"), "ts")
    placed = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(o_orderkey % 43200 AS INT), 0)")
    orders = _table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("bigint").alias("o_custkey"), placed.cast(hits.schema["ts"].dataType).alias("t"), "o_orderkey")
    orders = orders.groupBy("o_custkey", "t").agg(F.max("o_orderkey").alias("order_id"))
    return as_of_join(hits, orders, "customer", "o_custkey", "ts", "t", ["order_id"]).select("event_id", "customer", "order_id")


def header_columns(spark, sf_dir):
    """A load whose feed changes twice: columns change places, then one goes and one comes."""

    def make(path: str) -> None:
        headers = {
            "20240101": ["event_id", "date_time", "user_id", "event_type", "value"],
            "20240110": ["value", "event_type", "date_time", "event_id", "user_id"],
            "20240120": ["date_time", "event_id", "campaign", "user_id", "event_type"],
        }
        events = _table(spark, sf_dir, "events").withColumn("feed_day", F.date_format("ts", "yyyyMMdd"))
        events = events.withColumn("date_time", F.col("ts")).withColumn("campaign", F.concat(F.lit("c"), F.col("user_id") % 7))
        for day, columns in headers.items():
            later = min([d for d in headers if d > day], default="99999999")
            some = events.where(F.col("feed_day").between(day, later) & (F.col("feed_day") < later))
            writer = some.select(*columns, "feed_day").hint("rebalance", F.col("feed_day")).write.mode("append")
            writer.partitionBy("feed_day").options(sep="\t", compression="gzip").csv(path)
            nations = _nations(spark, sf_dir).collect()  # 25 rows at every scale
            bundle = _archive({"nation.tsv": [f"{r['id']}\t{r['name']}" for r in nations], "column_headers.tsv": ["\t".join(columns)]})
            write_bytes(spark, f"{path}/suite_{day}-000000-lookup_data.tar.gz", bundle)

    feed = _once(spark, sf_dir, "header-feed", make)
    target, ledger = scratch_path(spark, "by-header"), scratch_path(spark, "by-header-ledger")
    schema = T.StructType([field for field in FEED_SCHEMA if field.name != "nation"])
    load(spark, feed, target, ledger, schema, [("nation", "user_id")], names=EXPORT_NAMES, include_open=True, header_member="column_headers.tsv")
    found = spark.read.option("mergeSchema", "true").parquet(target)
    return found.select("event_id", F.col("user_id_id").alias("user_id"), F.col("user_id").alias("nation"), "event_type", "value", "campaign", "date")


def touched_partitions(spark, sf_dir):
    """What the catalog shows after a load of the last days into a lake whose other days were never shown."""
    target, table = scratch_path(spark, "touched"), f"hit_data_{uuid.uuid4().hex}"
    events = _daily_events(spark, sf_dir)
    write_hits(events.where("date <= DATE '2024-01-10'"), target)
    register(spark, table, target, events)
    stage(events.where("date > DATE '2024-01-20'"), target, "last")
    finish(spark, target, publish(spark, target, "last", table=table))
    return spark.table(table).select("event_id", "user_id", "event_type", "value", "date")


def entry(spark: SparkSession) -> DataFrame:
    """Enrich a day-partitioned lake of `events`, then query one day of it."""
    sf_dir = "/root/testdata/sf0.001"
    events = _daily_events(spark, sf_dir).withColumn("nation", F.col("user_id") % 30)
    named = enrich(events, {"nation": _nations(spark, sf_dir)}, [("nation", "nation")])
    target, table = scratch_path(spark, "entry"), f"hit_data_{uuid.uuid4().hex}"
    write_hits(named, target)
    register(spark, table, target, named)
    refresh(spark, table)
    return hits_on(spark, table, "2024-01-05")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "landing_listing": landing_listing,
        "landing_days_listed": landing_days_listed,
        "landing_feed_date": landing_feed_date,
        "landing_batch_by_date": landing_batch_by_date,
        "landing_closed_dates": landing_closed_dates,
        "landing_latest": landing_latest,
        "landing_removable": landing_removable,
        "ledger_pending": ledger_pending,
        "lookup_line_parse": lookup_line_parse,
        "lookup_bundle_scan": lookup_bundle_scan,
        "hits_tsv_scan": hits_tsv_scan,
        "hits_spread_scan": hits_spread_scan,
        "hits_drop_all_null": hits_drop_all_null,
        "hits_with_date": hits_with_date,
        "lookup_left_join": lookup_left_join,
        "lookup_fanout": lookup_fanout,
        "lookup_chain": lookup_chain,
        "lookup_spread_join": lookup_spread_join,
        "lookup_bloom_join": lookup_bloom_join,
        "lookup_string_key": lookup_string_key,
        "lookup_two_roles": lookup_two_roles,
        "list_lookup": list_lookup_inline,
        "list_lookup_joined": list_lookup_joined,
        "lake_roundtrip": lake_roundtrip,
        "show_partitions": show_partitions,
        "partition_query": partition_query,
        "limit_query": limit_query,
        "business_join": business_join_query,
        "replay_dedupe": replay_dedupe,
        "daily_load": daily_load,
        "standard_load": standard_load,
        "stream_ingest": stream_ingest,
        "load_counts": load_counts,
        "late_file_of_closed_day": late_file_of_closed_day,
        "stream_late_hits": stream_late_hits,
        "stream_archive": stream_archive,
        "stream_dedupe": stream_dedupe,
        "visitor_rollup": visitor_rollup,
        "sync_partitions": sync_partitions,
        "new_columns": new_columns,
        "crash_recovery": crash_recovery,
        "load_checksums": load_checksums,
        "manifest_closed_days": manifest_closed_days,
        "touched_partitions": touched_partitions,
        "compacted_lake": compacted_lake,
        "header_columns": header_columns,
        "business_as_of": business_as_of,
        **(llm_queries.queries() | {"pipeline": corpus_pipeline.run} if llm_queries else {}),
    }


# ---------------------------------------------------------------------------------------------------
# The same in SQL
# ---------------------------------------------------------------------------------------------------

_DATA = "'incoming/01-suite_'||strftime(ts,'%Y%m%d')||'-'||strftime(ts,'%H')||'0000.tsv.gz' AS path FROM events"
_FILES = f"WITH f AS (SELECT DISTINCT {_DATA}) "
_ALL_FILES = f"""WITH f AS (
  SELECT DISTINCT 'incoming/suite_'||strftime(ts,'%Y%m%d')||'-000000-lookup_data.tar.gz' AS path FROM events
  UNION SELECT DISTINCT 'incoming/suite_'||strftime(ts,'%Y-%m-%d')||'.txt' FROM events
  UNION SELECT DISTINCT {_DATA}) """
_FEED_DATE = r"SELECT path, regexp_extract(path, '_(\d{8})-\d{6}\.tsv\.gz$', 1) AS feed_date FROM f"
_EVENTS_BY_DATE = "SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS date FROM events"
_STREAMED = """SELECT event_id, user_id % 30 AS nation_id, n_name AS nation, CAST(ts AS DATE) AS date
            FROM events LEFT JOIN nation ON user_id % 30 = n_nationkey"""
_SCAN = "SELECT event_id, user_id, event_type, value FROM events"
_LISTS = """SELECT k, string_agg(coalesce(n_name, tok), ',' ORDER BY pos) AS names
  FROM (SELECT event_id AS k, unnest([1, 2, 3]) AS pos,
               unnest(string_split((user_id % 25)||','||(event_id % 40)||',x', ',')) AS tok FROM events) t
  LEFT JOIN nation ON TRY_CAST(tok AS BIGINT) = n_nationkey GROUP BY k"""


def _standard_sql() -> str:
    keys = [key for _, key in DEFAULT_ROLES]
    ids = [f"{_standard_key(at, key, 'VARCHAR')} AS {key}_id" for at, key in enumerate(keys)]
    joins = [f"LEFT JOIN nation n{at} ON TRY_CAST({key}_id AS BIGINT) = n{at}.n_nationkey" for at, key in enumerate(keys)]
    found = [f"{key}_id, n{at}.n_name AS {key}" for at, key in enumerate(keys)]
    return f"""SELECT hitid_low, pagename, date, {', '.join(found)}
        FROM (SELECT CAST(event_id AS VARCHAR) AS hitid_low, event_type AS pagename, CAST(ts AS DATE) AS date,
                     {', '.join(ids)} FROM events) e {' '.join(joins)}"""


def oracle_sql() -> dict[str, str]:
    return {
        "landing_listing": "SELECT DISTINCT strftime(ts, '%Y%m%d') AS feed_date FROM events",
        "landing_days_listed": """WITH d AS (SELECT strftime(ts, '%Y%m%d') AS feed_date, count(*) AS n_hits FROM events GROUP BY 1)
            SELECT feed_date, n_hits FROM (SELECT *, row_number() OVER (ORDER BY feed_date DESC) AS nth FROM d) t
            WHERE nth <= 5 OR CAST(feed_date AS INTEGER) % 7 <= 2""",
        "landing_feed_date": _FILES + _FEED_DATE,
        "landing_batch_by_date": _FILES
        + f"""SELECT feed_date, count(*) AS n_files, min(path) AS first_path, max(path) AS last_path
              FROM ({_FEED_DATE}) g GROUP BY feed_date""",
        "landing_closed_dates": """SELECT DISTINCT CAST(ts AS DATE) AS date FROM events
            WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events)""",
        "landing_latest": _ALL_FILES + "SELECT max(path) AS path FROM f WHERE suffix(path, 'lookup_data.tar.gz')",
        "landing_removable": _ALL_FILES
        + """, n AS (SELECT path FROM f WHERE NOT suffix(path, '.tsv.gz'))
             SELECT path FROM n WHERE path < (SELECT max(path) FROM n)""",
        "ledger_pending": _FILES
        + """SELECT path FROM f
             ANTI JOIN (SELECT path FROM f WHERE path < 'incoming/01-suite_20240110') d USING (path)""",
        "lookup_line_parse": """SELECT CAST(split_part(line, chr(9), 1) AS BIGINT) AS id,
              split_part(line, chr(9), 2) AS name
            FROM (SELECT CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE p_partkey||chr(9)||p_name END AS line
                  FROM part)
            WHERE length(line) - length(replace(line, chr(9), '')) = 1""",
        "lookup_bundle_scan": "SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS name FROM part",
        "hits_tsv_scan": _SCAN,
        "hits_spread_scan": _SCAN,
        "hits_drop_all_null": """SELECT event_id, a, b
            FROM (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id END AS a,
                         CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS b FROM events) t
            WHERE a IS NOT NULL OR b IS NOT NULL""",
        "hits_with_date": _EVENTS_BY_DATE,
        "lookup_left_join": """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS nation_id, n_name AS nation
            FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n ON c_nationkey = n_nationkey""",
        "lookup_fanout": """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS nation_id, n_name AS nation
            FROM customer LEFT JOIN (SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_nationkey < 5) n
            ON c_nationkey = n_nationkey""",
        "lookup_chain": """SELECT l_orderkey, l_linenumber, l_partkey AS part_id, l_suppkey AS supplier_id,
              p_name AS part, s_name AS supplier
            FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
        "lookup_spread_join": """SELECT o_orderkey, key AS customer_id, c_name AS customer
            FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 7 <> 0 THEN o_custkey END
                         AS key FROM orders) o LEFT JOIN customer ON key = c_custkey""",
        "lookup_bloom_join": """SELECT o_orderkey, key AS customer_id, c_name AS customer
            FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS key FROM orders) o
            LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 10 = 0) c ON key = c_custkey""",
        "lookup_string_key": """SELECT event_id, raw AS key_id, n_name AS key_name
            FROM (SELECT event_id, CASE WHEN event_type = 'click' THEN CAST(user_id % 30 AS VARCHAR)
                         ELSE event_type END AS raw FROM events) e
            LEFT JOIN nation ON TRY_CAST(e.raw AS BIGINT) = n_nationkey""",
        "lookup_two_roles": """SELECT s_suppkey, a.n_name AS home, b.n_name AS other
            FROM supplier LEFT JOIN nation a ON s_nationkey = a.n_nationkey
            LEFT JOIN nation b ON s_suppkey % 40 = b.n_nationkey""",
        "list_lookup": _LISTS,
        "list_lookup_joined": _LISTS,
        "lake_roundtrip": _EVENTS_BY_DATE,
        "show_partitions": "SELECT DISTINCT 'date='||CAST(CAST(ts AS DATE) AS VARCHAR) AS partition FROM events",
        "partition_query": _EVENTS_BY_DATE + " WHERE CAST(ts AS DATE) = DATE '2024-01-05'",
        "limit_query": "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 10",
        "business_join": """SELECT c_mktsegment, CAST(ts AS DATE) AS date, count(*) AS hits,
              count(DISTINCT user_id) AS visitors
            FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2""",
        "replay_dedupe": _EVENTS_BY_DATE + " WHERE event_type = 'view'",
        "daily_load": """SELECT event_id, event_type, value, user_id % 30 AS nation_id, n_name AS nation,
              CAST(ts AS DATE) AS date
            FROM events LEFT JOIN nation ON user_id % 30 = n_nationkey
            WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events)""",
        "standard_load": _standard_sql(),
        "stream_ingest": _STREAMED,
        "load_counts": """SELECT count(*) AS n_read, count(*) AS n_written FROM events
            WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events)""",
        "late_file_of_closed_day": _STREAMED + " WHERE CAST(ts AS DATE) = DATE '2024-01-03'",
        "stream_late_hits": _STREAMED,
        "stream_archive": _STREAMED,
        "stream_dedupe": _STREAMED,
        "visitor_rollup": """SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, count(*) AS hits,
            count(DISTINCT user_id) AS visitors FROM events GROUP BY ALL""",
        "sync_partitions": """SELECT DISTINCT 'date='||CAST(CAST(ts AS DATE) AS VARCHAR) AS partition FROM events
            WHERE CAST(ts AS DATE) <> DATE '2024-01-05'""",
        "new_columns": """SELECT event_id, event_type, CASE WHEN event_type = 'view' THEN value END AS value,
              CAST(ts AS DATE) AS date FROM events""",
        "crash_recovery": """SELECT event_id, event_type, value, user_id % 30 AS nation_id, n_name AS nation,
              CAST(ts AS DATE) AS date
            FROM events LEFT JOIN nation ON user_id % 30 = n_nationkey
            WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events)""",
        "load_checksums": """SELECT count(*) AS n_read, count(*) AS n_written, true AS same FROM events
            WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events)""",
        "manifest_closed_days": """WITH h AS (SELECT DISTINCT date_trunc('hour', ts) AS t FROM events),
              x AS (SELECT strftime(t, '%Y%m%d') AS feed_date, day(t) % 7 AS week, hour(t) = 5 AS odd FROM h),
              d AS (SELECT feed_date, count(*) AS n_listed, count(*) FILTER (odd AND week IN (1, 2)) AS n_missing
                    FROM x WHERE NOT (odd AND week = 3) GROUP BY feed_date)
            SELECT feed_date, n_listed, n_missing, n_missing = 0 AS closed,
                   CASE WHEN n_missing = 0 THEN n_listed ELSE 0 END AS n_loaded FROM d""",
        "compacted_lake": """SELECT event_id, user_id, event_type, CASE WHEN event_id % 5 <> 4 THEN value END AS value,
              CAST(ts AS DATE) AS date FROM events""",
        "header_columns": """SELECT event_id, user_id, n_name AS nation, event_type,
              CASE WHEN CAST(ts AS DATE) < DATE '2024-01-20' THEN value END AS value,
              CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN 'c'||(user_id % 7) END AS campaign, CAST(ts AS DATE) AS date
            FROM events LEFT JOIN nation ON user_id = n_nationkey""",
        "business_as_of": """WITH h AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS customer, ts FROM events),
              o AS (SELECT o_custkey, TIMESTAMP '2024-01-01' + to_minutes(CAST(o_orderkey % 43200 AS BIGINT)) AS t, max(o_orderkey) AS order_id
                    FROM orders GROUP BY 1, 2)
            SELECT event_id, CAST(customer AS BIGINT) AS customer, order_id
            FROM h ASOF LEFT JOIN o ON h.customer = o.o_custkey AND h.ts >= o.t""",
        "touched_partitions": _EVENTS_BY_DATE + " WHERE CAST(ts AS DATE) > DATE '2024-01-20'",
        **(llm_queries.oracle_sql() if llm_queries else {}),
    }
