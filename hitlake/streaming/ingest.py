"""Incremental ingest: each landed file once, as it arrives."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hitlake.operators.lookup_join import INLINE_ROWS, prepare
from hitlake.plans.load import LINE, stage_checked
from hitlake.plans.publish import finish, new_load_id, publish, recover
from hitlake.sources.hits import drop_empty, parse_hits, spread_lines, with_date
from hitlake.sources.schema import DEFAULT_ROLES, hit_schema
from hitlake.storage import exists


def first_arrivals(hits: DataFrame, keys: Sequence[str], within: str = "7 days") -> DataFrame:
    """A stream's hits, each once, however often it is delivered ``within`` that time of its first arrival.

    The state holds the ``keys`` of the hits of that time only.  Time is that of arrival, not of the hit: a late hit
    is never dropped for being late.  A hit with a NULL among its keys is not identified and always counts as new.
    """
    unknown = reduce(or_, [F.col(c).isNull() for c in keys])
    marked = hits.withColumns({"_arrived": F.current_timestamp(), "_alone": F.when(unknown, F.uuid())})
    return marked.withWatermark("_arrived", within).dropDuplicatesWithinWatermark([*keys, "_alone"]).drop("_arrived", "_alone")


def ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    lookups: Mapping[str, DataFrame] | Callable[[SparkSession], Mapping[str, DataFrame]],
    schema: T.StructType | None = None,
    roles: Sequence[tuple[str, str]] = DEFAULT_ROLES,
    timestamp: str = "date_time",
    pattern: str = "*.tsv.gz",
    archive: str | None = None,
    max_files: int | None = None,
    tasks: int | None = None,
    trigger: Mapping[str, object] | None = None,
    unique: bool = False,
    table: str | None = None,
    dedupe_on: Sequence[str] = (),
    dedupe_within: str = "7 days",
    stop: Callable[[str], None] = lambda step: None,
) -> StreamingQuery:
    """Start a stream that appends new hit files to the lake; by default it ends when it has caught up.

    The join is with static lookups and the sink is an append by the hit's own day, so there is no state
    and a late hit simply goes to its day.  ``archive`` moves a file away once a later batch is through.
    ``tasks`` spreads the parsing of a batch over that many tasks.  ``lookups`` may be a function, which is
    called for every batch: so a stream that runs for long takes its names from the newest bundle.

    Each batch's hits are counted before and after enrichment, as a load's are; a batch that lost some
    (or, with ``unique``, added some) fails the stream and is not noted.  ``table`` is registered, gets new
    columns, and shows each batch's partitions once the batch is written.

    A batch is published like a page of a load, together with a note beside the checkpoint.  A batch that Spark
    replays is first finished or dropped, and skipped if its note is there: its hits are in the lake once.

    ``dedupe_on`` keeps one of the hits that agree in these keys, whichever files of the last ``dedupe_within`` they
    came in (see :func:`first_arrivals`); the lake is not read for it.
    """
    schema = hit_schema() if schema is None else schema
    reader = spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def prepared(given: Mapping[str, DataFrame]):
        return prepare({name: given[name] for name, _ in roles}, unique, INLINE_ROWS)

    fixed = None if callable(lookups) else prepared(lookups)
    written = f"{checkpoint.rstrip('/')}-batches"

    def parsed(lines: DataFrame) -> DataFrame:
        return with_date(drop_empty(parse_hits(lines, schema, LINE), schema.names), timestamp)

    def append(lines: DataFrame, batch: int) -> None:
        session = lines.sparkSession
        mark = f"{written}/{batch}"
        recover(session, target)
        if exists(session, mark):
            if dedupe_on:  # The state must move on with the batch.
                lines.write.format("noop").mode("overwrite").save()
            return
        ready = prepared(lookups(session)) if fixed is None else fixed
        hits = lines if dedupe_on else parsed(spread_lines(lines, tasks) if tasks else lines)
        load_id = new_load_id()
        _, n_written = stage_checked(hits, ready, roles, target, load_id, bool(tasks), unique)
        stop("staged")
        manifest = publish(session, target, load_id, rows=n_written.rows, table=table, mark=mark)
        stop("published")
        finish(session, target, manifest, stop)

    arriving = reader.text(source)
    if dedupe_on:
        arriving = first_arrivals(parsed(arriving), dedupe_on, dedupe_within)
    stream = arriving.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return stream.trigger(**(trigger or {"availableNow": True})).start()
