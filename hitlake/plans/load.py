"""The daily load: landing area in, enriched lake out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from math import ceil

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlake.operators.enrich import enrich
from hitlake.operators.lookup_join import INLINE_ROWS, Lookup, prepare
from hitlake.plans.lake import not_loaded
from hitlake.plans.ledger import mark_done, pending, read_ledger, seal, sealable, sealed_days
from hitlake.plans.publish import finish, new_load_id, publish, recover, stage
from hitlake.sources.bundle import lookup_table, read_lookups
from hitlake.sources.columns import headers_by_day, read_hits_by_header
from hitlake.sources.hits import drop_empty, read_hits_spread, with_date
from hitlake.sources.landing import (
    FEED_NAMES,
    FeedNames,
    classify,
    closed_files,
    file_pages,
    latest_bundle,
    list_landing,
    list_unsealed,
    removable,
)
from hitlake.sources.manifest import ManifestNames, listed_files, read_manifests
from hitlake.sources.schema import DEFAULT_ROLES, hit_schema
from hitlake.storage import list_files, literal_path

# Compressed feed bytes per task: about the size of the Parquet file the task writes.
TASK_BYTES = 128 << 20


#: Column that identifies a hit while it is loaded; it is not written.
LINE = "_line_hash"


class IncompleteLoad(RuntimeError):
    """Other hits were written than read; the files stay pending."""


@dataclass(frozen=True)
class Checksum:
    """An order-free checksum of a multiset of hits: how many, the sum of their hashes, and their exclusive or."""

    rows: int = 0
    total: int = 0
    mixed: int = 0

    def __add__(self, other: Checksum) -> Checksum:
        return Checksum(self.rows + other.rows, self.total + other.total, self.mixed ^ other.mixed)


@dataclass(frozen=True)
class LoadReport:
    files: int
    rows_read: int
    rows_written: int
    read: Checksum = field(default=Checksum(), compare=False)
    written: Checksum = field(default=Checksum(), compare=False)


def check_sums(read: Checksum, written: Checksum, exact: bool) -> None:
    """The gate before a load is published: enrichment never loses a hit, and with unique ids writes just those read.

    A lost hit and a doubled one leave the count as it is, but not the sum.  Where ids may repeat only counts can tell.
    """
    if written.rows < read.rows or (exact and written != read):
        raise IncompleteLoad(f"{read} read but {written} written")


def check_files(observed: int, held: int) -> None:
    """The files must hold the rows that went into them."""
    if observed != held:
        raise IncompleteLoad(f"{observed} rows written but the files hold {held}")


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.col(LINE).cast("decimal(20,0)")).alias("total"), F.bit_xor(LINE).alias("mixed")]


def _observed(sums: Observation, rows: DataFrame) -> Checksum:
    """What was observed while ``rows`` were written."""
    try:
        found = sums.get
    except Py4JJavaError:
        # Spark drops the sums together with the rest of the plan when it finds the input empty.
        if rows.isEmpty():
            return Checksum()
        raise
    return Checksum(found["rows"], int(found["total"] or 0), found["mixed"] or 0)


def _held(spark: SparkSession, path: str) -> int:
    """Rows of staged files, told by their footers."""
    if not any(name.endswith(".parquet") for name, _ in list_files(spark, path)):
        return 0
    return spark.read.parquet(path).count()


def stage_checked(
    hits: DataFrame, ready: Mapping[str, Lookup], roles: Sequence[tuple[str, str]], target: str, load_id: str, clustered: bool, exact: bool
) -> tuple[Checksum, Checksum]:
    """Enrich and stage hits that carry ``LINE``, and check that none was lost: what was read, and what was written.

    What is written is observed in the job's last stage, which counts each of its tasks once.  Where a lookup is too
    large to broadcast, what is read is observed before a shuffle and can include a task that ran again: that fails
    the load, and never passes a wrong one.
    """
    exact = exact or all(lookup.names is not None for lookup in ready.values())
    read, written = Observation(), Observation()
    enriched = enrich(hits.observe(read, *_sums()), ready, roles).observe(written, *_sums())
    path = stage(enriched.drop(LINE), target, load_id, clustered)
    n_read, n_written = _observed(read, hits), _observed(written, enriched)
    check_sums(n_read, n_written, exact)
    check_files(n_written.rows, _held(hits.sparkSession, path))
    return n_read, n_written


def load(
    spark: SparkSession,
    source: str,
    target: str,
    ledger: str,
    schema: T.StructType | None = None,
    roles: Sequence[tuple[str, str]] = DEFAULT_ROLES,
    lookups: Mapping[str, DataFrame] | None = None,
    names: FeedNames = FEED_NAMES,
    timestamp: str = "date_time",
    include_open: bool = False,
    unique: bool = False,
    dedupe_on: Sequence[str] = (),
    files: int | None = None,
    page_size: int = 10_000,
    task_bytes: int = TASK_BYTES,
    table: str | None = None,
    manifests: ManifestNames | None = None,
    header_member: str | None = None,
    day_folder: str | None = None,
    seal_after: int = 7,
    stop: Callable[[str], None] = lambda step: None,
) -> LoadReport:
    """Load every pending file of the closed days, then mark it in the ledger.

    Files are taken in day order, a page at a time; one page is one Spark job, so a long backlog keeps
    the cluster busy rather than running one day's few files after another.  Lookups come from the newest
    bundle unless given.  A page is published as a whole (see ``publish``): a load that was stopped anywhere is
    finished or dropped by the next one, so no hit is lost or loaded twice.  ``dedupe_on`` names columns that
    identify a hit, for feeds that deliver hits again.  One load may run at a time.

    With ``manifests`` a day is closed once every file that its manifests list is there in full, the newest day
    too, and only listed files are loaded; ``include_open`` then has no meaning.

    With ``header_member`` the bundle's member of that name tells the columns of each day's files: columns are found by
    name, missing ones are NULL, and new ones are added to the lake as text.

    With ``day_folder`` the landing area is one folder per day, found by that pattern (see ``list_unsealed``).  Loaded days
    with ``seal_after`` newer ones are then sealed, and not listed again.

    A day is parsed and written by one task per ``task_bytes`` of its compressed files, or by ``files``
    tasks; so many files at most are written per day of the feed and date touched.
    """
    schema = hit_schema() if schema is None else schema
    recover(spark, target)
    known = read_ledger(spark, ledger)
    listed = list_landing(spark, source) if day_folder is None else list_unsealed(spark, source, sealed_days(known), day_folder)
    landing = classify(listed, names).persist()
    todo = pending(landing, known).persist()
    combined = None
    if lookups is None:
        tables = [name for name, _ in roles]
        combined = read_lookups(spark, literal_path(latest_bundle(landing)), tables).persist()
        lookups = {name: lookup_table(combined, name) for name in tables}
    n_files, n_read, n_written = 0, Checksum(), Checksum()
    try:
        ready = prepare({name: lookups[name] for name, _ in roles}, unique, INLINE_ROWS)
        if manifests is None:
            closed = closed_files(todo, include_open, landing)
        else:
            closed = listed_files(landing, read_manifests(spark, landing, manifests), names, manifests.per_day).join(todo.select("path"), "path", "left_semi")
        for page in file_pages(closed, page_size):
            sizes_by_day: dict[str, int] = {}
            for row in page:
                sizes_by_day[row["feed_date"]] = sizes_by_day.get(row["feed_date"], 0) + row["length"]
            tasks = {day: files or max(1, ceil(n_bytes / task_bytes)) for day, n_bytes in sizes_by_day.items()}
            paths = [literal_path(row["path"]) for row in page]
            if header_member is None:
                raw = read_hits_spread(spark, paths, tasks, schema, names.day_pattern, LINE)
            else:
                by_day: dict[str, list[str]] = {}
                for row, path in zip(page, paths, strict=True):
                    by_day.setdefault(row["feed_date"], []).append(path)
                headers = headers_by_day(spark, landing, by_day, names, header_member)
                raw = read_hits_by_header(spark, by_day, headers, tasks, schema, names.day_pattern, LINE)
            hits = with_date(drop_empty(raw, [name for name in raw.columns if name != LINE]), timestamp)
            if dedupe_on:
                hits = not_loaded(hits, target, dedupe_on)
            load_id = new_load_id()
            page_read, page_written = stage_checked(hits, ready, roles, target, load_id, True, unique)
            stop("staged")
            taken = [(row["path"], row["feed_date"]) for row in page]
            manifest = publish(spark, target, load_id, taken, page_written.rows, ledger, table)
            stop("published")
            finish(spark, target, manifest, stop)
            n_files, n_read, n_written = n_files + len(page), n_read + page_read, n_written + page_written
        rest = removable(todo)
        if not rest.isEmpty():
            mark_done(rest.coalesce(1), ledger)
        if day_folder is not None:
            days = sealable(landing, read_ledger(spark, ledger), seal_after)
            if not days.isEmpty():
                seal(days, ledger)
    finally:
        for frame in (todo, landing, combined):
            if frame is not None:
                frame.unpersist()
    return LoadReport(n_files, n_read.rows, n_written.rows, n_read, n_written)

