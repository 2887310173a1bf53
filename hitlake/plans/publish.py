"""Loads that happen once or not at all: staged files, a load manifest, and recovery.

A load writes its Parquet files below ``<lake>/_loads/<id>/data``, which no reader of the lake sees.  Creating its
manifest, a small file that must not be there yet, is the one step that publishes it.  Before that step the load never
happened, and the next start drops what it staged.  After it the load is finished by whoever starts next: files are
moved to their dates, touched partitions are shown, landing files are marked in the ledger, and the load's folder goes.
Each of these steps can be repeated, so a stop between any two of them neither loses nor doubles a row.

The driver handles names only: those of one load's files and of its landing files, both bounded by a page.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from hitlake.plans.lake import add_columns, add_partitions, refresh, register, write_hits
from hitlake.plans.ledger import mark_done, pending, read_ledger
from hitlake.storage import create_new, exists, list_files, list_folders, move, read_bytes, remove

#: Steps of a load after its hits are staged, in their order; ``stop`` hears of each when it is done.
STEPS = ("staged", "published", "moved", "shown", "marked", "settled")

_FOLDER = "_loads"
_NULL_DATE = "__HIVE_DEFAULT_PARTITION__"


class LostFile(RuntimeError):
    """A published file is neither staged nor in the lake."""


@dataclass(frozen=True)
class LoadManifest:
    """What a load publishes: its files by path below the lake, with their bytes, and the landing files it took.

    It also says where to make that known: the ledger, the catalog table, and a file to be made as a mark.  Files of
    the lake that it replaces go once its own are there.
    """

    load_id: str
    files: Sequence[tuple[str, int]]
    taken: Sequence[tuple[str, str]] = ()
    rows: int = 0
    ledger: str | None = None
    table: str | None = None
    mark: str | None = None
    replaced: Sequence[str] = ()

    @property
    def dates(self) -> list[str | None]:
        """The dates touched; None for hits without a date."""
        values = {unquote(name.split("/", 1)[0].split("=", 1)[1]) for name, _ in self.files}
        return [None if value == _NULL_DATE else value for value in sorted(values)]

    def encode(self) -> bytes:
        return json.dumps(asdict(self) | {"end": True}).encode()

    @staticmethod
    def decode(content: bytes) -> LoadManifest | None:
        """The manifest, or None where its writer was stopped before its end."""
        try:
            found = json.loads(content)
        except ValueError:
            return None
        if not isinstance(found, dict) or not found.pop("end", False):
            return None
        pairs = {name: tuple(map(tuple, found[name])) for name in ("files", "taken")}
        return LoadManifest(**(found | pairs | {"replaced": tuple(found["replaced"])}))


def new_load_id() -> str:
    return uuid.uuid4().hex


def _folder(target: str, load_id: str) -> str:
    return f"{target.rstrip('/')}/{_FOLDER}/{load_id}"


def stage(hits: DataFrame, target: str, load_id: str, clustered: bool = False) -> str:
    """Write hits where only their load sees them; what an earlier try staged is dropped.  Returns the folder."""
    path = f"{_folder(target, load_id)}/data"
    remove(hits.sparkSession, path)
    write_hits(hits, path, clustered=clustered)
    return path


def publish(
    spark: SparkSession,
    target: str,
    load_id: str,
    taken: Sequence[tuple[str, str]] = (),
    rows: int = 0,
    ledger: str | None = None,
    table: str | None = None,
    mark: str | None = None,
    replaced: Sequence[str] = (),
) -> LoadManifest:
    """Create the manifest of a staged load; from here on the load counts.  Fails if there is one already."""
    folder = _folder(target, load_id)
    found = [(name, size) for name, size in list_files(spark, f"{folder}/data") if name.endswith(".parquet")]
    manifest = LoadManifest(load_id, tuple(found), tuple(taken), rows, ledger, table, mark, tuple(replaced))
    create_new(spark, f"{folder}/manifest.json", manifest.encode())
    return manifest


def _nothing(step: str) -> None:
    return None


def _show(spark: SparkSession, target: str, manifest: LoadManifest) -> None:
    """The load's columns and dates in the catalog; a table that is new gets all that the lake holds."""
    if not manifest.table or not manifest.files:
        return
    hits = spark.read.option("basePath", target).parquet(f"{target.rstrip('/')}/{manifest.files[0][0]}")
    if spark.catalog.tableExists(manifest.table):
        add_columns(spark, manifest.table, hits)
        add_partitions(spark, manifest.table, manifest.dates)
    else:
        register(spark, manifest.table, target, hits)
        refresh(spark, manifest.table)


def finish(spark: SparkSession, target: str, manifest: LoadManifest, stop: Callable[[str], None] = _nothing) -> None:
    """Do what is left of a published load; every part of it may have been done before."""
    folder, lake = _folder(target, manifest.load_id), target.rstrip("/")
    # Names that Spark gives to files hold the writing job's id, so those of two loads differ.
    for name, size in manifest.files:
        if not move(spark, f"{folder}/data/{name}", f"{lake}/{name}", size):
            raise LostFile(f"load {manifest.load_id}: {name}")
    for name in manifest.replaced:
        remove(spark, f"{lake}/{name}")
    stop("moved")
    _show(spark, target, manifest)
    stop("shown")
    if manifest.ledger and manifest.taken:
        taken = spark.createDataFrame(list(manifest.taken), "path string, feed_date string")
        left = pending(taken, read_ledger(spark, manifest.ledger))
        if not left.isEmpty():
            mark_done(left.coalesce(1), manifest.ledger)
    if manifest.mark and not exists(spark, manifest.mark):
        create_new(spark, manifest.mark, b"")
    stop("marked")
    remove(spark, f"{folder}/data")
    remove(spark, folder)
    stop("settled")


def recover(spark: SparkSession, target: str) -> tuple[int, int]:
    """Finish published loads and drop the others; call it before a load plans.  Returns how many of each there were."""
    finished = dropped = 0
    for folder in list_folders(spark, f"{target.rstrip('/')}/{_FOLDER}"):
        path = f"{folder}/manifest.json"
        manifest = LoadManifest.decode(read_bytes(spark, path)) if exists(spark, path) else None
        if manifest is None:
            remove(spark, folder)
            dropped += 1
        else:
            finish(spark, target, manifest)
            finished += 1
    return finished, dropped
