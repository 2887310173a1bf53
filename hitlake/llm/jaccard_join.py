"""N-gram Jaccard join with adaptive multi-match prefixes.

A text is the set of its distinct runs of ``n`` words.  All sets are put in one global order, rare shingles first
(as told by a fixed-size sketch of counts over all texts, then by hash).  Two sets of similarity ``t`` or more share
at least ``k`` of the first ``size - ceil(t * size) + k`` elements of each.  Each text picks its own ``k``: a longer
prefix costs more postings, but more shared elements are asked for before a pair is verified.  A pair is a
candidate if it shares ``min`` of the two texts' ``k`` within the prefixes of that ``k``.

Equal sets are one class and take part once.  Verification first compares bitmaps, whose unshared bits each stand
for an unshared element, and then the whole sets of the pairs that this leaves.  It goes in two rounds.  The first
takes neighbours along each posting list that share much of their prefixes, and its links are contracted to components.  The second takes all
candidate pairs between different components, so that a group of thousands of near copies is not paired out.

Words are runs without space, tab, newline, vertical tab, form feed and return, with A-Z lowered.  A text of fewer
than ``n`` words is one shingle; a null or empty one has none and is linked with nothing.  Rows that share an id are
one document with several texts.  A row without an id is linked only to its copies.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlake.llm.batches import grams, mix, runs, word_hashes
from hitlake.llm.components import components as connect
from hitlake.operators.bloom_join import id_filter, n_blocks_for, split_by_ids
from hitlake.storage import scratch_path

MEMBER = np.ones(256, bool)
MEMBER[0x20] = MEMBER[0x09:0x0E] = False

#: Cells of the count sketch: its size does not grow with the corpus.
CELL_BITS = 21
_CHUNK = 1 << 15
#: Bytes of text handled at once.
_RUN_BYTES = 1 << 20
#: Longest multi-match, and what verifying a candidate costs in postings read.
MOST_MATCHES, VERIFY_COST = 4, 16.0
#: Postings of one bucket, on average.
BUCKET_POSTINGS = 400_000

#: How far along a list the first round looks.
NEIGHBOURS = 4

_SECOND = np.uint64(0x9E3779B97F4A7C15)


def _sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Ascending distinct shingles of each text."""
    words, first = word_hashes(column, MEMBER)
    shingles, first = grams(words, first, n)
    for k in range(len(first) - 1):
        yield np.unique(shingles[first[k] : first[k + 1]])


def _stored(frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def count_sketch(texts: DataFrame, n: int) -> np.ndarray:
    """How many texts' shingles fall into each cell, over all texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for run in runs(batches, 0, _RUN_BYTES):
            for own in _sets(run.column(0), n):
                np.add.at(total, _cells(own), 1)
        if total.any():
            yield packed(dict(enumerate(total.reshape(-1, _CHUNK))))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total[chunk] = total.get(chunk, 0) + np.frombuffer(zstandard.decompress(counts), "<u4").astype(np.int64)
        yield packed(total)

    def packed(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        bodies = [zstandard.compress(t.astype("<u4").tobytes(), 1) for t in total.values()]
        return pa.RecordBatch.from_pydict({"chunk": pa.array(list(total), pa.int32()), "counts": pa.array(bodies, pa.binary())})

    schema = "chunk int, counts binary"
    summed = texts.select("text").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema).toArrow()
    out = np.zeros(1 << CELL_BITS, np.uint32).reshape(-1, _CHUNK)
    for chunk, counts in zip(summed.column(0).to_pylist(), summed.column(1).to_pylist(), strict=True):
        out[chunk] = np.frombuffer(zstandard.decompress(counts), "<u4")
    return out.ravel()


def _order(shingles: np.ndarray, sketch: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """Rank keys (rarity level, then hash), and about how many other texts hold each shingle."""
    # Counts beyond what other shingles put into a cell by chance, in standard deviations of that.
    above = sketch[_cells(shingles)] - mean
    level = np.clip(4 * np.log2(1 + np.maximum(above, 0) / (2 * max(mean, 1.0) ** 0.5)), 0, 63).astype(np.uint64)
    return (level << np.uint64(58)) | (mix(shingles) >> np.uint64(6)), np.maximum(above - 2 * mean**0.5, 0.0)


def _needed(size: int, percent: int) -> int:
    """The least overlap that a set of this size has with any similar one: ceil(percent / 100 * size)."""
    return -(-percent * size // 100)


def prefix(own: np.ndarray, sketch: np.ndarray, mean: float, percent: int) -> tuple[np.ndarray, int]:
    """A set's prefix in the global order, and the number of matches that goes with its length."""
    keys, others = _order(own, sketch, mean)
    base = len(own) - _needed(len(own), percent)
    order = np.argsort(keys)[: base + MOST_MATCHES]
    postings = np.cumsum(others[order])
    best, matches = np.inf, 1
    for k in range(1, min(MOST_MATCHES, _needed(len(own), percent)) + 1):
        read = float(postings[min(base + k, len(order)) - 1])
        cost = read + VERIFY_COST * read / k + (base + k) * 0.5
        if cost < best:
            best, matches = cost, k
    return keys[order][: base + matches], matches


_PROFILE = "doc_id bigint, n_shingles bigint, sign binary, matches int, prefix binary"


def _profiles(texts: DataFrame, n: int, percent: int, sketch: np.ndarray) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(sketch)

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        mean = float(counts.mean())
        for run in runs(batches, limit=_RUN_BYTES):
            sizes, signs, matches, prefixes = [], [], [], []
            for own in _sets(run.column(1), n):
                sizes.append(len(own))
                signs.append(np.array([len(own), mix(own).sum(), mix(own ^ _SECOND).sum()], "<u8").tobytes())
                keys, k = prefix(own, counts, mean, percent) if len(own) else (own, 0)
                matches.append(k)
                prefixes.append(keys.astype("<u8").tobytes())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": run.column(0), "n_shingles": pa.array(sizes, pa.int64()), "sign": pa.array(signs, pa.binary()), "matches": pa.array(matches, pa.int32()), "prefix": pa.array(prefixes, pa.binary())}
            )

    return texts.select("doc_id", "text").mapInArrow(apply, _PROFILE)


_POSTING = np.dtype([("key", "<u8"), ("doc", "<i8"), ("root", "<i8"), ("size", "<i4"), ("at", "<i4"), ("matches", "<i4"), ("weight", "<i4")])


def _packed(postings: np.ndarray) -> bytes:
    """Postings sorted by key, column by column, keys as gaps and roots relative to documents."""
    columns = {name: postings[name].copy() for name in _POSTING.names}
    columns["key"][1:] -= postings["key"][:-1]
    columns["root"] -= postings["doc"]
    return zstandard.compress(b"".join(c.tobytes() for c in columns.values()), 1)


def _unpacked_postings(packed: bytes) -> np.ndarray:
    raw = zstandard.decompress(packed)
    postings, at = np.empty(len(raw) // _POSTING.itemsize, _POSTING), 0
    for name in _POSTING.names:
        kind = _POSTING[name]
        postings[name] = np.frombuffer(raw, kind, len(postings), at)
        at += kind.itemsize * len(postings)
    postings["key"] = np.cumsum(postings["key"], dtype=np.uint64)
    postings["root"] += postings["doc"]
    return postings


def _dealt(buckets: int):
    """Postings of one batch of texts, a packed array for each bucket of keys."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = [np.frombuffer(p, "<u8") for p in batch.column(5).to_pylist()]
            lengths = np.array([len(p) for p in prefixes])
            made = np.empty(int(lengths.sum()), _POSTING)
            if not len(made):
                continue
            made["key"] = np.concatenate(prefixes)
            for n, name in enumerate(("doc", "root", "size", "matches", "weight")):
                made[name] = np.repeat(batch.column(n).to_numpy(zero_copy_only=False), lengths)
            made["at"] = np.arange(len(made)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            bucket = (mix(made["key"]) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((made["key"], bucket))
            made, bucket = made[order], bucket[order]
            heads = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(heads[1:], len(made))
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket[heads], pa.int32()), "postings": pa.array([_packed(made[a:b]) for a, b in zip(heads, ends, strict=True)], pa.binary())})

    return apply


def _pairs_of(postings: np.ndarray, percent: int, mode: str) -> Iterator[np.ndarray]:
    """Rows (a, b, matches asked for, whether a and b may be similar) of one bucket's postings.

    "near" gives the neighbours along each list, "hub" each list's posting of largest weight with all others of it, and
    "all" all pairs; the last two only where roots differ and the texts may be similar.
    """
    by_weight = -postings["weight"] if mode == "hub" else np.zeros(len(postings), np.int8)
    postings = postings[np.lexsort((postings["doc"], by_weight, postings["key"]))]
    head = np.concatenate([[True], postings["key"][1:] != postings["key"][:-1]])
    group = np.cumsum(head)
    last = np.searchsorted(group, group, "right")  # end of each posting's list
    live = np.arange(len(postings))
    distance = 1
    while True:
        if mode == "hub":
            live = np.flatnonzero(~head)
            a, b = postings[np.flatnonzero(head)[group[live] - 1]], postings[live]
        else:
            live = live[live + distance < last[live]]
            a, b = postings[live], postings[np.minimum(live + distance, len(postings) - 1)]
        if not len(live):
            return
        need = -(-percent * (a["size"].astype(np.int64) + b["size"]) // (100 + percent))
        bound = np.minimum(a["at"], b["at"]) + np.minimum(a["size"] - a["at"], b["size"] - b["at"])
        k = np.minimum(a["matches"], b["matches"])
        limit = lambda x: x["size"] - -(-percent * x["size"].astype(np.int64) // 100) + k
        keep = (a["root"] != b["root"]) & (bound >= need) & (np.maximum(a["size"], b["size"]) * np.int64(percent) <= 100 * np.minimum(a["size"], b["size"]).astype(np.int64))
        keep &= (a["at"] < limit(a)) & (b["at"] < limit(b))
        if mode == "near":
            room = np.minimum(limit(a), limit(b))  # the first round is free to choose: likely links only
            yield np.stack([a["doc"], b["doc"], np.maximum(k, room // 4), keep], axis=1).astype(np.int64)
        else:
            yield np.stack([a["doc"][keep], b["doc"][keep], k[keep] if mode == "all" else keep[keep], keep[keep]], axis=1).astype(np.int64)
        distance += 1
        if mode == "hub" or mode == "near" and distance > NEIGHBOURS:
            return


def _candidates(dealt: DataFrame, percent: int, mode: str, parts: int) -> DataFrame:
    """(a, b, shared, likely): pairs with a < b, and whether they share as many prefix elements as was asked for.

    Neighbours come whatever they share; of all pairs only those that share enough.
    """

    def of_bucket(held: list[bytes]) -> Iterator[pa.RecordBatch]:
        postings = np.concatenate([_unpacked_postings(p) for p in held])
        waiting, size = [], 0
        for found in _pairs_of(postings, percent, mode):
            waiting.append(found)
            size += len(found)
            if size > 200_000:
                yield _counted(waiting)
                waiting, size = [], 0
        if size:
            yield _counted(waiting)

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, []
        for batch in batches:
            for bucket, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != number and held:  # one bucket at a time
                    yield from of_bucket(held)
                    held = []
                number = bucket
                held.append(packed)
        if held:
            yield from of_bucket(held)

    made = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(apply, "a bigint, b bigint, asked int, shared bigint")
    summed = made.groupBy("a", "b").agg(F.min("asked").alias("asked"), F.sum("shared").alias("shared"))
    return (summed if mode == "near" else summed.where("shared >= asked")).select("a", "b", "shared", (F.col("shared") >= F.col("asked")).alias("likely"))


def _counted(waiting: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(waiting)
    pairs = np.stack([np.minimum(rows[:, 0], rows[:, 1]), np.maximum(rows[:, 0], rows[:, 1])], axis=1)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs, asked = pairs[order], rows[order, 2]
    heads = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)]))
    return pa.RecordBatch.from_pydict(
        {
            "a": pa.array(pairs[heads, 0], pa.int64()),
            "b": pa.array(pairs[heads, 1], pa.int64()),
            "asked": pa.array(np.minimum.reduceat(asked, heads), pa.int32()),
            "shared": pa.array(np.add.reduceat(rows[order, 3], heads), pa.int64()),
        }
    )


def _bitmap(own: np.ndarray) -> bytes:
    """Two to four bits for each element, a power of two in all; the low bits of a hash tell its place."""
    size = 1 << max(6, int(2 * len(own) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(own & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _shingle_sets(texts: DataFrame, n: int) -> DataFrame:
    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, limit=_RUN_BYTES):
            sizes, packed, bitmaps = [], [], []
            for own in _sets(run.column(1), n):
                sizes.append(len(own))
                # Six bytes of each hash: two of a pair's elements agree by chance once in 2 ** 48.
                packed.append((own >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
                bitmaps.append(_bitmap(own))
            columns = [run.column(0), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary()), pa.array(bitmaps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "size", "own", "bits"])

    return texts.select("doc_id", "text").mapInArrow(apply, "doc_id bigint, size int, own binary, bits binary")


def _unpacked(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _common(x: bytes, y: bytes) -> int:
    """How many elements two packed sets share."""
    both = np.concatenate([_unpacked(x), _unpacked(y)])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def _most_common(x: bytes, y: bytes, size_x: int, size_y: int) -> int:
    """How many elements two sets share at most, told from their bitmaps."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    size = min(len(x), len(y))
    x, y = _folded(x, size), _folded(y, size)
    return min(size_x - int(np.bitwise_count(x & ~y).sum()), size_y - int(np.bitwise_count(y & ~x).sum()))


def _among(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``key`` is among ``ids``, and about one of a hundred others: told by a broadcast filter, without a shuffle."""
    n_blocks = n_blocks_for(ids.count())
    return rows if n_blocks is None else split_by_ids(rows, key, id_filter(ids, n_blocks), n_blocks)[0]


def _passing(pairs: DataFrame, sets: DataFrame, column: str, percent: int, exact: bool) -> DataFrame:
    """The pairs (a, b) that are similar by their whole sets, or may be by their bitmaps."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, m, n in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                common = _common(x, y) if exact else _most_common(x, y, m, n)
                keep.append(100 * common >= percent * (m + n - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = _among(sets.select("doc_id", "size", column), "doc_id", pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col(column).alias("x"), F.col("size").alias("m")), "a")
    both = left.join(sets.select(F.col("doc_id").alias("b"), F.col(column).alias("y"), F.col("size").alias("n")), "b")
    return both.select("a", "b", "x", "y", "m", "n").mapInArrow(apply, "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar."""
    left = _stored(_passing(pairs, sets, "bits", percent, False), "screened")
    return _stored(_passing(left, sets, "own", percent, True), "links")


def components(texts: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``texts`` (doc_id, text): doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    spark = texts.sparkSession
    texts = texts.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    profiles = _stored(_profiles(texts, n, percent, count_sketch(texts, n)), "profiles")
    classes = _stored(profiles.where("n_shingles > 0").groupBy("sign").agg(F.min("doc_id").alias("rep")), "classes")
    reps = profiles.join(classes.where("rep IS NOT NULL"), "sign").where("doc_id = rep").dropDuplicates(["sign"])
    reps = _stored(reps.select("doc_id", "n_shingles", "matches", "prefix"), "reps")
    total = reps.agg(F.sum(F.length("prefix") / 8)).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * parts, 1 + int(total) // BUCKET_POSTINGS)
    parts = max(parts, buckets // 4)

    def candidates(rooted: DataFrame, mode: str) -> DataFrame:
        rows = rooted.select("doc_id", "root", F.col("n_shingles").cast("int").alias("size"), "matches", "weight", "prefix")
        return _candidates(rows.mapInArrow(_dealt(buckets), "bucket int, postings binary"), percent, mode, parts)

    near = _stored(candidates(reps.withColumn("root", F.col("doc_id")).withColumn("weight", F.lit(0)), "near"), "neighbours")
    # Whoever stands on a list with another text has a neighbour there; nobody else can be a candidate.
    places = near.select(F.explode(F.array("a", "b")).alias("doc_id"), "shared")
    wanted = _stored(places.groupBy("doc_id").agg(F.sum("shared").cast("int").alias("weight")), "wanted")
    ids = wanted.select(F.col("doc_id").alias("id"))
    sets = _stored(_shingle_sets(_among(texts, "doc_id", ids), n), "sets")
    reps = _stored(_among(reps, "doc_id", ids).join(wanted, "doc_id"), "live")
    roots = _stored(connect(_verified(near.where("likely").select("a", "b"), sets, percent)), "roots")

    def rooted() -> DataFrame:
        return reps.join(roots, reps["doc_id"] == roots["node"], "left").withColumn("root", F.coalesce("root", "doc_id"))

    def joined(more: DataFrame) -> DataFrame:
        return connect(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more))

    hubs = _stored(candidates(rooted(), "hub").select("a", "b"), "hubs")
    roots = _stored(joined(_verified(hubs, sets, percent)), "roots")
    across = _stored(candidates(rooted(), "all").select("a", "b"), "across")
    whole = joined(_verified(across, sets, percent))

    found = profiles.select("doc_id", "n_shingles", "sign").join(classes, "sign", "left").join(whole, F.col("rep") == F.col("node"), "left")
    return found.select("doc_id", "n_shingles", F.coalesce("root", "rep", "doc_id").alias("component_id"))
