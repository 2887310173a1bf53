"""Suffix-array dedup: every byte covered by a string of ``LENGTH`` bytes that also starts in an earlier document.

Texts are packed into shards, which every step reads.  First, what cannot repeat is left aside without loss: every
window of ``LENGTH`` bytes has an anchor (the substring of ``GRAM`` bytes with the smallest hash, the first one of
equals), and equal windows have equal anchors.  The windows of each anchor form one stretch of text; each holds the anchor with
``SIDE`` more bytes before or after it, so a stretch has two sides, and windows of a side that stands in one document
alone are unique.  Stretches with a side that several documents hold are dealt out by anchor, and equal ones are kept
once with their smallest document.  No window stands twice within a stretch, so sides that only one of the different
stretches has are done.  The suffixes of the sides that are left are sorted by the difference-cover algorithm:
triples at two thirds of the places are sorted and named, the names' text is sorted in the same way until a name
covers ``LENGTH`` bytes or is unique, and the other suffixes are sorted by first byte and next name and merged in.
Neighbours in that order are compared by their first ``LENGTH`` bytes; the smallest document of each group of equal
windows goes back to the shards, which cut the text.

Null and empty texts have no bytes.  Rows without an id come before all others; rows that share an id are one
document and do not remove from each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlake.llm.batches import Hasher, byte_view, runs
from hitlake.llm.ranges import NO_KEY
from hitlake.storage import scratch_path

LENGTH, GRAM = 50, 24
_REACH = LENGTH - GRAM + 1  # places of an anchor within a window
SIDE = (LENGTH - GRAM) // 2  # every window holds this many bytes before its anchor, or after it
#: Bytes of text for each bucket of anchors.
BUCKET_BYTES = 1 << 20
#: Bytes of stretches that are sorted at once: a bucket's anchors are taken in groups of about this much.
SORT_BYTES = 1 << 18
#: Bytes of text in a shard.
SHARD_BYTES = 2 << 20
#: Window starts of a shard that are hashed at once.
RUN_STARTS = 1 << 18
_PLACE_BITS = 20  # of a place within a run; the same for every run, so that equal windows have equal anchors
_NONE = np.iinfo(np.int64).max

_SHARD = "shard bigint, ids binary, lengths binary, body binary"


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 32
    for number, run in enumerate(runs(batches, limit=SHARD_BYTES)):
        data, offsets = byte_view(run.column(1))
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([base + number], pa.int64()),
                "ids": pa.array([run.column(0).fill_null(NO_KEY).to_numpy().astype("<i8").tobytes()], pa.binary()),
                "lengths": pa.array([np.diff(offsets).astype("<i8").tobytes()], pa.binary()),
                "body": pa.array([zstandard.compress(data.tobytes(), 1)], pa.binary()),
            }
        )


class Stretches:
    """The anchors of one shard, and the windows that each of them stands for.

    Window starts are taken in bounded runs, so that only a little more than the text itself and its stretches is
    held at once.  A stretch ends where a run does.
    """

    def __init__(self, ids: bytes, lengths: bytes, body: bytes):
        self.ids = np.frombuffer(ids, "<i8")
        self.offsets = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, "<i8"))])
        self.data = np.frombuffer(zstandard.decompress(body) if body else b"", np.uint8)
        count = max(0, len(self.data) - LENGTH + 1)
        parts = [self._run(a, min(a + RUN_STARTS, count)) for a in range(0, count, RUN_STARTS)]
        kinds = (np.int64, np.int64, np.uint64, np.uint64, np.int64, np.uint8, np.uint64, np.uint64)
        self.begin, self.end, self.hash, self.content, self.doc, self.before, self.left, self.right = (np.concatenate([p[n] for p in parts]) if parts else np.zeros(0, kind) for n, kind in enumerate(kinds))

    def _run(self, a: int, b: int) -> tuple[np.ndarray, ...]:
        """Begin, end (of window starts), anchor hash, content hash, document, bytes before the anchor and hashes of both sides, for the stretches that start in [a, b)."""
        hasher = Hasher(self.data[a : b + LENGTH - 1])
        grams = np.arange(b - a + _REACH - 1)
        value = hasher.spans(grams, grams + GRAM)
        # The place in the low bits: the smallest is the first one of equals, and says where it stands.
        low = np.uint64(_PLACE_BITS)
        least = value >> low << low | grams.astype(np.uint64)
        width = 1
        while width < _REACH:  # the smallest of the next ``width`` grams
            step = min(width, _REACH - width)
            least = np.minimum(least[step:], least[:-step])
            width += step
        place = (least & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
        starts = np.arange(a, b)
        edges = np.searchsorted(starts, self.offsets)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(edges))
        whole = np.flatnonzero(starts + LENGTH <= self.offsets[doc + 1])
        anchor, doc = place[whole], doc[whole]
        heads = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])) if len(whole) else whole
        begin = whole[heads]
        end = whole[np.append(heads[1:], len(whole)) - 1] + 1 if len(whole) else whole
        at, last = anchor[heads], end + LENGTH - 1
        left, right = hasher.spans(np.maximum(at - SIDE, begin), at + GRAM), hasher.spans(at, np.minimum(at + GRAM + SIDE, last))
        return begin + a, end + a, value[at], hasher.spans(begin, last), self.ids[doc[heads]], (at - begin).astype(np.uint8), left, right

    def sides(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the sides that have windows, and the stretch of each."""
        middle = self.before.astype(np.int64) - SIDE
        left, right = np.flatnonzero(middle >= 0), np.flatnonzero(middle < self.end - self.begin)
        return np.concatenate([self.left[left], ~self.right[right]]), np.concatenate([left, right])

    def short(self) -> np.ndarray:
        """32 bits of each anchor's hash, by which stretches are dealt out."""
        return _short(self.hash)


def _short(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype("<u4")


def _bucket(short: np.ndarray, buckets: int) -> np.ndarray:
    return (short.astype(np.uint64) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _cut(order: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    heads = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    if not len(order):
        return
    for a, b in zip(heads, np.append(heads[1:], len(order)), strict=True):
        yield int(bucket[order[a]]), order[a:b]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for n in range(batch.num_rows):
        yield batch.slice(n, 1).to_pylist()[0]


def _sent(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns, schema=schema)


_PART = pa.schema([("bucket", pa.int32()), ("shard", pa.int64()), ("body", pa.binary())])
_PART_DDL = "bucket int, shard bigint, body binary"


#: Bytes of a side's name.  A side that shares its name by chance (about one of a hundred) is taken for one that
#: several documents hold, so its stretch is sorted too: more work, the same result.
_NAME_BYTES = 3


def _names(hashes: np.ndarray) -> np.ndarray:
    """The low bytes of the hashes, a row for each, which tell sides of one bucket apart; the high half gives the bucket."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_NAME_BYTES]


def _numbers(names: bytes) -> np.ndarray:
    """Names as numbers."""
    wide = np.zeros((len(names) // _NAME_BYTES, 4), np.uint8)
    wide[:, :_NAME_BYTES] = np.frombuffer(names, np.uint8).reshape(-1, _NAME_BYTES)
    return wide.view("<u4").ravel()


def _by_byte(values: np.ndarray) -> bytes:
    """Numbers as all their first bytes, all their second ones, ...: those that are zero compress to nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _from_bytes(raw: bytes, kind: str, size: int, at: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, width * size, at).reshape(width, size).T).view(kind).ravel()


def _sides(buckets: int):
    """For each shard and bucket the sides' names, and whether several of the shard's documents hold each."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                own = Stretches(row["ids"], row["lengths"], row["body"])
                hashes, stretch = own.sides()
                hashes, at = np.unique(hashes, return_inverse=True)
                docs = own.doc[stretch]
                first, last = np.full(len(hashes), _NONE), np.full(len(hashes), np.iinfo(np.int64).min)
                np.minimum.at(first, at, docs)
                np.maximum.at(last, at, docs)
                several, names = first != last, _names(hashes)
                out: dict[str, list] = {"bucket": [], "shard": [], "body": []}
                for number, part in _cut(np.arange(len(names)), _bucket(hashes >> np.uint64(32), buckets)):
                    out["bucket"].append(number)
                    out["shard"].append(row["shard"])
                    out["body"].append(names[part].tobytes() + np.packbits(several[part]).tobytes())
                yield _sent(out, _PART)

    return apply


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard and bucket, the names that more than one document holds."""
    held: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for bucket, shard, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            size = 8 * len(body) // (8 * _NAME_BYTES + 1)  # a name and a bit of each
            several = np.unpackbits(np.frombuffer(body, np.uint8, -1, _NAME_BYTES * size))[:size]
            held.setdefault(bucket, []).append((shard, np.frombuffer(body, np.uint8, _NAME_BYTES * size), several))
    for bucket, parts in held.items():
        _, at = np.unique(_numbers(b"".join(p[1] for p in parts)), return_inverse=True)
        common = (np.bincount(at, np.concatenate([p[2] for p in parts]) + 1.0) > 1)[at]
        out: dict[str, list] = {"bucket": [], "shard": [], "body": []}
        begin = 0
        for shard, own, several in parts:
            out["bucket"].append(bucket)
            out["shard"].append(shard)
            out["body"].append(own.reshape(-1, _NAME_BYTES)[common[begin : begin + len(several)]].tobytes())
            begin += len(several)
        yield _sent(out, _PART)


def _live(own: Stretches, common: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches with a shared side, as rows of distinct ones: (rows, first row of each, distinct row of each)."""
    hashes, stretch = own.sides()
    rows = np.unique(stretch[np.isin(_numbers(_names(hashes).tobytes()), _numbers(b"".join(common)))])
    content = own.content[rows] ^ own.hash[rows]
    _, first, distinct = np.unique(content, return_index=True, return_inverse=True)
    return rows, first, distinct


def _ordered(own: Stretches, rows: np.ndarray, first: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, numbers of distinct stretches) in an order that follows from the shard alone."""
    bucket = _bucket(own.short()[rows[first]], buckets)
    yield from _cut(np.lexsort((np.arange(len(first)), bucket)), bucket)


def _stretches(buckets: int):
    """For each shard and bucket its distinct live stretches with their smallest documents."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                own = Stretches(row["ids"], row["lengths"], row["body"])
                rows, first, distinct = _live(own, row["common"] or [])
                least = np.full(len(first), _NONE)
                np.minimum.at(least, distinct, own.doc[rows])
                before = own.before[rows[first]]
                out: dict[str, list] = {"bucket": [], "shard": [], "body": []}
                for number, part in _ordered(own, rows, first, buckets):
                    begin, end = own.begin[rows[first[part]]], own.end[rows[first[part]]] + LENGTH - 1
                    text = b"".join(own.data[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True))
                    head = np.array([len(part)], "<i8").tobytes() + _by_byte(least[part].astype("<i8")) + (end - begin).astype(np.uint8).tobytes() + before[part].tobytes()
                    out["bucket"].append(number)
                    out["shard"].append(row["shard"])
                    out["body"].append(zstandard.compress(head + text, 1))
                yield _sent(out, _PART)

    return apply


def suffix_order(text: np.ndarray, covered: int = 1) -> np.ndarray:
    """Places of ``text`` (symbols from 1 on) in suffix order, exact for the first ``LENGTH`` bytes.

    ``covered`` is the number of bytes behind a symbol: recursion ends when a name stands for ``LENGTH`` of them.
    """
    size = len(text)
    if size < 3:
        return np.array(sorted(range(size), key=lambda n: text[n:].tolist()), np.int64)
    padded = np.concatenate([text, np.zeros(3, text.dtype)]).astype(np.uint64)
    sample = np.concatenate([np.arange(1, size, 3), np.arange(2, size, 3)])
    if int(text.max()) < 1 << 21:
        packed = padded[sample] << np.uint64(42) | padded[sample + 1] << np.uint64(21) | padded[sample + 2]
        unique, names = np.unique(packed, return_inverse=True)
        count = len(unique)
    else:
        order = np.lexsort((padded[sample + 2], padded[sample + 1], padded[sample]))
        triples = np.stack([padded[sample[order] + k] for k in range(3)])
        fresh = np.concatenate([[False], (triples[:, 1:] != triples[:, :-1]).any(axis=0)])
        names = np.empty(len(sample), np.int64)
        names[order] = np.cumsum(fresh)
        count = int(fresh.sum()) + 1
    if count < len(sample) and covered * 3 < LENGTH:
        ones = len(range(1, size, 3))
        deeper = suffix_order(np.concatenate([names[:ones] + 2, [1], names[ones:] + 2]), covered * 3)
        deeper = deeper[deeper != ones]
        by_rank = sample[deeper - (deeper > ones)]
    else:
        by_rank = sample[np.argsort(names, kind="stable")]
    rank = np.zeros(size + 3, np.int64)
    rank[by_rank] = np.arange(1, len(by_rank) + 1)
    rest = np.arange(0, size, 3)
    rest = rest[np.lexsort((rank[rest + 1], padded[rest]))]
    # Merge: each of the rest finds its place among the samples by halving.
    low, high = np.zeros(len(rest), np.int64), np.full(len(rest), len(by_rank))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        a, b = rest[open_], by_rank[middle]
        one = b % 3 == 1
        second_a = np.where(one, rank[a + 1], padded[a + 1].astype(np.int64))
        second_b = np.where(one, rank[b + 1], padded[b + 1].astype(np.int64))
        third_a, third_b = np.where(one, 0, rank[a + 2]), np.where(one, 0, rank[b + 2])
        less = (padded[b] < padded[a]) | (padded[b] == padded[a]) & ((second_b < second_a) | (second_b == second_a) & (third_b < third_a))
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)
    out = np.empty(size, np.int64)
    # Suffixes that agree in LENGTH bytes may stand in any order, but the rest keeps its own.
    at = np.maximum.accumulate(low) + np.arange(len(rest))
    out[at] = rest
    free = np.ones(size, bool)
    free[at] = False
    out[free] = by_rank
    return out


def first_documents(stretches: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each window of the stretches (end to end) the smallest document of all equal windows."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    owner = np.repeat(np.arange(len(lengths)), lengths)
    # A zero between stretches; windows are those that stay within one.
    spread = np.zeros(len(stretches) + len(lengths), np.int64)
    place = np.arange(len(stretches)) + owner
    spread[place] = stretches.astype(np.int64) + 2
    spread[ends + np.arange(len(lengths))] = 1
    inside = np.arange(len(stretches)) + LENGTH <= ends[owner]
    window = np.full(len(spread), -1, np.int64)
    window[place[inside]] = np.flatnonzero(inside)
    order = window[suffix_order(spread)]
    order = order[order >= 0]
    views = np.lib.stride_tricks.sliding_window_view(stretches, LENGTH)
    equal = np.zeros(len(order), bool)
    for at in range(1, len(order), 1 << 16):
        part = order[at - 1 : at + (1 << 16)]
        equal[at : at + len(part) - 1] = (views[part[1:]] == views[part[:-1]]).all(axis=1)
    heads = np.flatnonzero(~equal)
    groups = np.minimum.reduceat(least[owner[order]], heads) if len(order) else order
    found = np.full(len(stretches), _NONE)
    found[order] = np.repeat(groups, np.diff(np.append(heads, len(order))))
    return found[inside] if len(stretches) else found


def _steps(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the sizes, end to end."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _repeated(keys: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Whether another row holds the same key, among the rows where it is there."""
    out = np.zeros(len(keys), bool)
    _, at, counts = np.unique(keys[there], return_inverse=True, return_counts=True)
    out[there] = counts[at] > 1
    return out


def _groups(short: np.ndarray, lengths: np.ndarray) -> Iterator[slice]:
    """Runs of whole anchors (equal ``short`` stand together) of about ``SORT_BYTES`` each; a longer anchor is a run alone."""
    if not len(short):
        return
    heads = np.flatnonzero(np.diff(short.astype(np.int64), prepend=-1))
    sizes = np.add.reduceat(lengths, heads)
    begin, held = 0, 0
    for head, size in zip(heads.tolist(), sizes.tolist(), strict=True):
        if held and held + size > SORT_BYTES:
            yield slice(begin, head)
            begin, held = head, 0
        held += size
    yield slice(begin, len(short))


def _sorted_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard and bucket, the smallest document of every window of its stretches."""
    held: dict[int, list[tuple[int, bytes]]] = {}
    for batch in batches:
        for bucket, shard, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.setdefault(bucket, []).append((shard, body))
    for bucket in list(held):  # one bucket is unpacked at a time
        parts = []
        for shard, body in held.pop(bucket):
            raw = zstandard.decompress(body)
            size = int(np.frombuffer(raw, "<i8", 1)[0])
            least, lengths = _from_bytes(raw, "<i8", size, 8), np.frombuffer(raw, np.uint8, size, 8 + 8 * size).astype(np.int64)
            before, text = np.frombuffer(raw, np.uint8, size, 8 + 9 * size), np.frombuffer(raw, np.uint8, -1, 8 + 10 * size)
            ends = np.cumsum(lengths)
            starts, anchor, hasher = ends - lengths, ends - lengths + before, Hasher(text)
            short = _short(hasher.spans(anchor, anchor + GRAM))
            sides = hasher.spans(np.maximum(anchor - SIDE, starts), anchor + GRAM), hasher.spans(anchor, np.minimum(anchor + GRAM + SIDE, ends))
            parts.append((shard, least, lengths, short, before, text, hasher.spans(starts, ends), *sides))
        least, lengths, short, before, text, content, left, right = (np.concatenate([p[k] for p in parts]) for k in range(1, 9))
        parts = [(p[0], len(p[1])) for p in parts]
        _, first, distinct = np.unique(content, return_index=True, return_inverse=True)
        # Distinct stretches by anchor, so that a group of anchors can be sorted without the others.
        order = np.argsort(short[first], kind="stable")
        first, distinct = first[order], np.argsort(order)[distinct]
        smallest = np.full(len(first), _NONE)
        np.minimum.at(smallest, distinct, least)
        counts = lengths[first] - LENGTH + 1
        at = np.cumsum(counts) - counts
        found = np.repeat(smallest, counts)
        # The windows with SIDE bytes or more before the anchor come first, up to ``middle``.
        middle = before[first].astype(np.int64) - SIDE
        earlier, later = _repeated(left[first], middle >= 0), _repeated(right[first], middle < counts)
        low = np.where(earlier, 0, np.maximum(middle, 0))
        high = np.where(later, counts, np.minimum(middle + 1, counts))
        open_ = np.flatnonzero(earlier | later)
        begins = (np.cumsum(lengths) - lengths)[first]
        for group in _groups(short[first][open_], (high - low)[open_] + LENGTH - 1):
            own = open_[group]
            a, size = begins[own] + low[own], high[own] - low[own]
            kept = text[np.repeat(a, size + LENGTH - 1) + _steps(size + LENGTH - 1)]
            found[np.repeat(at[own] + low[own], size) + _steps(size)] = first_documents(kept, size + LENGTH - 1, smallest[own])
        del text
        own_counts = lengths - LENGTH + 1
        starts = np.repeat(at[distinct], own_counts)
        all_found = found[starts + _steps(own_counts)]
        out: dict[str, list] = {"bucket": [], "shard": [], "body": []}
        begin = 0
        number = 0
        for shard, size in parts:
            end = begin + int(own_counts[number : number + size].sum())
            number += size
            out["bucket"].append(bucket)
            out["shard"].append(shard)
            out["body"].append(zstandard.compress(np.diff(all_found[begin:end], prepend=0).astype("<i8").tobytes(), 1))
            begin = end
        yield _sent(out, _PART)


def _cutter(buckets: int, texts: bool):
    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                own = Stretches(row["ids"], row["lengths"], row["body"])
                rows, first, distinct = _live(own, row["common"] or [])
                counts = (own.end - own.begin)[rows]
                answers = {x["bucket"]: x["body"] for x in row["found"] or []}
                begin, values = np.zeros(len(first), np.int64), []
                total = 0
                for number, part in _ordered(own, rows, first, buckets):
                    found = np.cumsum(np.frombuffer(zstandard.decompress(answers[number]), "<i8"))
                    sizes = counts[first[part]]
                    begin[part] = total + np.cumsum(sizes) - sizes
                    values.append(found)
                    total += len(found)
                steps = np.zeros(len(own.data) + 1, np.int32)
                if values:
                    values = np.concatenate(values)
                    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
                    gone = values[np.repeat(begin[distinct], counts) + place] < np.repeat(own.doc[rows], counts)
                    starts = (np.repeat(own.begin[rows], counts) + place)[gone]
                    np.add.at(steps, starts, 1)
                    np.add.at(steps, starts + LENGTH, -1)
                removed = np.cumsum(steps)[:-1] > 0
                out: dict[str, list] = {"doc_id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
                for key, a, b in zip(own.ids.tolist(), own.offsets[:-1].tolist(), own.offsets[1:].tolist(), strict=True):
                    mask = removed[a:b]
                    kept = own.data[a:b][~mask].tobytes()
                    out["doc_id"].append(None if key == NO_KEY else key)
                    out["n_bytes"].append(b - a)
                    out["n_removed"].append(int(mask.sum()))
                    out["n_spans"].append(int((np.diff(mask.astype(np.int8), prepend=0) == 1).sum()))
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    out["kept"].append(kept if texts else None)
                yield pa.RecordBatch.from_pydict(out, schema=_RESULT)

    return apply


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
_RESULT_DDL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def dedup(rows: DataFrame, key: str = "doc_id", text: str = "text", texts: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, with ``texts``, kept."""
    spark = rows.sparkSession

    def stored(frame: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    shards = stored(rows.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).mapInArrow(_shards, _SHARD), "suffix-shards")
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * parts, 1 + int(size) // BUCKET_BYTES)
    tasks = max(parts, buckets // 4)
    common = shards.mapInArrow(_sides(buckets), _PART_DDL).repartition(tasks, "bucket").mapInArrow(_shared, _PART_DDL)
    common = stored(common.groupBy("shard").agg(F.collect_list("body").alias("common")), "suffix-common")
    known = shards.join(common, "shard", "left")
    found = known.mapInArrow(_stretches(buckets), _PART_DDL).repartition(tasks, "bucket").mapInArrow(_sorted_buckets, _PART_DDL)
    found = stored(found.groupBy("shard").agg(F.collect_list(F.struct("bucket", "body")).alias("found")), "suffix-found")
    return known.join(found, "shard", "left").mapInArrow(_cutter(buckets, texts), _RESULT_DDL)
