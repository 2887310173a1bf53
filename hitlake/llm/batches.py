"""Vectorised helpers over Arrow batches of text: byte views, word spans, hashes.

All of them work on one bounded run of rows (``runs``), so a task's memory follows its largest single text
and not its partition.  A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is a run of its own.
RUN_BYTES = 4 << 20

_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)  # odd, and 3 modulo 4
_STEP_INVERSE = _U(pow(int(_STEP), -1, 1 << 64))
_LETTERS = np.random.default_rng(20240117).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)

#: Maps A-Z to a-z and leaves every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and the n + 1 offsets of its values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def runs(batches: Iterable[pa.RecordBatch], text: int = 1, limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes in column ``text``, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = byte_view(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grown(table: np.ndarray, step: np.uint64, size: int) -> np.ndarray:
    if len(table) > size:
        return table
    grown = np.full(max(size + 1, 1 << 16), step, np.uint64)
    grown[0] = 1
    return np.multiply.accumulate(grown)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Hasher:
    """64-bit hashes of any byte spans of one run, from prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        global _powers, _inverses
        _powers = _grown(_powers, _STEP, len(data))
        _inverses = _grown(_inverses, _STEP_INVERSE, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTERS[data] * _powers[: len(data)], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * _inverses[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``member`` bytes inside each text, and each text's first word (n + 1)."""
    inside = member[data]
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    edge = offsets[:-1][offsets[1:] > offsets[:-1]]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[edge] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edge[1:] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(column: pa.Array, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text with A-Z lowered, and each text's first word (n + 1)."""
    data, offsets = byte_view(column)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, member)
    return Hasher(data).spans(starts, ends), first


def grams(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``n`` words (of all its words, if fewer), and each text's first one (n + 1)."""
    counts = np.diff(first)
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out_first = np.concatenate([[0], np.cumsum(made)])
    total = int(out_first[-1])
    if not total:
        return np.zeros(0, np.uint64), out_first
    text = np.repeat(np.arange(len(counts)), made)
    at = first[:-1][text] + np.arange(total) - out_first[:-1][text]
    width = np.minimum(counts, n)[text]
    value = np.zeros(total, np.uint64)
    last = len(words) - 1
    for j in range(n):
        value = np.where(j < width, value * _STEP + words[np.minimum(at + j, last)], value)
    return mix(value + width.astype(np.uint64)), out_first


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the n + 1 offsets."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))
