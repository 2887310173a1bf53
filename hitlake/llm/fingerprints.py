"""Document fingerprints by content-defined chunking.

A gear hash over the last ``WINDOW`` bytes marks possible cuts.  Cutting is normalised: up to ``NORMAL`` bytes a
strict mask must be met, beyond it a loose one, so chunk lengths gather around it.  As cuts depend on nearby
bytes alone, an edit moves only the cuts beside it.  A fingerprint is the set of the chunks' digests with their
lengths; the likeness of two is the length of the shared chunks over that of the shorter set (containment).

Fingerprints are base64 of 8 bytes for each distinct chunk, in order of digest: 6 of digest, 2 of length.  Null and
empty texts have the empty fingerprint; two empty ones are alike, an empty and another are not at all.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hitlake.llm.batches import RUN_BYTES, Hasher
from hitlake.llm.ranges import in_order

WINDOW = 16
LEAST, NORMAL, MOST = 16, 40, 160
#: Bits of the hash that must be zero for a cut, before and after the normal length.
STRICT, LOOSE = 6, 3

_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
_ENTRY = np.dtype([("digest", "S6"), ("length", ">u2")])


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the last ``WINDOW`` bytes, by doubling the window."""
    value = _GEAR[data]
    width = 1
    while width < WINDOW:
        longer = value.copy()
        longer[width:] += value[:-width] << np.uint32(width)
        value, width = longer, width * 2
    return value


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk starts of all texts, and each text's first chunk (n + 1)."""
    value = gear(data)
    loose = np.flatnonzero(value >> np.uint32(32 - LOOSE) == 0)
    strict = loose[value[loose] >> np.uint32(32 - STRICT) == 0].tolist()
    loose = loose.tolist()
    starts, first = [], [0]
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        while begin < end:
            starts.append(begin)
            if end - begin <= LEAST:
                break
            # A cut after byte i ends a chunk of i + 1 - begin bytes.
            at = bisect_left(strict, begin + LEAST - 1)
            if at < len(strict) and strict[at] < begin + NORMAL:
                begin = strict[at] + 1
                continue
            at = bisect_left(loose, begin + NORMAL - 1)
            begin = loose[at] + 1 if at < len(loose) and loose[at] < begin + MOST else begin + MOST
        first.append(len(starts))
    return np.array(starts, np.int64), np.array(first)


def fingerprints(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ascending distinct digests (48 bits) and their lengths, for each text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    starts, first = cuts(data, offsets)
    ends = np.append(starts[1:], len(data))
    digests = Hasher(data).spans(starts, ends) >> np.uint64(16)
    lengths = ends - starts
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        own, at = np.unique(digests[a:b], return_index=True)
        out.append((own, lengths[a:b][at]))
    return out


def packed(print_: tuple[np.ndarray, np.ndarray]) -> str:
    digests, lengths = print_
    wide = np.zeros((len(digests), 8), np.uint8)
    wide[:, :6] = digests.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    wide[:, 6:] = lengths.astype(">u2").view(np.uint8).reshape(-1, 2)
    return base64.b64encode(wide.tobytes()).decode()


def unpacked(text: str) -> tuple[np.ndarray, np.ndarray]:
    wide = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 8)
    digests = np.zeros((len(wide), 8), np.uint8)
    digests[:, 2:] = wide[:, :6]
    return digests.view(">u8").ravel().astype(np.uint64), wide[:, 6:].copy().view(">u2").ravel().astype(np.int64)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Length of the shared chunks over that of the shorter set, 0 to 1."""
    least = min(int(a[1].sum()), int(b[1].sum()))
    if not least:
        return float(len(a[0]) == len(b[0]))
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    return float(a[1][b[0][at] == a[0]].sum()) / least


def edited(text: str, after: str) -> str:
    """The last quarter of the code points (rounded down) replaced by the first as many of the next text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + after[:quarter]


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            waiting.append(row)
            size += len(row[3])
            if row[1] or size >= RUN_BYTES:
                yield _block(waiting)
                waiting, size = ([], 0) if row[1] else ([row], 0)


def _block(rows: list[tuple]) -> pa.RecordBatch:
    """Results for all rows but the last, which is the text after them."""
    texts = [row[3] for row in rows]
    changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    raw = [t.encode() for t in changed]
    own, other = fingerprints([t.encode() for t in texts]), fingerprints(raw)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([row[2] for row in rows[:-1]], pa.int64()),
            "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in raw], pa.string()),
            "fingerprint": pa.array([packed(f) for f in own[:-1]], pa.string()),
            "edited_fingerprint": pa.array([packed(f) for f in other], pa.string()),
            "near_edited": pa.array([likeness(a, b) for a, b in zip(own[:-1], other, strict=True)], pa.float64()),
            "near_next": pa.array([likeness(a, b) for a, b in zip(own[:-1], own[1:], strict=True)], pa.float64()),
        }
    )


_COMPARED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited form, and likeness to that and to the next text.

    The next text is that of the next larger key (after the last, of the smallest); rows of one key follow each
    other by text, and rows without a key come first.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return in_order(texts, key, text, parts, tail=True).mapInArrow(_compared, _COMPARED)
