"""Token ids as files of wavelet matrices.

Texts are encoded in order of their ids, an end id after each, and the ids are cut into shards of bounded length.
A shard is one compressed record: a plane of bits for each bit of an id, most significant first, where each plane
lists the ids stably parted by the bit before.  With the number of ones before each block (made when a shard is
opened) a plane answers rank and select, so single ids can be read, counted and located without unpacking the rest.

Null and empty texts are just their end id.  A text longer than a shard is a shard of its own.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlake.llm.batches import Hasher
from hitlake.llm.ranges import in_order
from hitlake.storage import scratch_path

#: Ids of a shard, about, and code points encoded at once.
SHARD_IDS, BATCH_CHARS = 1 << 19, 1 << 20
END_ID = 2
#: Words a worker remembers, the longest of them, and words encoded as one text.
MEMORY_WORDS, MEMORY_CHARS, JOINED_WORDS = 1 << 19, 64, 200


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class WaveletMatrix:
    """Access, rank and select over a sequence of small integers."""

    BLOCK = 64

    def __init__(self, size: int, planes: np.ndarray):
        self.size, self.planes = size, planes  # levels x bytes, bits packed from the high end
        ones = np.unpackbits(planes, axis=1)[:, :size]
        self.zeros = size - ones.sum(axis=1, dtype=np.int64)
        starts = np.arange(0, max(size, 1), self.BLOCK)
        blocks = np.add.reduceat(ones, starts, axis=1, dtype=np.int64) if size else np.zeros((len(planes), 1), np.int64)
        self.before = np.concatenate([np.zeros((len(planes), 1), np.int64), np.cumsum(blocks, axis=1)], axis=1)

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> np.ndarray:
        """The planes of ``ids``."""
        planes = np.empty((levels, -(-len(ids) // 8)), np.uint8)
        for level in range(levels):
            bit = (ids >> ids.dtype.type(levels - 1 - level)) & ids.dtype.type(1)
            planes[level] = np.packbits(bit.astype(np.uint8))
            one = bit.astype(bool)
            ids = np.concatenate([ids[~one], ids[one]])
        return planes

    def _ones(self, level: int, at: int) -> int:
        """Ones among the first ``at`` bits of a plane."""
        block = at // self.BLOCK
        bits = np.unpackbits(self.planes[level, block * self.BLOCK // 8 : -(-at // 8)])[: at - block * self.BLOCK]
        return int(self.before[level, block]) + int(bits.sum())

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level, at >> 3]) >> (7 - (at & 7)) & 1

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.size:
            raise IndexError(at)
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, at), self._ones(level, at)
            value = value * 2 + bit
            at = int(self.zeros[level]) + ones if bit else at - ones
        return value

    def rank(self, value: int, end: int) -> int:
        """How often ``value`` stands among the first ``end`` ids."""
        if not 0 <= value < 1 << len(self.planes):
            return 0
        begin, end = 0, min(max(end, 0), self.size)
        for level in range(len(self.planes)):
            low, high = self._ones(level, begin), self._ones(level, end)
            if value >> (len(self.planes) - 1 - level) & 1:
                begin, end = int(self.zeros[level]) + low, int(self.zeros[level]) + high
            else:
                begin, end = begin - low, end - high
        return end - begin

    def _select_bit(self, level: int, bit: int, count: int) -> int:
        """The position of the ``count``-th (from 0) such bit of a plane."""
        at = self.before[level] if bit else np.minimum(np.arange(self.before.shape[1]) * self.BLOCK, self.size) - self.before[level]
        block = int(np.searchsorted(at, count, "right")) - 1
        bits = np.unpackbits(self.planes[level, block * self.BLOCK // 8 : (block + 1) * self.BLOCK // 8])
        return block * self.BLOCK + int(np.flatnonzero(bits == bit)[count - int(at[block])])

    def select(self, value: int, count: int) -> int:
        """The position of the ``count``-th (from 0) occurrence of ``value``, or -1."""
        if count < 0 or count >= self.rank(value, self.size):
            return -1
        begin = 0
        for level in range(len(self.planes)):
            ones = self._ones(level, begin)
            begin = int(self.zeros[level]) + ones if value >> (len(self.planes) - 1 - level) & 1 else begin - ones
        at = begin + count
        for level in reversed(range(len(self.planes))):
            bit = value >> (len(self.planes) - 1 - level) & 1
            at = self._select_bit(level, bit, at - int(self.zeros[level]) if bit else at)
        return at

    def locate(self, value: int) -> list[int]:
        return [self.select(value, n) for n in range(self.rank(value, self.size))]


def unpack(size: int, planes: np.ndarray) -> np.ndarray:
    """All ids of a matrix, by undoing the partings from the last plane on."""
    value = np.zeros(size, np.uint32)
    for level in reversed(range(len(planes))):
        one = np.unpackbits(planes[level])[:size].astype(bool)
        zeros = size - int(one.sum())
        back = np.empty(size, np.uint32)
        back[~one], back[one] = value[:zeros], value[zeros:] | np.uint32(1 << (len(planes) - 1 - level))
        value = back
    return value


class Encoder:
    """Ids of texts by one vocabulary file, where the ids of a word seen before are remembered.

    A byte-level vocabulary never joins a space and a visible character after it to what stands before them, so a text
    is cut there (``_cuts``) and only words not seen before go to the library, many of them as one text; the bytes that
    each id stands for tell their ids apart.  Words are known by 64-bit hashes, all of a batch at once.  Any other
    vocabulary encodes whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.size = self.own.get_vocab_size()
        form = json.loads(self.own.to_str())
        splits = form["pre_tokenizer"] or {}
        self.bytewise = form["normalizer"] is None and splits.get("type") == "ByteLevel" and splits["use_regex"] and not splits["add_prefix_space"]
        if self.bytewise:
            self.widths = np.zeros(self.size, np.int64)
            for token, n in self.own.get_vocab(with_added_tokens=False).items():
                self.widths[n] = len(token)  # a character for each byte
        # Tokens that are told in a text before it is cut into words.
        added = [token.content for token in self.own.get_added_tokens_decoder().values()]
        self.bytewise &= not any(" " in token for token in added)
        self.added = re.compile("|".join(map(re.escape, added)) if added else "(?!)")
        self.forget()

    def forget(self) -> None:
        # Known words by hash in ascending order; where their ids stand in the pool, and how many.
        self.hashes, self.begin, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(made.ids, np.uint32) for made in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and how many each has; words are encoded many as one text."""
        ids = self._whole(["".join(words[n : n + JOINED_WORDS]) for n in range(0, len(words), JOINED_WORDS)])
        ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        ends = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in words])
        reached = np.cumsum(self.widths[ids])
        last = np.searchsorted(reached, ends)
        if len(words) and (last[-1] != len(ids) - 1 or (reached[last] != ends).any()):
            raise ValueError("the vocabulary joins words")
        return ids, np.diff(last, prepend=-1)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, apart: np.ndarray, hashes: np.ndarray) -> None:
        """Remember new words, given by their spans in ascending order of their hashes."""
        body = data.tobytes()
        word = [body[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        # A text's first word may lack the space that sets it apart, so such words are not joined.
        alone, rest = np.flatnonzero(~apart), np.flatnonzero(apart)
        single = self._whole([word[n] for n in alone])
        ids, sizes = self._joined([word[n] for n in rest])
        count = np.empty(len(word), np.int64)
        count[rest], count[alone] = sizes, [len(x) for x in single]
        begin = np.empty(len(word), np.int64)
        begin[rest] = np.cumsum(sizes) - sizes
        begin[alone] = len(ids) + np.cumsum(count[alone]) - count[alone]
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.begin, self.count = np.insert(self.begin, place, begin + len(self.pool)), np.insert(self.count, place, count)
        self.pool = np.concatenate([self.pool, ids, *single])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.bytewise:
            return self._whole(texts)
        special = {n: text for n, text in enumerate(texts) if self.added.search(text)}
        if special:  # rare: such texts are encoded whole
            made = self.encode([text for n, text in enumerate(texts) if n not in special])
            for n, ids in zip(special, self._whole(list(special.values())), strict=True):
                made.insert(n, ids)
            return made
        if len(self.hashes) > MEMORY_WORDS:
            self.forget()
        bodies = [text.encode() for text in texts]
        offsets = np.cumsum([0, *map(len, bodies)])
        data = np.frombuffer(b"".join(bodies), np.uint8)
        apart = _cuts(data)
        heads = apart.copy()
        heads[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
        starts = np.flatnonzero(heads)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        hashes, first, word = np.unique(Hasher(data).spans(starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, hashes)
        new = place == len(self.hashes)
        new[~new] = self.hashes[place[~new]] != hashes[~new]
        if new.any():
            own = first[new]
            self._learn(data, starts[own], ends[own], apart[starts[own]], hashes[new])
        place = np.searchsorted(self.hashes, hashes)[word]
        begin, count = self.begin[place], self.count[place]
        made = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.repeat(begin - made[:-1], count) + np.arange(made[-1])]
        bounds = made[np.searchsorted(starts, offsets)]
        if new.any() and (long := new & (ends[first] - starts[first] > MEMORY_CHARS)).any():
            gone = np.searchsorted(self.hashes, hashes[long])  # their ids stay in the pool until it is forgotten
            self.hashes, self.begin, self.count = (np.delete(x, gone) for x in (self.hashes, self.begin, self.count))
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where UTF-8 text has a space before a character of ! to ~ or U+00A1 to U+167F: one that no version of Unicode
    takes for white space."""
    out = data == 0x20
    at = np.flatnonzero(out)
    follows = lambda n: data[np.minimum(at + n, len(data) - 1)]
    lead, second = follows(1), follows(2)
    good = (lead >= 0x21) & (lead <= 0x7E) | (lead == 0xC2) & (second >= 0xA1) | (lead >= 0xC3) & (lead <= 0xE0) | (lead == 0xE1) & (second <= 0x99)
    out[at] = good & (at + 1 < len(data))
    return out


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_SHARD = "range int, place bigint, n_ids bigint, levels int, doc_ids array<bigint>, starts array<int>, planes binary"


def _writer(path: str, end_id: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(path)
        levels = max(1, int(max(own.size - 1, end_id)).bit_length())
        kind = np.uint16 if levels <= 16 else np.uint32
        number, place, docs, parts, size = None, 0, [], [], 0

        def shard() -> pa.RecordBatch:
            nonlocal place, docs, parts, size
            ids = np.concatenate(parts).astype(kind)
            starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            made = pa.RecordBatch.from_pydict(
                {
                    "range": pa.array([number], pa.int32()),
                    "place": pa.array([place], pa.int64()),
                    "n_ids": pa.array([len(ids)], pa.int64()),
                    "levels": pa.array([levels], pa.int32()),
                    "doc_ids": pa.array([docs], pa.list_(pa.int64())),
                    "starts": pa.array([starts], pa.list_(pa.int32())),
                    "planes": pa.array([WaveletMatrix.build(ids, levels).tobytes()], pa.binary()),
                }
            )
            place, docs, parts, size = place + len(ids), [], [], 0
            return made

        for batch in batches:
            ranges, keys, texts = (batch.column(n).to_pylist() for n in (0, 2, 3))
            begin = 0
            while begin < len(texts):
                end, chars = begin, 0
                while end < len(texts) and (end == begin or chars + len(texts[end]) <= BATCH_CHARS):
                    chars += len(texts[end])
                    end += 1
                for at, made in enumerate(own.encode(texts[begin:end]), begin):
                    if docs and (ranges[at] != number or size >= SHARD_IDS):
                        yield shard()
                    if ranges[at] != number:
                        number, place = ranges[at], 0
                    ids = np.append(made, np.uint32(end_id))
                    docs.append(keys[at])
                    parts.append(ids)
                    size += len(ids)
                begin = end
        if docs:
            yield shard()

    return write


def write(texts: DataFrame, path: str, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Encode ``texts`` and write their shards to ``path``, one row and record for each."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = in_order(texts, key, text, parts)
    ordered.mapInArrow(_writer(vocabulary or default_vocabulary(), end_id), _SHARD).write.option("compression", "zstd").parquet(path)


def open_shards(spark, path: str) -> DataFrame:
    return spark.read.schema(_SHARD).parquet(path)


def matrix(row) -> WaveletMatrix:
    """The wavelet matrix of one row of ``open_shards``."""
    return WaveletMatrix(row["n_ids"], np.frombuffer(row["planes"], np.uint8).reshape(row["levels"], -1))


def occurrences(shards: DataFrame, value: int) -> DataFrame:
    """(doc_id, at) of every occurrence of an id: the document and the place within it."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = np.array(matrix(row).locate(value), np.int64)
                doc = np.searchsorted(row["starts"], places, "right") - 1
                ids = [row["doc_ids"][n] for n in doc]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "at": pa.array(places - np.array(row["starts"])[doc], pa.int64())})

    return shards.mapInArrow(find, "doc_id bigint, at bigint")


def read(shards: DataFrame) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the shards."""
    totals = dict(shards.groupBy("range").agg(F.sum("n_ids")).collect())  # one number per range
    bases, total = {}, 0
    for number in sorted(totals):
        bases[number], total = total, total + totals[number]

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["n_ids"], np.frombuffer(row["planes"], np.uint8).reshape(row["levels"], -1)).astype("<u4")
                starts = row["starts"]
                base = bases[row["range"]] + row["place"]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "start": pa.array([base + s for s in starts[:-1]], pa.int64()),
                        "n_tokens": pa.array(np.diff(starts), pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.int64()),
                    }
                )

    return shards.mapInArrow(apply, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``texts`` to the shared scratch folder and read their digests back from the files."""
    path = scratch_path(texts.sparkSession, "token-files")
    write(texts, path, key, text)
    return read(open_shards(texts.sparkSession, path))
