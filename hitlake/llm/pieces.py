"""SentencePiece encoding and decoding: N-best segmentation over the piece lattice.

Every text is a lattice of the model's pieces; a segmentation's score is the sum of its pieces' scores.  A forward
Viterbi pass gives the best score up to each position.  An A-star search then walks back from the end, with those
scores as its (exact) estimate of what is left, so segmentations come out in order of score.

Where no piece reaches from one character to the next (before a space mark, after a word), the lattice falls
apart: the search runs once per distinct part, and a text's N best are the N smallest sums of its parts' losses.  A character without a piece costs ``UNKNOWN`` more than the worst piece and is written as byte pieces.

Ties go to the segmentation that the search met first, which is the same in every run.  Null and empty texts have one segmentation, of no pieces.
The model file is a public vocabulary; its path is a parameter and must be readable on every worker.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from bisect import insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import itemgetter
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlake.llm.batches import Hasher, runs

MARK = "▁"
_cost = itemgetter(0)
_IDS = T.ArrayType(T.IntegerType())
UNKNOWN = 10.0
#: Characters of a word that is searched together with others (its piece lengths fit one integer), and words
#: searched together.
TOGETHER, BATCH = 16, 10_000
#: Bytes of text encoded at once.
ENCODED_BYTES = 2 << 20
#: Distinct words that a worker remembers, for each result wanted: searching again costs more the more there are.
MEMORY = 250_000
#: The same for a worker that also holds whole rows: bytes of text encoded at once, words searched together and
#: remembered.
ROW_BYTES, ROW_BATCH, ROW_WORDS = 1 << 20, 4_000, 100_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _spans(joined: str) -> tuple[Hasher, np.ndarray]:
    """A hasher of the characters' bytes, and the byte at which each character starts."""
    data = np.frombuffer(joined.encode(), np.uint8)
    return Hasher(data), np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def _hashes(joined: str, marks: np.ndarray) -> np.ndarray:
    hasher, at = _spans(joined)
    return hasher.spans(at[marks[:-1]], at[marks[1:]])


class _Rows:
    """The row of a hash among a fixed list of distinct ones, by two direct tables; -1 if it is none."""

    BITS = 20

    def __init__(self, hashes: np.ndarray):
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces share a hash")
        self.hashes = np.append(hashes, np.uint64(0))
        self.first, self.second = (np.full(1 << self.BITS, -1, np.int32) for _ in range(2))
        self.rest: dict[int, int] = {}
        rows = np.arange(len(hashes), dtype=np.int32)
        self.first[self._place(hashes, 0)] = rows
        left = rows[self.first[self._place(hashes, 0)] != rows]
        self.second[self._place(hashes[left], 1)] = left
        left = left[self.second[self._place(hashes[left], 1)] != left]
        self.rest = {int(hashes[n]): int(n) for n in left}

    def _place(self, hashes: np.ndarray, table: int) -> np.ndarray:
        return ((hashes >> np.uint64(44 - 20 * table)) & np.uint64((1 << self.BITS) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        row = self.first[self._place(hashes, 0)]
        out = np.where((row >= 0) & (self.hashes[row] == hashes), row, -1)
        row = self.second[self._place(hashes, 1)]
        out = np.where((row >= 0) & (self.hashes[row] == hashes), row, out)
        for value, own in self.rest.items():
            out[hashes == np.uint64(value)] = own
        return out


def _surface(model) -> list[bytes]:
    """The bytes that each id stands for."""
    out = []
    for n in range(model.get_piece_size()):
        piece = model.id_to_piece(n)
        if model.is_byte(n):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(b"" if model.is_control(n) or model.is_unknown(n) or model.is_unused(n) else piece.encode())
    return out


def _text(surface: list[bytes], ids: Iterable[int]) -> str:
    """The text of piece ids; marks become spaces, and the first one goes."""
    joined = b"".join(map(surface.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
    return joined[1:] if joined.startswith(" ") else joined


@dataclass
class Found:
    """Segmentations of many words: costs and numbers of ids (words x N), and the packed ids of the best and the others."""

    cost: np.ndarray
    length: np.ndarray
    best: list[bytes]
    others: list[bytes]


class Lattice:
    """The pieces of a model, and the N best segmentations of a word."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = model.get_piece_size()
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes = [0] * 256
        self.surface = _surface(model)
        for n in range(self.size):
            piece = model.id_to_piece(n)
            if model.is_byte(n):
                self.bytes[int(piece[3:5], 16)] = n
            elif not (model.is_control(n) or model.is_unknown(n) or model.is_unused(n)):
                self.pieces[piece] = ((n,), model.get_score(n))
        self.longest = max(map(len, self.pieces))
        self.unknown = min(score for _, score in self.pieces.values()) - UNKNOWN
        self.split = self._cuts()
        hashes = _hashes("".join(self.pieces), np.cumsum([0, *map(len, self.pieces)]))
        self._rows = _Rows(hashes)
        self._row_ids = np.array([ids[0] for ids, _ in self.pieces.values()], np.int32)
        self._row_scores = np.array([score for _, score in self.pieces.values()])

    def _cuts(self) -> re.Pattern:
        """Parts of a text between which no piece can reach, told from the pairs of characters within pieces."""
        pairs = {(piece[n], piece[n + 1]) for piece in self.pieces for n in range(len(piece) - 1)}
        word = re.compile(r"\w")
        if any(b == MARK and a != MARK for a, b in pairs):
            return re.compile("(?s).+")
        if any("\n" in pair for pair in pairs) or "\n" in self.pieces:
            return re.compile(f"(?s){MARK}*[^{MARK}]+|{MARK}+")
        if any(word.match(a) and not word.match(b) for a, b in pairs):
            return re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        return re.compile(rf"\n|{MARK}*[^\w{MARK}\n]*\w+|{MARK}*[^\w{MARK}\n]+|{MARK}+")

    def best(self, word: str, count: int) -> list[tuple[float, list[int]]]:
        """The ``count`` best segmentations of a word as (score, ids), best first."""
        size, get, longest = len(word), self.pieces.get, self.longest
        ahead = [0.0] + [-math.inf] * size
        ending: list[list[tuple[int, float, tuple]]] = [[] for _ in range(size + 1)]
        for at in range(size):
            base = ahead[at]
            for end in range(at + 1, min(size, at + longest) + 1):
                found = get(word[at:end])
                if found is None:
                    if end > at + 1:
                        continue
                    score, ids = self.unknown, tuple(self.bytes[b] for b in word[at].encode())
                else:
                    score, ids = found[1], found[0]
                ending[end].append((at, score, ids))
                if base + score > ahead[end]:
                    ahead[end] = base + score
        # An open path's estimate is exact: a whole path with that score starts with it, and no two open paths
        # share a whole one.  So only as many open paths as are still wanted can lead to a result.
        out: list[tuple[float, list[int]]] = []
        opened = [(-ahead[size], (), size, 0.0)]
        while opened and len(out) < count:
            cost, path, at, done = opened.pop(0)
            if at == 0:
                flat: list[int] = []
                while path:
                    ids, path = path
                    flat.extend(ids)
                out.append((-cost, flat))
                continue
            left = count - len(out)
            worst = opened[left - 1][0] if len(opened) >= left else math.inf
            for start, score, ids in ending[at]:
                estimate = -(done + score + ahead[start])
                if estimate < worst:
                    insort(opened, (estimate, (ids, path), start, done + score), key=_cost)
                    if len(opened) >= left:
                        worst = opened[left - 1][0]
            del opened[left:]
        return out

    def best_of_all(self, words: list[str], count: int) -> Found:
        """``best`` of many words at once: the same search, one step of all words at a time."""
        out = Found(np.full((len(words), count), np.inf), np.zeros((len(words), count), np.int32), [b""] * len(words), [b""] * len(words))
        lengths = np.array([len(w) for w in words])
        # In order of length, words of one step stand side by side.
        short = np.flatnonzero(lengths <= TOGETHER)
        short = short[np.argsort(-lengths[short], kind="stable")]
        alone = np.flatnonzero(lengths > TOGETHER).tolist()
        if len(short):
            marks = np.concatenate([[0], np.cumsum(lengths[short])])
            table, known = self._edges("".join([words[n] for n in short]), marks)
            alone += short[~known].tolist()
            self._search(table, marks, np.flatnonzero(known), short, count, out)
        for n in alone:
            found = self.best(words[n], count)
            out.cost[n, : len(found)] = [-score for score, _ in found]
            out.length[n, : len(found)] = [len(ids) for _, ids in found]
            out.best[n] = pack(f"<{len(found[0][1])}i", *found[0][1])
            out.others[n] = b"".join(pack(f"<{len(ids)}i", *ids) for _, ids in found[1:])
        return out

    def _edges(self, joined: str, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of the piece of each length that starts at each character (-1: none), and which words need no bytes."""
        size = len(joined)
        ends = np.repeat(marks[1:], np.diff(marks))
        hasher, at = _spans(joined)
        table = np.full((self.longest, size), -1, np.int32)
        for length in range(1, self.longest + 1):
            starts = np.flatnonzero(np.arange(size) + length <= ends)
            if not len(starts):
                break
            table[length - 1, starts] = self._rows.find(hasher.spans(at[starts], at[starts + length]))
        return table, np.logical_and.reduceat(table[0] >= 0, marks[:-1])

    def _search(self, table: np.ndarray, marks: np.ndarray, chosen: np.ndarray, places: np.ndarray, count: int, out: Found) -> None:
        base, size = marks[:-1][chosen], np.diff(marks)[chosen]
        n, reach = len(chosen), min(self.longest, TOGETHER)
        # Best scores up to each position, and each position's best incoming edges (whatever comes after it).
        ahead = np.full((n, TOGETHER + 1), -np.inf)
        ahead[:, 0] = 0
        edges = np.zeros((n, TOGETHER + 1, count), np.int8)
        gains = np.full((n, TOGETHER + 1, count), -np.inf)
        alone = np.zeros((n, TOGETHER + 1, count))
        for end in range(1, int(size.max(initial=0)) + 1):
            own = np.flatnonzero(size >= end)
            most = min(end, reach)
            starts = base[own][:, None] + end - np.arange(1, most + 1)
            rows = table[np.arange(most), starts]
            score = np.where(rows >= 0, self._row_scores[rows], -np.inf)
            total = score + ahead[own, end - most : end][:, ::-1]
            order = np.argsort(-total, axis=1, kind="stable")[:, :count]
            line = np.arange(len(own))[:, None]
            edges[own, end, : order.shape[1]] = order + 1
            gains[own, end, : order.shape[1]] = total[line, order]
            alone[own, end, : order.shape[1]] = score[line, order]
            ahead[own, end] = gains[own, end, 0]
        # Open paths of each word in order of cost; a path is the lengths of its pieces from the end on, 4 bits each.
        cost = np.full((n, count), np.inf)
        cost[:, 0] = -ahead[np.arange(n), size]
        at, done = np.zeros((n, count), np.int64), np.zeros((n, count))
        at[:, 0] = size
        path, steps = np.zeros((n, count), np.uint64), np.zeros((n, count), np.int64)
        found = np.zeros(n, np.int64)
        out_cost, out_path, out_steps = np.full((n, count), np.inf), np.zeros((n, count), np.uint64), np.zeros((n, count), np.int64)
        active = np.arange(n)
        while len(active):
            whole = at[active, 0] == 0
            own = active[whole]
            out_cost[own, found[own]], out_path[own, found[own]], out_steps[own, found[own]] = cost[own, 0], path[own, 0], steps[own, 0]
            found[own] += 1
            for array in (cost, at, done, path, steps):
                array[own, :-1] = array[own, 1:]
            cost[own, -1] = np.inf
            own = active[~whole]
            place, so_far = at[own, 0], done[own, 0][:, None]
            length = edges[own, place].astype(np.int64)
            every = np.concatenate([cost[own, 1:], -(so_far + gains[own, place])], axis=1)
            kept = np.argsort(every, axis=1, kind="stable")[:, :count]
            line = np.arange(len(own))[:, None]
            shift = (steps[own, :1] * 4).astype(np.uint64)
            longer = path[own, :1] | (np.maximum(length - 1, 0).astype(np.uint64) << shift)
            cost[own] = every[line, kept]
            for array, fresh in (
                (at, place[:, None] - length),
                (done, so_far + alone[own, place]),
                (path, longer),
                (steps, np.broadcast_to(steps[own, :1] + 1, length.shape)),
            ):
                array[own] = np.concatenate([array[own, 1:], fresh], axis=1)[line, kept]
            active = active[(found[active] < count) & np.isfinite(cost[active, 0])]
        # Lengths from the end on, turned into ids from the start on.
        lengths = ((out_path[:, :, None] >> (np.arange(TOGETHER, dtype=np.uint64) * np.uint64(4))) & np.uint64(15)).astype(np.int64) + 1
        used = np.arange(TOGETHER) < out_steps[:, :, None]
        begin = size[:, None, None] - np.cumsum(lengths * used, axis=2)
        word, rank, place = np.nonzero(used)
        rows = table[lengths[word, rank, place] - 1, base[word] + begin[word, rank, place]]
        first = np.cumsum(np.concatenate([[0], out_steps.ravel()]))
        flat = np.empty(int(first[-1]), "<i4")
        flat[first[word * count + rank + 1] - 1 - place] = self._row_ids[rows]
        packed, first = flat.tobytes(), (first * 4).tolist()
        out.cost[places[chosen]], out.length[places[chosen]] = out_cost, out_steps
        for k, place in enumerate(places[chosen].tolist()):
            at, after, end = first[k * count], first[k * count + 1], first[k * count + count]
            out.best[place], out.others[place] = packed[at:after], packed[after:end]

    def text(self, ids: Iterable[int]) -> str:
        """The text of piece ids; marks become spaces, and the first one goes."""
        return _text(self.surface, ids)


class Encoder:
    """Segments whole texts; remembers the words it has seen."""

    def __init__(self, model_file: str, count: int, batch: int = BATCH, words: int | None = None):
        self.lattice, self.count, self.batch, self.words = Lattice(model_file), count, batch, words
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.others: list[bytes] = []
        self.cost = np.empty((0, self.count))
        self.length = np.empty((0, self.count), np.int32)

    def learn(self, words: list[str]) -> None:
        begin = len(self.ids)
        found = [self.lattice.best_of_all(words[at : at + self.batch], self.count) for at in range(0, len(words), self.batch)]
        self.number.update(zip(words, range(begin, begin + len(words)), strict=True))
        for one in found:
            self.ids += one.best
            self.others += one.others
        if len(self.ids) > len(self.cost):  # room for the words of many runs
            room = np.zeros((max(len(self.ids), len(self.cost) * 3 // 2) - len(self.cost), self.count))
            self.cost, self.length = np.concatenate([self.cost, room]), np.concatenate([self.length, room.astype(np.int32)])
        if found:
            self.cost[begin : len(self.ids)] = np.concatenate([one.cost for one in found])
            self.length[begin : len(self.ids)] = np.concatenate([one.length for one in found])

    def segment_all(self, texts: list[str | None]) -> list[list[tuple[float, bytes]]]:
        """The N best segmentations of each text as (score, little-endian 32-bit ids), best first."""
        split = self.lattice.split.findall
        parts = [split(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.number) > (self.words or MEMORY * self.count):
            self.forget()
        fresh = sorted(set().union(*parts) - self.number.keys())
        self.learn(fresh)
        return [self._segment(p) for p in parts]

    def _segment(self, parts: list[str]) -> list[tuple[float, bytes]]:
        if not parts:
            return [(0.0, b"")]
        words = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        best = b"".join(map(self.ids.__getitem__, words.tolist()))
        total = -float(self.cost[words, 0].sum())
        if self.count == 1:
            return [(total, best)]
        losses = self.cost[words, 1] - self.cost[words, 0]
        most = min(self.count - 1, len(words))
        slots = np.lexsort((np.arange(len(words)), losses))[:most] if len(words) <= 64 else self._least(losses, most)
        slots = [int(s) for s in slots if np.isfinite(losses[s])]
        out = [(total, best)]
        # Sums in ascending order over lists sorted by their first loss: deepen the last change, add the next
        # list, or move the last change there.
        heap = [(losses[slots[0]], ((0, 0),))] if slots else []
        while heap and len(out) < self.count:
            cost, changes = heapq.heappop(heap)
            out.append((total - float(cost), self._changed(words, best, slots, changes)))
            at, option = changes[-1]
            options = self.cost[words[slots[at]], 1:] - self.cost[words[slots[at]], 0]
            if option + 1 < len(options) and np.isfinite(options[option + 1]):
                heapq.heappush(heap, (cost - options[option] + options[option + 1], (*changes[:-1], (at, option + 1))))
            if at + 1 < len(slots):
                more = losses[slots[at + 1]]
                heapq.heappush(heap, (cost + more, (*changes, (at + 1, 0))))
                if option == 0:
                    heapq.heappush(heap, (cost - losses[slots[at]] + more, (*changes[:-1], (at + 1, 0))))
        return out

    @staticmethod
    def _least(losses: np.ndarray, most: int) -> np.ndarray:
        bound = np.partition(losses, most - 1)[most - 1]
        near = np.flatnonzero(losses <= bound)
        return near[np.lexsort((near, losses[near]))][:most]

    def _other(self, word: int, option: int) -> bytes:
        ends = np.cumsum(self.length[word, 1:]) * 4
        return self.others[word][ends[option] - 4 * self.length[word, option + 1] : ends[option]]

    def _changed(self, words: np.ndarray, best: bytes, slots: list[int], changes: tuple) -> bytes:
        """The best segmentation's ids with those of the changed words put in their place."""
        places = np.cumsum(self.length[words, 0]) * 4
        parts, begin = [], 0
        for slot, option in sorted((slots[at], option) for at, option in changes):
            end = int(places[slot])
            parts += [best[begin : end - 4 * int(self.length[words[slot], 0])], self._other(int(words[slot]), option)]
            begin = end
        return b"".join([*parts, best[begin:]])


_encoders: dict[tuple, Encoder] = {}


def _encoder(*key) -> Encoder:
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


_surfaces: dict[str, list[bytes]] = {}


def _surface_of(model_file: str) -> list[bytes]:
    """The bytes of each id, for decoding alone: without the tables of the lattice."""
    if model_file not in _surfaces:
        import sentencepiece

        _surfaces[model_file] = _surface(sentencepiece.SentencePieceProcessor(model_file=model_file))
    return _surfaces[model_file]


def _ids(parts: list[bytes]) -> pa.Array:
    flat = pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(p) // 4 for p in parts)]), pa.int32()), flat)


def encode(texts: DataFrame, n_best: int = 1, text: str = "text", model_file: str | None = None) -> DataFrame:
    """``texts`` with the best segmentation (ids array<int>), all scores (array<double>) and, for ``n_best`` above
    1, the others (array<array<int>>)."""
    model_file = model_file or default_model()
    row = F.struct(*[F.col(f"`{n}`") for n in texts.columns]).alias("row")
    place = texts.columns.index(text) if text in texts.columns else None
    rows = texts.select(row, *([] if place is not None else [F.col(text).alias("text")]))

    def given(batch: pa.RecordBatch) -> pa.RecordBatch:
        # The text is taken from its row, so that it is not sent twice.
        return batch if place is None else pa.RecordBatch.from_arrays([batch.column(0), batch.column(0).field(place)], names=["row", "text"])

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(model_file, n_best, ROW_BATCH, ROW_WORDS)
        for run in runs(map(given, batches), limit=ROW_BYTES):
            found = own.segment_all(run.column(1).to_pylist())
            scores = pa.array([[s for s, _ in f] for f in found], pa.list_(pa.float64()))
            columns, names = [run.column(0), _ids([f[0][1] for f in found]), scores], ["row", "ids", "scores"]
            if n_best > 1:
                flat = _ids([ids for f in found for _, ids in f[1:]])
                starts = pa.array(np.cumsum([0, *(len(f) - 1 for f in found)]), pa.int32())
                columns, names = [*columns, pa.ListArray.from_arrays(starts, flat)], [*names, "others"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        own.forget()  # the worker goes on to other stages

    schema = rows.select("row").schema.add("ids", _IDS).add("scores", T.ArrayType(T.DoubleType()))
    if n_best > 1:
        schema = schema.add("others", T.ArrayType(_IDS))
    return rows.mapInArrow(apply, schema).select("row.*", "ids", "scores", *(["others"] if n_best > 1 else []))


def decode(rows: DataFrame, ids: str = "ids", model_file: str | None = None) -> DataFrame:
    """``rows`` with column decoded: the text of the ids (null for null).

    Only the ids go to Python, and those of one row at a time become Python objects: rows that also hold other
    segmentations are several times as wide.
    """
    model_file = model_file or default_model()
    return rows.select("*", F.arrow_udf(_decoder(model_file), "string")(F.col(ids)).alias("decoded"))


def _decoder(model_file: str):
    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        surface = _surface_of(model_file)
        for column in columns:
            yield pa.array((_text(surface, x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else None for x in column), pa.string())

    return apply


def digests(texts: DataFrame, key: str = "doc_id", n_best: int = 4, text: str = "text", model_file: str | None = None) -> DataFrame:
    """Per text: key, n_pieces of the best segmentation, and per segmentation its score and the crc32 of its ids
    (little-endian, 32 bits); and whether the best one decodes to the text."""
    model_file = model_file or default_model()
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(model_file, n_best)
        for run in runs(batches, limit=ENCODED_BYTES):
            given = run.column(1).to_pylist()
            found = own.segment_all(given)
            back = [own.lattice.text(np.frombuffer(f[0][1], "<i4").tolist()) == (t or "") for f, t in zip(found, given, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    run.column(0),
                    pa.array([len(f[0][1]) // 4 for f in found], pa.int64()),
                    pa.array([[s for s, _ in f] for f in found], pa.list_(pa.float64())),
                    pa.array([[zlib.crc32(ids) for _, ids in f] for f in found], pa.list_(pa.int64())),
                    pa.array(back, pa.bool_()),
                ],
                names=["key", "n_pieces", "scores", "ids_crc32", "round_trip"],
            )

    schema = T.StructType([rows.schema["key"]]).add("n_pieces", T.LongType()).add("scores", T.ArrayType(T.DoubleType())).add("ids_crc32", T.ArrayType(T.LongType())).add("round_trip", T.BooleanType())
    return rows.mapInArrow(apply, schema).withColumnRenamed("key", key)
