"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings of the training texts: each row of the stored table is the index of one
bounded run of texts (a shard), with its sorted terms and, per term, the ascending positions at which it stands.
``search`` looks phrases up in every shard: it takes a phrase's rarest term, shifts that term's positions to the
phrase's start, and intersects them with the shifted lists of the other terms, rarest first, until none is left.
``near`` finds the texts in which all terms of a query stand within a number of words.

Phrases come from a query table of any size, a bounded block at a time; each block is one pass over the index.

Words are runs of digits, ASCII letters (lowered) and all non-ASCII characters.  A null text has no words, and an
item without words asks for nothing.  Repeated rows and repeated ids are texts of their own.  Terms are 64-bit
hashes of words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlake.llm.batches import runs, word_hashes
from hitlake.storage import scratch_path

# Bytes that make words, after lowering: digits, a-z and all of UTF-8 beyond ASCII.
MEMBER = np.zeros(256, bool)
MEMBER[0x30:0x3A] = MEMBER[0x61:0x7B] = MEMBER[0x80:] = True

#: Code points of query texts that one pass over the index looks up.
BLOCK_CHARS = 8 << 20

_INDEX = "shard bigint, ids array<bigint>, starts binary, terms binary, term_starts binary, gaps binary"


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 32
    for number, run in enumerate(runs(batches)):
        words, first = word_hashes(run.column(1), MEMBER)
        order = np.argsort(words, kind="stable")
        ranked = words[order]
        heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
        # Positions as gaps within a term: small numbers, which the file format packs well.
        gaps = np.diff(order, prepend=0)
        gaps[heads] = order[heads]
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([base + number], pa.int64()),
                "ids": pa.array([run.column(0).cast(pa.int64()).to_pylist()], pa.list_(pa.int64())),
                "starts": pa.array([first.astype("<i4").tobytes()], pa.binary()),
                "terms": pa.array([ranked[heads].astype("<u8").tobytes()], pa.binary()),
                "term_starts": pa.array([np.append(heads, len(ranked)).astype("<i4").tobytes()], pa.binary()),
                "gaps": pa.array([gaps.astype("<i4").tobytes()], pa.binary()),
            }
        )


def build_index(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the positional index of ``texts`` to the shared scratch folder; the stored table."""
    spark = texts.sparkSession
    path = scratch_path(spark, "phrase-index")
    chosen = texts.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    chosen.mapInArrow(_shards, _INDEX).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(_INDEX).parquet(path)


class Shard:
    """One row of the index, unpacked."""

    def __init__(self, starts: bytes, terms: bytes, term_starts: bytes, gaps: bytes):
        self.starts = np.frombuffer(starts, "<i4")
        self.terms = np.frombuffer(terms, "<u8")
        self.term_starts = np.frombuffer(term_starts, "<i4")
        self._gaps = np.frombuffer(gaps, "<i4")

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The row of each term, or -1."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def positions(self, row: int) -> np.ndarray:
        return np.cumsum(self._gaps[self.term_starts[row] : self.term_starts[row + 1]])


def _held(values: np.ndarray, sorted_list: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_list, values), len(sorted_list) - 1)
    return sorted_list[at] == values


class Phrases:
    """Distinct phrases of a block of query texts, by length, and the items each belongs to."""

    def __init__(self, items: list, column: pa.Array, width: int):
        words, first = word_hashes(column, MEMBER)
        owners: dict[tuple, set[int]] = {}
        for n in range(len(items)):
            own = words[first[n] : first[n + 1]].tolist()
            for at in range(max(1, len(own) - width + 1) if own else 0):
                owners.setdefault(tuple(own[at : at + width]), set()).add(n)
        self.items = items
        self.owners = [sorted(x) for x in owners.values()]
        phrases = list(owners)
        self.terms = np.unique(np.array([t for p in phrases for t in p], np.uint64))
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in sorted({len(p) for p in phrases}):
            own = [n for n, p in enumerate(phrases) if len(p) == length]
            table = np.array([phrases[n] for n in own], np.uint64)
            self.by_length[length] = (np.array(own), np.searchsorted(self.terms, table))

    def occurrences(self, shard: Shard) -> Iterator[tuple[int, int, np.ndarray]]:
        """(phrase, length, start positions) of every phrase that occurs within one text of the shard."""
        rows = shard.find(self.terms)
        sizes = np.where(rows >= 0, np.diff(shard.term_starts)[rows] if len(shard.terms) else 0, 0)
        lists: dict[int, np.ndarray] = {}

        def positions(term: int) -> np.ndarray:
            if term not in lists:
                lists[term] = shard.positions(rows[term])
            return lists[term]

        for length, (numbers, table) in self.by_length.items():
            counts = sizes[table]
            alive = np.flatnonzero(counts.min(axis=1) > 0)
            order = np.argsort(counts[alive], axis=1, kind="stable")
            for n, rarest in zip(alive, order, strict=True):
                phrase = table[n]
                starts = positions(phrase[rarest[0]]) - rarest[0]
                for offset in rarest[1:]:
                    starts = starts[_held(starts + offset, positions(phrase[offset]))]
                    if not len(starts):
                        break
                starts = starts[starts >= 0]
                if len(starts):  # a phrase stays within one text
                    text = np.searchsorted(shard.starts, starts, "right") - 1
                    starts = starts[starts + length <= shard.starts[text + 1]]
                if len(starts):
                    yield int(numbers[n]), length, starts


_HITS = "shard bigint, slot int, id bigint, n_words bigint, items array<string>, hit binary"


def _searcher(phrases: Phrases):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["starts"], row["terms"], row["term_starts"], row["gaps"])
                steps = np.zeros(int(shard.starts[-1]) + 1, np.int32)
                found: dict[int, set[int]] = {}
                for phrase, length, starts in phrases.occurrences(shard):
                    np.add.at(steps, starts, 1)
                    np.add.at(steps, starts + length, -1)
                    for slot in set((np.searchsorted(shard.starts, starts, "right") - 1).tolist()):
                        found.setdefault(slot, set()).update(phrases.owners[phrase])
                hit = np.cumsum(steps)[:-1] > 0
                slots = range(len(row["ids"]))
                bits = [np.packbits(hit[shard.starts[s] : shard.starts[s + 1]]).tobytes() if s in found else None for s in slots]
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([row["shard"]] * len(slots), pa.int64()),
                        "slot": pa.array(slots, pa.int32()),
                        "id": pa.array(row["ids"], pa.int64()),
                        "n_words": pa.array(np.diff(shard.starts), pa.int64()),
                        "items": pa.array([[phrases.items[n] for n in sorted(found.get(s, ()))] for s in slots], pa.list_(pa.string())),
                        "hit": pa.array(bits, pa.binary()),
                    }
                )

    return search


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of hit words over the passes that a text was found in."""
    for batch in batches:
        counts = []
        for bitmaps in batch.column(4).to_pylist():
            total = np.zeros(0, np.uint8)
            for bits in bitmaps or ():
                one = np.frombuffer(bits, np.uint8)
                total = one | total if len(total) else one
            counts.append(int(np.unpackbits(total).sum()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(counts, pa.int64())], names=["id", "n_words", "items", "row", "n_hit"])


def _blocks(queries: DataFrame, key: str, text: str) -> Iterator[tuple[list, pa.Array]]:
    """The query texts in blocks of a bounded size, one at a time."""
    chosen = queries.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = chosen.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = 1 + int(size) // BLOCK_CHARS
    for part in range(parts):
        block = chosen.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part).toArrow()
        yield block.column(0).to_pylist(), block.column(1)


def search(index: DataFrame, queries: DataFrame, key: str = "item_id", text: str = "text", width: int = 13) -> DataFrame:
    """Per indexed text: id, n_words, items (sorted ids of the query texts with an occurring phrase), n_hit words.

    A phrase is ``width`` consecutive words of a query text, or all words of a shorter one.
    """
    spark = index.sparkSession
    passes = [index.mapInArrow(_searcher(Phrases(items, column, width)), _HITS) for items, column in _blocks(queries, key, text)]
    if len(passes) == 1:
        rows = passes[0].select("id", "n_words", "items", F.lit(0).alias("row"), F.when(F.col("hit").isNotNull(), F.array("hit")).alias("hits"))
    else:
        # Each pass is stored before the next block is taken, so that the driver holds one block.
        stored = []
        for one in passes:
            path = scratch_path(spark, "phrase-hits")
            one.write.parquet(path)
            stored.append(path)
        rows = (
            spark.read.schema(_HITS).parquet(*stored)
            .groupBy("shard", "slot")
            .agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("items")).alias("items"), F.collect_list("hit").alias("hits"))
            .select("id", "n_words", "items", F.lit(0).alias("row"), "hits")
        )
    merged = rows.mapInArrow(_merged, "id bigint, n_words bigint, items array<string>, row int, n_hit bigint")
    return merged.select("id", "n_words", F.array_sort(F.array_distinct("items")).alias("items"), "n_hit")


def near(index: DataFrame, terms: list[str], span: int) -> DataFrame:
    """The ids of the texts in which all ``terms`` (single words) stand within ``span`` consecutive words.

    No terms match nothing.  A term asked for twice must stand there once.
    """
    words, first = word_hashes(pa.array(terms, pa.string()), MEMBER)
    wanted = np.unique(words)

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for row in batch.to_pylist():
                shard = Shard(row["starts"], row["terms"], row["term_starts"], row["gaps"])
                at = shard.find(wanted)
                if not len(wanted) or (at < 0).any():
                    continue
                lists = sorted((shard.positions(r) for r in at), key=len)
                # Any window that holds all terms can be moved to start at one of them.
                starts = np.unique(np.concatenate(lists))
                last = starts.copy()
                for one in lists:
                    place = np.searchsorted(one, starts)
                    last = np.maximum(last, np.append(one, np.iinfo(np.int64).max)[place])
                text = np.searchsorted(shard.starts, starts, "right") - 1
                held = (last - starts < span) & (last < shard.starts[text + 1])
                ids += [row["ids"][slot] for slot in np.unique(text[held])]
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64())})

    return index.mapInArrow(found, T.StructType([T.StructField("id", T.LongType())]))


def contamination(texts: DataFrame, benchmark: DataFrame, width: int = 13, share: float = 0.05) -> DataFrame:
    """Per row of ``texts`` (doc_id, text): id, n_words, items, n_hit, contaminated.

    A text is contaminated if at least ``share`` of its words, and at least one, stand in a phrase of the benchmark.
    """
    found = search(build_index(texts), benchmark, width=width)
    ratio = round(1 / share)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * ratio >= F.col("n_words")))
