"""Spelling variants grouped by reduced-alphabet generation.

Letters are hashed to a few symbols.  Two words that differ by one edit have reduced words that are equal or differ
by one edit, so each word generates the full one-edit neighbourhood of its reduced word (itself, every deletion,
replacement and insertion), which is joined with the reduced vocabulary; each pair found is verified on the original
strings.  The number of symbols follows the size of the vocabulary, so that a generated reduced word meets a bounded
number of words on average: it changes what the join costs, never what it finds.

Neighbourhoods are made as 64-bit hashes in time proportional to the word's length, so words of any length take part;
a collision only costs a verification.  Words are counted within each run of text before they are shuffled.

Defined results: a null text has no words; a null document id is written as the empty string where ids are hashed.
Every row counts, also where ids repeat.  Other columns are not read.  Empty documents give an empty table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlake.llm.batches import LOWER, Hasher, byte_view, mix, runs, word_spans
from hitlake.storage import scratch_path

#: Words shorter than this many code points are not grouped.
LEAST_LETTERS = 6
#: Words that occur less often are not grouped.
LEAST_COUNT = 5
#: A form occurs at least this many times as often as the words that it stands for.
FORM_FACTOR = 5
#: One run in so many loses a letter before it is counted; 0 for none.
EDIT_ONE_IN = 199
#: Neighbourhood hashes made at once.
CHUNK = 1 << 18
#: Nothing that grows with the vocabulary is broadcast: the driver would hold it whole.
JOIN = "merge"

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


def edited(word: bytes, doc_id: int | None, one_in: int) -> bytes:
    """The word (lower-cased UTF-8) as it is counted: one in ``one_in`` by checksum loses a letter."""
    if one_in:
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode() + word)
        if not h % one_in:
            letters = word.decode()
            at = h % len(letters)
            return (letters[:at] + letters[at + 1 :]).encode()
    return word


def word_counts(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, one_in: int = EDIT_ONE_IN) -> DataFrame:
    """(word, n) of words that are long and frequent enough, over all texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, limit=2 << 20):
            data, offsets = byte_view(batch.column(1))
            data = LOWER[data]
            wide = data == 0xC3  # with the byte that follows: U+00C0 to U+00FF
            member = _LETTER[data] | wide
            member[1:] |= wide[:-1]
            starts, ends, first = word_spans(member.astype(np.uint8), offsets, np.array([False, True]))
            if not len(starts):
                continue
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
            hashes = Hasher(data).spans(starts, ends)
            order = np.lexsort((hashes, text))
            new = np.ones(len(order), bool)
            new[1:] = (text[order][1:] != text[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(order)))
            at = order[at]
            ids, body = batch.column(0).to_pylist(), data.tobytes()
            found: dict[bytes, int] = {}
            for doc, i, j, n in zip(text[at].tolist(), starts[at].tolist(), ends[at].tolist(), times.tolist(), strict=True):
                word = edited(body[i:j], ids[doc], one_in)
                found[word] = found.get(word, 0) + n
            kept = {w: n for w, n in found.items() if len(w) >= least_letters and len(w.decode()) >= least_letters}
            for begin in range(0, len(kept), CHUNK):
                words = list(kept)[begin : begin + CHUNK]
                yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words], pa.string()), pa.array([kept[w] for w in words], pa.int64())], ["word", "n"])

    texts = documents.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    counts = texts.mapInArrow(counted, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def symbols_for(words: int) -> int:
    """Symbols of the reduced alphabet: enough that as many reduced words of six letters as there are words differ."""
    return max(4, math.ceil(words ** (1 / LEAST_LETTERS)) + 2)


def neighbourhood(symbols: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Hashes of a reduced word and of all that one edit makes of it, in bounded chunks; the first hash is the word's own."""
    n = len(symbols)
    powers = np.full(n + 2, _BASE, _U)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    values = symbols.astype(_U) + _U(1)
    ahead = np.concatenate([np.zeros(1, _U), np.cumsum(values * powers[:n])])  # of the first i symbols
    later = np.concatenate([np.zeros(1, _U), np.cumsum(values * powers[1 : n + 1])])  # the same, one place later
    total = ahead[n]
    sealed = lambda h, length: mix(h + _U(length) * _U(0xD1B54A32D192ED03))
    yield sealed(np.array([total]), n)
    step = max(1, CHUNK // size)
    letters = np.arange(1, size + 1, dtype=_U)
    inverse = _U(pow(int(_BASE), -1, 1 << 64))
    for i in range(0, n, step):
        at = np.arange(i, min(n, i + step))
        yield sealed(ahead[at] + (total - ahead[at + 1]) * inverse, n - 1)
        yield sealed(((total - values[at] * powers[at])[:, None] + letters * powers[at][:, None]).ravel(), n)
    for i in range(0, n + 1, step):
        at = np.arange(i, min(n + 1, i + step))
        yield sealed(((ahead[at] + later[n] - later[at])[:, None] + letters * powers[at][:, None]).ravel(), n + 1)


def _reduced(word: str, size: int) -> np.ndarray:
    codes = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(_U)
    return (mix(codes * _BASE) % _U(size)).astype(np.int64)


def near_pairs(counts: DataFrame) -> DataFrame:
    """(word, near, near_n) for every two words of ``counts`` (word, n) that differ by exactly one edit, both ways."""
    size = symbols_for(counts.count())

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            keys = [next(neighbourhood(_reduced(w, size), size))[0] for w in words]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, _U).view(np.int64)), *batch.columns], ["key", "near", "near_n"])

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, words, held = [], [], 0

        def out():
            keys = np.concatenate(made)
            at = np.repeat(np.arange(len(words)), [len(m) for m in made])
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(words, pa.string()).take(pa.array(at))], ["key", "word"])

        for batch in batches:
            for word in batch.column(0).to_pylist():
                seen = []
                for hashes in neighbourhood(_reduced(word, size), size):
                    seen.append(hashes)
                    if sum(map(len, seen)) >= CHUNK:  # of one very long word
                        made.append(np.unique(np.concatenate(seen)))
                        words.append(word)
                        yield out()
                        made, words, held, seen = [], [], 0, []
                if seen:
                    made.append(np.unique(np.concatenate(seen)))
                    words.append(word)
                    held += len(made[-1]) * (8 + len(word))
                if held >= 8 << 20:
                    yield out()
                    made, words, held = [], [], 0
        if words:
            yield out()

    vocabulary = counts.select("word", "n")
    # Spark sizes what is made here by the compressed file of the words, and would take it for small enough to broadcast.
    made = vocabulary.select("word").mapInArrow(around, "key bigint, word string").hint(JOIN)
    found = made.join(vocabulary.mapInArrow(own, "key bigint, near string, near_n bigint").hint(JOIN), "key")
    within = F.abs(F.length("word") - F.length("near")) <= 1
    return found.where((F.col("word") != F.col("near")) & within & (F.levenshtein("word", "near", 1) == 1)).select("word", "near", "near_n").distinct()


def variants(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, factor: int = FORM_FACTOR, one_in: int = EDIT_ONE_IN) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word.

    The form is the near word of largest n (the smallest in code-point order, if several), if its n is at least
    ``factor`` times the word's; the root is where the forms lead.
    """
    spark = documents.sparkSession
    if factor < 2:
        raise ValueError("a form must be more frequent than its word")
    path = scratch_path(spark, "words")
    word_counts(documents, id_column, text_column, least_letters=least_letters, least_count=least_count, one_in=one_in).write.parquet(path)
    counts = spark.read.schema("word string, n bigint").parquet(path)
    best = near_pairs(counts).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("w"))).alias("best"))
    path = scratch_path(spark, "forms")
    found = counts.join(best.hint(JOIN), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best")
    found = found.withColumn("form_n", F.when(-F.col("best.n") >= F.col("n") * factor, -F.col("best.n")))
    found.withColumn("form", F.when(F.col("form_n").isNotNull(), F.col("best.w"))).drop("best").write.parquet(path)
    words = spark.read.schema("word string, n bigint, n_near bigint, form_n bigint, form string").parquet(path)
    # Counts grow by the factor from form to form, so a chain of 2^63 at most has less than 64 links: six doublings.
    step = words.where("form IS NOT NULL").select("word", F.col("form").alias("to"))
    for _ in range(6):
        path = scratch_path(spark, "steps")
        after = step.select(F.col("word").alias("to"), F.col("to").alias("next"))
        step.join(after.hint(JOIN), "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")).write.parquet(path)
        step = spark.read.schema("word string, to string, moved boolean").parquet(path)
        if step.where("moved").isEmpty():
            break
        step = step.drop("moved")
    roots = step.select("word", F.col("to").alias("root"))
    return words.join(roots.hint(JOIN), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
