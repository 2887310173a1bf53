"""Ranked lexical search by pipelined term partitioning.

The terms of the searched items are dealt out to a few term owners, rarest first, so that each owner holds about the
same number of postings.  Documents are cut into blocks of bounded bytes.  For each block one bundle travels through
the owners in turn: it carries the sparse accumulators (item, document, score so far) of the block, and every stage
cogroups it with that owner's postings of the block and adds their integer contributions.  The last stage selects
the best of each block, a ranking over all blocks the best of all.

A stage lets go of an accumulator only if its score and the most that later owners can add stay below the k-th best
score that the block has already; the document then cannot be among the k best of the block.  So nothing that belongs
in the result is lost, and bundles stay sparse though common terms occur in nearly every document.

Bounds: items are searched in blocks of about ``BLOCK_TERMS`` terms (one pass over the documents each; one item is
never cut), whose vocabulary and weights pass the driver.  A task holds one block of documents with its accumulators.
Terms are told by 64-bit hashes.

Defined results: a null text or one without terms has no terms; it is counted nowhere and found by nothing.  Rows of
one item id are one item, whose terms are those of all its rows; a null item id is an item of its own.  Every row of
documents is a document, also where ids repeat; a null document id ranks after all others of its score.  An item
without terms, or without a document that scores above 0, has no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlake.llm.batches import runs, word_hashes
from hitlake.storage import scratch_path

#: Bytes of text of one block of documents; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Terms, counted once for each of their items, that are searched for in one pass over the documents.
BLOCK_TERMS = 1 << 15
#: Documents of a block, at most: places of documents take two bytes.
BLOCK_ROWS = 1 << 16

#: A term is a maximal run of these bytes: digits, letters, and all bytes of characters beyond ASCII.
MEMBER = np.zeros(256, bool)
MEMBER[0x30:0x3A] = MEMBER[0x41:0x5B] = MEMBER[0x61:0x7B] = MEMBER[0x80:] = True

_INDEX = "block bigint, term int, docs binary, tfs binary, df bigint, total bigint, most_tf bigint, least_n bigint, ids array<bigint>, lengths array<bigint>"
_BUNDLE = "block bigint, ids array<bigint>, lengths array<bigint>, items binary, docs binary, scores binary"


def _term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term hash, occurrences) of each distinct term of each text, and the terms of each text with repeats."""
    hashes, first = word_hashes(texts, MEMBER)
    lengths = np.diff(first)
    text = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(text))), lengths


def _item_terms(items: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """(item, term) once each, stored."""
    kind = items.schema[item_column].dataType

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, limit=BLOCK_BYTES):
            text, hashes, _, _ = _term_counts(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text)), pa.array(hashes.view(np.int64))], ["item", "term"])

    schema = T.StructType([T.StructField("item", kind), T.StructField("term", T.LongType())])
    chosen = items.select(F.col(item_column).alias("item"), F.col(text_column).cast("string").alias("text"))
    path = scratch_path(items.sparkSession, "item-terms")
    chosen.mapInArrow(terms, schema).distinct().write.parquet(path)
    return items.sparkSession.read.schema(schema).parquet(path)


def _index(documents: DataFrame, vocabulary: np.ndarray) -> str:
    """Where the postings of the vocabulary (sorted hashes) are stored by block of documents; term -1 heads each block."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)  # at most BLOCK_TERMS hashes, or those of one item

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        block = TaskContext.get().partitionId() << 32
        for run in runs(batches, limit=BLOCK_BYTES):
            for begin in range(0, run.num_rows, BLOCK_ROWS):
                part = run.slice(begin, BLOCK_ROWS)
                text, hashes, tf, lengths = _term_counts(part.column(1))
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                text, tf, term = text[hit], tf[hit], at[hit]
                order = np.argsort(term, kind="stable")
                text, tf, term = text[order], tf[order], term[order]
                first = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
                rows = {name: [] for name in ("block", "term", "docs", "tfs", "df", "total", "most_tf", "least_n", "ids", "lengths")}

                def add(*values):
                    for name, value in zip(rows, values, strict=True):
                        rows[name].append(value)

                add(block, -1, b"", b"", int((lengths > 0).sum()), int(lengths.sum()), 0, 0, part.column(0), lengths)
                for i, j in zip(first, np.append(first, len(term))[1:], strict=True):
                    held = text[i:j]
                    add(block, int(term[i]), held.astype("<u2").tobytes(), tf[i:j].astype("<i4").tobytes(), j - i, 0, int(tf[i:j].max()), int(lengths[held].min()), None, None)
                arrays = [pa.array(rows["block"], pa.int64()), pa.array(rows["term"], pa.int32()), pa.array(rows["docs"], pa.binary()), pa.array(rows["tfs"], pa.binary())]
                arrays += [pa.array([int(x) for x in rows[name]], pa.int64()) for name in ("df", "total", "most_tf", "least_n")]
                ends = pa.array([0] + [part.num_rows] * len(rows["block"]), pa.int32())
                nothing = pa.array([False] + [True] * (len(rows["block"]) - 1))
                arrays += [pa.ListArray.from_arrays(ends, values, mask=nothing) for values in (part.column(0), pa.array(lengths, pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, list(rows))
                block += 1

    path = scratch_path(spark, "postings")
    documents.mapInArrow(postings, _INDEX).write.parquet(path)
    shared.unpersist()
    return path


def weight(n_documents: int, df: int) -> int:
    """The integer weight of a term that ``df`` of ``n_documents`` documents hold."""
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def _stage(owner: int, last: bool, plan: dict):
    """One owner's stage: adds its contributions to the bundle of a block; the last one selects the best."""

    def add(key: tuple, bundle: pa.Table, postings: pa.Table) -> pa.Table:
        ids, lengths = (bundle.column(name).combine_chunks().values for name in ("ids", "lengths"))
        m = 100 - 90 + (90 * lengths.to_numpy(zero_copy_only=False) * plan["documents"]) // plan["terms"]
        held = {}
        for term, docs, tfs in zip(*(postings.column(name).to_pylist() for name in ("term", "docs", "tfs")), strict=True):
            at, tf = np.frombuffer(docs, "<u2"), np.frombuffer(tfs, "<i4").astype(np.int64)
            held[term] = (at, plan["weights"][term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[at])))
        items, docs, scores = (np.frombuffer(bundle.column(name)[0].as_py() or b"", kind) for name, kind in (("items", "<i4"), ("docs", "<u2"), ("scores", "<i8")))
        first = np.searchsorted(items, np.arange(len(plan["owned"][owner]) + 1))
        out = []
        total = np.zeros(len(m), np.int64)
        for item, terms in enumerate(plan["owned"][owner]):
            total[:] = 0
            total[docs[first[item] : first[item + 1]]] = scores[first[item] : first[item + 1]]
            for term in terms:
                if term in held:
                    at, more = held[term]
                    total[at] += more
            found = np.flatnonzero(total)
            if len(found) >= plan["k"]:
                mine = total[found]
                best = np.partition(mine, len(mine) - plan["k"])[len(mine) - plan["k"]]
                found = found[mine + (0 if last else plan["rest"][owner][item]) >= best]
            if len(found):
                out.append((np.full(len(found), item, "<i4"), found.astype("<u2"), total[found].astype("<i8")))
        items, docs, scores = (np.concatenate(x) if out else np.zeros(0, kind) for x, kind in zip(zip(*out, strict=True) if out else ((), (), ()), ("<i4", "<u2", "<i8"), strict=True))
        if last:
            return pa.table({"item": pa.array(items, pa.int32()), "doc_id": ids.take(pa.array(docs)), "score": pa.array(scores, pa.int64())})
        return pa.table([bundle.column("block"), bundle.column("ids"), bundle.column("lengths"), *(pa.array([x.tobytes()], pa.binary()) for x in (items, docs, scores))], names=["block", "ids", "lengths", "items", "docs", "scores"])

    return add


def _search_block(documents: DataFrame, terms: list[np.ndarray], k: int, owners: int) -> DataFrame | None:
    """(item, doc_id, score): the best of each block of documents for items given by their distinct term hashes."""
    spark = documents.sparkSession
    vocabulary = np.unique(np.concatenate(terms)) if terms else np.zeros(0, np.uint64)
    if not len(vocabulary):
        return None
    path = _index(documents, vocabulary)
    index = spark.read.schema(_INDEX).parquet(path)
    n_documents, n_terms = index.where("term = -1").agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    if not n_documents:
        return None
    m = f"(10 + (90 * least_n * {n_documents}) div {n_terms})"
    most = F.max(F.expr(f"(1000000000 * most_tf) div (1000 * most_tf + 8 * {m})"))  # no document of the block gets more
    df, bound = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
    for term, n, part in index.where("term >= 0").groupBy("term").agg(F.sum("df"), most).collect():  # at most the vocabulary
        df[term], bound[term] = n, part
    weights = np.array([weight(n_documents, int(n)) for n in df], np.int64)
    bound *= weights
    order = np.argsort(df, kind="stable")
    owner = np.zeros(len(vocabulary), np.int64)
    owner[order] = np.minimum((np.cumsum(df[order]) - df[order]) * owners // max(1, int(df.sum())), owners - 1)
    places = [np.searchsorted(vocabulary, t) for t in terms]
    plan = {
        "k": k,
        "documents": n_documents,
        "terms": n_terms,
        "weights": weights,
        "owned": [[p[(owner[p] == o) & (df[p] > 0)].tolist() for p in places] for o in range(owners)],
        "rest": [[int(bound[p[owner[p] > o]].sum()) for p in places] for o in range(owners)],
    }
    owned = spark.createDataFrame([(int(t), int(owner[t])) for t in range(len(vocabulary))], "term int, owner int")
    bundles = index.where("term = -1").selectExpr("block", "ids", "lengths", "binary('') AS items", "binary('') AS docs", "binary('') AS scores")
    for o in range(owners):
        postings = spark.read.schema(_INDEX).parquet(path).where("term >= 0").join(F.broadcast(owned.where(F.col("owner") == o)), "term", "left_semi").select("block", "term", "docs", "tfs")
        schema = "item int, doc_id bigint, score bigint" if o == owners - 1 else _BUNDLE
        bundles = bundles.groupBy("block").cogroup(postings.groupBy("block")).applyInArrow(_stage(o, o == owners - 1, plan), schema)
    return bundles


def search(documents: DataFrame, items: DataFrame, k: int = 10, owners: int = 4, *, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item, rank, doc_id, score): the ``k`` best documents of each item, equal scores by ascending id."""
    spark = documents.sparkSession
    kind = items.schema[item_column].dataType
    texts = documents.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    pairs = _item_terms(items, item_column, item_text)
    blocks = max(1, math.ceil(pairs.count() / block_terms))
    out = None
    for block in range(blocks):
        held = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        found = _search_block(texts, [np.array(row["terms"], np.int64).view(np.uint64) for row in held], k, owners)
        if found is None:
            continue
        names = spark.createDataFrame([(n, row["item"]) for n, row in enumerate(held)], T.StructType([T.StructField("item", T.IntegerType()), T.StructField("name", kind)]))
        best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        found = found.join(F.broadcast(names), "item").select(F.col("name").alias("item"), "rank", "doc_id", "score")
        out = found if out is None else out.unionAll(found)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField("item", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    return out
