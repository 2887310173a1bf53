"""Left outer lookup join that shuffles only the hits that can have a match.

A lookup too large to broadcast can still be told in a few bits an id: a Bloom filter of its ids is broadcast, and
hits whose key is surely not among them get their NULL name without a shuffle.  It pays where many keys miss.

The filter is cut into words of 64 bits.  A hash picks one word for an id, and ``_BITS`` bits of it; words are built by
``bit_or`` over partial aggregates, and lie in blocks of ``_WORDS`` so that a test is one lookup of a block and one
look at a word.  Its size is told by the counted ids before anything is built.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlake.operators.lookup_join import BROADCAST_BYTES, join_lookup

# Words in a block (4 KB), and bits that an id sets in its word.
_WORDS, _BITS = 512, 4

# With fewer bits an id too many misses would pass.
_LEAST_BITS = 6


def _places(key: Column, n_blocks: int) -> tuple[Column, Column, Column]:
    """Block, word within it, and bits within that word, of an id."""
    other = F.xxhash64(key, F.lit(1))
    bits = [
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(other, 9 + 6 * n).bitwiseAND(F.lit(63)).cast("int"))
        for n in range(_BITS)
    ]
    mask = reduce(lambda a, b: a.bitwiseOR(b), bits)
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)), other.bitwiseAND(F.lit(_WORDS - 1)).cast("int"), mask


def n_blocks_for(n_ids: int, bits_per_id: int = 16, max_bytes: int = BROADCAST_BYTES) -> int | None:
    """Blocks of a filter of so many ids: with ``bits_per_id`` bits for each, or what the bound leaves.

    None where the bound leaves so few that the filter would let most misses pass.
    """
    block = _WORDS * 64
    wanted, bound = max(1, ceil(n_ids * bits_per_id / block)), max_bytes * 8 // block
    if wanted <= bound:
        return wanted
    return bound if bound * block >= n_ids * _LEAST_BITS else None


def id_filter(ids: DataFrame, n_blocks: int) -> DataFrame:
    """The filter of column ``id`` as rows ``block``, ``words``; every block is there.  NULL ids set no bit."""
    block, word, mask = _places(F.col("id"), n_blocks)
    places = ids.where("id IS NOT NULL").select(block.alias("block"), word.alias("word"), mask.alias("bits"))
    # Each word once without a bit, so that a block's words are complete and in order.
    every = ids.sparkSession.range(n_blocks * _WORDS).select(
        F.expr(f"id DIV {_WORDS}").alias("block"), (F.col("id") % _WORDS).cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits")
    )
    words = places.unionAll(every).groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return words.groupBy("block").agg(F.transform(in_order, lambda x: x["bits"]).alias("words"))


def split_by_ids(hits: DataFrame, key: str, blocks: DataFrame, n_blocks: int) -> tuple[DataFrame, DataFrame]:
    """Hits whose ``key`` may be among the ids of a filter, and those whose key (or NULL) surely is not."""
    block, word, mask = _places(F.col(key), n_blocks)
    side = blocks.select(F.col("block").alias("_bloom_block"), F.col("words").alias("_bloom_words"))
    marked = hits.join(F.broadcast(side), F.when(F.col(key).isNotNull(), block) == F.col("_bloom_block"), "left")
    may = F.coalesce(F.get("_bloom_words", word).bitwiseAND(mask) == mask, F.lit(False))
    return tuple(marked.where(which).drop("_bloom_block", "_bloom_words") for which in (may, ~may))


def bloom_join_lookup(
    hits: DataFrame,
    lookup: DataFrame,
    key: str,
    name: str,
    tasks: int | None = None,
    bits_per_id: int = 16,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left outer join of ``hits`` with ``lookup(id, name)`` by shuffle of the hits that may match; adds column ``name``.

    ``key`` has the type of the lookup's id.  The rows are those of ``join_lookup``: misses and NULL keys keep their
    row with a NULL name, an id that occurs twice gives two rows, and the matched id stays as ``<name>_match``.  Of
    the misses about 1 % are shuffled with 16 bits an id.  ``hits`` is read once for either part, so it should be a table
    rather than a chain of costly steps.  ``max_bytes`` bounds the filter; above it all hits are shuffled.
    """
    kinds = hits.schema[key].dataType, lookup.schema["id"].dataType
    if kinds[0] != kinds[1]:
        raise ValueError(f"key {key!r} is {kinds[0].simpleString()} but the lookup's id is {kinds[1].simpleString()}")
    n_blocks = n_blocks_for(lookup.where("id IS NOT NULL").count(), bits_per_id, max_bytes)
    if n_blocks is None:
        return join_lookup(hits, lookup, key, name, False, tasks)
    may, never = split_by_ids(hits, key, id_filter(lookup.select("id"), n_blocks), n_blocks)
    found = join_lookup(may, lookup, key, name, False, tasks)
    nothing = {f"{name}_match": F.lit(None).cast(kinds[1]), name: F.lit(None).cast(lookup.schema["name"].dataType)}
    return found.unionAll(never.select("*", *(value.alias(column) for column, value in nothing.items())))
