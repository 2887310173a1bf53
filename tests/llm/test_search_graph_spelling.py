"""Lexical search, the vector graph and spelling variants against brute force, odd rows and empty tables."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitlake.llm import lexical_search, spelling, vector_graph
from hitlake.llm import queries as llm

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Lexical search ------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(documents, items, k):
    texts = [(doc, collections.Counter(TERM.findall((text or "").translate(LOWER)))) for doc, text in documents]
    texts = [(doc, held) for doc, held in texts if held]
    count, total = len(texts), sum(sum(held.values()) for _, held in texts)
    df = collections.Counter(term for _, held in texts for term in held)
    terms = collections.defaultdict(set)
    for item, text in items:
        terms[item] |= set(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, wanted in terms.items():
        scores = []
        for doc, held in texts:
            m = 100 - 90 + (90 * sum(held.values()) * count) // total
            w = {t: math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) for t in wanted if t in held}
            score = sum(w[t] * ((1000000000 * held[t]) // (1000 * held[t] + 8 * m)) for t in w)
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, n + 1, None if lost else doc, -score) for n, (score, lost, doc) in enumerate(sorted(scores)[:k])]
    return out


ROWS = [
    (1, None),
    (2, ""),
    (3, "The cat sat on the mat. The CAT looked at 2 dogs"),
    (4, "the cat sat on the mat the cat looked at 2 dogs"),
    (4, "the cat sat on the mat the cat looked at 2 dogs"),
    (None, "a cat without an id"),
    (6, "Wörter ñandú 日本 zebra " * 20000),
    (7, "!!! ... ---"),
    (8, "zebra" * 30000),
]
ITEMS = [("i1", "the cat and the zebra"), ("i2", "日本 Wörter, wörter"), ("i3", None), ("i4", "nothing of this occurs"), (None, "dogs"), ("i1", "dogs too"), ("i5", "")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string").selectExpr("*", "1 AS item", "2 AS term", "3 AS block", "4 AS n", "5 AS word", "6 AS score")


@pytest.mark.parametrize(("owners", "block_terms"), [(4, 1 << 15), (1, 4), (3, 2)])
def test_search_odd_rows(spark, odd, owners, block_terms):
    items = spark.createDataFrame(ITEMS, "item_id string, text string").selectExpr("*", "1 AS item", "2 AS doc_id", "3 AS rank")
    got = lexical_search.search(odd, items, k=3, owners=owners, block_terms=block_terms)
    assert got.columns == ["item", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_search(ROWS, ITEMS, 3), key=str)


@pytest.mark.parametrize("block", [4 << 20, 1 << 12])
def test_search_of_the_benchmark(spark, monkeypatch, block):
    """Small blocks let go of accumulators; nothing of the result may be lost by that."""
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block)
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = brute_search([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()], 10)
    got = lexical_search.search(documents.repartition(3), items, k=10)
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_search_of_nothing(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    for documents, wanted in ((odd.where("false"), items), (odd, items.where("false")), (odd.where("doc_id < 3"), items)):
        found = lexical_search.search(documents, wanted)
        assert found.columns == ["item", "rank", "doc_id", "score"] and found.count() == 0


# Spelling variants ---------------------------------------------------------------------------------

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(documents, one_in):
    counts = collections.Counter()
    for doc, text in documents:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def brute_variants(documents, least_letters=6, least_count=5, factor=5, one_in=199):
    counts = {w: n for w, n in brute_words(documents, one_in).items() if len(w) >= least_letters and n >= least_count}
    deleted = collections.defaultdict(set)  # two words of one edit share a word that one deletion, or none, makes of both
    for word in counts:
        for i in range(len(word)):
            deleted[word[:i] + word[i + 1 :]].add(word)
        deleted[word].add(word)
    near = {w: set() for w in counts}
    for together in deleted.values():
        for w in together:
            near[w] |= {v for v in together if one_edit(w, v)}
    form = {}
    for word, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= factor * counts[word] else None
    out = []
    for word in counts:
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, counts[word], len(near[word]), counts[form[word]] if form[word] else None))
    return out


def test_words_are_counted_as_stated(spark, odd):
    got = spelling.word_counts(odd, least_letters=1, least_count=1, one_in=3)
    expected = {w: n for w, n in brute_words(ROWS, 3).items() if w}
    assert {r.word: r.n for r in got.collect()} == expected


def test_variants_of_given_words(spark):
    times = {"colour": 130, "color": 130, "colours": 25, "coloors": 5, "kolours": 5, "ñandúes": 25, "nandúes": 5, "ñandúess": 5, "straße": 6, "strasse": 6, "abcdef": 5, "abcdefg": 24, "zzzzzz": 4, "colourx": 26, "coloury": 26, "çolours": 1}
    texts = [(n, " ".join(f"{word}" for word, often in times.items() if n < often)) for n in range(130)]
    texts += [(None, "COLOURS, Colours; ÑANDÚES"), (7, None), (8, "")] + [(300 + n, "q" * 500 + " " + "q" * 501) for n in range(6)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS near", "4 AS key")
    for one_in in (0, 199, 7):
        got = spelling.variants(frame, one_in=one_in)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted(map(tuple, got.collect())) == sorted(brute_variants(texts, one_in=one_in))


def test_variants_of_the_smallest_tables(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = spelling.variants(documents.repartition(5), least_letters=4, least_count=2, factor=2)
    assert sorted(map(tuple, got.collect())) == sorted(brute_variants(rows, 4, 2, 2))
    assert sorted(map(tuple, llm.op13_spelling(spark, SF).collect())) == sorted(brute_variants(rows))


def test_neighbourhoods_are_whole():
    size = 4
    for word in ((0,), (1, 2, 3), (0, 0, 0, 0), tuple(n % 4 for n in range(60))):
        own = lambda w: int(next(spelling.neighbourhood(np.array(w), size))[0])
        around = {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}
        around |= {word[:i] + (c,) + word[i + 1 :] for i in range(len(word)) for c in range(size)}
        around |= {word[:i] + (c,) + word[i:] for i in range(len(word) + 1) for c in range(size)}
        made = {int(h) for chunk in spelling.neighbourhood(np.array(word), size) for h in chunk}
        assert made == {own(w) for w in around}


def test_variants_of_nothing(spark, odd):
    found = spelling.variants(odd.where("false"))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"] and found.count() == 0


def test_variants_broadcast_no_words(spark, monkeypatch):
    """The words' file is small enough to broadcast, what is made of it is not."""
    drawn = np.random.default_rng(11).integers(97, 123, (2000, 7))
    words = {bytes(w.tolist()).decode() for w in drawn}
    texts = [(n, " ".join(words)) for n in range(5)] + [(5, "colours " * 30 + "colour " * 5)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    plans, kind = [], type(frame)

    def joined(*args, join=kind.join, **named):
        found = join(*args, **named)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(kind, "join", joined)
    got = sorted(map(tuple, spelling.variants(frame, one_in=0).collect()))
    assert len(plans) >= 4
    assert all("SortMergeJoin" in plan and "Broadcast" not in plan for plan in plans)
    assert got == sorted(brute_variants(texts, one_in=0))


# Vector graph --------------------------------------------------------------------------------------


def brute_links(rows, threshold=0.93):
    good = []
    for n, (_, x, label) in enumerate(rows):
        ok = x is not None and label is not None and None not in x and len(x) and np.isfinite(x).all() and np.any(x)
        if ok:
            x = np.array(x, float)
            good.append((n, (label, len(x)), x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())))
    links = {n: set() for n in range(len(rows))}
    for i, (n, part, x) in enumerate(good):
        for m, other, y in good[:i]:
            if part == other and x @ y >= threshold:
                links[n].add(m)
                links[m].add(n)
    out, order = [], lambda v: (v is None, v or 0)
    for n, (vec, _, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            more = links[todo.pop()] - seen
            seen |= more
            todo += more
        least = min((rows[m][0] for m in seen), key=order)
        out.append((vec, len(links[n]), least, vec == least))
    return out


def same_links(frame, rows):
    assert frame.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, frame.collect()), key=str) == sorted(brute_links(rows), key=str)


def test_links_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0], "a"), (2, [2.0, 0.0], "a"), (2, [2.0, 0.0], "a"), (3, [1.0, 0.1], "b"), (4, [1.0, 0.1], None), (5, None, "a"), (6, [0.0, 0.0], "a"), (7, [nan, 1.0], "a"), (8, [inf, 1.0], "a"), (9, [None, 1.0], "a"), (10, [], "a"), (None, [1.0, 0.05], "a"), (None, None, None), (11, [1.0, 0.0, 0.0], "a"), (12, [1e300, 1e299], "a"), (13, [5e-324, 0.0], "a"), (14, [-1.0, 0.0], "a"), (1, [0.0, 1.0], "a")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string").selectExpr("*", "1 AS id", "2 AS part", "3 AS v", "4 AS node", "5 AS key")
    same_links(vector_graph.links(frame), rows)


def clustered(seed, dim, sizes, noise):
    draw = np.random.default_rng(seed)
    out = []
    for size, spread in zip(sizes, noise):
        centre = draw.standard_normal(dim)
        out += [centre + spread * draw.standard_normal(dim) for _ in range(size)]
    out += list(draw.standard_normal((200, dim)))
    return [(n, [float(c) for c in np.float32(x)], "one" if n % 9 else "two") for n, x in enumerate(out)]


@pytest.mark.parametrize(("block", "cell"), [(1024, 0.01), (16, 0.05)])
def test_large_groups_are_counted_whole(spark, monkeypatch, block, cell):
    """Tight groups, loose ones whose members link in part, and chains; more members than a list holds."""
    monkeypatch.setattr(vector_graph, "BLOCK", block)
    monkeypatch.setattr(vector_graph, "CELL", cell)
    rows = clustered(5, 16, [60, 90, 5, 40], [0.05, 0.27, 0.2, 0.22])
    rows += [(1000 + n, [math.cos(n / 40), math.sin(n / 40)] + [0.0] * 14, "one") for n in range(100)]
    rows += [(2000 + n, rows[3][1], "one") for n in range(50)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label string")
    same_links(vector_graph.links(frame), rows)


def test_links_of_the_smallest_tables(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    same_links(llm.op12_vector_graph(spark, "/root/testdata/sf0.01"), [(r.vec_id, r.embedding, r.label) for r in frame.collect()])


def test_recall_of_the_graph_alone(spark):
    """Pairs among random vectors: nothing but the search finds them."""
    draw = np.random.default_rng(3)
    base = draw.standard_normal((1500, 32))
    twins = base[:300] + 0.2 * draw.standard_normal((300, 32))
    rows = [(n, [float(c) for c in x], 1) for n, x in enumerate(np.concatenate([base, twins]))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    expected = {vec: n for vec, n, _, _ in brute_links(rows)}
    got = {r.vec_id: r.n_links for r in vector_graph.links(frame).collect()}
    assert all(got[vec] <= n for vec, n in expected.items())
    assert sum(got.values()) >= 0.97 * sum(expected.values())


def test_links_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert vector_graph.links(frame).count() == 0
    assert vector_graph.links(frame.unionAll(spark.createDataFrame([(1, None, 2)], frame.schema))).first().kept
