"""Each operator against a brute-force version, on odd rows, on empty tables and on the smallest scale."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from hitlake.llm import components, fingerprints, jaccard_join, main_text, perspectives, phrase_index, pieces, private_data, suffix_dedup, token_files, toxicity
from hitlake.llm import queries as llm
from hitlake.llm.ranges import in_order

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Texts that every operator must take: null, empty, very long, ties, repeated rows, clashing extra columns.
ROWS = [
    (1, None),
    (2, ""),
    (3, "The cat sat on the mat and looked at the dog over there today."),
    (4, "The cat sat on the mat and looked at the dog over there today."),
    (4, "The cat sat on the mat and looked at the dog over there today."),
    (5, "Mail a.b@c.example.com or +1 (988) 555-2485, host 10.0.0.300 not 10.0.0.30, card 4111 1111 1111 1111."),
    (6, "wörter ñandú 日本 " * 3000),
    (None, "no id at all"),
    (7, "aaaaaaaaaa" * 40),
    (8, "x" + "aaaaaaaaaa" * 40),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd documents, with columns whose names clash with the operators' own."""
    return spark.createDataFrame(ROWS, "doc_id bigint, text string").selectExpr("*", "'en' AS lang", "1 AS row", "2 AS key", "'x' AS hit", "3 AS `range`", "4 AS n_words", "'s' AS source", "0L AS n_chars")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(frame):
    return [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]


def same(got, expected):
    assert sorted(got, key=str) == sorted(expected, key=str)


# 1 -------------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(documents, items, width):
    windows = collections.defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        for at in range(max(1, len(words) - width + 1) if words else 0):
            windows[tuple(words[at : at + width])].add(str(item))
    lengths = {len(w) for w in windows}
    for key, text in documents:
        words, hit, found = WORD.findall(text.translate(LOWER)), set(), set()
        for n in lengths:
            for at in range(len(words) - n + 1):
                if (own := tuple(words[at : at + n])) in windows:
                    hit.update(range(at, at + n))
                    found |= windows[own]
        yield key, len(words), sorted(found), len(hit), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block", [phrase_index.BLOCK_CHARS, 3000])
def test_contamination(spark, docs, odd, none, monkeypatch, block):
    monkeypatch.setattr(phrase_index, "BLOCK_CHARS", block)
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    benchmark = benchmark.unionAll(spark.createDataFrame([(900, "CAT sat"), (901, None), (902, "..."), (900, "the dog")], "item_id bigint, text string"))
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    for frame in (docs, odd, none):
        got = [tuple(r) for r in phrase_index.contamination(frame, benchmark).select("id", "n_words", "items", "n_hit", "contaminated").collect()]
        same(got, brute_contamination(pairs(frame), items, 13))
    assert not phrase_index.contamination(odd, benchmark.where("false")).where("contaminated").count()


def test_near(odd):
    index = phrase_index.build_index(odd)
    assert sorted(r.id for r in phrase_index.near(index, ["cat", "mat"], 5).collect()) == [3, 4, 4]
    assert phrase_index.near(index, ["cat", "mat"], 4).count() == 0
    assert phrase_index.near(index, [], 4).count() == 0


# 2 -------------------------------------------------------------------------------------------------


def all_segmentations(lattice, text):
    if not text:
        return [(0.0, ())]
    out = []
    for end in range(1, len(text) + 1):
        found = lattice.pieces.get(text[:end])
        if found or end == 1:
            ids, score = found or (tuple(lattice.bytes[b] for b in text[0].encode()), lattice.unknown)
            out += [(score + s, (*ids, *rest)) for s, rest in all_segmentations(lattice, text[end:])]
    return out


@pytest.mark.parametrize("text", ["the cat", "a  b\n", "Ⅳx", "it it", "ab.com, x", "abcdefghijk"])
def test_n_best(text):
    encoder = pieces.Encoder(pieces.default_model(), 4)
    got = encoder.segment_all([text])[0]
    every = sorted(all_segmentations(encoder.lattice, pieces.MARK + text.replace(" ", pieces.MARK)), key=lambda x: -x[0])
    assert [s for s, _ in got] == [s for s, _ in every[:4]]
    assert len({ids for _, ids in got}) == len(got)
    assert {(s, tuple(np.frombuffer(ids, "<i4").tolist())) for s, ids in got} <= set(every)


def test_pieces_round_trip(docs, odd, none):
    for frame in (docs, odd, none):
        back = pieces.decode(pieces.encode(frame, n_best=3))
        assert back.where("decoded <> coalesce(text, '')").count() == 0
        assert back.count() == frame.count() and set(frame.columns) < set(back.columns)
        assert pieces.digests(frame).where("NOT round_trip").count() == 0


def test_decoding_sends_only_the_ids(spark):
    """The other segmentations, several times as wide as the ids, stay with Spark; the worker needs no lattice."""
    texts = spark.createDataFrame([(1, "the cat sat"), (2, None), (3, "Ⅳx é")], "doc_id bigint, text string")
    rows = pieces.encode(texts, n_best=4).withColumn("ids", F.when(F.col("doc_id") != 2, F.col("ids")))
    back = pieces.decode(rows)
    assert [tuple(r) for r in back.select("doc_id", "decoded").orderBy("doc_id").collect()] == [(1, "the cat sat"), (2, None), (3, "Ⅳx é")]
    assert back.columns == [*rows.columns, "decoded"]
    plan = back._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython [apply(ids" in plan and plan.count("MapInArrow") == 1
    assert re.search(r"AS row#\d+\]\n", plan)  # nor is a text sent beside its row
    assert pieces._surface_of(pieces.default_model()) == pieces.Lattice(pieces.default_model()).surface
    assert pieces._text(pieces._surface_of(pieces.default_model()), [pieces.Lattice(pieces.default_model()).bytes[200]]) == "\ufffd"


def test_a_small_memory_gives_the_same_segmentations(docs):
    texts = [r.text for r in docs.collect()]
    few, many = pieces.Encoder(pieces.default_model(), 4, 7, 300), pieces.Encoder(pieces.default_model(), 4)
    expected = many.segment_all(texts)
    assert [found for n in range(0, len(texts), 5) for found in few.segment_all(texts[n : n + 5])] == expected
    assert len(few.number) < len(many.number)


# 3 -------------------------------------------------------------------------------------------------


def brute_dedup(rows):
    order = lambda key: suffix_dedup.NO_KEY if key is None else key
    first = {}
    texts = [(key, text.encode()) for key, text in rows]
    for key, text in texts:
        for at in range(len(text) - 49):
            own = text[at : at + 50]
            first[own] = min(first.get(own, 1 << 62), order(key))
    for key, text in texts:
        mask = bytearray(len(text))
        for at in range(len(text) - 49):
            if first[text[at : at + 50]] < order(key):
                mask[at : at + 50] = b"\1" * 50
        kept = bytes(c for c, gone in zip(text, mask, strict=True) if not gone)
        yield key, len(text), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest()


def test_dedup(docs, odd, none):
    for frame in (docs, odd, none):
        same([tuple(r) for r in suffix_dedup.dedup(frame).drop("kept").collect()], brute_dedup(pairs(frame)))


def test_suffix_order():
    rng = random.Random(3)
    for size in (1, 2, 3, 5, 40, 300):
        for letters in (1, 2, 4):
            text = np.array([rng.randrange(1, letters + 1) for _ in range(size)])
            order = suffix_dedup.suffix_order(text)
            heads = [text[at : at + 50].tolist() for at in order]
            assert sorted(order.tolist()) == list(range(size)) and heads == sorted(heads)


# 4 -------------------------------------------------------------------------------------------------


def test_blocks():
    page = """<html><head><title>t</title><style>p{}</style></head><body><nav><a>menu</a></nav><div class="ad">buy</div>
    <article><h1>Head &amp; more</h1><p><b>One<br>two</b>  three<p>four<script>var x="</p>"</script><ul><li>a<li>b</ul>
    <div class="comments">hi</div></article><footer>foot</footer></body></html>"""
    kept = [b[1] for b in main_text.blocks(page) if not b[2]]
    assert kept == ["Head & more", "One two three", "four", "a", "b"]
    assert main_text.blocks(None) == [] and main_text.blocks("plain  text") == [("", "plain text", False, 0)]


def test_site_style_tree(spark):
    page = "<body><div><p>Follow us on all channels</p></div><section><p>Story number {0} is about {0}</p></section></body>"
    rows = [(n, f"http://a.example/{n}", page.format(n)) for n in range(20)] + [(20, None, None), (21, "x", ""), (22, "http://b.example", page.format(1))]
    found = {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[3] == "Story number 3 is about 3"
    assert found[20] == found[21] == ""
    assert found[22] == "Follow us on all channels\n\nStory number 1 is about 1"  # one page is no site
    assert main_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


# 5 -------------------------------------------------------------------------------------------------

RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    doubled = [int(d) * (1 + n % 2) for n, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute_base(text):
    out = []
    for place, (kind, rule) in enumerate(RULES):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}
            if good[kind]:
                out.append((m.start(), place, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_base_spans(spark, docs, odd, none):
    tricky = ["a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "x@@y.z", "00000000255.1.1.1 256.1.1.1 99999999999999999999.1.1.1", "+1-2 +123456789", "4111-1111-1111-1111 5", "ü a@b.de", "+1 (", "1..2.3.4", "a" * 3000 + "@" + "b" * 3000]
    more = spark.createDataFrame([(100 + n, t) for n, t in enumerate(tricky)], "doc_id bigint, text string")
    for frame in (docs, odd, none, more):
        found = private_data.find_private(frame).collect()
        assert len(found) == frame.count()
        for row in found:
            assert [(s.kind, s.start, s.end) for s in row.base] == brute_base(row.text or "")
            assert {tuple(s) for s in row.base} <= {tuple(s) for s in row.spans}


def test_secrets_and_redaction(spark):
    rng = random.Random(5)
    token = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = [f"so token = \"{token(40)}\" it is" for _ in range(60)] + [f"order 4{n:015d} plain" for n in range(60)]
    found = private_data.find_private(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    kinds = {r.doc_id: [s.kind for s in r.spans] for r in found.collect()}
    assert all("secret" in kinds[n] for n in range(60)) and not any("secret" in kinds[n] for n in range(60, 120))
    assert private_data.redact(found).where("doc_id = 0").first().text == 'so token = "[secret]" it is'


# 6 -------------------------------------------------------------------------------------------------


def test_wavelet_matrix():
    ids = np.random.default_rng(1).integers(0, 37, 1000).astype(np.uint16)
    matrix = token_files.WaveletMatrix(len(ids), token_files.WaveletMatrix.build(ids, 6))
    assert [matrix.access(n) for n in range(0, 1000, 7)] == ids[::7].tolist()
    for value in (0, 5, 36, 50, 99):
        places = np.flatnonzero(ids == value).tolist()
        assert matrix.locate(value) == places and matrix.rank(value, 500) == sum(p < 500 for p in places)
        assert matrix.select(value, len(places)) == -1
    assert (token_files.unpack(len(ids), matrix.planes) == ids).all()
    empty = token_files.WaveletMatrix(0, token_files.WaveletMatrix.build(ids[:0], 6))
    assert empty.rank(3, 0) == 0 and empty.locate(3) == []


def test_token_files(spark, docs, odd, none, tmp_path):
    own = token_files._encoder(token_files.default_vocabulary()).own
    for n, frame in enumerate((docs, odd, none)):
        expected, at = [], 0
        for key, text in sorted(pairs(frame), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
            ids = np.array([*own.encode(text, add_special_tokens=False).ids, 2], "<u4")
            expected.append((key, at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
        path = str(tmp_path / str(n))
        token_files.write(frame, path)
        same([tuple(r) for r in token_files.read(token_files.open_shards(spark, path)).collect()], expected)
    ends = token_files.occurrences(token_files.open_shards(spark, str(tmp_path / "0")), 2)
    assert ends.select("doc_id").distinct().count() == docs.count()


def test_remembered_words(docs, monkeypatch):
    texts = ["", " ", "a", " a", "a  b", "a \n b\n\n c \t", "  x\u00a0 y\u2003z \u2003 w", "\u2003 a", "it's 12 o'clock'll <|endoftext|> x", "\x1c a\x85 b \u3000c", "日本 語 ñandú é\r\n é", "x" * 500 + " " + "y z" * 90]
    texts += [t for _, t in pairs(docs)]
    draw = random.Random(5)
    texts += ["".join(draw.choice(" \n\t\u00a0\u2003ab'1.é日") for _ in range(draw.randrange(40))) for _ in range(500)]
    own = token_files.Encoder(token_files.default_vocabulary())
    expected = [e.ids for e in own.own.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(token_files, "MEMORY_WORDS", 50)
    for step in (1, 97, len(texts)):
        assert [ids.tolist() for n in range(0, len(texts), step) for ids in own.encode(texts[n : n + step])] == expected
    own.bytewise = False
    assert [ids.tolist() for ids in own.encode(texts)] == expected


def test_words_are_known_all_at_once():
    """The ids of any mix of marks and spaces, by hashes of words that are looked up together; only new ones are encoded."""
    draw = random.Random(9)
    texts = ["", "it's", "(a)", "a.b,c", "'s 's's a's", "x\n\n y.\n z \n", "we'll've'd? \"Q\"; é. é,\nz9,9z", "a\r\n.b\t,c", "A" * 100 + "." * 100, "a\u2003. b\x85."]
    texts += ["".join(draw.choice(["a", "Bc", "'", "'s", "'ll", ".", ",", "!", "\n", "\r", " ", "  ", "1", "é", "日", "\u00a0", "\u2003", "@", "_"]) for _ in range(draw.randrange(30))) for _ in range(1500)]
    own = token_files.Encoder(token_files.default_vocabulary())
    expected = [e.ids for e in own.own.encode_batch(texts, add_special_tokens=False)]
    for step in (1, 50, len(texts)):
        own.forget()
        assert [ids.tolist() for n in range(0, len(texts), step) for ids in own.encode(texts[n : n + step])] == expected
    asked = []
    whole = own._whole
    own._whole = lambda words: asked.extend(words) or whole(words)
    own.forget()
    own.encode(["the cat sat", "the cat ran", "x " * 70, "a b" + "c" * 70])
    assert len(own.hashes) == 8 and asked.count("the") == 1 and "".join(asked).count("cat") == 1
    asked.clear()
    assert [len(ids) for ids in own.encode(["the cat ran", "the dog sat"])] == [3, 3] and asked == [" dog"]


# 7 -------------------------------------------------------------------------------------------------


def test_fingerprints(docs, odd, none):
    for frame in (docs, odd):
        rows = sorted(pairs(frame), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
        after = rows[1:] + rows[:1]
        expected = [(k, len(t), hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode()).hexdigest()) for (k, t), (_, n) in zip(rows, after, strict=True)]
        found = fingerprints.compare(frame).collect()
        same([(r.doc_id, r.n_chars, r.edited_sha256) for r in found], expected)
    assert fingerprints.compare(none).count() == 0
    found = fingerprints.compare(docs).collect()
    long = [r for r in found if r.n_chars > 1000]
    assert np.mean([r.near_edited for r in long]) > 0.6 and np.mean([r.near_next for r in long]) < 0.2
    for row in found[:20]:
        a, b = fingerprints.unpacked(row.fingerprint), fingerprints.unpacked(row.edited_fingerprint)
        assert fingerprints.likeness(a, b) == row.near_edited and fingerprints.packed(a) == row.fingerprint


def test_cuts_follow_the_content():
    text = bytes(random.Random(1).randrange(97, 123) for _ in range(20_000))
    (a,), (b,) = fingerprints.fingerprints([text]), fingerprints.fingerprints([b"shifted " + text])
    assert fingerprints.likeness(a, b) > 0.98
    assert (a[1] <= fingerprints.MOST).all()


# 8 -------------------------------------------------------------------------------------------------


def test_perspectives(spark):
    rows = [(1, 2, "bob", "hi"), (1, 1, "ann", "hello"), (1, None, None, None), (1, 300, "ann", "late"), (None, 1, "x", "y")]
    found = {(r.conv_id, r.speaker, r.part): r for r in perspectives.rotate(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    row = found[1, "ann", 0]
    assert row.text == "<|im_start|>assistant\nhello<|im_end|>\n<|im_start|>user name=bob\nhi<|im_end|>"
    assert [row.text[m.start : m.end] for m in row.mask] == ["hello<|im_end|>"]
    assert found[1, "bob", -1].n_turns == 1 and found[1, "bob", 2].n_own == 0 and found[1, "ann", 2].n_own == 1
    assert len(found) == 9


# 9 -------------------------------------------------------------------------------------------------


def test_toxicity_learns(spark, odd, none):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(150)]
    text = lambda bad: " ".join(rng.sample(words, 40) + ([rng.choice(["Idiot", "moron,", "lowei" + rng.choice(words)])] if bad else []))
    rows = [(n, text(n % 4 == 0), "en", int(n % 4 == 0)) for n in range(1200)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, toxic int")
    model = toxicity.fit(frame.drop("toxic"), frame.select("doc_id", "toxic"))
    held = toxicity.score(frame, model).where(toxicity.held_out(F.col("doc_id")))
    right = held.where("(toxic_score >= 0.3) = (toxic = 1)").count()
    assert right >= 0.95 * held.count()
    scored = toxicity.score(odd, model)
    assert scored.count() == odd.count() and scored.where("toxic_score BETWEEN 0 AND 1").count() == odd.count()
    assert set(odd.columns) < set(scored.columns)
    blank = toxicity.fit(none, frame.where("false").select("doc_id", "toxic"))
    assert toxicity.score(none, blank).count() == 0 and toxicity.score(odd, blank).count() == odd.count()


def test_long_text_in_parts(monkeypatch):
    rng = np.random.default_rng(0)
    model = toxicity.train(pa.array(["good day", "bad idiot"] * 20), np.array([0, 1] * 20, np.float32), ["en"] * 40, steps=60)
    model.words += rng.normal(0, 0.1, model.words.shape).astype(np.float32)
    text = pa.array([" ".join(f"w{n % 97}" for n in range(3000)), "", "one"])
    whole = model.scores(text)
    monkeypatch.setattr(toxicity, "PART_WORDS", 100)
    assert np.allclose(model.scores(text), whole)


# 10 ------------------------------------------------------------------------------------------------


def brute_components(rows):
    sets = collections.defaultdict(list)
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
        sets[key].append({tuple(words[n : n + 5]) for n in range(max(1, len(words) - 4))} if words else set())
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(k for k in sets if k is not None)
    for n, a in enumerate(keys):
        for b in keys[:n]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [(key, len(own), find(key)) for key in sets for own in sets[key]]


@pytest.mark.parametrize("verify", [0.01, 16.0, 1000.0])
def test_jaccard_components(spark, docs, odd, none, monkeypatch, verify):
    monkeypatch.setattr(jaccard_join, "VERIFY_COST", verify)
    rng = random.Random(4)
    base = [f"w{n}" for n in range(60)]
    family = []
    for n in range(60):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(60)] = f"v{rng.randrange(200)}"
        family.append((1000 + n, " ".join(words)))
    family = spark.createDataFrame(family, "doc_id bigint, text string")
    for frame in (docs, odd, none, family):
        same([tuple(r) for r in jaccard_join.components(frame).collect()], brute_components(pairs(frame)))


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    found = {r.node: r.root for r in components.components(edges).collect()}
    assert found == {**{n: 0 for n in range(41)}, 100: 100, 101: 100}


# Queries -------------------------------------------------------------------------------------------


def test_pipeline(spark, docs):
    import corpus_pipeline as cp

    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = cp.run(spark, SF)
    assert found.count() > 0 and found.select("doc_id").distinct().count() == found.count()
    kept = {r[0]: r[1] for r in pairs(docs)}
    clean = docs.where(docs["doc_id"].isin(list(kept)))
    rows = pairs(clean)
    same(
        [r.doc_id for r in cp.drop_near_copies(spark, clean, SF).collect()],
        [key for key, _, root in brute_components(rows) if key == root],
    )
    same(
        [r.doc_id for r in cp.drop_contaminated(spark, clean, SF).collect()],
        [key for key, *_, bad in brute_contamination(rows, benchmark, 13) if not bad],
    )
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, docs.where("false"), SF).columns == list(cp.COLUMNS)
    assert [name for name, _ in cp.STAGES] == ["toxicity", "n-gram Jaccard join", "benchmark decontamination", "PII", "SentencePiece encoding and decoding"]


def test_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in llm.queries())
    assert numbers == list(range(1, 11))


# Long and odd texts --------------------------------------------------------------------------------


def test_private_data_in_very_long_texts(spark):
    """Labels and numbers by the hundred thousand in one text: linear time, no recursion."""
    mail = "a@b" + ".cd" * 100_000
    numbers = " ".join(f"10.{n % 200}.{n // 200 % 200}.7" for n in range(60_000))
    frame = spark.createDataFrame([(1, mail), (2, numbers), (3, "x" * 100_000 + "@")], "doc_id bigint, text string")
    began = time.time()
    found = {r.doc_id: r for r in private_data.find_private(frame).collect()}
    assert [(s.kind, s.start, s.end) for s in found[1].base] == [("email", 0, len(mail))]
    spans = [(m.start(), m.end()) for m in re.finditer(r"[0-9]+(?:\.[0-9]+){3}", numbers)]
    assert [(s.start, s.end) for s in found[2].base if s.kind == "ip"] == spans
    assert found[3].base == []
    redacted = {r.doc_id: r.text for r in private_data.redact(private_data.find_private(frame)).select("doc_id", "text").collect()}
    assert redacted[1] == "[email]" and redacted[2] == " ".join(["[ip]"] * 60_000)
    assert time.time() - began < 120


@pytest.mark.parametrize("together", [1, 3, 128])
def test_redaction_in_blocks(spark, monkeypatch, together):
    monkeypatch.setattr(private_data, "_TOGETHER", together)
    text = "é " + " and ".join(f"u{n}@mail.example 10.0.0.{n}" for n in range(9)) + " end"
    frame = spark.createDataFrame([(1, text), (2, "none"), (3, None)], "doc_id bigint, text string")
    got = [r.text for r in private_data.redact(private_data.find_private(frame)).orderBy("doc_id").select("text").collect()]
    assert got == ["é " + " and ".join(["[email] [ip]"] * 9) + " end", "none", None]
    # Spans that overlap across blocks are one.
    spans = [(0, 0, "a", 5), (2, 0, "b", 9), (8, 0, "c", 10), (12, 0, "d", 13)]
    rows = spark.createDataFrame([("0123456789-=+*!", spans)], "text string, spans array<struct<start:int,place:int,kind:string,end:int>>")
    assert private_data.redact(rows).first().text == "[a]-=[d]*!"


def test_ranges_with_many_partitions(spark):
    """Thousands of ranges: the plan stays small, and each range is a partition."""
    rows = spark.range(20_000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    made = in_order(rows, "doc_id", "text", 5000, tail=True)
    got = made.select("range", "tail", "key", F.spark_partition_id().alias("p")).collect()
    assert sorted(r.key for r in got if not r.tail) == list(range(20_000))
    assert all(r.p == r.range for r in got)
    last = {r.range: r.key for r in got if not r.tail}
    firsts = {}
    for r in got:
        if not r.tail:
            last[r.range] = max(last[r.range], r.key)
            firsts[r.range] = min(firsts.get(r.range, r.key), r.key)
    order = sorted(firsts)
    assert {r.range: r.key for r in got if r.tail} == {order[n - 1]: firsts[order[n]] for n in range(len(order))}


def test_token_files_tell_added_tokens(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(token_files.default_vocabulary())
    texts = ["hi <|endoftext|> yo", "plain words here", "<|endoftext|>", "a<|endoftext|>b <|endof text|>", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = {n: own.encode(t, add_special_tokens=False).ids + [2] for n, t in enumerate(texts)}
    assert expected[0] == [5303, 220, 50256, 27406, 2]
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_files.round_trip(frame).collect()}
    assert got == {n: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for n, ids in expected.items()}


def test_pipeline_keeps_rows_without_an_id(spark, tmp_path):
    import corpus_pipeline

    text = " ".join(f"word{n}" for n in range(40))
    rows = [(None, text), (None, text), (1, text), (2, text + " more"), (3, ""), (4, None), (None, None), (5, "other words stand in this one")]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.drop_near_copies(spark, frame, str(tmp_path)).collect()
    assert sorted((str(r.doc_id) for r in kept)) == sorted(["None", "None", "None", "1", "3", "4", "5"])


def test_suffix_stretches_over_runs(spark, monkeypatch):
    """Stretches that end where a run of window starts does change nothing."""
    random.seed(4)
    passage = "".join(random.choice("abc ") for _ in range(300))
    rows = [(n, "".join(random.choice("defg ") for _ in range(random.randrange(200))) + passage[random.randrange(100) :] * random.randrange(3)) for n in range(30)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = [tuple(r) for r in suffix_dedup.dedup(frame).drop("kept").orderBy("doc_id").collect()]
    assert any(r[2] for r in whole)
    raw = [t.encode() for _, t in rows]
    made = lambda: suffix_dedup.Stretches(np.arange(len(raw)).astype("<i8").tobytes(), np.array([len(t) for t in raw], "<i8").tobytes(), zstandard.compress(b"".join(raw)))
    one = made()
    monkeypatch.setattr(suffix_dedup, "RUN_STARTS", 97)
    cut = made()
    spread = lambda own: [(w, int(h), int(d)) for b, e, h, d in zip(own.begin, own.end, own.hash, own.doc, strict=True) for w in range(b, e)]
    assert spread(cut) == spread(one) and len(cut.begin) > len(one.begin)


def test_suffix_buckets_by_groups_of_anchors(monkeypatch):
    lines = [b"the same long line of fifty and more bytes stands in many texts %d, " % n for n in range(12)]
    texts = [b"".join(lines[(n * k) % 12] for k in range(1, 5)) + b"text %d" % n for n in range(30)]

    def found() -> list[tuple]:
        rows = []
        for shard, part in enumerate((texts[:17], texts[17:])):
            ids = np.arange(17 * shard, 17 * shard + len(part)).astype("<i8").tobytes()
            row = {"ids": [ids], "lengths": [np.array([len(t) for t in part], "<i8").tobytes()], "body": [zstandard.compress(b"".join(part))]}
            own = suffix_dedup.Stretches(*(v[0] for v in row.values()))
            batch = pa.RecordBatch.from_pydict({"shard": [shard], **row, "common": [[suffix_dedup._names(own.sides()[0]).tobytes()]]})
            rows.extend(suffix_dedup._stretches(3)([batch]))
        return sorted((tuple(r.values()) for b in suffix_dedup._sorted_buckets(rows) for r in b.to_pylist()))

    whole = found()
    for size in (1, 200, 3000):
        monkeypatch.setattr(suffix_dedup, "SORT_BYTES", size)
        assert found() == whole


def test_suffix_dedup_sends_few_bytes_a_side_and_a_stretch(monkeypatch):
    """Before: 5 bytes for each side, and 21 bytes beside the text of each stretch."""
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 123, 4000).astype(np.uint8).tobytes() for _ in range(6)]
    row = {"shard": 0, "ids": np.arange(6).astype("<i8").tobytes(), "lengths": np.full(6, 4000, "<i8").tobytes(), "body": zstandard.compress(b"".join(texts))}
    own = suffix_dedup.Stretches(row["ids"], row["lengths"], row["body"])
    hashes, _ = own.sides()
    sides = [r for b in suffix_dedup._sides(4)([pa.RecordBatch.from_pylist([row])]) for r in b.to_pylist()]
    assert sum(len(r["body"]) for r in sides) < 3.3 * len(np.unique(hashes))
    # Two shards that hold the same sides: all are shared, and come back to both by name.
    twice = pa.RecordBatch.from_pylist([{**r, "shard": shard} for r in sides for shard in (0, 1)])
    shared = [r for b in suffix_dedup._shared([twice]) for r in b.to_pylist()]
    for shard in (0, 1):
        names = b"".join(r["body"] for r in shared if r["shard"] == shard)
        assert set(suffix_dedup._numbers(names)) == set(suffix_dedup._numbers(suffix_dedup._names(hashes).tobytes()))
    batch = pa.RecordBatch.from_pydict({**{k: [v] for k, v in row.items()}, "common": [[names]]})
    sent = [zstandard.decompress(r["body"]) for b in suffix_dedup._stretches(4)([batch]) for r in b.to_pylist()]
    size = sum(int(np.frombuffer(raw, "<i8", 1)[0]) for raw in sent)
    assert size == len(own.begin) and sum(map(len, sent)) == 8 * len(sent) + 10 * size + int((own.end - own.begin + suffix_dedup.LENGTH - 1).sum())


def test_suffix_dedup_is_exact_when_names_collide(docs, odd, monkeypatch):
    """A name shared by chance only adds work: with names of 256 values the result is the same."""

    def rows(batches):
        return [r for b in batches for r in b.to_pylist()]

    def whole(texts) -> tuple[list, int]:
        shards = []
        for shard in range(3):
            part = [t.encode() for t in texts[shard::3]]
            ids, lengths = np.arange(shard, len(texts), 3).astype("<i8"), np.array([len(t) for t in part], "<i8")
            shards.append({"shard": shard, "ids": ids.tobytes(), "lengths": lengths.tobytes(), "body": zstandard.compress(b"".join(part))})
        batch = lambda more: pa.RecordBatch.from_pylist([{**r, **more(r["shard"])} for r in shards])
        shared = rows(suffix_dedup._shared(suffix_dedup._sides(5)([pa.RecordBatch.from_pylist(shards)])))
        common = lambda shard: {"common": [r["body"] for r in shared if r["shard"] == shard]}
        sent = list(suffix_dedup._stretches(5)([batch(common)]))
        found = rows(suffix_dedup._sorted_buckets(sent))
        given = lambda shard: {**common(shard), "found": [r for r in found if r["shard"] == shard]}
        return rows(suffix_dedup._cutter(5, False)([batch(given)])), sum(map(len, (r["body"] for b in sent for r in b.to_pylist())))

    texts = [r.text or "" for frame in (docs, odd) for r in frame.collect()]
    few, size = whole(texts)
    monkeypatch.setattr(suffix_dedup, "_NAME_BYTES", 1)
    many, more = whole(texts)
    assert few == many and more > size and any(r["n_removed"] for r in few)


def test_page_wide_classes_and_closed_foreign_elements():
    kept = lambda page: [b[1] for b in main_text.blocks(page) if not b[2]]
    assert kept('<body class="no-sidebar"><article class="post no-comments"><p>Hello') == ["Hello"]
    assert kept('<p>a</p><svg class="i"/><p>b</p><math/><p>c') == ["a", "b", "c"]
    assert kept("<p>a</p><svg><text>no</text></svg><p>b") == ["a", "b"]
    assert kept('<body><div class="sidebar">no</div><p>yes') == ["yes"]


def test_pipeline_searches_and_decodes(spark, docs):
    import corpus_pipeline as cp

    found = {r.doc_id: r for r in cp.encode(spark, docs, SF).collect()}
    expected = {r.doc_id: r for r in pieces.digests(docs, n_best=4).collect()}
    assert {n: r.scores for n, r in found.items()} == {n: r.scores for n, r in expected.items()}
    crc = lambda ids: zlib.crc32(np.array(ids, "<i4").tobytes())
    assert {n: [crc(ids) for ids in (r.ids, *r.others)] for n, r in found.items()} == {n: r.ids_crc32 for n, r in expected.items()}
    assert any(len(r.others) == 3 for r in found.values()) and all(r.score == r.scores[0] for r in found.values())
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {n for n, r in found.items() if r.decoded == texts[n]} == {n for n, r in expected.items() if r.round_trip}
    assert sum(r.round_trip for r in expected.values()) > len(texts) // 2


def test_jaccard_shared_passages_stand_last_in_the_order():
    """A shingle of forty texts is told from those of one among ten million, so no prefix holds it."""
    rng = np.random.default_rng(5)
    once = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    often = rng.integers(0, 1 << 63, 30, dtype=np.uint64) * np.uint64(2)
    cells = 1 << jaccard_join.CELL_BITS
    sketch = rng.poisson(10_000_000 / cells, cells)
    np.add.at(sketch, jaccard_join._cells(once), 1)
    np.add.at(sketch, jaccard_join._cells(often), 40)
    mean = float(sketch.mean())
    keys, _ = jaccard_join.prefix(np.unique(np.concatenate([once, often])), sketch, mean, 80)
    assert not np.isin(keys, jaccard_join._order(often, sketch, mean)[0]).any()


def test_jaccard_sets_are_filtered_without_a_shuffle(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("doc_id"), F.lit("x").alias("own"))
    ids = spark.range(0, 3000, 5)
    some = jaccard_join._among(rows, "doc_id", ids)
    found = {r.doc_id for r in some.collect()}
    assert {n for n in range(0, 3000, 5) if n % 7} <= found and len(found) < 800 and None not in found
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan and plan.count("Join") == 1


def test_jaccard_bitmaps_never_hide_a_shared_element():
    rng = np.random.default_rng(6)
    for size in (1, 5, 40, 700):
        x = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: size // 2], rng.integers(0, 1 << 63, size * 2, dtype=np.uint64)]))
        bits = [jaccard_join._bitmap(own) for own in (x, y)]
        assert jaccard_join._most_common(*bits, len(x), len(y)) >= len(np.intersect1d(x, y))
        assert len(bits[0]) * 8 <= max(64, 4 * len(x))
