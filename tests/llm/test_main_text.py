"""Main text against probes and a style tree made by brute force."""

import math
from collections import Counter, defaultdict

import pytest

from hitlake.llm import main_text

SCHEMA = "page_id bigint, url string, html string"


def text_of(page):
    return main_text.kept(main_text.blocks(page), frozenset())


@pytest.mark.parametrize(
    "page, texts",
    [
        ('<article><h2 id="side-effects">Side effects</h2><p class="related-work">Others</p></article>', ["Side effects", "Others"]),
        ('<article><h2 id="search">Search</h2><p class="share">Share</p><p>x</p></article>', ["Search", "x"]),
        ('<article><p>x <span class="share">Share <b>this</b></span> y</p></article>', ["x y"]),
        ('<article><p>x <button>Go</button></p><label>Name</label></article>', ["x"]),
        ('<article><p>a</p></article><ol class="commentlist"><li><article><p>first!</p></article></ol>', ["a"]),
        ('<article><p>a</p><div id="comments"><p>b</p></div></article><article class="comment"><p>c</p></article>', ["a"]),
        ('<article class="post no-sidebar"><p>a</p></article>', ["a"]),
        ('<article><header><h1>T</h1></header><p>a</p></article><header>Site</header>', ["T", "a"]),
        ('<main><div>beside</div><article><p>a</p></article></main><div>out</div>', ["beside", "a"]),
        ('<div class="w-1/2"><p>a</p></div>', ["a"]),
        ('<span class="share">x', []),
    ],
)
def test_markup(page, texts):
    assert text_of(page) == texts


def brute_tree(pages):
    """Importance of (host, node) of a site, straight from the definition."""
    values = defaultdict(Counter)
    for host, page in pages:
        found, children = main_text.parse(page)
        texts = defaultdict(list)
        for node, text, noise, _ in found:
            if not noise:
                texts[node].append(text)
        for node, parts in texts.items():
            values[host, node, "content"][tuple(parts)] += 1
        for node in {n[: n.rfind("/")] if "/" in n else "" for n in texts}:
            values[host, node, "layout"][tuple(children.get(node, ()))] += 1

    def importance(counts):
        m = sum(counts.values())
        if m == 1:
            return 1.0
        entropy = -sum(n / m * math.log(n / m) for n in counts.values()) / math.log(m)
        return 1 - (1 - entropy) * (1 - 1 / m)

    return {
        (host, node): 0.5 * importance(counts) + 0.5 * importance(values[host, node[: node.rfind("/")] if "/" in node else "", "layout"])
        for (host, node, kind), counts in values.items()
        if kind == "content"
    }


def site(n, name="s.org"):
    """Pages with an article, a line beside it that all share, and body parts of differing length with one heading."""
    rows = []
    for k in range(n):
        body = "".join(f"<p>text {k} {j}</p>" for j in range(k % 7 + 1))
        page = f"<body><main><div class='x9'><p>Read on {name}</p></div><article><h2>Summary</h2>{body}</article></main><div class=z>{'more' if k % 2 else 'less'}</div></body>"
        rows.append((k, f"https://www.{name}/{k}", page))
    return rows


def free(n, name="f.org"):
    """Pages without an article: a legal line that all share, and a heading in a part that differs."""
    rows = []
    for k in range(n):
        body = "".join(f"<p>words {k} {j}</p>" if (k + j) % 3 else f"<ul><li>item {k} {j}</ul>" for j in range(k + 1))
        rows.append((1000 + k, f"http://{name}/{k}", f"<body><div class=t><h2>Summary</h2>{body}</div><div class=q><p>All rights kept</p></div></body>"))
    return rows


def test_the_tree_equals_brute_force(spark):
    rows = site(40) + free(12) + [(5000, None, "<p>lone"), (5001, "x", None), (5002, "x", "")]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = {(r.host, r.node): r.importance for r in main_text.style_tree(pages).collect()}
    hosts = {r[0]: ("s.org" if r[0] < 1000 else "f.org" if r[0] < 5000 else "") for r in rows}
    expected = brute_tree([(hosts[key], page) for key, _, page in rows])
    assert found.keys() == expected.keys()
    assert all(found[key] == pytest.approx(expected[key]) for key in expected)


def extracted(spark, rows):
    return {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_the_tree_removes_branches_also_beside_an_article(spark):
    many, few = extracted(spark, site(40)), extracted(spark, site(2))
    assert many[1] == "Summary\n\ntext 1 0\n\ntext 1 1"
    # Another tree gives another text: two pages do not tell that the line is the site's.
    assert few[1] == "Read on s.org\n\nSummary\n\ntext 1 0\n\ntext 1 1"
    loose = extracted(spark, free(12))
    assert loose[1001].startswith("Summary\n\nwords 1 0") and not any("rights" in text for text in loose.values())


def test_copies_of_an_article_stay(spark):
    rows = [(k, "http://c.org/", "<body><article><h1>T</h1><p>same</p></article></body>") for k in range(30)]
    rows += [(100 + k, "http://d.org/", "<body><main><p>same</p></main></body>") for k in range(30)]
    assert set(extracted(spark, rows).values()) == {"T\n\nsame", "same"}


def test_repeated_long_and_clashing_rows(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 100_000 + "</article>"
    rows = [(1, "http://a/1", long), (2, "http://a/2", "<p>x"), (2, "http://a/2", "<p>x"), (None, None, None)]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS host", "2 AS low", "'n' AS node", "3 AS text")
    found = main_text.extract(pages).collect()
    assert sorted((r.page_id or 0, len(r.text)) for r in found) == [(0, 0), (1, 100_000 * 13 - 2), (2, 1), (2, 1)]
