"""HTML extraction with site style trees.

Each page is cut into blocks: runs of text under one chain of elements.  The pages of one host are merged into a
style tree, kept as counts.  Its nodes are chains of tags and classes.  A node with text has its distinct contents and
how often each stands there; a node with children has its presentations, the distinct sequences of its children, and
how often each is used.  With m pages and the entropy H of either over them, divided by log m, an importance is
1 - (1 - H) (1 - 1 / m): 1 for a node of one page, near 0 where many pages say, or lay out, the same.  A node's own
importance mixes that of its contents with that of the presentation it stands in (``LAYOUT``), so a heading that all
pages repeat stays within a part that differs from page to page.  A branch is noise when all nodes with text below it are less
important than ``LEAST``; to remove its branches is to remove those nodes.

A block goes if it is boilerplate by its markup (``SKIPPED``, ``NOISE``), or by the tree, or if the page has an article
or a main part and the block stands outside.  The tree never judges an article, nor a main part without one: what a
site repeats there is copies of an article.  Inline elements that are boilerplate by an exact class lose just their own text.

The counts are aggregated by (host, node) and (host, node, content digest) before they meet, so that a host with a
third of all pages is no single task; they are joined back by host and node.

Character references are decoded, white space inside a block becomes one space, and blocks are joined in page order by two newlines.
Null and empty pages have no text.  A page without a host is a site of its own name "".
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlake.llm.batches import runs
from hitlake.storage import scratch_path

#: Least importance of a node, and the share of its presentation in it.
LEAST, LAYOUT = 0.3, 0.5

# HTML elements by their part in a page.
RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "xmp", "noembed", "noframes")
FOREIGN = frozenset(("svg", "math"))  # may close themselves
WHOLE = frozenset(("html", "body", "main"))  # their classes tell of the page, not of a part
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head nav header footer aside form menu dialog button select option label fieldset script style noscript template iframe textarea title svg math object".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body html head td th tr tbody thead tfoot caption dd dt li legend summary figcaption".split())
# Elements of the article's own text, which only a class that is a noise word as a whole turns into boilerplate.
TEXT = frozenset("article p h1 h2 h3 h4 h5 h6 pre blockquote figure table tr td th dl dt dd li".split())
WORDS = (
    r"ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|notice|popup|modal|newsletter|subscribe|sidebar|side|nav\w*|menu|breadcrumbs?|"
    r"footer|header|masthead|social|share|sharing|related|recommend\w*|widget|comments?|commentlist|replies|reply|disqus|respond|pagination|pager|tags|toolbar|skip|login|search"
)
NOISE, NOISE_CLASS = re.compile(rf"(?:^|[\s_-])(?:{WORDS})(?=$|[\s_-])"), re.compile(rf"(?:^|\s)(?:{WORDS})(?=$|\s)")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_CLASS = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")


def _is_noise(tag: str, classes: str, ids: str) -> bool:
    """Whether an element is boilerplate by its markup.  A heading's id tells what it speaks of, not what it is."""
    if tag in SKIPPED:
        return True
    if tag in WHOLE:
        return False
    if tag in TEXT or tag not in BLOCKS:
        return bool(classes and NOISE_CLASS.search(classes))
    names = f"{classes} {ids}".strip()
    return bool(names and NOISE.search(names))


def parse(page: str | None) -> tuple[list[tuple[str, str, bool, int]], dict[str, list[str]]]:
    """A page's blocks in order, and the children of each of its nodes.

    A block is its node, its text, whether its markup is boilerplate, and its place: 2 in an article, 1 in a main part
    outside of one, 0 elsewhere.
    """
    out: list[tuple[str, str, bool, int]] = []
    children: dict[str, list[str]] = {}
    stack: list[tuple[str, str, bool, int, bool]] = [("", "", False, 0, False)]  # tag, node, noise, place, noise by an inline element
    waiting: list[str] = []

    def say(text: str) -> None:
        waiting.append(" " if stack[-1][4] else text)

    def flush() -> None:
        if waiting:
            text = _SPACE.sub(" ", html.unescape("".join(waiting))).strip()
            waiting.clear()
            if text:
                own = next(x for x in reversed(stack) if x[0] in BLOCKS or not x[0])
                out.append((own[1], text, own[2], own[3]))

    def close(tag: str) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] == tag:
                if any(x[0] in BLOCKS for x in stack[depth:]):
                    flush()
                del stack[depth:]
                return
            if stack[depth][0] in ("article", "td", "th", "table") and tag in ("p", "b", "i", "em", "strong", "span", "a"):
                return

    page, at = page or "", 0
    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "p" and not any(x[0] == "p" for x in stack):
                flush()
            close(tag)
            continue
        if tag in BLOCKS or tag == "br" or tag == "hr":
            if tag != "br":
                if tag in CLOSES_P and any(x[0] == "p" for x in stack):
                    close("p")
                flush()
            else:
                waiting.append(" ")
        if tag in ("li", "dd", "dt", "td", "th", "tr", "option") and stack[-1][0] == tag:
            close(tag)
        if tag in FOREIGN and found[3].endswith("/"):
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.start() if end else len(page)
            continue
        if tag in VOID or found[3].endswith("/") and tag not in BLOCKS:
            continue
        named = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in _CLASS.finditer(found[3])]
        classes = " ".join(value for kind, value in named if kind != "id")
        ids = " ".join(value for kind, value in named if kind == "id")
        _, node, noise, place, hidden = stack[-1]
        own_noise = _is_noise(tag, classes, ids)
        if tag == "header" and place and not noise:  # an article's own header holds its title
            names = f"{classes} {ids}".strip()
            own_noise = bool(names and NOISE.search(names))
        if tag in BLOCKS:
            label = tag + (f".{' '.join((classes + ' ' + ids).split())}" if classes or ids else "").replace("/", "|")
            children.setdefault(node, []).append(label)
            node = f"{node}/{label}"
            noise, hidden = noise or hidden or own_noise, False
        else:
            hidden = hidden or own_noise
        if tag == "article" or place == 2:
            place = 2
        elif tag == "main" or "main" in f"{classes} {ids}".split():
            place = 1
        stack.append((tag, node, noise, place, hidden))
    flush()
    return out, children


def blocks(page: str | None) -> list[tuple[str, str, bool, int]]:
    """A page's blocks in order, see ``parse``."""
    return parse(page)[0]


def kept(found: list[tuple[str, str, bool, int]], low: frozenset[str]) -> list[str]:
    """The texts of a page's blocks that stay, where ``low`` are the nodes of its site's tree that go."""
    left = [b for b in found if not b[2]]
    # The tree judges what stands outside an article, and a main part only where there is an article.
    spared = 2 if any(b[3] == 2 for b in left) else 1
    left = [b for b in left if b[3] >= spared or b[0] not in low]
    if any(b[3] for b in left):
        left = [b for b in left if b[3]]
    return [b[1] for b in left]


def host(url: Column) -> Column:
    """The lower-case host of a URL, without a leading www."""
    return F.coalesce(F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), r"^www\.", ""), F.lit(""))


def page_nodes(page: str | None) -> Iterator[tuple[str, bool, str]]:
    """What a page adds to its site's tree: (node, whether it is a presentation, content or sequence of children)."""
    found, children = parse(page)
    texts: dict[str, list[str]] = {}
    for node, text, noise, _ in found:
        if not noise:
            texts.setdefault(node, []).append(text)
    for node, parts in texts.items():
        yield node, False, "\n".join(parts)
    # Only the layouts that nodes with text stand in are asked for.
    for node in {n.rpartition("/")[0] for n in texts}:
        yield node, True, "\n".join(children.get(node, ()))


def _style_nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (host, node, layout, value) within one run of pages; a page counts once."""
    for run in runs(batches):
        counts: dict[tuple[str, str, bool, int], int] = {}
        for name, page in zip(run.column(0).to_pylist(), run.column(1).to_pylist(), strict=True):
            for node, layout, value in page_nodes(page):
                key = (name, node, layout, xxhash.xxh3_64_intdigest(value.encode("utf-8", "replace")) - (1 << 63))
                counts[key] = counts.get(key, 0) + 1
        columns = list(zip(*counts, strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64())
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(list(counts.values()), pa.int64())], names=["host", "node", "layout", "value", "n"])


def style_tree(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, node, n_pages, content, presentation, importance): the nodes with text of every site's merged style tree.

    ``content`` is the importance of what stands there, ``presentation`` that of the layout it stands in.
    """
    rows = pages.select(host(F.col(url)).alias("host"), F.col(page).alias("page"))
    counts = rows.mapInArrow(_style_nodes, "host string, node string, layout boolean, value bigint, n bigint")
    values = counts.groupBy("host", "node", "layout", "value").agg(F.sum("n").alias("n"))
    nodes = values.groupBy("host", "node", "layout").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
    same = F.col("s") / F.col("m") / F.log("m")  # 1 - H
    importance = F.when(F.col("m") > 1, 1 - same * (1 - 1 / F.col("m"))).otherwise(1.0)
    # Written once: both sides of the join below come from one pass over the pages.
    path = scratch_path(pages.sparkSession, "style-nodes")
    nodes.select("host", "node", "layout", "m", importance.alias("importance")).write.parquet(path)
    judged = pages.sparkSession.read.parquet(path)
    layouts = judged.where("layout").select("host", F.col("node").alias("parent"), F.col("importance").alias("presentation"))
    parts = judged.where("NOT layout").select("host", "node", F.regexp_replace("node", "/[^/]*$", "").alias("parent"), F.col("m").alias("n_pages"), F.col("importance").alias("content"))
    mixed = (1 - LAYOUT) * F.col("content") + LAYOUT * F.col("presentation")
    return parts.join(layouts, ["host", "parent"]).select("host", "node", "n_pages", "content", "presentation", mixed.alias("importance"))


def _extractor(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in runs(batches, 2):
        texts = ["\n\n".join(kept(blocks(page), frozenset(low or ()))) for page, low in zip(run.column(2).to_pylist(), run.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([run.column(0), run.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per page: page_id, url and the main text."""
    spark = pages.sparkSession
    path = scratch_path(spark, "style-tree")
    style_tree(pages, url, page).where(F.col("importance") < LEAST).select("host", "node").write.parquet(path)
    # A site's layouts are few; what is joined is a list for each host, kept to the nodes that go.
    low = spark.read.parquet(path).groupBy("host").agg(F.collect_set("node").alias("low"))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"), host(F.col(url)).alias("host"))
    joined = rows.join(low, "host", "left").select("page_id", "url", "html", "low")
    kind = pages.schema
    return joined.mapInArrow(_extractor, f"page_id {kind[key].dataType.simpleString()}, url string, text string")
