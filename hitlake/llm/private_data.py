"""Personal data by candidate gradient boosting, in DataFrame functions only.

Three steps.  Exact base rules give e-mail, IP, card and phone spans.  A high-recall generator proposes further
tokens that may hold a credential and that may overlap the base spans; each gets format features (length,
character classes, distinct characters, shape) and context features (the word before, the sign between).
Boosted trees score the candidates, and a threshold, calibrated on candidates that the trees did not see,
selects what is kept as ``secret``.

The trees are fitted here.  Their labels are distant ones: a candidate is positive if its format is one that
credential issuers document (``KNOWN_FORMATS``) or if an assignment names it (``NAMED``), negative otherwise.
Candidates meet as a contingency table of binned features, which has at most ``CELLS`` rows whatever the size of
the corpus, so all candidates of all texts are counted and nothing grows on the driver.

Null and empty texts have no spans.  Repeated rows are judged one by one.  Offsets are code points, ends are
exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans that start together are listed.
KINDS = ("email", "ip", "card", "phone", "secret")

# A match may start only where a run starts or where the last match ended: the same matches as without the
# guard (a failing run fails from every later start too), in linear time on long runs.
_EMAIL_RUN = r"(?:\G|(?<![A-Za-z0-9._%+-]))"
BASE_RULES = {
    "email": _EMAIL_RUN + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a rule to be tried at all.
_GATES = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"(?:[0-9][\x20-]?){11}[0-9]", "phone": r"\+[0-9]"}

#: High recall: tokens of letters, digits and a few signs, of 12 or more, that hold a digit.
CANDIDATE = r"(?<![A-Za-z0-9+/_.%@-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+"
_CANDIDATE_GATE = r"[0-9][A-Za-z]|[A-Za-z][0-9]"

# Documented credential formats and the names under which credentials are assigned.
KNOWN_FORMATS = r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^sk_live_[A-Za-z0-9]{16,}$|^AIza[A-Za-z0-9_-]{35}$"
NAMED = r"(?i)(?:password|passwd|pwd|secret|token|api_?key|access_?key)\s{0,2}[=:]\s{0,2}[\"']?$"

#: Code points read before a candidate.
CONTEXT = 24

#: Number of bins of each feature.
FEATURES = {"length": 5, "upper": 3, "lower": 3, "digit": 3, "distinct": 4, "hex": 2, "sign": 3, "head": 2}
CELLS = math.prod(FEATURES.values())


#: Matches whose positions are added up together: arrays grow by copying, so one long sum would be quadratic.
_TOGETHER = 128


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where functions inside refer to it often."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(items: Column) -> Column:
    """An array cut into arrays of ``_TOGETHER``; one empty array for an empty one."""
    last = F.floor((F.size(items) - 1) / _TOGETHER).cast("int")
    return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda n: F.slice(items, n * _TOGETHER + 1, F.lit(_TOGETHER)))


def _pieces(text: Column, rule: str, gate: str) -> Column:
    """Spans of a rule's matches as structs (start, end, value)."""
    found = F.regexp_extract_all(text, F.lit(f"({rule})"), F.lit(1))
    between = F.split(text, rule, -1)
    kind = "array<struct<start:int,end:int,value:string>>"
    none = F.array().cast(kind)
    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, b: F.struct(m.alias("m"), F.length(b).alias("gap"), F.length(m).alias("own")))

    def located(block: Column, first: Column) -> Column:
        """The spans of one block that starts at ``first``."""
        return F.aggregate(
            block,
            F.struct(first.alias("at"), none.alias("out")),
            lambda acc, p: F.struct(
                (acc["at"] + p["gap"] + p["own"]).alias("at"),
                F.concat(acc["out"], F.array(F.struct((acc["at"] + p["gap"]).alias("start"), (acc["at"] + p["gap"] + p["own"]).alias("end"), p["m"].alias("value")))).cast(kind).alias("out"),
            ),
        )["out"]

    def starts(blocks: Column) -> Column:
        """Where each block starts."""
        lengths = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, p: acc + p["gap"] + p["own"]))
        return F.aggregate(
            lengths,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        )["out"]

    summed = _let(pairs, lambda every: _let(_blocks(every), lambda blocks: F.flatten(F.zip_with(blocks, starts(blocks), located))))
    return F.when(text.rlike(gate), summed).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(F.filter(places, lambda d: d.isNotNull()), F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(F.lit("0"), p)) <= 3) & (F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Array of structs (start, end, value): what the base rule of ``kind`` finds, failing matches dropped."""
    return F.filter(_pieces(text, BASE_RULES[kind], _GATES[kind]), lambda s: _valid(kind, s["value"]))


def _bin(value: Column, *bounds: float) -> Column:
    out = F.lit(0)
    for bound in bounds:
        out = out + (value >= bound).cast("int")
    return out


def _features(value: Column, before: Column) -> list[Column]:
    count = lambda rule: F.regexp_count(value, F.lit(rule)) / F.length(value)
    distinct = F.size(F.array_distinct(F.split(value, "")))
    sign = F.when(before.rlike(r"[=:]\s{0,2}[\"']?$"), 2).when(before.rlike(r"[\"'(]$"), 1).otherwise(0)
    made = {
        "length": _bin(F.length(value), 16, 18, 20, 36),
        "upper": _bin(count("[A-Z]"), 0.01, 0.5),
        "lower": _bin(count("[a-z]"), 0.01, 0.7),
        "digit": _bin(count("[0-9]"), 0.1, 0.9),
        "distinct": _bin(distinct, 6, 9, 13),
        "hex": value.rlike("^[0-9a-f]+$").cast("int"),
        "sign": sign,
        "head": value.rlike("^[A-Z]{4}|^[a-z]{2,4}_").cast("int"),
    }
    return [made[name].alias(name) for name in FEATURES]


def candidates(texts: DataFrame, key: str, text: str) -> DataFrame:
    """One row per proposed span: key, start, end, its features and its distant label."""
    found = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).where(
        F.col("text").rlike(_CANDIDATE_GATE) & F.col("text").rlike(CANDIDATE)
    )
    spans = found.select("key", "text", F.explode(_pieces(F.col("text"), CANDIDATE, _CANDIDATE_GATE)).alias("s"))
    begin = F.greatest(F.col("s.start") - CONTEXT, F.lit(0))
    before = F.substring(F.col("text"), begin + 1, F.col("s.start") - begin)
    rows = spans.select("key", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.value").alias("value"), before.alias("before"))
    label = (F.col("value").rlike(KNOWN_FORMATS) | F.col("before").rlike(NAMED)).cast("int")
    return rows.select("key", "start", "end", *_features(F.col("value"), F.col("before")), label.alias("label"))


@dataclass
class Model:
    """Boosted trees of depth two over binned features, and the calibrated threshold."""

    bias: float = 0.0
    trees: list[tuple] = field(default_factory=list)
    threshold: float = math.inf

    def margin(self, row) -> float:
        total = self.bias
        for root, left, right in self.trees:
            name, cut, low, high = left if row[root[0]] <= root[1] else right
            total += low if row[name] <= cut else high
        return total


def _stump(cells, weights) -> tuple[float, tuple]:
    """The best single cut of weighted (gradient, curvature) cells: gain and (feature, cut, low, high)."""
    leaf = lambda g, h: 0.4 * g / (h + 1.0)
    score = lambda g, h: g * g / (h + 1.0)
    all_g, all_h = sum(g for g, _ in weights), sum(h for _, h in weights)
    best = (0.0, (next(iter(FEATURES)), 0, leaf(all_g, all_h), leaf(all_g, all_h)))
    for name, bins in FEATURES.items():
        sums = [[0.0, 0.0] for _ in range(bins)]
        for cell, (g, h) in zip(cells, weights, strict=True):
            sums[cell[name]][0] += g
            sums[cell[name]][1] += h
        g = h = 0.0
        for cut in range(bins - 1):
            g, h = g + sums[cut][0], h + sums[cut][1]
            gain = score(g, h) + score(all_g - g, all_h - h) - score(all_g, all_h)
            if gain > best[0] + 1e-12:
                best = (gain, (name, cut, leaf(g, h), leaf(all_g - g, all_h - h)))
    return best


def fit(proposed: DataFrame, rounds: int = 30, precision: float = 0.95) -> Model:
    """Boost on three quarters of the candidates (by key), calibrate on the fourth.

    The data come in as counts per cell of the feature grid, at most ``4 * CELLS`` small rows.  With no positive
    candidate the threshold is infinite, and nothing is added to the base spans.
    """
    part = (F.pmod(F.xxhash64("key"), F.lit(4)) == 0).cast("int").alias("part")
    table = proposed.groupBy(*FEATURES, part, "label").count().collect()
    fitted = [row.asDict() for row in table if not row["part"]] or [row.asDict() for row in table]
    kept = [row.asDict() for row in table if row["part"]] or fitted
    total, positive = sum(r["count"] for r in fitted), sum(r["count"] for r in fitted if r["label"])
    model = Model()
    if not positive:
        return model
    share = min(max(positive / total, 1e-3), 1 - 1e-3)
    model.bias = math.log(share / (1 - share))
    margins = [model.bias] * len(fitted)
    for _ in range(rounds):
        chance = [1 / (1 + math.exp(-m)) for m in margins]
        weights = [(r["count"] * (r["label"] - p), r["count"] * p * (1 - p)) for r, p in zip(fitted, chance, strict=True)]
        # The root is the cut whose two halves can then be cut best.
        _, (name, cut, _, _) = _stump(fitted, weights)
        halves = []
        for low in (True, False):
            inside = [i for i, r in enumerate(fitted) if (r[name] <= cut) == low]
            halves.append(_stump([fitted[i] for i in inside], [weights[i] for i in inside])[1])
        model.trees.append(((name, cut), halves[0], halves[1]))
        margins = [model.margin(r) for r in fitted]
    # The lowest margin from which on the kept candidates are right often enough.
    right = wrong = 0
    for margin, label, count in sorted(((model.margin(r), r["label"], r["count"]) for r in kept), reverse=True):
        right, wrong = right + count * label, wrong + count * (1 - label)
        if right and right / (right + wrong) >= precision:
            model.threshold = margin - 1e-9
    return model


def find_private(texts: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = 30, also: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``texts``: key, text, columns ``also``, and arrays ``base`` and ``spans`` of structs (start, place, kind, end).

    ``base`` holds the four base kinds, ``spans`` those and the selected candidates that no base span covers.
    Both are sorted by start, then by the order of ``KINDS``.
    """
    model = fit(candidates(texts, key, text), rounds)
    place = {kind: n for n, kind in enumerate(KINDS)}
    span = lambda kind: lambda s: F.struct(s["start"].alias("start"), F.lit(place[kind]).alias("place"), F.lit(kind).alias("kind"), s["end"].alias("end"))
    body = F.coalesce(F.col(text), F.lit(""))
    found = [F.transform(base_spans(body, kind), span(kind)) for kind in KINDS[:4]]
    rows = texts.select(F.col(key), F.col(text), *also, F.array_sort(F.concat(*found)).alias("base"))
    if math.isinf(model.threshold):
        return rows.withColumn("spans", F.col("base"))
    def scored(s: Column) -> Column:
        begin = F.greatest(s["start"] - CONTEXT, F.lit(0))
        before = F.substring(F.coalesce(F.col(text), F.lit("")), begin + 1, s["start"] - begin)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), *_features(s["value"], before))

    proposed = F.transform(_pieces(body, CANDIDATE, _CANDIDATE_GATE), scored)
    free = lambda s: ~F.exists(F.col("base"), lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))
    chosen = F.filter(proposed, lambda s: (_margin(model, s) >= model.threshold) & free(s))
    return rows.withColumn("spans", F.array_sort(F.concat("base", F.transform(chosen, span("secret")))))


def _margin(model: Model, s: Column) -> Column:
    total = F.lit(model.bias)
    for root, left, right in model.trees:
        leaf = [F.when(s[n] <= cut, F.lit(low)).otherwise(F.lit(high)) for n, cut, low, high in (left, right)]
        total = total + F.when(s[root[0]] <= root[1], leaf[0]).otherwise(leaf[1])
    return total


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span of ``spans`` by its kind in brackets; overlapping spans are replaced as one.

    Spans are taken in blocks, each with the stretch of text that it covers, so that neither the text made so far nor
    the way to a span's place is gone over again for every span.
    """
    state = "struct<at:int,out:string>"

    def replaced(block: Column, piece: Column, first: Column, done: Column) -> Column:
        """One block's text from ``done``, where the text made so far ends; ``piece`` starts at ``first``."""
        return F.aggregate(
            block,
            F.struct(done.alias("at"), F.lit("").alias("out")).cast(state),
            lambda acc, s: F.when(
                s["start"] >= acc["at"],
                F.struct(
                    s["end"].alias("at"),
                    F.concat(acc["out"], F.substring(piece, acc["at"] - first + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"),
                ),
            ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).cast(state),
        )

    def joined_blocks(blocks: Column) -> Column:
        ends = F.transform(blocks, lambda b: F.coalesce(F.array_max(F.transform(b, lambda s: s["end"])), F.lit(0)))
        # Where all spans before a block end: the block's text starts there.
        done = F.aggregate(
            ends,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, e: F.struct(F.greatest(acc["at"], e).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        )

        def one(block: Column, at: Column) -> Column:
            last = F.coalesce(F.array_max(F.transform(block, lambda s: s["start"])), F.lit(0))
            piece = F.substring(F.col(text), at + 1, F.greatest(last - at, F.lit(0)))
            return _let(piece, lambda p: replaced(block, p, at, at)["out"])

        return _let(done, lambda d: F.concat(F.array_join(F.zip_with(blocks, d["out"], one), ""), F.substring(F.col(text), d["at"] + 1, F.length(text))))

    made = _let(_blocks(F.col("spans")), joined_blocks)
    return found.withColumn(text, F.when(F.size("spans") > 0, made).otherwise(F.col(text)))
