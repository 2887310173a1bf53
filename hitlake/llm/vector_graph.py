"""Near-duplicate vectors by NN-descent.

Equal vectors of one label are one node.  Each node keeps a list of its nearest neighbours found so far.  A first graph
comes from random orderings: nodes sorted by the signs of random projections, compared with those next to them.  A
round joins neighbours of neighbours: every node compares the members of its neighbourhood (its list and the nearest of
those that list it) with one another, where one of the two is new, and lists take up what is nearer.  Recall is audited
against brute force on a bounded sample of nodes, over all nodes; rounds go on until it reaches its target, and new
orderings are added where the graph stands still below it.  Edges at the threshold are kept, verified in doubles.

A list whose members all reach the threshold is saturated: there may be more.  Such lists are enlarged to the whole
component of their node.  Within it, nodes are put into cells by their angle to the component's centre.  Two cells whose
angles add up to no more than the threshold's are linked throughout, two that lie further apart not at all, so their
links are counted without making pairs; blocks of all other cells are compared by matrix products, which return counts.
So what a large group of near copies adds to the data moved follows its size and not its square.

Bounds: lists and neighbourhoods have fixed lengths, the audit sample at most ``AUDIT`` nodes.  The search is approximate
(its recall is audited); links are exact, and counts within enlarged lists complete.

Defined results: a null label, or a vector that is null, empty, zero or holds null or non-finite components links with
nothing; nor do vectors of different lengths.  Every row gives a row.  Rows of one id with equal vectors link like any
two; the component of a row is the smallest id of its component, nulls last.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitlake.llm.batches import byte_view, mix, runs
from hitlake.llm.components import components
from hitlake.storage import scratch_path

#: Cosine from which on two vectors link.
THRESHOLD = 0.93
#: Neighbours that a list holds before it is enlarged.
NEIGHBOURS = 12
#: Nodes of the audit sample.
AUDIT = 1000
#: Share of the audited links that ends the search.
RECALL = 0.99
#: Orderings of the first graph, nodes before each that it is compared with, and how many of those it takes up.
ORDERINGS, WINDOW, TAKEN = 4, 16, 4
#: Candidates that a member of a neighbourhood takes up from it.
PROPOSED = 3
#: Searches use two-byte components; cosines are this near at least.
SLACK = 0.01
#: Width of a cell, in radians, and nodes of a block.
CELL, BLOCK = 0.01, 1024

_CLASSES = "node bigint, part string, v binary, key string, weight bigint, least bigint"


def _stored(frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Vectors of one length, one a row."""
    data, _ = byte_view(column)
    return data.view(kind).reshape(len(column), -1) if len(column) else np.zeros((0, 0), kind)


def _rows(vectors: DataFrame, id_column: str, label_column: str, vector_column: str) -> DataFrame:
    """(id, part, v): part is null where the row links with nothing, v a unit vector of doubles."""

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(2):
                x = None if not x.is_valid or x.values.null_count else x.values.to_numpy()
                most = np.abs(x).max() if x is not None and len(x) else 0
                if not 0 < most < np.inf:
                    out.append(None)
                    continue
                x = x / most
                out.append((x / math.sqrt(x @ x)).tobytes())
            v = pa.array(out, pa.binary())
            part = pa.compute.if_else(v.is_valid(), batch.column(1), pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), part, pa.compute.if_else(part.is_valid(), v, pa.scalar(None, pa.binary()))], ["id", "part", "v"])

    import pyarrow.compute  # noqa: F401  gives pa.compute

    part = F.concat(F.col(label_column).cast("string"), F.lit(":"), F.size(vector_column).cast("string"))
    chosen = vectors.select(F.col(id_column).cast("bigint").alias("id"), part.alias("part"), F.col(vector_column).cast("array<double>").alias("v"))
    made = chosen.mapInArrow(unit, "id bigint, part string, v binary")
    return made.withColumn("key", F.when(F.col("v").isNotNull(), F.md5(F.concat(F.encode("part", "UTF-8"), F.col("v")))))


def _orderings(nodes: DataFrame, seed: int) -> DataFrame:
    """(a, b, sim): nodes next to one another in random orderings, both ways."""
    spark = nodes.sparkSession

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = np.array([int(p.rpartition(":")[2]) for p in batch.column("part").to_pylist()])
            for dim in np.unique(parts):
                some = batch.take(pa.array(np.flatnonzero(parts == dim)))
                x = _matrix(some.column("h"), "<f2").astype(np.float32)
                for r in range(ORDERINGS):
                    planes = np.random.default_rng([seed, r, dim]).standard_normal((dim, 48)).astype(np.float32)
                    bits = (x @ planes > 0) @ (1 << np.arange(47, -1, -1))
                    place = pa.array([f"{seed}.{r} {p}" for p in some.column("part").to_pylist()])
                    yield pa.RecordBatch.from_arrays([place, pa.array(bits.astype(np.int64)), some.column("node"), some.column("h")], ["place", "bits", "node", "h"])

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in runs(batches, text=3, limit=2 << 20):
            both = pa.Table.from_batches([batch] if tail is None else [tail, batch]).combine_chunks()
            old = 0 if tail is None else tail.num_rows
            place = both.column("place").combine_chunks().dictionary_encode().indices.to_numpy()
            node = both.column("node").to_numpy()
            for begin in np.flatnonzero(np.append(True, place[1:] != place[:-1])):
                end = begin + int(np.argmax(np.append(place[begin:] != place[begin], True)))
                x = _matrix(both.column("h").slice(begin, end - begin).combine_chunks(), "<f2").astype(np.float32)
                if end <= old or len(x) < 2:
                    continue
                near = np.full((WINDOW, len(x)), -2, np.float32)
                for o in range(1, min(WINDOW, len(x) - 1) + 1):
                    near[o - 1, o:] = np.einsum("ij,ij->i", x[o:], x[:-o])
                near[:, : max(0, old - begin)] = -2
                best = np.argsort(-near, axis=0, kind="stable")[:TAKEN]
                sim = np.take_along_axis(near, best, 0)
                o, i = np.nonzero(sim > -2)
                a, b, sim = node[begin + i], node[begin + i - best[o, i] - 1], sim[o, i]
                yield pa.RecordBatch.from_arrays([pa.array(np.append(a, b)), pa.array(np.append(b, a)), pa.array(np.append(sim, sim))], ["a", "b", "sim"])
            tail = both.slice(max(0, both.num_rows - WINDOW)).combine_chunks().to_batches()[0]

    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = nodes.mapInArrow(signs, "place string, bits bigint, node bigint, h binary")
    return placed.repartitionByRange(parts, "place", "bits", "node").sortWithinPartitions("place", "bits", "node").mapInArrow(beside, "a bigint, b bigint, sim float")


def _nearest(candidates: DataFrame, graph: DataFrame | None, size: int) -> DataFrame:
    """The lists (a, b, sim, fresh) after taking up candidates; an edge that was there before is not fresh."""
    edges = candidates.select("a", "b", "sim", F.lit(True).alias("fresh"))
    if graph is not None:
        edges = graph.select("a", "b", "sim", F.lit(False).alias("fresh")).unionAll(edges)
    edges = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.col("sim").desc(), "b"))
    return _stored(edges.withColumn("rank", rank).where(F.col("rank") <= size).drop("rank"), "graph")


def _neighbours_of_neighbours(nodes: DataFrame, graph: DataFrame, size: int) -> DataFrame:
    """(a, b, sim) proposed by a round."""
    back = graph.select(F.col("b").alias("u"), F.col("a").alias("x"), "sim", "fresh")
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.col("fresh").desc(), F.col("sim").desc(), "x"))
    back = back.withColumn("rank", rank).where(F.col("rank") <= size).drop("rank")
    hood = graph.select(F.col("a").alias("u"), F.col("b").alias("x"), "sim", "fresh").unionAll(back)
    hood = hood.groupBy("u", "x").agg(F.max("fresh").alias("fresh"))
    floors = graph.groupBy(F.col("a").alias("x")).agg(F.when(F.count("*") >= size, F.min("sim")).alias("floor"))
    known = nodes.select(F.col("node").alias("x"), "h").join(floors, "x", "left").select("x", "h", F.coalesce("floor", F.lit(-2.0)).cast("float").alias("floor"))
    rows = hood.join(known, "x").select("u", "x", "fresh", "floor", "h")

    def compare(rows: pa.Table) -> pa.RecordBatch | None:
        u, x = rows.column("u").to_numpy(), rows.column("x").to_numpy()
        fresh, floor = rows.column("fresh").to_numpy(zero_copy_only=False), rows.column("floor").to_numpy()
        _, at = byte_view(rows.column("h"))
        first = np.flatnonzero(np.append(True, u[1:] != u[:-1]))
        counts, widths = np.diff(np.append(first, len(u))), np.diff(at)[first]
        out = []
        for n, width in {(int(n), int(w)) for n, w in zip(counts, widths, strict=True)}:
            if n < 2:
                continue
            chosen = first[(counts == n) & (widths == width)]
            for begin in range(0, len(chosen), step := max(1, (4 << 20) // (n * width + n * n * 4))):
                place = chosen[begin : begin + step, None] + np.arange(n)
                v = _matrix(rows.column("h").take(pa.array(place.ravel())).combine_chunks(), "<f2").astype(np.float32).reshape(len(place), n, -1)
                sims = v @ v.transpose(0, 2, 1)
                new = fresh[place]
                useful = (new[:, :, None] | new[:, None, :]) & (sims > floor[place][:, :, None]) & ~np.eye(n, dtype=bool)
                sims = np.where(useful, sims, -2)
                best = np.argsort(-sims, axis=2, kind="stable")[:, :, :PROPOSED]
                sim = np.take_along_axis(sims, best, 2)
                g, i, j = np.nonzero(sim > -2)
                out.append((x[place[g, i]], x[place[g, best[g, i, j]]], sim[g, i, j]))
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["a", "b", "sim"])

    def proposals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in runs(batches, text=4):
            rows = pa.Table.from_batches([batch] if tail is None else [tail, batch]).combine_chunks()
            u = rows.column("u").to_numpy()
            cut = int(np.searchsorted(u, u[-1]))  # the last neighbourhood may go on
            if cut and (made := compare(rows.slice(0, cut))) is not None:
                yield made
            tail = rows.slice(cut).combine_chunks().to_batches()[0]
        if tail is not None and (made := compare(pa.Table.from_batches([tail]))) is not None:
            yield made

    parts = max(2, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(parts, "u").sortWithinPartitions("u").mapInArrow(proposals, "a bigint, b bigint, sim float")


def _audit_links(classes: DataFrame, threshold: float, size: int, sample: int) -> DataFrame:
    """(a, b): for a bounded sample of nodes their nearest links among all nodes, by brute force."""
    spark = classes.sparkSession
    picked = classes.select("node", "part", "v").orderBy(F.xxhash64("node"), "node").limit(sample).collect()
    by_part: dict[str, list] = {}
    for row in picked:
        by_part.setdefault(row["part"], []).append(row)
    shared = {part: (np.array([r["node"] for r in rows]), np.array([np.frombuffer(r["v"], "<f8") for r in rows])) for part, rows in by_part.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, text=2, limit=1 << 20):
            names = np.array(batch.column("part").to_pylist(), object)
            for part in set(names.tolist()) & set(shared):
                own, queries = shared[part]
                some = batch.take(pa.array(np.flatnonzero(names == part)))
                node = some.column("node").to_numpy()
                sims = queries @ _matrix(some.column("v"), "<f8").T
                sims[own[:, None] == node[None, :]] = -2
                best = np.argsort(-sims, axis=1, kind="stable")[:, :size]
                sim = np.take_along_axis(sims, best, 1)
                i, j = np.nonzero(sim >= threshold)
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(own[i]), pa.array(node[best[i, j]]), pa.array(sim[i, j])], ["a", "b", "sim"])

    found = classes.select("node", "part", "v").mapInArrow(scan, "a bigint, b bigint, sim double")
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.col("sim").desc(), "b"))
    return _stored(found.withColumn("rank", rank).where(F.col("rank") <= size).select("a", "b"), "audit")


def _saturated(graph: DataFrame, threshold: float, size: int) -> DataFrame:
    """Nodes whose whole list may reach the threshold."""
    return graph.where(F.col("sim") >= threshold - SLACK).groupBy("a").count().where(F.col("count") >= size).select("a")


def _recall(audit: DataFrame, graph: DataFrame, threshold: float, size: int) -> float:
    """Share of the audited links in the graph; a saturated list counts as whole, as it is enlarged."""
    pairs = graph.select("a", "b").unionAll(graph.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().withColumn("here", F.lit(1))
    full = _saturated(graph, threshold, size).withColumn("full", F.lit(1))
    row = audit.join(pairs, ["a", "b"], "left").join(full, "a", "left").agg(F.count("*"), F.count(F.coalesce("here", "full"))).first()
    return row[1] / row[0] if row[0] else 1.0


def neighbour_graph(classes: DataFrame, threshold: float = THRESHOLD, size: int = NEIGHBOURS, *, recall: float = RECALL, rounds: int = 10, audit: int = AUDIT) -> tuple[DataFrame, float]:
    """The lists (a, b, sim, fresh) of all nodes, and their audited recall."""

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = [np.frombuffer(v, "<f8").astype("<f2").tobytes() for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(short, pa.binary())], ["node", "part", "h"])

    nodes = _stored(classes.select("node", "part", "v").mapInArrow(halves, "node bigint, part string, h binary"), "nodes")
    truth = _audit_links(classes, threshold, size, audit)
    seed = 0
    graph = _nearest(_orderings(nodes, seed), None, size)
    reached = 0.0
    for _ in range(rounds):
        graph = _nearest(_neighbours_of_neighbours(nodes, graph, size), graph, size)
        before, reached = reached, _recall(truth, graph, threshold, size)
        if reached >= recall:
            break
        if reached - before < 0.01:  # it stands still
            seed += 1
            graph = _nearest(_orderings(nodes, seed), graph, size)
    return graph, reached


def _verified(classes: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose cosine in doubles reaches the threshold."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, text=2):
            ok = [float(np.frombuffer(a, "<f8") @ np.frombuffer(b, "<f8")) >= threshold for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in (batch.column(0), batch.column(1))], ["a", "b"])

    left = classes.select(F.col("node").alias("a"), F.col("v").alias("va"))
    right = classes.select(F.col("node").alias("b"), F.col("v").alias("vb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(check, "a bigint, b bigint")


def _enlarged(members: DataFrame, threshold: float) -> DataFrame:
    """(node, linked): the weight of all nodes that each links with, itself included, within its root.

    ``members`` (root, node, weight, v) holds whole components.
    """
    angle = math.acos(threshold)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, text=3):
            roots, place = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            v = batch.column(3).to_pylist()
            made = [None] * len(roots)
            for i, x in zip(place, v, strict=True):
                x = np.frombuffer(x, "<f8")
                made[i] = x if made[i] is None else made[i] + x
            yield pa.RecordBatch.from_arrays([pa.array(roots), pa.array([x.tobytes() for x in made], pa.binary())], ["root", "sum"])

    def centre(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, "<f8") for x in rows.column("sum").to_pylist()], axis=0)
        return pa.table({"root": pa.array([key[0].as_py()], pa.int64()), "centre": pa.array([total.tobytes()], pa.binary())})

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, text=3):
            out = []
            for x, c in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                x, c = np.frombuffer(x, "<f8"), np.frombuffer(c, "<f8")
                out.append(int(math.acos(min(1.0, max(-1.0, float(x @ c) / (math.sqrt(c @ c) or 1.0)))) / CELL))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.int32())], ["root", "node", "weight", "v", "cell"])

    def plan(key: tuple, rows: pa.Table) -> pa.Table:
        """What is known of the cells of one root (at most pi / CELL): sure weights, and blocks still to compare."""
        cell, count, weight = (rows.column(n).to_numpy() for n in ("cell", "n", "weight"))
        blocks = np.maximum(1, -(-count // BLOCK))
        sure = (cell[:, None] + cell[None, :] + 2) * CELL <= angle - 1e-6
        apart = (np.abs(cell[:, None] - cell[None, :]) - 1) * CELL > angle + 1e-6
        out = [(int(c), int(n), None, None, None, int(weight[s].sum())) for c, n, s in zip(cell, blocks, sure, strict=True)]
        for i, j in np.argwhere(~sure & ~apart):
            out += [(int(cell[i]), int(blocks[i]), s, int(cell[j]), t, 0) for s in range(blocks[i]) for t in range(blocks[j])]
        names, kinds = ("cell", "blocks", "block", "other", "other_block", "sure"), (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        made = {name: pa.array([row[n] for row in out], kind) for n, (name, kind) in enumerate(zip(names, kinds, strict=True))}
        return pa.table({"root": pa.array([key[0].as_py()] * len(out), pa.int64())} | made)

    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        body = b"".join(rows.column("v").to_pylist())
        return pa.table({"root": pa.array([key[0].as_py()], pa.int64()), "cell": pa.array([key[1].as_py()], pa.int32()), "block": pa.array([key[2].as_py()], pa.int32()), "nodes": pa.array([rows.column("node").to_numpy().tobytes()], pa.binary()), "weights": pa.array([rows.column("weight").to_numpy().tobytes()], pa.binary()), "vs": pa.array([body], pa.binary())})

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        nodes = np.frombuffer(rows.column("nodes")[0].as_py(), "<i8")
        weights = np.frombuffer(rows.column("weights")[0].as_py(), "<i8")
        ours, theirs = (np.frombuffer(rows.column(n)[0].as_py(), "<f8") for n in ("vs", "other_vs"))
        dim = len(ours) // len(nodes)
        sims = ours.reshape(-1, dim) @ theirs.reshape(-1, dim).T
        return pa.table({"node": pa.array(nodes), "linked": pa.array((sims >= threshold) @ np.frombuffer(rows.column("other_weights")[0].as_py(), "<i8") if len(weights) else [], pa.int64())})

    centres = members.mapInArrow(sums, "root bigint, sum binary").groupBy("root").applyInArrow(centre, "root bigint, centre binary")
    placed = members.join(centres, "root").select("root", "node", "weight", "v", "centre").mapInArrow(cells, "root bigint, node bigint, weight bigint, v binary, cell int")
    placed = _stored(placed, "cells")
    plans = placed.groupBy("root", "cell").agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).groupBy("root")
    plans = _stored(plans.applyInArrow(plan, "root bigint, cell int, blocks int, block int, other int, other_block int, sure bigint"), "plans")
    sure = plans.where("other IS NULL").select("root", "cell", "blocks", "sure")
    placed = placed.join(sure, ["root", "cell"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = plans.where("other IS NOT NULL").select("root", "cell", "block", "other", "other_block")
    needed = tiles.select("root", "cell", "block").distinct()  # the relation is symmetric
    blocks = placed.join(needed, ["root", "cell", "block"], "left_semi").groupBy("root", "cell", "block")
    blocks = _stored(blocks.applyInArrow(packed, "root bigint, cell int, block int, nodes binary, weights binary, vs binary"), "blocks")
    others = blocks.select("root", F.col("cell").alias("other"), F.col("block").alias("other_block"), F.col("weights").alias("other_weights"), F.col("vs").alias("other_vs"))
    tiles = tiles.join(blocks, ["root", "cell", "block"]).join(others, ["root", "other", "other_block"])
    counted = tiles.groupBy("root", "cell", "block", "other", "other_block").applyInArrow(compare, "node bigint, linked bigint")
    return placed.select("node", F.col("sure").alias("linked")).unionAll(counted).groupBy("node").agg(F.sum("linked").alias("linked"))


def links(vectors: DataFrame, threshold: float = THRESHOLD, size: int = NEIGHBOURS, *, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding", recall: float = RECALL, rounds: int = 10) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine above 0")
    spark: SparkSession = vectors.sparkSession
    rows = _stored(_rows(vectors, id_column, label_column, vector_column), "vectors")
    classes = rows.where("part IS NOT NULL").groupBy("part", "v", "key").agg(F.count("*").alias("weight"), F.min("id").alias("least"))
    classes = _stored(classes.withColumn("node", F.monotonically_increasing_id()).selectExpr("node", "part", "v", "key", "weight", "least"), "classes")
    graph, _ = neighbour_graph(classes, threshold, size, recall=recall, rounds=rounds)
    pairs = graph.where(F.col("sim") >= threshold - SLACK).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = _stored(_verified(classes, pairs, threshold), "links")
    roots = _stored(components(edges), "roots")
    weights = classes.select("node", "weight")
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(weights.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("others"))
    full = roots.join(_saturated(graph, threshold, size).withColumnRenamed("a", "node"), "node", "left_semi").select("root").distinct()
    dense = roots.join(full, "root", "left_semi").join(classes.select("node", "weight", "v"), "node").select("root", "node", "weight", "v")
    dense = _stored(dense, "dense")
    whole = spark.createDataFrame([], "node bigint, linked bigint") if dense.isEmpty() else _stored(_enlarged(dense, threshold), "enlarged")
    least = roots.join(classes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("component"))
    found = classes.select("node", "key", "weight", "least").join(counts, "node", "left").join(whole, "node", "left").join(roots, "node", "left").join(least, "root", "left")
    found = found.select("key", (F.coalesce("linked", F.coalesce("others", F.lit(0)) + F.col("weight")) - 1).alias("n_links"), F.coalesce("component", "least").alias("component"))
    out = rows.select("id", "key").join(found, "key", "left")
    out = out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
