"""Approximate nearest neighbours by cosine: NN-descent and greedy graph search.

Equal vectors are one node, with its first ids.  *Build*: every node has a list of
``LIST`` neighbours.  It starts from exact comparisons inside leaves of ``LEAF`` nodes
that are next to each other by the signs of random projections (``TREES`` times) and in
random order (once, so that lists are not closed inside a leaf); then
each round joins neighbours of neighbours: a node's neighbours, and up to ``REVERSE`` nodes
that have it in their lists, meet at that node and are compared if one of them
is new there, and each keeps the best.  Rounds end when few lists change.
*Search*: a query starts from its node's list and keeps the ``BEAM`` best nodes it has seen;
each round all nodes of the beam not yet expanded are joined with the graph and their
neighbours scored, until the beam no longer changes.

Everything but the last step works on unit vectors in half precision; the best
``EXACT`` of a beam are scored again in double precision on the original vectors.  What
meets at a node is bounded (LIST + REVERSE, and EMIT pairs for each), also at
hubs: reverse neighbours and candidates are limited before their exchange.

Defined cases: vectors that are NULL, empty, zero or hold a NULL or non-finite component take no
part, as rows with a NULL id; shorter vectors count as filled up with zeros; rows that repeat
an id and its vector count once; fewer candidates than asked for give fewer
rows; an empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sublens.llm.common import discard, stored

NEAREST = 5
LIST, REVERSE, EMIT = 32, 24, 12
LEAF, TREES, BITS = 512, 2, 16
ROUNDS, SETTLED = 6, 0.02     # rounds at most; share of new list entries at which they end
BEAM, EXACT = 240, 16
PART = 4096                   # nodes in a partition at least
NONE = -2.0                   # below every cosine

LISTED = "array<struct<score:float,id:bigint,fresh:boolean>>"
BEAMED = "array<struct<score:float,id:bigint,done:boolean>>"
SCORED = pa.list_(pa.struct([("score", pa.float32()), ("id", pa.int64())]))


def usable(id_col: str, vector_col: str) -> Column:
    number = lambda x: x.cast("double")
    whole = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < float("inf")))
    some = F.exists(vector_col, lambda x: number(x) != 0)
    return F.col(id_col).isNotNull() & F.coalesce(whole & some, F.lit(False))


def _rows(values: pa.Array, width: int) -> np.ndarray:
    """Half-precision rows out of a binary column."""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1]
    if not len(values):
        return np.zeros((0, width), np.float32)
    data = np.frombuffer(values.buffers()[2], np.float16, int(ends[-1] - ends[0]) // 2, int(ends[0]))
    return data.reshape(-1, width).astype(np.float32)


def _offsets(column: pa.ListArray) -> np.ndarray:
    at = column.offsets.to_numpy()
    return at - at[0]


def nodes_of(rows: DataFrame, id_col: str, vector_col: str, members: int) -> DataFrame:
    """Distinct vectors: node, vec (array<double>), members (their first ids)."""
    plain = rows.filter(usable(id_col, vector_col)).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0)).alias("vec")).distinct()
    first = plain.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("n") <= members)
    return first.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("members")).withColumn(
        "node", F.monotonically_increasing_id())


def coded(nodes: DataFrame, width: int, trees: int, seed: int = 11) -> DataFrame:
    """node, code (unit vector in half precision) and a leaf order per tree."""
    planes = np.random.default_rng(seed).normal(size=(trees, BITS, width))
    weights = 1 << np.arange(BITS)[::-1]
    names = [f"tree{i}" for i in range(trees)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.diff(_offsets(b.column(1)))
            m = np.zeros((b.num_rows, width))
            m[np.arange(width) < sizes[:, None]] = b.column(1).flatten().to_numpy()
            m /= np.abs(m).max(axis=1, keepdims=True, initial=1e-300)      # no overflow of squares
            m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
            code = m.astype(np.float16)
            yield pa.record_batch([b.column(0), pa.array([r.tobytes() for r in code], pa.binary()),
                                   *[pa.array(((m @ p.T) > 0) @ weights, pa.int64()) for p in planes]],
                                  ["node", "code", *names])

    return nodes.select("node", "vec").mapInArrow(
        run, "node bigint, code binary, " + ", ".join(f"{n} bigint" for n in names))


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of every row, largest first."""
    k = min(k, scores.shape[1])
    part = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    order = np.argsort(-np.take_along_axis(scores, part, 1), axis=1, kind="stable")
    return np.take_along_axis(part, order, 1)


def _leaves(size: int, keep: int, width: int) -> Callable:
    """Exact neighbours inside leaves of ``size`` to 2 ``size`` nodes in a row."""
    def joined(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        scores = x @ x.T
        np.fill_diagonal(scores, NONE)
        top = _top(scores, min(keep, len(ids) - 1)) if len(ids) > 1 else np.zeros((len(ids), 0), np.int64)
        lists = [{"score": s, "id": i} for s, i in zip(
            np.take_along_axis(scores, top, 1).ravel().tolist(), ids[top].ravel().tolist(), strict=True)]
        ends = np.arange(len(ids) + 1) * top.shape[1]
        return pa.record_batch([pa.array(ids), pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(lists, SCORED.value_type))], ["node", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = np.zeros(0, np.int64), np.zeros((0, width), np.float32)
        for b in batches:
            ids = np.r_[ids, b.column(0).to_numpy()]
            x = np.concatenate([x, _rows(b.column(1), width)])
            while len(ids) >= 2 * size:
                yield joined(ids[:size], x[:size])
                ids, x = ids[size:], x[size:]
        if len(ids):
            yield joined(ids, x)

    return run


def _meet(emit: int, width: int) -> Callable:
    """Compares the members that meet at a node: (a, b, score) for b that would
    enter a's list, the ``emit`` best for each a."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                column = whole.column(0).slice(at, 128)
                ends, flat = _offsets(column), column.flatten()
                sizes, m = np.diff(ends), len(flat)
                inside = np.arange(int(sizes.max())) < sizes[:, None]

                def padded(values, empty, inside=inside):
                    out = np.full(inside.shape + values.shape[1:], empty, values.dtype)
                    out[inside] = values
                    return out

                x = padded(_rows(flat.field("code"), width), 0)
                ids = padded(flat.field("id").to_numpy(), -1)
                fresh = padded(flat.field("fresh").to_numpy(zero_copy_only=False), False)
                floor = padded(flat.field("floor").to_numpy(), np.float32(9))
                scores = x @ x.transpose(0, 2, 1)
                ok = (fresh[:, :, None] | fresh[:, None, :]) & inside[:, None, :] & (scores > floor[:, :, None])
                ok[:, np.arange(ok.shape[1]), np.arange(ok.shape[1])] = False
                scores = np.where(ok, scores, NONE)
                if scores.shape[2] > emit:
                    last = np.partition(scores, -emit, axis=2)[:, :, -emit]
                    ok &= scores >= last[:, :, None]
                g, i, j = np.nonzero(ok)
                if len(g):
                    yield pa.record_batch([pa.array(ids[g, i]), pa.array(ids[g, j]), pa.array(scores[g, i, j])],
                                          ["node", "id", "score"])
                assert m == inside.sum()
    return run


def _first(found: DataFrame, keep: int) -> DataFrame:
    """(node, id, score) rows -> node, found: the ``keep`` best different ids."""
    best = found.groupBy("node", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("node").orderBy(F.desc("score"), "id")
    return (best.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= keep)
            .groupBy("node").agg(F.collect_list(F.struct("score", "id")).alias("found")))


def _merged(lists: DataFrame, found: DataFrame, keep: int) -> DataFrame:
    """Lists with the found nodes that they lack, the ``keep`` best of both."""
    return lists.join(found, "node", "left").select("node", "code", F.expr(f"""
        slice(sort_array(concat(
            transform(nbrs, x -> struct(x.score, x.id, false as fresh)),
            transform(filter(coalesce(found, array()), f -> not exists(nbrs, x -> x.id = f.id)),
                      f -> struct(f.score, f.id, true as fresh))), false), 1, {keep})""").cast(LISTED).alias("nbrs"))


def build(codes: DataFrame, width: int, count: int, keep: int = LIST, reverse: int = REVERSE, emit: int = EMIT,
          leaf: int = LEAF, trees: int = TREES, rounds: int = ROUNDS, settled: float = SETTLED) -> DataFrame:
    """Stored neighbour lists: node, code, nbrs (score, id, fresh; best first)."""
    parts = max(1, count // PART)
    starts = None
    for order in [*(F.col(f"tree{i}") for i in range(trees)), F.xxhash64("node")]:
        rows = (codes.select("node", "code", order.alias("at")).repartitionByRange(parts, "at", "node")
                .sortWithinPartitions("at", "node").select("node", "code"))
        one = rows.mapInArrow(_leaves(leaf, keep, width), "node bigint, found array<struct<score:float,id:bigint>>")
        starts = one if starts is None else starts.unionByName(one)
    start = _first(starts.select("node", F.explode("found").alias("f")).select("node", "f.id", "f.score"), keep)
    none = codes.select("node", "code", F.array().cast(LISTED).alias("nbrs"))
    lists = stored(_merged(none, start, keep), "neighbours-lists")
    for turn in range(rounds):
        ends = lists.select("node", F.explode("nbrs").alias("n")).select("node", "n.id", "n.fresh")
        back = ends.select(F.col("id").alias("node"), F.col("node").alias("id"), "fresh")
        order = Window.partitionBy("node").orderBy(F.desc("fresh"), F.xxhash64("id", F.lit(turn)), "id")
        back = back.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= reverse).drop("n")
        meet = ends.unionByName(back).groupBy("node", "id").agg(F.max("fresh").alias("fresh"))
        member = lists.select(F.col("node").alias("id"), "code", F.when(
            F.size("nbrs") >= keep, F.element_at("nbrs", -1)["score"]).otherwise(F.lit(NONE)).cast("float").alias("floor"))
        groups = (meet.join(member, "id").groupBy("node")
                  .agg(F.collect_list(F.struct("id", "fresh", "floor", "code")).alias("members"))
                  .filter(F.exists("members", lambda m: m["fresh"])).select("members"))
        found = groups.mapInArrow(_meet(emit, width), "node bigint, id bigint, score float")
        before, lists = lists, stored(_merged(lists, _first(found, keep), keep), "neighbours-lists")
        discard(before)
        new = lists.agg(F.sum(F.size(F.filter("nbrs", lambda n: n["fresh"])))).first()[0] or 0
        if new <= settled * count * keep:
            break
    return lists


def graph_of(lists: DataFrame) -> DataFrame:
    """Stored adjacency: node, ids and codes of its neighbours."""
    ends = lists.select("node", F.explode("nbrs").alias("n")).select("node", F.col("n.id").alias("id"))
    rows = ends.join(lists.select(F.col("node").alias("id"), "code"), "id")
    return stored(rows.groupBy("node").agg(F.collect_list(F.struct("id", "code")).alias("around")), "neighbours-graph")


def _expand(width: int) -> Callable:
    """Scores of an expanded node's neighbours that are above the beam's last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                ends, flat = _offsets(b.column(3)), b.column(3).flatten()
                row = np.repeat(np.arange(b.num_rows), np.diff(ends))
                scores = np.einsum("ij,ij->i", _rows(flat.field("code"), width), _rows(b.column(1), width)[row])
                ok = np.flatnonzero(scores > b.column(2).to_numpy()[row])
                yield pa.record_batch([pa.array(b.column(0).to_numpy()[row[ok]]), pa.array(flat.field("id").to_numpy()[ok]),
                                       pa.array(scores[ok])], ["query", "id", "score"])
    return run


def search(queries: DataFrame, lists: DataFrame, width: int, beam: int = BEAM) -> DataFrame:
    """For query nodes (column node): stored (query, beam: score, id, done; best first)."""
    graph = graph_of(lists)
    state = stored(queries.select("node").distinct().join(lists, "node").select(
        F.col("node").alias("query"), "code",
        F.transform("nbrs", lambda n: F.struct(n["score"], n["id"], F.lit(False).alias("done"))).cast(BEAMED).alias("beam")),
        "neighbours-beams")
    while True:
        last = F.when(F.size("beam") >= beam, F.element_at("beam", -1)["score"]).otherwise(F.lit(NONE)).cast("float")
        front = state.select("query", "code", last.alias("last"), F.explode(
            F.filter("beam", lambda n: ~n["done"])["id"]).alias("node"))
        seen = front.join(graph, "node").select("query", "code", "last", "around").mapInArrow(
            _expand(width), "query bigint, id bigint, score float")
        best = seen.filter(F.col("id") != F.col("query")).groupBy("query", "id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        best = (best.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= 2 * beam).groupBy("query")
                .agg(F.collect_list(F.struct("score", "id")).alias("found")))
        before, state = state, stored(state.join(best, "query", "left").select("query", "code", F.expr(f"""
            slice(sort_array(concat(
                transform(beam, x -> struct(x.score, x.id, true as done)),
                transform(filter(coalesce(found, array()), f -> not exists(beam, x -> x.id = f.id)),
                          f -> struct(f.score, f.id, false as done))), false), 1, {beam})""").cast(BEAMED).alias("beam")),
            "neighbours-beams")
        discard(before)
        if not state.agg(F.max(F.exists("beam", lambda n: ~n["done"]))).first()[0]:
            discard(graph)
            return state


def nearest(rows: DataFrame, query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = NEAREST, beam: int = BEAM, **options) -> DataFrame:
    """For every row where ``query`` holds, the k nearest other rows found: query_id,
    rank, vec_id, score (cosine in double precision); ties to smaller ids."""
    nodes = stored(nodes_of(rows, id_col, vector_col, k + 1), "neighbours-nodes")
    size = nodes.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("width")).first()
    width = size["width"] or 1
    codes = stored(coded(nodes, width, options.get("trees", TREES)), "neighbours-codes")
    lists = build(codes, width, size["n"], **options)
    asked = (rows.filter(usable(id_col, vector_col) & F.coalesce(query, F.lit(False)))
             .select(F.col(id_col).cast("bigint").alias("query_id"),
                     F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0)).alias("vec")).distinct()
             .join(nodes.select("node", "vec"), "vec").select("query_id", "node"))
    asked = stored(asked, "neighbours-queries")
    beams = search(asked, lists, width, beam)
    near = beams.select(F.col("query").alias("node"), F.explode(F.concat(
        F.array(F.col("query")), F.slice("beam", 1, max(EXACT, k + 1))["id"])).alias("other"))
    size_of = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    dot = F.aggregate(F.zip_with("vec", "other_vec", lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
    pairs = (near.join(nodes.select("node", "vec"), "node")
             .join(nodes.select(F.col("node").alias("other"), F.col("vec").alias("other_vec"), "members"), "other")
             .select("node", (dot / (size_of("vec") * size_of("other_vec"))).alias("score"), F.explode("members").alias("vec_id")))
    order = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "vec_id")
    out = stored(asked.join(pairs, "node").filter(F.col("vec_id") != F.col("query_id"))
                 .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"), "neighbours")
    discard(nodes, codes, lists, asked, beams)
    return out
