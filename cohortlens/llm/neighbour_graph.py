"""Approximate nearest neighbours by a neighbour graph (NN-descent) and greedy
search, both as Spark joins.

Equal vectors are one point; a point keeps its smallest ids, as many as a
result can hold. Points are compared by the inner product; for the graph they
get one more component that gives all of them the same length, so that its
neighbours are near in the usual sense whatever their lengths.

Graph. Every point starts with its best partners in a few random projection
trees, whose thresholds come from a bounded sample and whose leaves are compared
in full inside tasks. Then rounds of joins of neighbours of neighbours: every
point is the pivot of a local join of the points in its list and of those that
list it, pairs with at least one new edge; a pair better than one of its points'
worst partner goes to that point, lists are merged by point. Lists hold the
vector (16-bit floats) and the worst partner's score, so a local join needs no
other table. Sampled edges per pivot are bounded, rounds end when few lists
change.

Search. A query's beam starts with its own point. Per hop the best points not
yet expanded are joined with their neighbours, the neighbours are dealt to the
blocks of vectors that hold them together with the query's vector, scored there
in double precision, and merged into the beam; the search ends when the beam
holds nothing unexpanded. Every point is indexed and can be reached; what is
approximate is the graph, never a cap on rows.

Defined results: vectors that are NULL, zero, or hold NULL, NaN or infinite
components, and rows without an id, take no part; rows that repeat an id count
once (smallest vector); shorter vectors are read as padded with zeros; equal
scores go to the smaller id; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.tables import finite, hot_join, stored

DEGREE = 32              # partners of a point in the graph
SAMPLE = 10              # new (and old) edges of a point in a local join, each way
ROUNDS = 4
QUIET = 0.02             # rounds end when a round changed fewer than this share of all edges
TREES = 4
LEAF = 4096              # points of a leaf that are compared in full, about
MOST_LEAVES = 2048
TREE_SAMPLE = 16_384     # points that set the trees' thresholds
BEAM = 160
STEP = 64                # points a query expands per hop
BLOCK = 4096             # vectors of a block
PIVOTS = 256             # local joins computed at once

_LIST = "u long, code binary, v array<long>, s array<double>, st array<byte>, worst double, changed int"
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------ arrays of rows
def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of a list column."""
    return (column.flatten().to_numpy(zero_copy_only=False),
            column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))


def _list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _by_group(batches: Iterator[pa.RecordBatch], rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Sorted batches put together to about ``rows`` rows that end with a group
    (equal values of the first column)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        key = whole.column(0).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield whole.slice(0, cut)
        held = [whole.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _order(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Fixed pseudo-random numbers of edges."""
    x = (u.astype(np.uint64) * _MIX) ^ (v.astype(np.uint64) + _MIX)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def best_of(u: np.ndarray, v: np.ndarray, s: np.ndarray, st: np.ndarray, k: int):
    """The k best distinct partners of every u, best first, ties to the smaller
    v; of a repeated pair the lowest state stays."""
    o = np.lexsort((st, v, u))
    u, v, s, st = u[o], v[o], s[o], st[o]
    first = np.ones(len(u), bool)
    first[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    u, v, s, st = u[first], v[first], s[first], st[first]
    o = np.lexsort((v, -s, u))
    u, v, s, st = u[o], v[o], s[o], st[o]
    on = np.arange(len(u)) - np.searchsorted(u, u) < k
    return u[on], v[on], s[on], st[on]


def _merge(rows: DataFrame, k: int, active: int, by_score: bool) -> DataFrame:
    """One row per u of the k best partners in rows (u, code, v, s, st). States:
    0 used, 1 not yet used, 3 new in this merge; up to ``active`` of the unused
    become active (2): the best ones, or any. ``worst`` is the k-th score,
    ``changed`` the number of new partners."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _by_group(batches):
            ids = b.column(0).to_numpy(zero_copy_only=False)
            v, n = _lists(b.column(2))
            u, v, s, st = best_of(np.repeat(ids, n), v, _lists(b.column(3))[0], _lists(b.column(4))[0].astype(np.int8), k)
            keys = np.unique(ids)
            changed = np.bincount(np.searchsorted(keys, u[st == 3]), minlength=len(keys)).astype(np.int32)
            st[st == 3] = 1
            o = np.lexsort((-s if by_score else _order(u, v), st != 1, u))     # unused ones first in their u
            place = np.arange(len(u)) - np.searchsorted(u, u)
            st[o[(place < active) & (st[o] == 1)]] = 2
            size = np.searchsorted(u, keys, side="right") - np.searchsorted(u, keys)
            worst = np.full(len(keys), -np.inf)
            full = size == k
            worst[full] = s[np.searchsorted(u, keys[full], side="right") - 1]
            has = np.flatnonzero(b.column(1).is_valid().to_numpy(zero_copy_only=False))
            code = np.full(len(keys), -1)
            code[np.searchsorted(keys, ids[has])] = has
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), b.column(1).take(pa.array(code, mask=code < 0)), _list_column(v, size, pa.int64()),
                 _list_column(s, size, pa.float64()), _list_column(st, size, pa.int8()), pa.array(worst), pa.array(changed)],
                ["u", "code", "v", "s", "st", "worst", "changed"])

    return (rows.select("u", "code", "v", "s", "st").repartition("u").sortWithinPartitions("u").mapInArrow(merge, _LIST))


def _rows_of(u: np.ndarray, v: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    """(u, code, v, s, st) rows of new edges sorted by u."""
    keys, size = np.unique(u, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.nulls(len(keys), pa.binary()), _list_column(v, size, pa.int64()), _list_column(s, size, pa.float64()),
         _list_column(np.full(len(u), 3, np.int8), size, pa.int8())], ["u", "code", "v", "s", "st"])


_NEW = "u long, code binary, v array<long>, s array<double>, st array<byte>"


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


# ---------------------------------------------------------------- the points
def points_of(base: DataFrame, keep: int) -> DataFrame:
    """(rep, ids, vector): distinct vectors with their ``keep`` smallest ids."""
    by = Window.partitionBy("vector").orderBy("id")
    few = base.withColumn("place", F.row_number().over(by)).where(F.col("place") <= keep)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.col("ids")[0].alias("rep"), "ids", "vector")


def _coded(points: DataFrame, dims: int) -> DataFrame:
    """(u, code): vectors as 16-bit floats, scaled to a common length with one
    more component."""
    top = points.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x).cast("double"))))).first()[0] or 1.0
    square = points.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / F.lit(top)) * (x / F.lit(top))))).first()[0] or 1.0

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = padded(b.column(1), dims) / top
            more = np.sqrt(np.maximum(square - (x * x).sum(1), 0))
            x = (np.concatenate([x, more[:, None]], 1) / np.sqrt(square)).astype("<f2")
            flat, w = x.tobytes(), 2 * (dims + 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([flat[i * w:(i + 1) * w] for i in range(len(x))], pa.binary())], ["u", "code"])

    return points.select("rep", "vector").mapInArrow(code, "u long, code binary")


def padded(vectors: pa.Array, dims: int) -> np.ndarray:
    values, n = _lists(vectors)
    out = np.zeros((len(vectors), dims))
    out[np.repeat(np.arange(len(n)), n), np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)] = values
    return out


# ----------------------------------------------------------------- the graph
def _trees(sample: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per tree (one direction a level, thresholds in heap order)."""
    depth = 0
    while n > LEAF << depth and 2 << depth <= min(MOST_LEAVES, max(1, len(sample) // 8)):
        depth += 1
    out = []
    for t in range(TREES):
        way = np.random.default_rng(t).standard_normal((depth, sample.shape[1])).astype(np.float32)
        cut, node, proj = np.zeros(1 << depth, np.float32), np.ones(len(sample), np.int64), sample @ way.T
        for level in range(depth):
            for k in range(1 << level, 2 << level):
                on = node == k
                cut[k] = np.median(proj[on, level]) if on.any() else 0
            node = 2 * node + (proj[:, level] > cut[node])
        out.append((way, cut))
    return out


def _start(coded: DataFrame, n: int, dims: int, degree: int) -> DataFrame:
    """New edges between the points of common leaves."""
    sample = coded.orderBy(F.xxhash64("u"), "u").limit(TREE_SAMPLE).toArrow().combine_chunks()
    trees = _trees(_matrix(sample.column("code"), "<f2", dims + 1).astype(np.float32), n)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1), "<f2", dims + 1).astype(np.float32)
            for t, (way, cut) in enumerate(trees):
                node, proj = np.ones(len(x), np.int64), x @ way.T
                for level in range(len(way)):
                    node = 2 * node + (proj[:, level] > cut[node])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(node), b.column(0), b.column(1)],
                                                 ["tree", "leaf", "u", "code"])

    dealt = coded.mapInArrow(deal, "tree int, leaf long, u long, code binary")
    # a leaf that got more than it should is dealt out by hash (at most TREES * MOST_LEAVES counts)
    size = dealt.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / (2 * LEAF)).alias("chunks"))
    dealt = dealt.join(F.broadcast(size), ["tree", "leaf"]).withColumn("chunk", F.pmod(F.xxhash64("u"), F.col("chunks")))

    def compare(table: pa.Table) -> pa.Table:
        b = table.combine_chunks()
        ids = b.column("u").to_numpy()
        x = _matrix(b.column("code"), "<f2", dims + 1).astype(np.float32)
        k, out = min(degree, len(x) - 1), []
        if not k:
            return pa.Table.from_batches([_rows_of(ids[:0], ids[:0], np.zeros(0))])
        for a in range(0, len(x), 512):
            score = x[a:a + 512] @ x.T
            score[np.arange(len(score)), np.arange(a, a + len(score))] = -np.inf
            near = np.argpartition(-score, k - 1, 1)[:, :k]
            u, v, s = np.repeat(ids[a:a + 512], k), ids[near.ravel()], np.take_along_axis(score, near, 1).ravel()
            o = np.argsort(u, kind="stable")
            out.append(_rows_of(u[o], v[o], s[o].astype(float)))
        return pa.Table.from_batches(out)

    return dealt.select("tree", "leaf", "chunk", "u", "code").groupBy("tree", "leaf", "chunk").applyInArrow(compare, _NEW)


def local_joins(pivot: np.ndarray, member: np.ndarray, fresh: np.ndarray, worst: np.ndarray, x: np.ndarray, k: int):
    """Improving edges (u, v, s) among the members of every pivot (sorted): all
    pairs with a fresh member, for a point only partners above its worst."""
    bounds = np.flatnonzero(np.concatenate(([True], pivot[1:] != pivot[:-1], [True])))
    found = []
    for a in range(0, len(bounds) - 1, PIVOTS):
        lo, hi = bounds[a], bounds[min(a + PIVOTS, len(bounds) - 1)]
        group = np.searchsorted(bounds, np.arange(lo, hi), side="right") - 1 - a
        groups = int(group[-1]) + 1

        def table(rows: np.ndarray) -> np.ndarray:
            g = group[rows - lo]
            place = np.arange(len(rows)) - np.searchsorted(g, g)
            out = np.full((groups, int(place.max(initial=-1)) + 1), -1, np.int64)
            out[g, place] = rows
            return out

        every = table(np.arange(lo, hi))
        new = table(lo + np.flatnonzero(fresh[lo:hi]))
        if not new.shape[1]:
            continue
        score = x[new].astype(np.float32) @ x[every].astype(np.float32).transpose(0, 2, 1)
        left, right = member[new][:, :, None], member[every][:, None, :]
        good = (new >= 0)[:, :, None] & (every >= 0)[:, None, :] & (left != right)
        for at, to, low in ((left, right, worst[new][:, :, None]), (right, left, worst[every][:, None, :])):
            i, j, l = np.nonzero(good & (score > low))
            found.append((np.broadcast_to(at, score.shape)[i, j, l], np.broadcast_to(to, score.shape)[i, j, l], score[i, j, l].astype(float)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    u, v, s = (np.concatenate(c) for c in zip(*found))
    u, v, s, _ = best_of(u, v, s, np.ones(len(u), np.int8), k)
    return u, v, s


def build_graph(points: DataFrame, dims: int, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """Neighbour lists (u, code, v, s, st, worst) of all points (rep, vector)."""
    coded = stored(_coded(points, dims), "codes")
    n = coded.count()
    empty = [F.array().cast(t).alias(c) for c, t in (("v", "array<long>"), ("s", "array<double>"), ("st", "array<byte>"))]
    lists = stored(_merge(coded.select("u", "code", *empty).unionByName(_start(coded, n, dims, degree)), degree, SAMPLE, False), "lists")
    for turn in range(rounds):
        edge = lists.select("u", F.inline(F.arrays_zip("v", "st"))).where("st <> 1")
        both = (edge.select(F.col("u").alias("pivot"), F.col("v").alias("member"), "st")
                .unionByName(edge.select(F.col("v").alias("pivot"), F.col("u").alias("member"), "st")))
        some = Window.partitionBy("pivot").orderBy(F.desc("st"), F.xxhash64("member", "pivot", F.lit(turn)), "member")
        # the limit is applied before the shuffle too, so a point in very many lists stays a small pivot;
        # rows come out by pivot, fresh edges first
        members = (both.join(lists.select(F.col("u").alias("member"), "code", "worst"), "member")
                   .withColumn("place", F.row_number().over(some)).where(F.col("place") <= 4 * SAMPLE)
                   .select("pivot", "member", (F.col("st") == 2).alias("fresh"), "worst", "code"))

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in _by_group(batches):
                pivot, member, fresh, worst = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
                yield _rows_of(*local_joins(pivot, member, fresh, worst, _matrix(b.column(4), "<f2", dims + 1), degree))

        better = members.mapInArrow(join, _NEW)
        used = lists.select("u", "code", "v", "s", F.transform("st", lambda x: F.when(x == 2, F.lit(0)).otherwise(x).cast("byte")).alias("st"))
        lists = stored(_merge(used.unionByName(better), degree, SAMPLE, False), "lists")
        if (lists.agg(F.sum("changed")).first()[0] or 0) < QUIET * n * degree:
            break
    return lists


# ---------------------------------------------------------------- the search
def _blocks(points: DataFrame, n_blocks: int, dims: int, kind: str) -> DataFrame:
    """(block, ids, grid): vectors in blocks, ids ascending."""
    def bind(table: pa.Table) -> pa.Table:
        b = table.sort_by("rep").combine_chunks()
        x = padded(b.column("vector").chunk(0), dims).astype(kind)
        return pa.table({"block": pa.array([b.column("block")[0].as_py()], pa.int64()),
                         "ids": pa.array([b.column("rep").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "grid": pa.array([x.tobytes()], pa.binary())})

    return (points.select(F.pmod(F.xxhash64("rep"), F.lit(n_blocks)).alias("block"), "rep", "vector")
            .groupBy("block").applyInArrow(bind, "block long, ids binary, grid binary"))


def greedy(points: DataFrame, lists: DataFrame, queries: DataFrame, dims: int, beam: int = BEAM, step: int = STEP) -> DataFrame:
    """Beams (u, code, v, s, …) of the points ``queries`` (rep, vector): best
    first by inner product, u itself among them."""
    kind = "<f4" if points.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"
    width, n_blocks = np.dtype(kind).itemsize * dims, -(-points.count() // BLOCK) or 1
    blocks = stored(_blocks(points, n_blocks, dims, kind), "blocks")
    edge = lists.select("u", F.inline(F.arrays_zip("v", "s")))
    both = (edge.select(F.col("u").alias("node"), F.col("v").alias("to"), "s", F.lit(0).alias("back"))
            .unionByName(edge.select(F.col("v").alias("node"), F.col("u").alias("to"), "s", F.lit(1).alias("back"))))
    best = Window.partitionBy("node").orderBy("back", F.desc("s"), "to")
    near = stored(both.withColumn("place", F.row_number().over(best)).where(F.col("place") <= 2 * DEGREE)
                  .groupBy("node").agg(F.collect_set("to").alias("near")), "adjacency")

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = padded(b.column(1), dims).astype(kind)
            flat, one = x.tobytes(), np.ones(len(x), np.int64)
            with np.errstate(over="ignore"):
                own = np.einsum("ij,ij->i", x.astype(float), x.astype(float))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([flat[i * width:(i + 1) * width] for i in range(len(x))], pa.binary()),
                 _list_column(b.column(0).to_numpy(), one, pa.int64()), _list_column(own, one, pa.float64()),
                 _list_column(2 * one, one, pa.int8()), pa.array(np.full(len(x), -np.inf)), pa.array(np.zeros(len(x), np.int32))],
                ["u", "code", "v", "s", "st", "worst", "changed"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, u, code, worst, v): a query's candidates by block."""
        for b in batches:
            v, n = _lists(b.column(3))
            row, block = np.repeat(np.arange(len(n)), n), _lists(b.column(4))[0]
            o = np.lexsort((v, block, row))
            row, block, v = row[o], block[o], v[o]
            first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (block[1:] != block[:-1])))) if len(row) else np.zeros(0, int)
            at = pa.array(row[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[first], pa.int64()), b.column(0).take(at), b.column(1).take(at), b.column(2).take(at),
                 _list_column(v, np.diff(np.append(first, len(row))), pa.int64()), pa.nulls(len(at), pa.binary())],
                ["block", "u", "code", "worst", "v", "ids"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, grid = None, None, None
        for b in batches:
            of = b.column(0).to_numpy(zero_copy_only=False)
            for a, z in zip(*(lambda c: (c[:-1], c[1:]))(np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1], [True]))) if len(of) else np.zeros(1, int))):
                part = b.slice(a, z - a)
                if of[a] != block:              # the block's vectors come first
                    block = of[a]
                    ids = np.frombuffer(part.column(5)[0].as_py(), "<i8")
                    grid = np.frombuffer(part.column(2)[0].as_py(), kind).reshape(-1, dims).astype(float)
                    part = part.slice(1)
                if not part.num_rows:
                    continue
                q = _matrix(part.column(2), kind, dims).astype(float)
                v, n = _lists(part.column(4))
                row = np.repeat(np.arange(len(n)), n)
                at = np.searchsorted(ids, v)
                s = np.empty(len(v))
                for lo in range(0, len(v), 1 << 16):
                    cut = slice(lo, lo + (1 << 16))
                    with np.errstate(over="ignore", invalid="ignore"):
                        s[cut] = np.einsum("ij,ij->i", q[row[cut]], grid[at[cut]])
                on = s > part.column(3).to_numpy(zero_copy_only=False)[row]
                u = part.column(1).to_numpy(zero_copy_only=False)[row[on]]
                o = np.argsort(u, kind="stable")
                yield _rows_of(u[o], v[on][o], s[on][o])

    state = stored(queries.select("rep", "vector").mapInArrow(enter, _LIST), "beams")
    home = F.transform("near", lambda x: F.pmod(F.xxhash64(x), F.lit(n_blocks)))
    while state.where(F.exists("st", lambda x: x == 2)).limit(1).count():
        front = state.select("u", F.explode(F.transform(F.filter(F.arrays_zip("v", "st"), lambda x: x["st"] == 2), lambda x: x["v"])).alias("node"))
        none = {c: F.lit(None).cast(t).alias(c) for c, t in (("code", "binary"), ("worst", "double"), ("v", "array<long>"), ("near", "array<long>"))}
        reached = (front.join(near, "node").select("u", "near", none["code"], none["worst"], none["v"])
                   .unionByName(state.select("u", none["near"], "code", "worst", "v"))
                   .groupBy("u").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"),
                                     *[F.first(c, ignorenulls=True).alias(c) for c in ("code", "worst", "v")])
                   .select("u", "code", "worst", F.array_except("near", "v").alias("near"))
                   .select("u", "code", "worst", "near", home.alias("home")))
        asked = reached.mapInArrow(ask, "block long, u long, code binary, worst double, v array<long>, ids binary")
        rows = asked.unionByName(blocks.select("block", F.lit(None).cast("long").alias("u"), F.col("grid").alias("code"),
                                               F.lit(None).cast("double").alias("worst"), F.lit(None).cast("array<long>").alias("v"), "ids"))
        scored = (rows.repartition("block").sortWithinPartitions("block", F.asc_nulls_first("u")).mapInArrow(score, _NEW))
        used = state.select("u", "code", "v", "s", F.transform("st", lambda x: F.when(x == 2, F.lit(0)).otherwise(x).cast("byte")).alias("st"))
        state = stored(_merge(used.unionByName(scored), beam, step, True), "beams")
    return state


def nearest(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector: str = "embedding",
            beam: int = BEAM, graph: Callable[[DataFrame, int], DataFrame] = build_graph) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every row with ``is_query``
    (a condition on ``id``) the k nearest other rows found."""
    usable = F.col(id_col).isNotNull() & finite(vector) & F.exists(vector, lambda x: x != 0)
    base = stored(vectors.where(usable).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(vector).alias("vector")), "vectors")
    points = stored(points_of(base, k + 1), "points")
    dims = points.agg(F.max(F.size("vector"))).first()[0] or 1
    asked = stored(hot_join(base.where(is_query).select("id", "vector"), points.select("vector", "rep"), "vector").select("id", "rep"), "asked")
    queries = points.join(asked.select("rep").distinct(), "rep", "left_semi")
    beams = greedy(points, graph(points, dims), queries, dims, max(beam, k + 1))
    hits = (beams.select("u", F.inline(F.arrays_zip("v", "s"))).join(points.select(F.col("rep").alias("v"), "ids"), "v")
            .select("u", F.explode("ids").alias("vec_id"), F.col("s").alias("score")))
    first = Window.partitionBy("u").orderBy(F.desc("score"), "vec_id")
    lists = (hits.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
             .groupBy(F.col("u").alias("rep")).agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("hits")))
    own = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("id")), 1, k)
    return (hot_join(asked, lists, "rep").select(F.col("id").alias("query_id"), F.posexplode(own).alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")))
