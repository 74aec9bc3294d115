"""Nearest-record search (J1): exact, without a cross join, at any size.

1. Indexed rows become *distinct* vectors, so a value shared by a third of the
   rows is one point. A k-d tree on a bounded sample deals them to cells (about
   ``MAX_CELLS`` of them); wherever a cell holds more than twice
   ``leaf_size`` points, trees built inside tasks from samples of that cell
   split it further, level by level, until every bucket is small. The boxes of
   the cells are read by the driver, those of the buckets stay a table.
2. A bucket is searched inside one task, where a second k-d tree over its
   points puts them into leaves of ``IN_TASK``: the leaf a query falls into
   bounds the others, of which only those closer than the bound are visited. A
   query's vector is thus shipped once per bucket, never per leaf.
3. Rows of the query table go to the bucket they fall into first, with the
   columns to keep; equal vectors are searched once there. The best distance
   bounds the other cells, and rows that no other cell's box is close enough to
   are done: they are neither shipped nor joined again. The vectors of the others
   go on: in rounds of growing width a vector visits its next nearest cells
   whose box is closer than the bound, which tightens from round to round.
   Only vectors with cells left go into the next round. Boxes are compared for
   neighbouring queries together first (``boxes_within``), so that what a query
   costs follows the cells near it, not the number of cells.

Queries of a bucket are dealt to chunks by hash (and by the partition they come
from, so that copies of one vector spread as well) and the bucket's points
repeated per chunk, so no group is unbounded where one bucket is hot. Pairs are
never materialised as rows. Distances are direct differences in float64.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.session import materialize, reuse

# the search functions travel with the job, so workers need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_CELLS = 4096           # cells the driver's tree aims at
MAX_SPLIT = 1024           # buckets a task's tree aims at
PER_LEAF = 32              # sampled points behind a bucket of a tree
IN_TASK = 256              # points in a leaf of a task's own tree
PART = 65_536              # rows of a large cell that one task deals out at a time
_FIRST = 4                 # cells a query visits in the round after its home; four times as many in the next
_BLOCK = 4_000_000         # doubles per numpy distance block (≈ 32 MB)
_TOGETHER = 512            # neighbouring queries whose boxes are looked up together


def stats_and_count(real: DataFrame, cols: list[str]):
    """Mean, ddof-1 std (0 or undefined → 1) per column and the number of
    rows with every column present — one aggregate pass."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    r = real.agg(F.count_if(cond).alias("_n"),
                 *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    means = [r[f"m{i}"] or 0.0 for i in range(len(cols))]
    stds = [(r[f"s{i}"] if r[f"s{i}"] not in (None, 0.0) and not math.isnan(r[f"s{i}"]) else 1.0)
            for i in range(len(cols))]
    return means, stds, r["_n"]


# ----------------------------------------------------------------- k-d tree
def halve(points: np.ndarray) -> tuple[int, float | None]:
    """(dimension, value): ``x[dimension] > value`` is one side. The widest
    dimension whose median leaves a quarter on each side, else the most even;
    value None where all points coincide."""
    best = (0, 0, None)
    for d in np.argsort(points.min(axis=0) - points.max(axis=0), kind="stable"):
        col = np.sort(points[:, d])
        cut = col[(len(col) - 1) // 2]
        if cut == col[-1]:
            below = np.searchsorted(col, cut)
            if not below:
                continue
            cut = col[below - 1]
        low = int(np.searchsorted(col, cut, side="right"))
        if min(low, len(col) - low) > best[0]:
            best = (min(low, len(col) - low), int(d), float(cut))
        if 4 * best[0] >= len(col):
            break
    return best[1], best[2]


def grow(points: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
    """k-d tree with at most ``limit`` of the points in a leaf, as arrays over
    its nodes in preorder: dimension, value, right child (0: a leaf; the left
    child follows its parent), number of the leaf."""
    dim, val, right, leaf = [], [], [], []
    todo, leaves = [(points, -1)], 0
    while todo:
        pts, parent = todo.pop()
        me = len(dim)
        if parent >= 0:
            right[parent] = me
        d, cut = halve(pts) if len(pts) > limit else (0, None)
        dim.append(d)
        right.append(0)
        val.append(0.0 if cut is None else cut)
        leaf.append(leaves if cut is None else -1)
        if cut is None:
            leaves += 1
            continue
        up = pts[:, d] > cut
        todo += [(pts[up], me), (pts[~up], -1)]
    return np.array(dim), np.array(val), np.array(right), np.array(leaf)


def walk(x: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    """Leaf number of every row."""
    dim, val, right, leaf = tree
    node = np.zeros(len(x), dtype=np.int64)
    live = np.arange(len(x)) if right[0] else np.arange(0)
    while len(live):
        at = node[live]
        node[live] = np.where(x[live, dim[at]] > val[at], right[at], at + 1)
        live = live[right[node[live]] > 0]
    return leaf[node]


# ------------------------------------------------------- search in one bucket
def exact_nearest(Q: np.ndarray, R: np.ndarray, block: int = _BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Exact min squared distance from each row of Q to the rows of R and
    the first index attaining it. A BLAS expansion |q|²+|r|²−2q·r shortlists
    every r within a tolerance far above its rounding error of the
    expanded minimum; the shortlist is then recomputed by direct
    differences, so the result equals a brute-force search."""
    qn = np.einsum("ij,ij->i", Q, Q)
    rn = np.einsum("ij,ij->i", R, R)
    rmax = rn.max() if len(rn) else 0.0
    out_d = np.full(len(Q), np.inf)
    out_i = np.zeros(len(Q), dtype=np.int64)
    qb = max(1, min(len(Q), block // max(1, len(R))))
    for i in range(0, len(Q), qb):
        blk = Q[i:i + qb]
        D = qn[i:i + qb, None] + rn[None, :] - 2.0 * (blk @ R.T)
        m = D.min(axis=1)
        tol = 1e-9 * (qn[i:i + qb] + rmax + 1.0)
        qi, ri = np.nonzero(D <= (m + tol)[:, None])
        diff = blk[qi] - R[ri]
        ex = np.einsum("ij,ij->i", diff, diff)
        order = np.lexsort((ri, ex, qi))        # per query: smallest distance, then smallest index
        qi, ri, ex = qi[order], ri[order], ex[order]
        first = np.ones(len(qi), dtype=bool)
        first[1:] = qi[1:] != qi[:-1]
        out_d[i + qi[first]] = ex[first]
        out_i[i + qi[first]] = ri[first]
    return out_d, out_i


def box_distances(Q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance of every query to every box (0 inside)."""
    out = np.zeros((len(Q), len(lo)))
    for j in range(Q.shape[1]):
        gap = np.maximum(np.maximum(lo[None, :, j] - Q[:, j, None], Q[:, j, None] - hi[None, :, j]), 0)
        out += gap * gap
    return out


def boxes_within(Q: np.ndarray, limit: np.ndarray, home: np.ndarray, lo: np.ndarray, hi: np.ndarray
                 ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, boxes, far): for groups of at most ``_TOGETHER`` queries of one
    ``home``, the boxes that may lie within a query's ``limit`` and the squared
    distances (inf beyond it). Boxes out of reach of the box around a whole group
    are left out without a look at its queries."""
    order = np.lexsort((limit, home))
    cuts = np.flatnonzero(np.r_[True, np.diff(home[order]) != 0, True])
    for a, b in zip(cuts[:-1], cuts[1:]):
        for i in range(a, b, _TOGETHER):
            rows = order[i:min(i + _TOGETHER, b)]
            q, most = Q[rows], limit[rows]
            low, high, far = q.min(axis=0), q.max(axis=0), np.zeros(len(lo))
            for j in range(q.shape[1]):
                gap = np.maximum(np.maximum(lo[:, j] - high[j], low[j] - hi[:, j]), 0)
                far += gap * gap
            boxes = np.flatnonzero(far <= most.max())
            if len(boxes):
                far = box_distances(q, lo[boxes], hi[boxes])
                far[far > most[:, None]] = np.inf
                yield rows, boxes, far


def slack(d2, ties: bool):
    """Box distances up to this may hold a nearer point (or an equally near
    one, if ``ties`` matter; else a distance of 0 cannot be beaten)."""
    s = d2 * (1 + 1e-9) + 1e-12
    return s if ties else np.where(d2 > 0, s, -1.0)


def nearest_in(Q: np.ndarray, R: np.ndarray, ties: bool, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``exact_nearest``, by a k-d tree over R: the leaf a query falls into,
    then the leaves within the distance found there, nearest first."""
    if len(R) <= 2 * leaf:
        return exact_nearest(Q, R)
    tree = grow(R, leaf)
    at = walk(R, tree)
    order = np.argsort(at, kind="stable")
    start = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])    # every leaf has points: they are numbered in order
    end = np.r_[start[1:], len(R)]
    S = R[order]
    lo, hi = np.minimum.reduceat(S, start, axis=0), np.maximum.reduceat(S, start, axis=0)
    d2, arg = np.full(len(Q), np.inf), np.full(len(Q), len(R), dtype=np.int64)

    def visit(b: int, rows: np.ndarray) -> None:
        e, j = exact_nearest(Q[rows], S[start[b]:end[b]])
        j = order[start[b] + j]
        better = (e < d2[rows]) | ((e == d2[rows]) & (j < arg[rows]))
        d2[rows[better]], arg[rows[better]] = e[better], j[better]

    home = walk(Q, tree)
    by_home = np.argsort(home, kind="stable")
    for rows in np.split(by_home, np.flatnonzero(np.diff(home[by_home])) + 1):
        if len(rows):
            visit(home[rows[0]], rows)
    for rows, boxes, far in boxes_within(Q, slack(d2, ties), home, lo, hi):
        far[:, boxes == home[rows[0]]] = np.inf
        for k in np.argsort(far.min(axis=0), kind="stable"):
            on = far[:, k] < np.inf
            on &= far[:, k] <= slack(d2[rows], ties)
            if on.any():
                visit(boxes[k], rows[on])
    return d2, arg


def home_cells(Q: np.ndarray, tree: tuple[np.ndarray, ...], lo: np.ndarray, hi: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The cell every query falls into; the nearest one where that got no point."""
    cell = walk(Q, tree)
    none = np.flatnonzero(~np.isin(cell, ids))
    if len(none):
        cell[none] = ids[box_distances(Q[none], lo, hi).argmin(axis=1)]
    return cell


def distinct_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first of every distinct row, number of each row's distinct one)."""
    x = np.ascontiguousarray(x)
    _, first, of = np.unique(x.view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel(), return_index=True, return_inverse=True)
    return first, of


def matrix(table: pa.Table, cols: list[str]) -> np.ndarray:
    """Double columns of an Arrow table as rows of a matrix; NULL is NaN."""
    return np.column_stack([np.asarray(table.column(c).to_numpy(), dtype=np.float64) for c in cols])


class NearestIndex:
    """Exact Euclidean nearest rows of one table: built once, searched for any
    number of query tables. ``cols``: numeric columns (z-scored with ``stats``
    = (means, stds), by default the table's own, when ``standardize``); or
    ``vector_col``: an array column used as is. ``payload``: a column returned
    (as text) for the nearest row, the smallest among equidistant ones. Rows
    with a NULL or NaN feature take no part. ``leaf_size``: points in a bucket
    aimed at (by default 32,768, fewer of more than 32 features); at most twice
    as many are searched by a task."""

    def __init__(self, real: DataFrame, cols: list[str] | None = None, vector_col: str | None = None,
                 standardize: bool = True, leaf_size: int | None = None, seed: int = 42, payload: str | None = None,
                 stats=None, max_cells: int = MAX_CELLS, max_split: int = MAX_SPLIT, in_task: int | None = None):
        self.ties, self.max_split = payload is not None, max_split
        n = None
        if vector_col:
            dim = real.select(F.max(F.size(vector_col))).first()[0] or 0
            self.features = [F.col(vector_col).cast("array<double>")[i] for i in range(dim)]
        else:
            if stats is not None:
                means, stds = stats
            elif standardize:
                means, stds, n = stats_and_count(real, cols)
            else:
                means, stds = [0.0] * len(cols), [1.0] * len(cols)
            self.features = [(F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(cols, means, stds)]
        self.z = [f"_z{i}" for i in range(len(self.features))]
        # buckets and chunks follow the width of a vector: 8 MB and 4 MB of doubles at most
        dims = max(1, len(self.z))
        leaf_size = self.leaf_size = leaf_size or min(32_768, max(1024, (1 << 20) // dims))
        self.in_task = in_task or max(IN_TASK, 64 * dims if dims > 16 else 0)    # many dimensions leave no leaf out
        self.chunk = min(32_768, max(512, (1 << 19) // dims))
        self.columns = ", ".join(f"{c} double" for c in self.z)
        self.carried, self.text = (["p"], ", p string") if payload else ([], "")      # a payload travels where there is one
        rows = real.select(*self.vectors(), *([F.col(payload).cast("string").alias("p")] if payload else [])).where(self.valid())
        self.empty = not self.z
        self.splits = 0
        if self.empty:
            return
        # cells follow the row count (an upper bound of the distinct one) and a bounded
        # sample of raw rows: no job has to wait for the distinct vectors
        n = n if n is not None else rows.count()
        want = min(max_cells, math.ceil(n / leaf_size))
        sample = []
        if want > 1:
            target = max(4096, PER_LEAF * want)
            sample = rows.select(*self.z).sample(fraction=min(1.0, 1.2 * target / n), seed=seed).collect()
        pts = np.unique(np.array([list(r) for r in sample], dtype=np.float64).reshape(-1, len(self.z)), axis=0)
        self.tree = tree = grow(pts, math.ceil(len(pts) / max(want, 1)))
        z = self.z

        def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                if f.duplicated(z).any():                  # copies leave a batch as one row, a bucket's task merges the rest
                    f = f.sort_values("p", kind="stable", na_position="last").drop_duplicates(z)
                yield f.assign(bucket=walk(f[z].to_numpy(dtype=np.float64), tree))

        # a minimum of texts would sort the whole table: with a payload rows become distinct in tasks
        self.points = reuse(rows.mapInPandas(deal, f"{self.columns}{self.text}, bucket long") if payload else
                            rows.dropDuplicates(z).withColumn("bucket", self._place(lambda x: walk(x, tree))))
        boxes = self._boxes(self.points, "bucket").collect()       # about MAX_CELLS rows
        self.empty = not boxes
        self.cell = np.array([b["bucket"] for b in boxes], dtype=np.int64)
        self.lo = np.array([[b[f"lo{j}"] for j in range(len(z))] for b in boxes]).reshape(len(boxes), len(z))
        self.hi = np.array([[b[f"hi{j}"] for j in range(len(z))] for b in boxes]).reshape(len(boxes), len(z))
        largest = max((b["n"] for b in boxes), default=0)
        while largest > 2 * leaf_size and self.splits < 3:         # 4 trillion buckets
            self._split()
            largest = self.points.groupBy("bucket").count().agg(F.max("count")).first()[0]
        if self.splits:
            cell = F.shiftright("bucket", 16 * self.splits)
            self.buckets = reuse(self._boxes(self.points, "bucket").withColumn("cell", cell))

    def vectors(self) -> list[Column]:
        return [f.alias(c) for f, c in zip(self.features, self.z)]

    def valid(self) -> Column:
        ok = F.lit(True)
        for c in self.z:
            ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
        return ok

    def _place(self, cells: Callable[[np.ndarray], np.ndarray]) -> Column:
        """The cell of every row, -1 where a feature is missing. Tasks' Python gets the
        vectors and gives back a number: to send whole rows there and back costs more than the search for the cell."""
        def place(*features: pd.Series) -> pd.Series:
            x = np.column_stack([f.to_numpy(dtype=np.float64) for f in features])
            there = np.flatnonzero(~np.isnan(x).any(axis=1))
            cell = np.full(len(x), -1, dtype=np.int64)
            cell[there] = cells(x[there])
            return pd.Series(cell)

        return F.pandas_udf(place, "long")(*self.z)

    def _boxes(self, points: DataFrame, by: str) -> DataFrame:
        return points.groupBy(by).agg(F.count(F.lit(1)).alias("n"),
                                      *[F.min(c).alias(f"lo{i}") for i, c in enumerate(self.z)],
                                      *[F.max(c).alias(f"hi{i}") for i, c in enumerate(self.z)])

    def _split(self) -> None:
        """Every bucket above twice ``leaf_size`` is dealt out by a tree that a
        task grows from its own sample; ids gain 16 bits (a tree
        has no more leaves than sampled points)."""
        z, size, most, kept = self.z, self.leaf_size, self.max_split, [*self.z, *self.carried]
        counts = self.points.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        large = reuse(counts.where(F.col("n") > 2 * size).withColumn(
            "want", F.least(F.ceil(F.col("n") / size), F.lit(most))).withColumn(
            "parts", F.ceil(F.col("n") / PART).cast("int")))
        unit = F.pmod(F.xxhash64(*z), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sample = self.points.join(large, "bucket").where(
            unit * F.col("n") < F.greatest(F.col("want") * PER_LEAF, F.lit(256)))

        def plant(f: pd.DataFrame) -> pd.DataFrame:
            pts = f[z].to_numpy(dtype=np.float64)
            tree = grow(pts, math.ceil(len(pts) / int(f["want"].iloc[0])))
            return pd.DataFrame({"bucket": [int(f["bucket"].iloc[0])], "tree": [pickle.dumps(tree, 5)]})

        trees = sample.select("bucket", "want", *z).groupBy("bucket").applyInPandas(plant, "bucket long, tree binary")
        trees = trees.join(large.select("bucket", "parts"), "bucket").select(
            "bucket", "tree", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        marked = self.points.join(large.select("bucket", "parts"), "bucket", "left")
        rows = marked.where("parts IS NOT NULL").withColumn("part", F.pmod(F.xxhash64(*z), "parts").cast("int"))

        def deal(_key, f: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
            out = f[[*kept, "bucket"]].copy()
            out["bucket"] *= 65_536
            if len(t) and len(f):
                out["bucket"] += walk(f[z].to_numpy(dtype=np.float64), pickle.loads(t["tree"].iloc[0]))
            return out

        dealt = (rows.select(*kept, "bucket", "part").groupBy("bucket", "part")
                 .cogroup(trees.groupBy("bucket", "part"))
                 .applyInPandas(deal, f"{self.columns}{self.text}, bucket long"))
        small = marked.where("parts IS NULL").select(*kept, (F.col("bucket") * 65_536).alias("bucket"))
        self.points = materialize(small.unionByName(dealt))
        self.splits += 1

    def _nearest(self):
        """(Q, points, payloads) → (squared distances, payloads) of distinct queries, for the tasks."""
        ties, leaf = self.ties, self.in_task

        def nearest(Q: np.ndarray, R: np.ndarray, p: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
            if not len(R) or not len(Q):
                return np.full(len(Q), np.inf), np.full(len(Q), None, dtype=object) if ties else None
            if ties:
                by = pd.Series(p, dtype=object).sort_values(kind="stable", na_position="last").index.to_numpy()
                R, p = R[by], p[by]
                first = np.sort(distinct_rows(R)[0])       # the smallest payload of every point, payloads still in order
                R, p = R[first], p[first]
            d2, arg = nearest_in(Q, R, ties, leaf)
            return d2, p[np.minimum(arg, len(R) - 1)] if ties else None

        return nearest

    def _dealt(self, queries: DataFrame, chunk: int, passing: list[DataFrame], *salt: Column) -> tuple[DataFrame, DataFrame]:
        """Points and queries by (bucket, ch), ch a chunk of the bucket's queries. What is persisted for it joins ``passing``."""
        z = self.z
        chunks = reuse(queries.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks")))
        passing.append(chunks)
        few = (lambda x: x) if self.splits else F.broadcast          # a row a cell, about MAX_CELLS
        q = queries.join(few(chunks), "bucket").withColumn("ch", F.pmod(F.xxhash64(*z, *salt), "chunks").cast("int")).drop("chunks")
        r = self.points.join(few(chunks), "bucket").withColumn("ch", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        return r.select("bucket", "ch", *z, *self.carried).groupBy("bucket", "ch"), q.groupBy("bucket", "ch")

    def _search(self, queries: DataFrame, chunk: int, passing: list[DataFrame]) -> DataFrame:
        """(z…, bucket) → (z…, bucket, d2[, p]): nearest point of that bucket."""
        z, ties, nearest = self.z, self.ties, self._nearest()

        def run(r: pa.Table, q: pa.Table) -> pa.Table:
            d2, p = nearest(matrix(q, z), matrix(r, z), r.column("p").to_pandas().to_numpy(dtype=object) if ties else None)
            out = q.select([*z, "bucket"]).append_column("d2", pa.array(d2))
            return out.append_column("p", pa.array(p, pa.string())) if ties else out

        r, q = self._dealt(queries.select(*z, F.col("bucket").alias("bucket")), chunk, passing)     # no column of the points' own
        return r.cogroup(q).applyInArrow(run, f"{self.columns}, bucket long, d2 double{self.text}")

    def _first(self, placed: DataFrame, kept: list[T.StructField], chunk: int, passing: list[DataFrame]) -> DataFrame:
        """Rows with their home bucket (-1: a feature is missing) → (kept…, z…,
        bucket, d2[, p], open): nearest point of that bucket, and whether another
        cell may hold a nearer one; z and bucket of open rows alone. Equal vectors
        of a chunk are searched once."""
        z, ties, nearest, lo, hi, ids, whole = self.z, self.ties, self._nearest(), self.lo, self.hi, self.cell, not self.splits
        names = [f.name for f in kept]

        def run(r: pa.Table, q: pa.Table) -> pa.Table:
            Q, home = matrix(q, z), q.column("bucket").to_numpy()
            d2, p, open_ = np.full(len(Q), np.nan), np.full(len(Q), None, dtype=object), np.zeros(len(Q), dtype=bool)
            if len(Q) and home[0] >= 0:
                first, of = distinct_rows(Q)
                D = Q[first]
                best, text = nearest(D, matrix(r, z), r.column("p").to_pandas().to_numpy(dtype=object) if ties else None)
                left = np.zeros(len(D), dtype=bool)
                for rows, boxes, far in boxes_within(D, slack(best, ties), home[first], lo, hi):
                    if whole:
                        far[:, ids[boxes] == home[0]] = np.inf
                    left[rows] = (far < np.inf).any(axis=1)
                d2, open_ = best[of], left[of]
                p = text[of] if ties else p
            # vectors are needed of open rows alone: of the others they would be most of what is written
            gone = pa.array(~open_)
            out = q.select(names)
            for c in [*z, "bucket"]:
                out = out.append_column(c, pc.if_else(gone, pa.scalar(None, q.column(c).type), q.column(c)))
            out = out.append_column("d2", pa.array(d2, from_pandas=True))
            if ties:
                out = out.append_column("p", pa.array(p, pa.string()))
            return out.append_column("open", pa.array(open_))

        r, q = self._dealt(placed, chunk, passing, F.spark_partition_id())
        double, text = T.DoubleType(), [T.StructField("p", T.StringType())] if ties else []
        return r.cogroup(q).applyInArrow(run, T.StructType(
            [*kept, *[T.StructField(c, double) for c in z], T.StructField("bucket", T.LongType()), T.StructField("d2", double),
             *text, T.StructField("open", T.BooleanType())]))

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows with the bucket they fall into; -1 where a feature is missing."""
        z, tree, lo, hi, ids = self.z, self.tree, self.lo, self.hi, self.cell
        if self.splits:
            homes = self._targets(self._homes(rows.select(*z).where(self.valid()).dropDuplicates(z)), True)
            return rows.join(homes, z, "left").withColumn("bucket", F.coalesce("bucket", F.lit(-1)))
        return rows.withColumn("bucket", self._place(lambda x: home_cells(x, tree, lo, hi, ids)))

    def _homes(self, queries: DataFrame) -> DataFrame:
        """(z…) → (z…, home, d2, cell): the cell the driver's tree deals a query to."""
        z, tree, lo, hi, ids = self.z, self.tree, self.lo, self.hi, self.cell

        def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                cell = home_cells(f[z].to_numpy(dtype=np.float64), tree, lo, hi, ids)
                yield f.assign(home=np.int64(-1), d2=np.inf, cell=cell)

        return queries.mapInPandas(place, f"{self.columns}, home long, d2 double, cell long")

    def _cells(self, queries: DataFrame, since: int, width: int) -> DataFrame:
        """(z…, bucket, d2) → (z…, home, d2, cell, more): cells number ``since`` up to
        ``since + width`` in order of their boxes' distance, while closer than
        d2, and whether others follow. A home cell that is one bucket is not listed again."""
        z, ties, lo, hi, ids, whole = self.z, self.ties, self.lo, self.hi, self.cell, not self.splits
        at = slice(since - 1, since - 1 + width)

        def list_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                Q, home = f[z].to_numpy(dtype=np.float64), f["bucket"].to_numpy()
                parts = []
                for rows, boxes, far in boxes_within(Q, slack(f["d2"].to_numpy(), ties), home, lo, hi):
                    if whole:                                 # searched in the first round
                        far[ids[boxes][None, :] == home[rows][:, None]] = np.inf
                    order = np.argsort(far, axis=1, kind="stable")[:, at]
                    qi, k = np.nonzero(np.take_along_axis(far, order, 1) < np.inf)
                    more = (far < np.inf).sum(axis=1) > at.stop
                    parts.append((rows[qi], ids[boxes[order[qi, k]]], more[qi]))
                if parts:
                    rows, cell, more = (np.concatenate(c) for c in zip(*parts))
                    out = f.iloc[rows][[*z, "bucket", "d2"]].rename(columns={"bucket": "home"})
                    yield out.assign(cell=cell, more=more)

        return queries.select(*z, "bucket", "d2").mapInPandas(
            list_cells, f"{self.columns}, home long, d2 double, cell long, more boolean")

    def _targets(self, cells: DataFrame, first: bool) -> DataFrame:
        """(z…, bucket): the buckets of the listed cells closer than d2 (the
        nearest one alone in the first round)."""
        z = self.z
        if not self.splits:
            return cells.select(*z, F.col("cell").alias("bucket"))
        far = sum((F.pow(F.greatest(F.col(f"lo{i}") - F.col(c), F.col(c) - F.col(f"hi{i}"), F.lit(0.0)), 2)
                   for i, c in enumerate(z)), F.lit(0.0))
        open_ = cells.join(self.buckets, "cell").withColumn("far", far)
        if first:
            return open_.groupBy(*z).agg(F.min(F.struct("far", "bucket"))["bucket"].alias("bucket"))
        return open_.where((F.col("far") <= F.col("d2") * (1 + 1e-9) + 1e-12) & (F.col("bucket") != F.col("home"))
                           ).select(*z, "bucket")

    def search(self, queries: DataFrame, keep: list[str] | None = None, chunk: int | None = None) -> DataFrame:
        """(keep…, dcr, nn_payload) for every row of ``queries``; NULL where a
        feature is NULL or NaN, or the index holds no row. ``chunk``: queries of a bucket
        that a task takes at once (by default 32,768, fewer of more than 16 features)."""
        keep, z, chunk = list(keep or []), self.z, chunk or self.chunk
        if self.empty:
            return queries.select(*keep, F.lit(None).cast("double").alias("dcr"),
                                  F.lit(None).cast("string").alias("nn_payload"))
        at = [f"_k{i}" for i in range(len(keep))]
        rows = queries.select(*[F.col(c).alias(k) for c, k in zip(keep, at)], *self.vectors())
        kept = [T.StructField(f.name, f.dataType) for f in rows.schema.fields[:len(keep)]]
        passing = [reuse(self._placed(rows))]
        every = materialize(self._first(passing[0], kept, chunk, passing))    # written: plans on top of it stay small
        let_go_of(passing)

        def result(found: DataFrame) -> DataFrame:
            payload = F.col("p") if self.ties else F.lit(None).cast("string")
            return found.select(*[F.col(k).alias(c) for c, k in zip(keep, at)], F.sqrt("d2").alias("dcr"), payload.alias("nn_payload"))

        live = materialize(every.where("open").select(*z, "bucket", "d2", *self.carried).dropDuplicates(z))
        if live.isEmpty():
            return result(every)
        found, since, width = [live.select(*z, "d2", *self.carried)], 1, _FIRST
        while since < len(self.cell) + bool(self.splits):
            listed = reuse(self._cells(live, since, width))
            targets = reuse(self._targets(listed, False))
            passing += [listed, targets]
            if targets.isEmpty() and not self.splits:
                break                     # cells come in order of distance: none was left within the bound
            found.append(reuse(self._search(targets, chunk, passing).select(*z, "d2", *self.carried)))
            passing.append(found[-1])
            more = listed.where("more").select(*z, F.col("home").alias("bucket"), "d2")
            if more.isEmpty():
                break
            tighter = found[-1].select(*z, F.lit(None).cast("long").alias("bucket"), "d2")
            # written, so that a round's plan does not hold those of all rounds before it
            live = materialize(more.unionByName(tighter).groupBy(*z).agg(F.max("bucket").alias("bucket"), F.min("d2").alias("d2"))
                               .where("bucket IS NOT NULL"))
            since, width = since + width, 4 * width
        best = found[0]
        for f in found[1:]:
            best = best.unionByName(f)
        if self.ties:
            best = best.groupBy(*z).agg(F.min(F.struct("d2", "p")).alias("_b")).select(*z, "_b.*")
        else:
            best = best.groupBy(*z).agg(F.min("d2").alias("d2"))
        best = materialize(best)
        let_go_of(passing)
        open_ = every.where("open").select(*at, *z).join(best, z)
        return result(every.where("NOT open")).unionByName(result(open_))


def let_go_of(frames: list[DataFrame]) -> None:
    """Drop persisted intermediates whose reader has been written."""
    while frames:
        frames.pop().unpersist()


def nearest_distance(real: DataFrame, synth: DataFrame, cols: list[str] | None = None,
                     keep: list[str] | None = None, chunk: int | None = None, payload: str | None = None, **index) -> DataFrame:
    """Exact Euclidean distance from every synthetic row to its nearest real
    row: (keep..., dcr), and with ``payload`` nn_payload. A ``NearestIndex`` of
    ``real`` (its arguments go there), searched once."""
    out = NearestIndex(real, cols, payload=payload, **index).search(synth, keep, chunk)
    return out if payload else out.drop("nn_payload")
