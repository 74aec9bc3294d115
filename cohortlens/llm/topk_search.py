"""Exact top-k search by columnar branch and bound.

Candidates are stored in blocks in vertical layout (one row per dimension),
queries in small blocks. A task accumulates the integer inner products of a
query block with a candidate block a few dimensions at a time; after each
step the mass that the remaining dimensions can still add (Cauchy-Schwarz on
the norms of the rest) bounds every score from above, and candidates that
cannot reach any query's current k-th score are compacted away. Blocks hold
whole numbers in the narrowest type. A task gets a group of candidate blocks and
a group of query blocks, each block once, and holds k candidates a query, whose
k-th scores cut later blocks earlier. Sizes of blocks and groups are fixed, so a
task's memory is; a candidate is shuffled once per query group and a query once
per candidate group, blocks and vectors are never paired as rows.

Defined results: vectors that are NULL or hold NULL, NaN or infinite
components, and rows without an id, take no part; rows that repeat an id
count once (smallest vector); shorter vectors are read as padded with zeros;
equal scores go to the smaller id; scores beyond 64 bits are clipped before they are compared; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.tables import finite, stored

CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 64
DIMENSIONS_AT_ONCE = 16
BLOCK_NUMBERS = CANDIDATE_BLOCK * 64      # components of a candidate block: fewer rows of longer vectors
CANDIDATE_GROUP, QUERY_GROUP = 16, 256    # blocks of a group at most


def one_per_id(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    return (vectors.where(F.col(id_col).isNotNull() & finite(vector))
            .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(vector).alias("vector")))


def _rows(rows: list) -> np.ndarray:
    """Rows as a float matrix, padded with zeros."""
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def on_grid(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x); whole numbers of any size where that leaves the doubles."""
    with np.errstate(over="ignore"):
        grid = np.floor(scale * x)
    if np.isfinite(grid).all():
        return grid
    exact = [int(g) if math.isfinite(g) else math.floor(Fraction(v) * Fraction(scale)) for g, v in zip(grid.ravel().tolist(), x.ravel().tolist())]
    return np.array(exact, object).reshape(x.shape)


def packed(grid: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest type that holds them all."""
    if grid.dtype != object:
        low, high = grid.min(initial=0), grid.max(initial=0)
        for kind in (np.int8, np.int16, np.int32):
            if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
                return grid.astype(kind)
    return grid


def _blocks(vectors: DataFrame, n_blocks: int, scale: float) -> DataFrame:
    """(block, body): ids and the vertical grid of a block's vectors."""
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        grid = packed(on_grid(_rows(frame["vector"].tolist()), scale))
        return pd.DataFrame({"block": [int(frame["block"].iloc[0])],
                             "body": [pickle.dumps((frame["id"].to_numpy(np.int64), np.ascontiguousarray(grid.T)), 5)]})

    return (vectors.select(F.pmod(F.xxhash64("id"), F.lit(n_blocks)).alias("block"), "id", "vector")
            .groupBy("block").applyInPandas(build, "block long, body binary"))


def _wide(grid: np.ndarray, dims: int) -> np.ndarray:
    """A block's grid as numbers to reckon with, padded with zeros."""
    out = np.zeros((dims, grid.shape[1]), object if grid.dtype == object else float)
    out[:len(grid)] = grid
    return out


def branch_and_bound(q: np.ndarray, c: np.ndarray, k: int, floor: np.ndarray,
                     at_once: int = DIMENSIONS_AT_ONCE) -> tuple[np.ndarray, np.ndarray]:
    """Exact scores of the candidates (columns of ``c``) that may be among the
    k best of some query (rows of ``q``): (positions, scores). ``floor`` holds
    a score that k candidates of each query are known to reach."""
    dims = len(c)
    if q.dtype == object or c.dtype == object or dims and np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * dims >= 2 ** 53:
        exact = np.array([[int(x) for x in r] for r in q], object) @ np.array([[int(x) for x in r] for r in c], object)
        return np.arange(c.shape[1]), exact
    order = np.argsort(-np.abs(c).sum(1), kind="stable")   # heavy dimensions first
    q, c = q[:, order], c[order]
    q_rest = np.sqrt(np.cumsum((q ** 2)[:, ::-1], 1)[:, ::-1])
    pos = np.arange(c.shape[1])
    c_rest = (c ** 2).sum(0)
    if c.shape[1] > 4 * k:                                  # first k-th scores from a few whole candidates
        some = q @ c[:, :4 * k]
        floor = np.maximum(floor, np.partition(some, -k, 1)[:, -k])
    score = np.zeros((len(q), c.shape[1]))
    for d in range(0, dims, at_once):
        part = c[d:d + at_once]
        score += q[:, d:d + at_once] @ part
        c_rest = np.maximum(c_rest - (part ** 2).sum(0), 0)
        if d + at_once >= dims:
            break
        mass = q_rest[:, d + at_once:d + at_once + 1] * np.sqrt(c_rest)[None, :]
        live = (score + mass * (1 + 1e-9) + 1 >= floor[:, None]).any(0)
        if live.mean() < 0.9:
            score, c, c_rest, pos = score[:, live], c[:, live], c_rest[live], pos[live]
    return pos, score


def best_of_blocks(q_ids: np.ndarray, q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of the k best candidates of each query of a block
    among those of all ``blocks``; never more than k a query are kept."""
    at, ids, score = (np.zeros(0, np.int64) for _ in range(3))
    reached = np.full(len(q_ids), np.iinfo(np.int64).min)             # the k-th best score so far
    full = np.zeros(len(q_ids), bool)
    for c_ids, c in blocks:
        dims = max(len(q), len(c))
        # one more than k, as the query itself may be among the candidates
        pos, s = branch_and_bound(_wide(q, dims).T, _wide(c, dims) if len(c) < dims else c, k + 1,
                                  np.where(full, reached.astype(float), -np.inf))
        s = np.clip(s, -2 ** 63, 2 ** 63 - 1).astype(np.int64) if s.dtype == object else s.astype(np.int64)
        floor = reached
        if s.shape[1] > k + 1:
            floor = np.maximum(reached, np.partition(s, -(k + 1), 1)[:, -(k + 1)])
        i, j = np.nonzero(s >= floor[:, None])
        other = c_ids[pos[j]] != q_ids[i]
        i, j = i[other], j[other]
        at, ids, score = np.r_[at, i], np.r_[ids, c_ids[pos[j]]], np.r_[score, s[i, j]]
        order = np.lexsort((ids, ~score, at))                           # ~: the order of -score, also at its least value
        at, ids, score = at[order], ids[order], score[order]
        first = np.searchsorted(at, np.arange(len(q_ids)))
        on = np.arange(len(at)) - first[at] < k
        at, ids, score = at[on], ids[on], score[on]
        n = np.bincount(at, minlength=len(q_ids))
        full = n >= k
        last = np.cumsum(n) - 1
        reached[full] = score[last[full]]
    return q_ids[at], ids, score


def group_sizes(n_cand: int, n_query: int) -> tuple[int, int]:
    """Candidate and query blocks in a group: a task holds one group of each.
    At most CANDIDATE_GROUP and QUERY_GROUP blocks, fewer of small tables, so that many
    tasks share the work."""
    return min(CANDIDATE_GROUP, -(-n_cand // 16)), min(QUERY_GROUP, -(-n_query // 4))


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector: str = "embedding",
          scale: float = 64.0) -> DataFrame:
    """The k best candidates (every other id) of each query by the inner
    product of floor(scale * x): query_id, rank (from 1), vec_id, score."""
    base = stored(one_per_id(vectors, id_col, vector), "vectors")
    queries = base.where(is_query)
    n, dims = base.agg(F.count("*"), F.max(F.size("vector"))).first()
    rows = max(QUERY_BLOCK, min(CANDIDATE_BLOCK, BLOCK_NUMBERS // max(dims or 0, 1)))
    n_cand, n_query = math.ceil(n / rows) or 1, math.ceil(queries.count() / QUERY_BLOCK) or 1
    of_cand, of_query = group_sizes(n_cand, n_query)
    to = lambda blocks, size: F.explode(F.sequence(F.lit(0), F.lit(-(-blocks // size) - 1)))
    cand = _blocks(base, n_cand, scale).select(F.floor(F.col("block") / of_cand).cast("int").alias("c"),
                                               to(n_query, of_query).alias("q"), "body")
    asked = _blocks(queries, n_query, scale).select(F.floor(F.col("block") / of_query).cast("int").alias("q"),
                                                    to(n_cand, of_cand).alias("c"), "body")

    def search(c_blocks: pa.Table, q_blocks: pa.Table) -> pa.Table:
        held = [pickle.loads(x) for x in c_blocks.column("body").to_pylist()]
        dims = max((len(g) for _, g in held), default=0)
        held = [(ids, _wide(g, dims)) for ids, g in held]
        out = []
        for body in q_blocks.column("body"):
            q_ids, q = pickle.loads(body.as_py())
            out.append(best_of_blocks(q_ids, q, held, k))
        who, ids, score = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*out) if out else [()] * 3))
        return pa.table({"query_id": who, "vec_id": ids, "score": score})

    found = (cand.groupBy("c", "q").cogroup(asked.groupBy("c", "q"))
             .applyInArrow(search, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
