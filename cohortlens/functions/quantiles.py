"""Exact quantiles by weighted selection over distinct values.

Spark's exact ``percentile`` keeps a value → count map per group, which for a
global quantile over a near-unique column ends in one task holding every
distinct value. ``exact_quantiles`` selects order statistics instead:

1. all columns are unpivoted and reduced to distinct (column, value) rows with
   their counts (combined before the shuffle, so repeated values cost nothing);
2. those rows are range-partitioned by (column, value), which puts every value
   after all smaller ones, and written once;
3. the sums of counts per (partition, column), a few numbers per partition,
   tell which partition holds a wanted rank and how many values lie before it;
4. only those partitions are read again: a running sum inside them names the
   value at each rank. What comes back is one row per wanted rank.

No value list is fetched and no task holds more than a range of distinct
values. NULL and NaN are no values; infinities are.
Linear interpolation between neighbouring ranks matches numpy / DuckDB
``quantile_cont``. The same pass yields the number of distinct values.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(ci, x, n): distinct values of each column (by its place) as double."""
    pairs = ", ".join(f"{i}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
    u = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (ci, x)").where(F.col("x").isNotNull() & ~F.isnan("x"))
    return u.groupBy("ci", "x").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], buckets: int = 20_000,
                    max_collect: int = 200_000, min_distinct: int = 0) -> dict[str, list[float | None]]:
    """{col: [quantile for each p in probs]} (None for a column without
    values). Ranges hold about ``max_collect`` distinct values, or more where
    that would take over ``buckets`` ranges. Columns with at most
    ``min_distinct`` distinct values are left out of the result."""
    if not cols:
        return {}
    from cohortlens.operators.privacy import materialize, reuse
    counts = reuse(value_counts(df, cols))
    per = {r["ci"]: r for r in counts.groupBy("ci").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n")).collect()}
    wanted = [i for i in range(len(cols)) if min_distinct == 0 or (i in per and per[i]["d"] > min_distinct)]
    ranks = {i: sorted({r for p in probs for r in (math.floor(p * (per[i]["n"] - 1)), math.ceil(p * (per[i]["n"] - 1)))})
             for i in wanted if i in per}
    found: dict[tuple[int, int], float] = {}
    if ranks:
        blocks = min(buckets, max(1, -(-sum(per[i]["d"] for i in ranks) // max_collect)))
        some = counts.where(F.col("ci").isin(*ranks)) if len(ranks) < len(per) else counts
        placed = materialize(some.repartitionByRange(blocks, "ci", "x").withColumn("block", F.spark_partition_id()))
        sums = placed.groupBy("ci", "block").agg(F.sum("n").alias("n")).orderBy("ci", "block").collect()
        before: dict[int, int] = {}
        targets = []                       # (ci, block, rank inside the block, rank)
        for r in sums:
            start = before.get(r["ci"], 0)
            targets += [(r["ci"], r["block"], k - start, k) for k in ranks[r["ci"]] if start <= k < start + r["n"]]
            before[r["ci"]] = start + r["n"]
        spark = df.sparkSession
        at = F.broadcast(spark.createDataFrame(targets, "ci int, block int, inner long, rank long"))   # one row a rank
        upto = Window.partitionBy("ci", "block").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
        hit = placed.join(at.select("ci", "block").distinct(), ["ci", "block"], "left_semi").withColumn("upto", F.sum("n").over(upto))
        hit = hit.join(at, ["ci", "block"]).where((F.col("inner") < F.col("upto")) & (F.col("inner") >= F.col("upto") - F.col("n")))
        found = {(r["ci"], r["rank"]): r["x"] for r in hit.select("ci", "rank", "x").collect()}
    counts.unpersist()
    out: dict[str, list[float | None]] = {}
    for i in wanted:
        out[cols[i]] = []
        for p in probs:
            if i not in per:
                out[cols[i]].append(None)
                continue
            pos = p * (per[i]["n"] - 1)
            a, b = found[i, math.floor(pos)], found[i, math.ceil(pos)]
            out[cols[i]].append(a if a == b or pos == math.floor(pos) else a + (b - a) * (pos - math.floor(pos)))
    return out


def rank_in(grid: list[float], x: Column, strict: bool = True) -> Column:
    """Number of elements of the sorted list ``grid`` that are < x (``strict``)
    or ≤ x, for whole Arrow batches; NULL stays NULL."""
    cuts = np.array(grid, float)

    @F.pandas_udf("int")
    def place(v: pd.Series) -> pd.Series:
        at = np.searchsorted(cuts, v.to_numpy(dtype=float, na_value=np.nan), side="left" if strict else "right")
        return pd.Series(at.astype(np.int32)).astype("Int32").mask(v.isna().to_numpy())
    return place(x.cast("double"))


def sorted_count(grid, x, strict: bool = True, max_len: int = 1 << 20):
    """Number of elements of the sorted array column ``grid`` that are < x
    (``strict``) or ≤ x, by binary search in a lambda (O(log n) per row)."""
    import math as _m
    n = F.size(grid)
    steps = F.lit(max(1, _m.ceil(_m.log2(max_len + 1)) + 1))  # iterations after convergence are no-ops

    def step(acc, _i):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        v = F.element_at(grid, mid + 1)
        go_right = (v < x) if strict else (v <= x)
        return F.when(lo < hi, F.when(go_right, F.struct((mid + 1).alias("lo"), hi.alias("hi")))
                      .otherwise(F.struct(lo.alias("lo"), mid.alias("hi")))).otherwise(acc)
    init = F.struct(F.lit(0).alias("lo"), n.alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), steps), init, step)["lo"]
