"""Fidelity operators: correlation (A7–A9), column shapes / KS (M1–M3),
histograms and box statistics (A10), moments (A13), density overlap (D5).

Scale notes
* Correlations: one pass for counts, extremes and means, one for the sums of
  products of centred values (k(k+1)/2 accumulators, one row shuffled per
  task). Pairs with a column that has NULLs keep their own moments, over the
  rows where both are present.
* KS: the two tables are unpivoted and reduced to distinct (column, value)
  counts first; the empirical CDFs come from a *two-level* prefix sum — value
  blocks by approximate quantiles, block totals with a tiny window, then a
  window per (column, block) — so no task ever holds a whole column.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.expr import br, kolmogorov_sf, r6

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ------------------------------------------------------------- A7 correlation
def _pair_list(cols, diagonal=True):
    return [(a, b) for i, a in enumerate(cols) for b in cols[(i if diagonal else i + 1):]]


WIDE_PAIRS = 1000   # pairs aggregated in one plan (44 columns)


def correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation, long form (col_a, col_b, corr) for all k×k
    ordered pairs (diagonal included). Each pair is computed over the rows
    where both are present (means and deviations too). A column that is
    constant there → NULL (pandas NaN). Wide tables are aggregated a block of
    pairs at a time, so no plan holds more than WIDE_PAIRS of them."""
    cols = list(cols)
    cast = [F.col(c).cast("double") for c in cols]
    st = df.agg(F.count(F.lit(1)).alias("n"), *[f(x).alias(f"{p}{i}") for i, x in enumerate(cast)
                                                for f, p in ((F.count, "n"), (F.min, "a"), (F.max, "b"), (F.avg, "m"))]).first()
    whole = {c: st[f"n{i}"] == st["n"] for i, c in enumerate(cols)}       # no NULL: every pair covers all rows
    flat = {c: st[f"a{i}"] is None or st[f"a{i}"] == st[f"b{i}"] for i, c in enumerate(cols)}
    mean = {c: st[f"m{i}"] or 0.0 for i, c in enumerate(cols)}

    def cell(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        if whole[a] and whole[b]:
            if flat[a] or flat[b]:
                return F.lit(None).cast("double")
            if a == b:
                return F.lit(1.0)
            # sums of products of centred values; the squares are shared by all pairs of a column
            x, y = x - F.lit(mean[a]), y - F.lit(mean[b])
            return F.try_divide(F.sum(x * y), F.sqrt(F.sum(x * x)) * F.sqrt(F.sum(y * y)))
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        spread = (F.max(x) > F.min(x)) & (F.max(y) > F.min(y))
        return F.when(spread, F.lit(1.0) if a == b else F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)))

    pairs = _pair_list(cols)
    out = None
    for at in range(0, len(pairs), WIDE_PAIRS):
        some = pairs[at:at + WIDE_PAIRS]
        aggs = [cell(a, b).alias(f"r{n}") for n, (a, b) in enumerate(some)]
        rows = ", ".join(f"'{a}', '{b}', r{n}" for n, (a, b) in enumerate(some))
        rows += "".join(f", '{b}', '{a}', r{n}" for n, (a, b) in enumerate(some) if a != b)
        k = len(some) + sum(a != b for a, b in some)
        part = df.agg(F.count(F.lit(1)).alias("_n"), *aggs).selectExpr(f"stack({k}, {rows}) AS (col_a, col_b, corr)")
        out = part if out is None else out.unionByName(part)
    return out


def corr_mae(real: DataFrame, synth: DataFrame, cols: list[str], dp: int | None = 4,
             corr: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Mean |corr_r − corr_s| over all k² cells, NaN → 0 (A8). ``corr``: the
    two tables' correlations, where they are known already."""
    r, s = corr or (correlation(real, cols), correlation(synth, cols))
    r, s = r.withColumnRenamed("corr", "cr"), s.withColumnRenamed("corr", "cs")
    m = r.join(s, ["col_a", "col_b"]).agg(
        F.avg(F.abs(F.coalesce("cr", F.lit(0.0)) - F.coalesce("cs", F.lit(0.0)))).alias("mae"))
    return m.select((br(F.col("mae"), dp) if dp is not None else F.col("mae")).alias("corr_matrix_mae"))


def pairwise_trends(real: DataFrame, synth: DataFrame, cols: list[str], profile: str = "core",
                    first: int | None = None, corr: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Share of column pairs whose correlation trend is preserved (A9). ``corr`` as in ``corr_mae``.

    core: all pairs i<j, sign(r) == sign(s), NULL never matches.
    full: both > 0, both < 0, or both |r| < 0.05. ``first`` takes the pairs
    among the first so many columns only."""
    cols = list(cols)[:first]
    order = {(a, b): n for n, (a, b) in enumerate(_pair_list(cols, diagonal=False))}
    keep = F.create_map(*[x for (a, b) in order for x in (F.lit(f"{a}|{b}"), F.lit(True))])
    r, s = corr or (correlation(real, cols), correlation(synth, cols))
    r, s = r.withColumnRenamed("corr", "cr"), s.withColumnRenamed("corr", "cs")
    j = r.join(s, ["col_a", "col_b"]).where(
        F.coalesce(keep[F.concat_ws("|", "col_a", "col_b")], F.lit(False)))
    if profile == "core":
        match = F.coalesce(F.signum("cr") == F.signum("cs"), F.lit(False))
        total = F.count(F.lit(1))
        return j.agg(F.count_if(match).alias("m"), total.alias("t")).select(
            br(F.col("m") / F.greatest(F.col("t"), F.lit(1)) * 100, 1).alias("trend_accuracy_pct"),
            F.col("m").alias("pairs_matched"), F.col("t").alias("pairs_total"))
    cr, cs = F.col("cr"), F.col("cs")
    match = F.coalesce(((cr > 0) & (cs > 0)) | ((cr < 0) & (cs < 0))
                       | ((F.abs(cr) < 0.05) & (F.abs(cs) < 0.05)), F.lit(False))
    return j.agg(F.count_if(match).alias("m"), F.count(F.lit(1)).alias("t")).select(
        br(F.col("m") / F.greatest(F.col("t"), F.lit(1)) * 100, 1).alias("trend_accuracy_pct"),
        F.col("t").alias("pairs_checked"))


# ------------------------------------------------------------------ M1 KS
def unpivot(df: DataFrame, cols: list[str], value: str = "value") -> DataFrame:
    """(column, value DOUBLE) rows, NULL values dropped."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, {value})").where(F.col(value).isNotNull())


def ks_statistics(real: DataFrame, synth: DataFrame, cols: list[str], block_values: int = 20_000) -> DataFrame:
    """Two-sample KS statistic per column with sizes: (column, ks_statistic,
    n_real, n_synth). Exact: sup |F_r − F_s| over all observed values. Blocks
    hold about ``block_values`` distinct values of a column, however many
    there are."""
    u = (unpivot(real, cols).withColumn("_s", F.lit(0))
         .unionByName(unpivot(synth, cols).withColumn("_s", F.lit(1))))
    from cohortlens.operators.privacy import reuse
    # distinct (feature, value) counts feed four branches below: read the tables once
    h = reuse(u.groupBy("feature", "value").agg(F.sum(1 - F.col("_s")).alias("cr"), F.sum("_s").alias("cs")))
    # blocks are ranges: rows are range-partitioned by (feature, value), so a block is a partition
    n_blocks = max(1, -(-h.count() // block_values))
    from cohortlens.operators.privacy import materialize
    hb = materialize(h.repartitionByRange(n_blocks, "feature", "value").withColumn("blk", F.spark_partition_id()))
    tot = hb.groupBy("feature", "blk").agg(F.sum("cr").alias("br_"), F.sum("cs").alias("bs_"))
    wb = Window.partitionBy("feature").orderBy("blk")
    wc = Window.partitionBy("feature")
    off = tot.select(
        "feature", "blk",
        F.coalesce(F.sum("br_").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("or_"),
        F.coalesce(F.sum("bs_").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("os_"),
        F.sum("br_").over(wc).alias("nr"), F.sum("bs_").over(wc).alias("ns"))
    wv = Window.partitionBy("feature", "blk").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    cum = hb.join(off, ["feature", "blk"]).select(
        "feature", "nr", "ns",
        ((F.col("or_") + F.sum("cr").over(wv)) / F.col("nr")
         - (F.col("os_") + F.sum("cs").over(wv)) / F.col("ns")).alias("gap"))
    return cum.groupBy("feature").agg(F.max(F.abs("gap")).alias("ks_statistic"),
                                     F.first("nr").cast("bigint").alias("n_real"),
                                     F.first("ns").cast("bigint").alias("n_synth"))


def ks_pvalue(d: Column, n_real: Column, n_synth: Column) -> Column:
    """Asymptotic two-sided p-value: Kolmogorov survival at sqrt(en)·d,
    en = n·m/(n+m)."""
    en = n_real.cast("double") * n_synth.cast("double") / (n_real + n_synth).cast("double")
    return kolmogorov_sf(F.sqrt(en) * d)


# ---------------------------------------------------- M2 exact small samples
EXACT_ROWS = 10_000      # largest n, m for the exact law, as the reference's test does


def ks_exact_pvalue(d: float, n: int, m: int) -> float:
    """P(D >= d) of the two-sided two-sample statistic under the null, by the
    lattice-path recursion: among the paths from (0, 0) to (n, m), all equally
    likely, the share that meets |i/n - j/m| >= d somewhere. Path counts are kept
    as probabilities of having stayed inside, one diagonal at a time, so nothing
    overflows; a diagonal holds at most min(n, m) + 1 numbers."""
    if n > m:
        n, m = m, n
    if n == 0 or d <= 0:
        return 1.0
    lcm = n // math.gcd(n, m) * m
    step, limit = (lcm // n, lcm // m), math.ceil(d * lcm - 1e-9)     # steps of i and j; the strip ends at limit
    inside = np.zeros(n + 1)
    inside[0] = 1.0
    i = np.arange(n + 1)
    for k in range(1, n + m + 1):
        j = k - i
        # a path of n + m steps is at (i, j) after k of them; its last step came from (i - 1, j) or (i, j - 1)
        from_left = np.concatenate(([0.0], inside[:-1])) * (n - (i - 1)) / (n + m - k + 1)
        from_below = inside * (m - (j - 1)) / (n + m - k + 1)
        inside = from_left + from_below
        inside[(j < 0) | (j > m) | (np.abs(i * step[0] - j * step[1]) >= limit)] = 0.0
    return float(min(max(1.0 - inside[n], 0.0), 1.0))


def ks_pvalues(stats: DataFrame, col: str = "_p", exact_rows: int = EXACT_ROWS) -> DataFrame:
    """``stats`` (ks_statistic, n_real, n_synth) with the p-value: exact where
    both samples have at most ``exact_rows`` rows, the asymptotic series beyond.
    One recursion per column, each in the task that holds its row."""
    limit = exact_rows

    @F.pandas_udf("double")
    def exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([ks_exact_pvalue(x, int(a), int(b)) if max(a, b) <= limit else None for x, a, b in zip(d, n, m)], dtype="float64")

    return stats.withColumn(col, F.coalesce(F.nanvl(exact("ks_statistic", "n_real", "n_synth"), F.lit(None).cast("double")),
                                            ks_pvalue(F.col("ks_statistic"), F.col("n_real"), F.col("n_synth"))))


def ks_columns(real: DataFrame, synth: DataFrame, cols: list[str], pvalue: bool = True) -> DataFrame:
    """Per column KS statistic and p-value, both rounded to 4 dp (core
    report's per-column section)."""
    k = ks_statistics(real, synth, cols)
    if pvalue:  # p from the unrounded statistic (computed before the rounding projection)
        k = ks_pvalues(k)
    return k.select("feature", br(F.col("ks_statistic"), 4).alias("ks_statistic"),
                    *([br(F.col("_p"), 4).alias("p_value")] if pvalue else []))


def column_shapes(real: DataFrame, synth: DataFrame, cols: list[str], profile: str = "core") -> DataFrame:
    """core: mean of the *rounded* statistics and % of columns with p > 0.05;
    full: mean and max of the unrounded statistics (M3)."""
    if profile == "core":
        k = ks_columns(real, synth, cols)
        return k.agg(br(F.avg("ks_statistic"), 4).alias("avg_ks_statistic"),
                      br(F.count_if(F.col("p_value") > 0.05) / F.greatest(F.count(F.lit(1)), F.lit(1)) * 100,
                         1).alias("columns_passed_pct"))
    k = ks_statistics(real, synth, cols)
    return k.agg(br(F.avg("ks_statistic"), 4).alias("avg_ks_statistic"),
                 br(F.max("ks_statistic"), 4).alias("max_ks_statistic"))


# ------------------------------------------------------------ A10 histograms
def _range(dfs: list[DataFrame], col: str):
    """(min, max) of ``col`` over several tables (small action)."""
    r = None
    for d in dfs:
        x = d.agg(F.min(F.col(col).cast("double")).alias("mn"), F.max(F.col(col).cast("double")).alias("mx")).first()
        if x["mn"] is None:
            continue
        r = (x["mn"], x["mx"]) if r is None else (min(r[0], x["mn"]), max(r[1], x["mx"]))
    return r


def bin_expr(c: Column, lo: float, hi: float, nbins: int) -> Column:
    """Equal-width bin index in [0, nbins−1]; the maximum falls in the last bin."""
    w = (hi - lo) / nbins if hi > lo else 1.0
    return F.least(F.floor((c.cast("double") - F.lit(lo)) / F.lit(w)), F.lit(nbins - 1)).cast("int")


def histogram(df: DataFrame, col: str, nbins: int = 30, lo: float | None = None,
              hi: float | None = None) -> DataFrame:
    """(bin, bin_lo, bin_hi, n) equal-width histogram."""
    if lo is None or hi is None:
        lo, hi = _range([df], col)
    w = (hi - lo) / nbins if hi > lo else 1.0
    return (df.where(F.col(col).isNotNull()).groupBy(bin_expr(F.col(col), lo, hi, nbins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("bin", r6(F.lit(lo) + F.col("bin") * F.lit(w)).alias("bin_lo"),
                    r6(F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("bin_hi"), "n"))


def histogram_overlay(real: DataFrame, synth: DataFrame, col: str, nbins: int = 30) -> DataFrame:
    """Real vs synthetic counts on shared bins (edges over both tables)."""
    lo, hi = _range([real, synth], col)
    hr = histogram(real, col, nbins, lo, hi).withColumnRenamed("n", "real_n")
    hs = histogram(synth, col, nbins, lo, hi).withColumnRenamed("n", "synth_n")
    return hr.join(hs, ["bin", "bin_lo", "bin_hi"], "full_outer").select(
        "bin", "bin_lo", "bin_hi", F.coalesce("real_n", F.lit(0)).alias("real_n"),
        F.coalesce("synth_n", F.lit(0)).alias("synth_n"))


def box_stats(df: DataFrame, col: str) -> DataFrame:
    """min, q1, median, q3, max, mean (linear-interpolated quartiles, exact)."""
    from cohortlens.functions.quantiles import exact_quantiles
    q = exact_quantiles(df, [col], [0.25, 0.5, 0.75])[col]
    x = F.col(col).cast("double")
    a = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx"), F.avg(x).alias("mean"))
    lit = lambda v: F.lit(v).cast("double")
    return a.select(r6(F.col("mn")).alias("min"), r6(lit(q[0])).alias("q1"), r6(lit(q[1])).alias("median"),
                    r6(lit(q[2])).alias("q3"), r6(F.col("mx")).alias("max"), r6(F.col("mean")).alias("mean"))


def density_overlap(real: DataFrame, synth: DataFrame, cols: list[str], nbins: int = 30) -> DataFrame:
    """Histogram overlap Σ min(p, q) per column on shared equal-width bins."""
    rng = {}
    a = real.agg(*[F.min(F.col(c).cast("double")).alias(f"a{i}") for i, c in enumerate(cols)],
                 *[F.max(F.col(c).cast("double")).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    b = synth.agg(*[F.min(F.col(c).cast("double")).alias(f"a{i}") for i, c in enumerate(cols)],
                  *[F.max(F.col(c).cast("double")).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    for i, c in enumerate(cols):
        rng[c] = (min(a[f"a{i}"], b[f"a{i}"]), max(a[f"b{i}"], b[f"b{i}"]))

    def binned(df):
        stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
        u = df.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, value)").where(F.col("value").isNotNull())
        e = None
        for c in cols:
            lo, hi = rng[c]
            x = bin_expr(F.col("value"), lo, hi, nbins)
            e = F.when(F.col("feature") == c, x) if e is None else e.when(F.col("feature") == c, x)
        h = u.groupBy("feature", e.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        return h.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("feature")))

    hr = binned(real).select("feature", "bin", F.col("share").alias("p"))
    hs = binned(synth).select("feature", "bin", F.col("share").alias("q"))
    j = hr.join(hs, ["feature", "bin"], "full_outer")
    return j.groupBy("feature").agg(
        br(F.sum(F.least(F.coalesce("p", F.lit(0.0)), F.coalesce("q", F.lit(0.0)))), 6).alias("overlap"))


# --------------------------------------------------------------- A13 moments
def moments(real: DataFrame, synth: DataFrame, cols: list[str]) -> DataFrame:
    """(column, real_mean, real_std, synth_mean, synth_std), ddof = 1."""
    def side(df, p):
        return unpivot(df, cols).groupBy("feature").agg(
            r6(F.avg("value")).alias(f"{p}_mean"), r6(F.stddev_samp("value")).alias(f"{p}_std"))
    return side(real, "real").join(side(synth, "synth"), "feature", "full_outer")
