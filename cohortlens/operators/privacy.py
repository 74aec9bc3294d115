"""Privacy operators: nearest-record distance (J1), re-identification risk
(J2), exact copies (J3), k-anonymity (A6), singling-out / linkability /
inference risks (D1–D3).

The nearest-record search itself is ``operators.nearest``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.expr import br, r6
from cohortlens.functions.quantiles import exact_quantiles
from cohortlens.operators.nearest import NearestIndex, nearest_distance, stats_and_count
from cohortlens.session import materialize, reuse

__all__ = ["NearestIndex", "materialize", "nearest_distance", "reuse"]

EXACT_EPS = 1e-6           # distance below which a record counts as copied


# ------------------------------------------------------------------ helpers
def const_array(values, typ: str) -> Column:
    """Foldable array constant (one string literal, folded by Catalyst)."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{typ}>")


def standardize_stats(real: DataFrame, cols: list[str]) -> tuple[list[float], list[float]]:
    """Real mean and ddof-1 std per column (std 0 or undefined → 1)."""
    means, stds, _ = stats_and_count(real, cols)
    return means, stds


def zvector(cols: list[str], means, stds) -> Column:
    return F.array(*[(F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(cols, means, stds)])


def dcr(real: DataFrame, synth: DataFrame, cols: list[str], profile: str = "core",
        sample_size: int | None = None, seed: int = 42, real_key: list[str] | None = None,
        synth_key: list[str] | None = None, **kw) -> DataFrame:
    """DCR summary (J1). ``sample_size=None`` scores the whole tables (the
    default here); a number reproduces the reference's sampling: ``core``
    samples each side to min(n, sample_size) independently, ``full`` both
    sides to min(sample_size, n_real, n_synth). Samples are hash-ordered on
    the given keys, and z-scores use the real *sample*'s statistics."""
    if sample_size:
        from cohortlens.operators.cohort import sample_n
        if profile == "full":
            kr = ks = min(sample_size, real.count(), synth.count())
        else:
            kr = ks = sample_size
        real = sample_n(real, kr, seed, real_key or cols).drop("draw")
        synth = sample_n(synth, ks, seed, synth_key or cols).drop("draw")
    return dcr_summary(nearest_distance(real, synth, cols, **kw), profile)


# --------------------------------------------------------------- summaries
def dcr_summary(dist: DataFrame, profile: str = "core", col: str = "dcr") -> DataFrame:
    """avg / median / min (/ max for ``full``) distance, exact-copy count and
    % (distance < 1e-6), rounded like the reference (J1)."""
    med = exact_quantiles(dist, [col], [0.5])[col][0]
    d = F.col(col)
    a = dist.where(d.isNotNull()).agg(F.avg(d).alias("a"), F.min(d).alias("mn"), F.max(d).alias("mx"),
                                      F.count_if(d < EXACT_EPS).alias("ex"), F.count(F.lit(1)).alias("n"))
    cols = [br(F.col("a"), 4).alias("avg_dcr"), br(F.lit(med).cast("double"), 4).alias("median_dcr"),
            br(F.col("mn"), 4).alias("min_dcr")]
    if profile == "full":
        cols.append(br(F.col("mx"), 4).alias("max_dcr"))
    cols += [F.col("ex").alias("exact_match_count"),
             br(F.col("ex") / F.col("n") * 100, 2).alias("exact_match_percent")]
    return a.select(*cols)


def reid_risk(dist: DataFrame, profile: str = "core", col: str = "dcr") -> DataFrame:
    """Risk per synthetic row from its nearest distance (J2): ``core``
    exp(−d) → avg, max, count and % > 0.5; ``full`` 1/(1+d) → avg, max, min,
    % > 0.5. Reuses J1's output (no second neighbour search)."""
    d = F.col(col)
    risk = F.exp(-d) if profile == "core" else F.lit(1.0) / (F.lit(1.0) + d)
    a = dist.where(d.isNotNull()).select(risk.alias("r")).agg(
        F.avg("r").alias("a"), F.max("r").alias("mx"), F.min("r").alias("mn"),
        F.count_if(F.col("r") > 0.5).alias("hi"), F.count(F.lit(1)).alias("n"))
    if profile == "core":
        return a.select(br(F.col("a"), 4).alias("avg_risk_score"), br(F.col("mx"), 4).alias("max_risk_score"),
                        F.col("hi").alias("high_risk_count"),
                        br(F.col("hi") / F.col("n") * 100, 2).alias("high_risk_percent"))
    return a.select(br(F.col("a"), 4).alias("avg_risk_score"), br(F.col("mx"), 4).alias("max_risk_score"),
                    br(F.col("mn"), 4).alias("min_risk_score"),
                    br(F.col("hi") / F.col("n") * 100, 2).alias("pct_high_risk"))


# ------------------------------------------------------------ J3 copies
def exact_copies(real: DataFrame, synth: DataFrame, cols: list[str]) -> DataFrame:
    """Synthetic rows equal to some real row on all ``cols`` (NULL = NULL).
    The real side is de-duplicated first, so a hot value is one build row."""
    rd = real.select(*cols).dropDuplicates()
    cond = [synth[c].eqNullSafe(rd[c]) for c in cols]
    return synth.join(rd, cond, "left_semi")


def novel_rows(real: DataFrame, synth: DataFrame, cols: list[str]) -> DataFrame:
    rd = real.select(*cols).dropDuplicates()
    cond = [synth[c].eqNullSafe(rd[c]) for c in cols]
    return synth.join(rd, cond, "left_anti")


# ------------------------------------------------------------ A6 k-anonymity
_FLOAT = (T.DoubleType, T.FloatType)


def qi_bins(df: DataFrame, qis: list[str], profile: str = "core") -> list[Column]:
    """Binned quasi-identifier columns (small statistics actions).

    core: numeric QIs with > 20 distinct values → decile edges (exact,
    rounded to 6 dp, duplicates dropped), right-closed, lowest included.
    full: float QIs → 10 equal-width bins over [min, max]."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    if profile == "core":
        from cohortlens.operators.clean import numeric_cols
        num = [q for q in qis if q in numeric_cols(df)]
        qs = exact_quantiles(df, num, [i / 10 for i in range(11)], min_distinct=20)    # counts distinct values too
        binned = list(qs)
        for q in qis:
            if q in binned:
                edges = sorted(set(round(e, 6) for e in qs[q]))
                inner = edges[1:-1]
                x = F.col(q).cast("double")
                out.append(F.size(F.filter(const_array(inner, "double"), lambda e: e < x)).alias(q)
                           if inner else F.lit(0).alias(q))
            else:
                out.append(F.col(q))
        return out
    fl = [q for q in qis if isinstance(types[q], _FLOAT)]
    mm = df.agg(*[F.min(q).alias(f"a{i}") for i, q in enumerate(fl)],
                *[F.max(q).alias(f"b{i}") for i, q in enumerate(fl)]).first() if fl else {}
    for q in qis:
        if q in fl:
            i = fl.index(q)
            mn, mx = mm[f"a{i}"], mm[f"b{i}"]
            step = (mx - mn) / 10
            inner = [mn + j * step for j in range(1, 10)]
            x = F.col(q).cast("double")
            out.append(F.size(F.filter(const_array(inner, "double"), lambda e: e < x)).alias(q))
        else:
            out.append(F.col(q))
    return out


def k_groups(df: DataFrame, qis: list[str], profile: str = "core") -> DataFrame:
    """(binned QIs..., k) — equivalence classes and their sizes."""
    return df.groupBy(*qi_bins(df, qis, profile)).agg(F.count(F.lit(1)).alias("k"))


def _size_bucket(k: Column) -> Column:
    return (F.when(k <= 5, "1-5").when(k <= 10, "6-10").when(k <= 20, "11-20").when(k <= 50, "21-50")
            .otherwise("51+"))


def k_anonymity(df: DataFrame, qis: list[str], profile: str = "core") -> DataFrame:
    """One-row k-anonymity summary; distribution columns count *groups*
    (core) or *records* (full) per size bucket 1-5, 6-10, 11-20, 21-50, 51+."""
    g = reuse(k_groups(df, qis, profile))
    k = F.col("k")
    unit = F.lit(1) if profile == "core" else k
    dist = [F.sum(F.when(_size_bucket(k) == b, unit).otherwise(0)).cast("bigint").alias(n)
            for b, n in [("1-5", "d_1_5"), ("6-10", "d_6_10"), ("11-20", "d_11_20"),
                         ("21-50", "d_21_50"), ("51+", "d_51_plus")]]
    a = g.agg(F.min(k).alias("k_min"), F.max(k).alias("k_max"), F.avg(k).alias("k_mean"),
              F.sum(F.when(k <= 5, k).otherwise(0)).alias("vul"), F.sum(k).alias("n"), *dist)
    pct = br(F.col("vul") / F.col("n") * 100, 2).alias("pct_records_k_leq_5")
    dn = ["d_1_5", "d_6_10", "d_11_20", "d_21_50", "d_51_plus"]
    if profile == "core":
        med = exact_quantiles(g, ["k"], [0.5])["k"][0]
        return a.select(F.col("k_min").cast("bigint").alias("k_min"),
                        F.lit(int(med)).cast("bigint").alias("k_median"),
                        br(F.col("k_mean"), 2).alias("k_mean"), pct, *dn)
    return a.select(F.col("k_min").cast("bigint").alias("k_min"), F.col("k_max").cast("bigint").alias("k_max"),
                    br(F.col("k_mean"), 1).alias("k_mean"), pct, *dn)


# ------------------------------------------------------- D1 singling out
def singling_out(real: DataFrame, synth: DataFrame, attrs: list[str]) -> DataFrame:
    """Share of attribute combinations unique in the synthetic table that
    single out exactly one real record."""
    s = synth.groupBy(*attrs).agg(F.count(F.lit(1)).alias("ns")).where(F.col("ns") == 1)
    r = real.groupBy(*attrs).agg(F.count(F.lit(1)).alias("nr"))
    cond = [s[a].eqNullSafe(r[a]) for a in attrs]
    j = s.join(r, cond, "left").select(s["ns"], r["nr"])
    return j.agg(F.count(F.lit(1)).alias("unique_synth_combos"),
                 F.count_if(F.col("nr") == 1).alias("singled_out")).select(
        "unique_synth_combos", "singled_out",
        r6(F.coalesce(F.try_divide(F.col("singled_out"), F.col("unique_synth_combos")), F.lit(0.0)))
        .alias("singling_out_risk"))


# ---------------------------------------------- D2 / D3 linkability, inference
def linkability(real: DataFrame, synth: DataFrame, attrs_a: list[str], attrs_b: list[str],
                synth_key: list[str], **kw) -> DataFrame:
    """Share of real rows whose nearest synthetic row on ``attrs_a`` is the
    same row as on ``attrs_b`` (exact searches, both standardised with the
    real table's statistics; rows count one by one, whatever key they share).
    The second search carries the first one's answer along."""
    s2 = synth.withColumn("_sid", F.concat_ws("|", *[F.col(k).cast("string") for k in synth_key]))
    a = nearest_distance(s2, real, attrs_a, keep=attrs_b, payload="_sid",
                         stats=standardize_stats(real, attrs_a), **kw).withColumnRenamed("nn_payload", "na")
    j = nearest_distance(s2, a, attrs_b, keep=["na"], payload="_sid",
                         stats=standardize_stats(real, attrs_b), **kw).withColumnRenamed("nn_payload", "nb")
    return j.agg(F.count(F.lit(1)).alias("n_real"), F.count_if(F.col("na") == F.col("nb")).alias("linked")).select(
        "n_real", "linked", r6(F.try_divide(F.col("linked"), F.col("n_real"))).alias("linkability_risk"))


def attribute_inference(real: DataFrame, synth: DataFrame, qis: list[str], secret: str,
                        real_key: list[str], **kw) -> DataFrame:
    """Guess each real row's ``secret`` from its nearest synthetic row on the
    quasi-identifiers; accuracy of the guesses (exact search)."""
    g = nearest_distance(synth, real, qis, keep=[*real_key, secret], payload=secret,
                         stats=standardize_stats(real, qis), **kw)
    ok = F.col("nn_payload") == F.col(secret).cast("string")
    return g.agg(F.count(F.lit(1)).alias("n_real"), F.count_if(ok).alias("correct")).select(
        "n_real", "correct", r6(F.try_divide(F.col("correct"), F.col("n_real"))).alias("inference_accuracy"))
