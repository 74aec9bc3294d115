"""Cohort selection and perturbed generation.

``match_cohorts`` (a table of requests against a patient table) lives in
``operators.matching``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.expr import br, hash_normal, hash_uniform, r6
from cohortlens.operators.matching import match_cohorts  # noqa: F401
from cohortlens.operators.requests import CONDITION_COLUMNS

NOISE_SCALE = 0.05          # fixed value: noise std multiplier of the generator
POOL_NOISE_SCALE = 0.02     # fixed value: multiplier of the pool variant
POOL_MULTIPLIERS = [10, 25, 50]
POOL_COVERS = 5             # draws per row of the table before nobody is said to match


# ------------------------------------------------------------- P10 filter
def cohort_predicate(df: DataFrame, c: dict) -> Column:
    """Conjunction of the request's clauses; a clause whose column is absent
    is skipped. Gender column tried as Sex, male, gender (text accepts
    M/F and male/female)."""
    cols = set(df.columns)
    cond = F.lit(True)
    g = c.get("gender")
    if g is not None:
        for gc in ["Sex", "male", "gender"]:
            if gc in cols:
                if gc == "gender":
                    cond = cond & F.upper(F.col(gc)).isin(["M", "MALE"] if g == 1 else ["F", "FEMALE"])
                else:
                    cond = cond & (F.col(gc) == F.lit(g))
                break
    for ac in ["Age", "age"]:
        if ac in cols:
            if c.get("age_min") is not None:
                cond = cond & (F.col(ac) >= F.lit(c["age_min"]))
            if c.get("age_max") is not None:
                cond = cond & (F.col(ac) <= F.lit(c["age_max"]))
            break
    for name in c.get("conditions", []) or []:
        col = CONDITION_COLUMNS.get(name)
        if col and col in cols:
            cond = cond & ((F.col(col) >= 1) if name == "diabetes" else (F.col(col) == 1))
    st = c.get("severity_target")
    if st is not None and "Diabetes_Target" in cols:
        cond = cond & (F.col("Diabetes_Target") == F.lit(st))
    return F.coalesce(cond, F.lit(False))


def cohort_filter(df: DataFrame, constraints: dict) -> DataFrame:
    return df.where(cohort_predicate(df, constraints))


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First-n preview in an explicit order."""
    return df.orderBy(*order).limit(n)


# -------------------------------------------------------- A11 cohort summary
def cohort_summary(df: DataFrame, n_total: Column | int, n_matched: Column | int,
                   where: Column | None = None) -> DataFrame:
    """Counts, age mean/min/max, % male/female and prevalence of the three
    conditions, one conditional aggregate (A11). With ``where`` the summary
    covers the matching rows and the totals come from the same pass
    (``n_total`` / ``n_matched`` then ignored)."""
    if where is None:
        inside = F.lit(True)
        tot, mat = F.lit(n_total).cast("bigint"), F.lit(n_matched).cast("bigint")
    else:
        inside = F.coalesce(where, F.lit(False))
        tot, mat = F.count(F.lit(1)), F.count_if(inside)
    w = lambda x: F.when(inside, x)
    n = F.count_if(inside)
    pct = lambda cond: br(F.count_if(inside & cond) * 100.0 / F.greatest(n, F.lit(1)), 1)
    male = F.count_if(inside & (F.col("Sex") == 1)) * 100.0 / F.greatest(n, F.lit(1))
    return df.agg(
        tot.cast("bigint").alias("total_real_rows"), mat.cast("bigint").alias("matched_rows"),
        n.alias("generated_rows"), F.lit(len(df.columns)).alias("num_columns"),
        br(F.avg(w(F.col("Age"))), 1).alias("age_mean"), F.min(w(F.col("Age"))).cast("bigint").alias("age_min"),
        F.max(w(F.col("Age"))).cast("bigint").alias("age_max"),
        br(male, 1).alias("male_pct"), br(F.lit(100.0) - male, 1).alias("female_pct"),
        pct(F.col("Diabetes_Target") >= 1).alias("diabetes_pct"),
        pct(F.col("Has_Hypertension") == 1).alias("hypertension_pct"),
        pct(F.col("Has_Hypothyroidism") == 1).alias("hypothyroidism_pct"))


# ------------------------------------------------------- G1 seeded sampling
def sample_n(df: DataFrame, n: int, seed: int, key: list[str], replace: bool = False) -> DataFrame:
    """Seeded simple random sample of n rows (G1), reproducible on any
    partitioning and in SQL: without replacement the n smallest
    md5(seed|key) hashes; with replacement draw i picks the row of rank
    ⌊u_i·m⌋ in hash order (m rows). Adds ``draw`` (0..n−1)."""
    h = hash_uniform(seed, *key)
    if not replace:
        w = Window.orderBy(h, *key)
        return df.orderBy(h, *key).limit(n).withColumn("draw", F.row_number().over(w) - 1)
    m = df.count()
    if m == 0:
        return df.withColumn("draw", F.lit(0).cast("bigint")).limit(0)
    ranked = _global_rank(df, h, key)
    draws = df.sparkSession.range(n).select(
        F.col("id").alias("draw"),
        F.floor(hash_uniform(seed, F.col("id"), salt="draw") * F.lit(m)).cast("bigint").alias("_rk"))
    return draws.join(ranked, "_rk").drop("_rk")


def _global_rank(df: DataFrame, h: Column, key: list[str]) -> DataFrame:
    """Dense 0-based rank in (hash, key) order without a single-partition
    window: range-partitioned sort, per-partition counts, offsets."""
    s = df.withColumn("_h", h).repartitionByRange("_h", *key).sortWithinPartitions("_h", *key)
    s = s.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    from cohortlens.operators.privacy import materialize
    s = materialize(s)
    # one row per partition
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c")).select(
        "_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return s.join(offs, "_pid").withColumn("_rk", F.col("_off") + pos).drop("_h", "_pid", "_mid", "_off")


# ------------------------------------------------- G7 perturbed resampling
def generate_perturbed(df: DataFrame, n: int, constraints: dict, seed: int, key: list[str],
                       scale: float = NOISE_SCALE, int_cols: list[str] | None = None,
                       exclude: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Filter → sample n (with replacement when n > matched) → add
    N(0, scale·std) per numeric column, std from the *sample* (NULL/zero std
    → no noise) → round integer columns half-even. Returns (rows, summary);
    zero matches → empty rows and a summary with a message."""
    from cohortlens.operators.clean import numeric_cols
    total = df.count()
    f = cohort_filter(df, constraints)
    m = f.count()
    summ_cols = ["total_real_rows", "matched_rows", "generated_rows", "message"]
    if m == 0:
        msg = "No patients matched the specified criteria. Try broader constraints."
        rows = f.withColumn("draw", F.lit(0).cast("bigint")).limit(0)
        summary = df.sparkSession.range(1).select(
            F.lit(total).cast("bigint").alias(summ_cols[0]), F.lit(0).cast("bigint").alias(summ_cols[1]),
            F.lit(0).cast("bigint").alias(summ_cols[2]), F.lit(msg).alias(summ_cols[3]))
        return rows, summary
    s = sample_n(f, n, seed, key, replace=n > m)
    ex = set(exclude or []) | set(key)
    num = [c for c in numeric_cols(df) if c not in ex]
    ints = set(int_cols if int_cols is not None else
               [fl.name for fl in df.schema.fields if fl.name in num and fl.dataType.typeName() in
                ("integer", "long", "short", "byte")])
    st = s.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in num]).first()
    out = []
    for c in s.columns:
        if c in num:
            sd = st[c]
            x = F.col(c).cast("double")
            if sd is not None and sd > 0:
                x = x + hash_normal(seed, F.col("draw"), salt=f"n{c}") * F.lit(sd * scale)
            x = F.bround(x, 0).cast("bigint") if c in ints else r6(x)
            out.append(x.alias(c))
        else:
            out.append(F.col(c))
    rows = s.select(*out)
    summary = cohort_summary(rows, total, m) if "Sex" in df.columns else rows.agg(
        F.lit(total).alias("total_real_rows"), F.lit(m).alias("matched_rows"),
        F.count(F.lit(1)).alias("generated_rows"))
    return rows, summary


def generate_until(df: DataFrame, n: int, constraints: dict, seed: int, key: list[str],
                   multipliers=POOL_MULTIPLIERS, patience: int = 3) -> DataFrame:
    """Quota filling (G8): pools of n×10, n×25, n×50 rows, then doubled, are
    drawn from the whole table with small noise and filtered by the request;
    the first n distinct rows in draw order are returned. Ends early only if
    ``patience`` pools in a row bring no new row and together have drawn
    ``POOL_COVERS`` times the table's rows (nobody else matches)."""
    from cohortlens.operators.privacy import materialize
    values = df.columns
    rows = df.count()
    collected, attempt, barren, drawn = None, 0, 0, 0      # drawn: rows of the barren pools
    while barren < patience or drawn < POOL_COVERS * rows:
        attempt += 1
        mult = multipliers[attempt - 1] if attempt <= len(multipliers) else multipliers[-1] * 2 ** (attempt - len(multipliers))
        pool, _ = generate_perturbed(df, n * mult, {}, seed + attempt, key, scale=POOL_NOISE_SCALE, exclude=key)
        got = cohort_filter(pool, constraints).withColumn("_turn", F.struct(F.lit(attempt).alias("a"), "draw")).drop("draw")
        got = got if collected is None else collected.unionByName(got)
        before = 0 if collected is None else have
        collected = materialize(got.groupBy(*values).agg(F.min("_turn").alias("_turn")))
        have = collected.count()
        if have >= n:
            break
        barren, drawn = (0, 0) if have > before else (barren + 1, drawn + n * mult)
    return collected.orderBy("_turn").limit(n).drop("_turn")
