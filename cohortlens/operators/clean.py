"""Cleaning operators.

Pattern used throughout: *one* aggregate pass computes the per-column
statistics a step needs (null shares, percentiles, medians …) — a driver
round trip of O(columns) values — and the step itself is a single static
projection. No per-column loops of Spark jobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.quantiles import exact_quantiles

# The reference's missingness threshold and clinical floors.
MISSINGNESS_THRESHOLD = 0.05
CLINICAL_FLOORS = {
    "Weight_kg": 10, "BMI": 10, "Age": 0, "Height_cm": 50, "FBS_mg_dL": 0, "PPBS_mg_dL": 0,
    "HbA1c_percent": 0, "Total_Cholesterol_mg_dL": 0, "HDL_Cholesterol_mg_dL": 0,
    "LDL_Cholesterol_mg_dL": 0, "Triglycerides_mg_dL": 0, "Serum_Creatinine_mg_dL": 0,
    "TSH_uIU_mL": 0, "BP_Systolic_mmHg": 0, "Pulse_bpm": 0,
}
# Binary / integer columns rounded after imputation.
BINARY_COLS_DIABETES = ["Sex", "Has_Hypertension", "Has_Hypothyroidism"]
INTEGER_COLS_DIABETES = ["Age", "Diabetes_Target"]
BINARY_COLS_FRAMINGHAM = ["male", "currentSmoker", "BPMeds", "prevalentStroke", "prevalentHyp",
                          "diabetes", "TenYearCHD"]
INTEGER_COLS_FRAMINGHAM = ["age", "education"]
# Columns checked for 0/1 content by the validator.
VALIDATED_BINARY = ["Sex", "male", "currentSmoker", "BPMeds", "prevalentStroke", "prevalentHyp",
                    "diabetes", "Has_Hypertension", "Has_Hypothyroidism"]

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


# ----------------------------------------------------------------- helpers
def numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)
            and not isinstance(f.dataType, T.BooleanType)]


def categorical_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    """Drop named columns if present."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_nulls(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with any NULL (or NaN) in ``subset``."""
    return df.na.drop(how="any", subset=subset)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalise NaN to NULL in float columns (pandas treats both as missing)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


# --------------------------------------------------------------------- A1 dedup
def dedup(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (NULLs compare equal, like pandas)."""
    return df.dropDuplicates()


def dedup_report(df: DataFrame) -> DataFrame:
    """(rows_before, rows_after, duplicates_removed) in one grouped pass;
    map-side partial aggregation collapses hot duplicate groups early."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.sum("_n").cast("bigint").alias("rows_before"),
                 F.count(F.lit(1)).alias("rows_after")).select(
        "rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("duplicates_removed"))


# ------------------------------------------------------------ P6 missing flags
def null_shares(df: DataFrame, cols=None) -> dict[str, float]:
    """Null share per column (one aggregate; small action)."""
    cols = cols or df.columns
    r = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols]).first()
    return {c: (r[c] or 0.0) for c in cols}


def missing_flag_columns(df: DataFrame, threshold: float = MISSINGNESS_THRESHOLD) -> list[str]:
    return [c for c, s in null_shares(df).items() if s > threshold]


def add_missing_flags(df: DataFrame, threshold: float = MISSINGNESS_THRESHOLD,
                      cols: list[str] | None = None) -> DataFrame:
    """Add ``<col>_is_missing`` (0/1) for each column whose null share is
    strictly above ``threshold``. ``cols`` skips the statistics pass."""
    cols = missing_flag_columns(df, threshold) if cols is None else cols
    return df.select("*", *[F.col(c).isNull().cast("int").alias(f"{c}_is_missing") for c in cols])


# ---------------------------------------------------------------- P7 floors
def apply_floors(df: DataFrame, floors: dict[str, float] = CLINICAL_FLOORS) -> DataFrame:
    """Values below a column's floor become NULL."""
    fl = {c: v for c, v in floors.items() if c in df.columns}
    return df.select(*[
        (F.when(F.col(c) < F.lit(fl[c]), F.lit(None)).otherwise(F.col(c)) if c in fl else F.col(c)).alias(c)
        for c in df.columns])


def floor_violations(df: DataFrame, floors: dict[str, float] = CLINICAL_FLOORS) -> DataFrame:
    """(column, floor, violations) counted in one pass with ``count_if``."""
    fl = [(c, float(v)) for c, v in floors.items() if c in df.columns]
    if not fl:
        return df.sparkSession.createDataFrame([], "column string, floor double, violations bigint")
    agg = df.agg(*[F.count_if(F.col(c) < F.lit(v)).alias(f"v{i}") for i, (c, v) in enumerate(fl)])
    stack = ", ".join(f"'{c}', CAST({v!r} AS DOUBLE), v{i}" for i, (c, v) in enumerate(fl))
    return agg.selectExpr(f"stack({len(fl)}, {stack}) AS (column, floor, violations)")


# ------------------------------------------------------------ P8 winsorize
def percentile_bounds(df: DataFrame, cols: list[str], lower: float = 1, upper: float = 99) -> dict:
    """Exact linear-interpolated percentiles (numpy ``nanpercentile``) of all
    columns, found by distributed histogram refinement (no single-task value
    map). Returns {col: (lo, hi)} (small actions)."""
    if not cols:
        return {}
    q = exact_quantiles(df, cols, [lower / 100.0, upper / 100.0])
    return {c: (q[c][0], q[c][1]) for c in cols}


def clip_expr(c: Column, lo, hi) -> Column:
    """Clip keeping NULLs (``greatest``/``least`` would skip them)."""
    c = c.cast("double")
    if lo is None:
        return c
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi))))


def winsorize(df: DataFrame, cols: list[str] | None = None, lower: float = 1, upper: float = 99,
              exclude: list[str] | None = None) -> DataFrame:
    """Clip numeric columns to their P``lower``/P``upper`` (default: every
    numeric column that is not a missingness flag, as the reference does)."""
    ex = set(exclude or [])
    cols = cols if cols is not None else [c for c in numeric_cols(df)
                                          if not c.endswith("_is_missing") and c not in ex]
    b = percentile_bounds(df, cols, lower, upper)
    return df.select(*[(clip_expr(F.col(c), *b[c]) if c in b else F.col(c)).alias(c) for c in df.columns])


# --------------------------------------------------------- P9 keyword flags
def keyword_flags(df: DataFrame, col: str, keywords: dict[str, str], drop: bool = True) -> DataFrame:
    """``name`` = 1 when ``col`` contains ``keyword`` (case-insensitive),
    NULL text → 0; the text column is dropped."""
    flags = [F.coalesce(F.upper(F.col(col)).contains(kw.upper()), F.lit(False)).cast("int").alias(name)
             for name, kw in keywords.items()]
    out = df.select("*", *flags)
    return out.drop(col) if drop else out


# ------------------------------------------------------ A3 / I1 median & mode
def column_mode(df: DataFrame, col: str) -> DataFrame:
    """One-row mode of ``col``: highest count, smallest value among ties.
    Two-stage (per-value counts, then ``min_by`` over them), so a
    high-cardinality column never sits in one task's map."""
    h = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return h.agg(F.min_by("v", F.struct((-F.col("n")).alias("k"), F.col("v").alias("v"))).alias("mode"))


def medians_and_modes(df: DataFrame, num: list[str], cat: list[str]) -> dict:
    """Exact median per numeric column; mode per categorical column with the
    smallest value winning ties ('Unknown' when all NULL)."""
    out = {}
    if num:
        q = exact_quantiles(df, num, [0.5])
        out.update({c: q[c][0] for c in num})
    for c in cat:
        m = column_mode(df, c).first()["mode"]
        out[c] = m if m is not None else "Unknown"
    return out


def fill_median_mode(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Fill numeric NULLs with the column median (column becomes double) and
    string NULLs with the mode."""
    cols = cols or df.columns
    num = [c for c in numeric_cols(df) if c in cols]
    cat = [c for c in categorical_cols(df) if c in cols]
    fills = medians_and_modes(df, num, cat)
    out = []
    for c in df.columns:
        if c in num:
            out.append(F.coalesce(F.col(c).cast("double"), F.lit(fills[c]).cast("double")).alias(c))
        elif c in cat:
            out.append(F.coalesce(F.col(c), F.lit(fills[c])).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def fill_values(df: DataFrame, values: dict) -> DataFrame:
    """``na.fill`` restricted to present columns."""
    v = {c: x for c, x in values.items() if c in df.columns}
    return df.na.fill(v) if v else df


# ---------------------------------------------------------- I3 round types
def round_types(df: DataFrame, binary=(), integer=(), flags=()) -> DataFrame:
    """binary / flags: half-even round, clip 0..1, int; integer: half-even
    round, int (bigint)."""
    b, i, fl = set(binary) | set(flags), set(integer), set()
    out = []
    for c in df.columns:
        x = F.col(c)
        if c in b:
            x = F.least(F.greatest(F.bround(x.cast("double"), 0), F.lit(0.0)), F.lit(1.0)).cast("int")
        elif c in i:
            x = F.bround(x.cast("double"), 0).cast("bigint")
        out.append(x.alias(c))
    del fl
    return df.select(*out)


# ---------------------------------------------------------- A2 validation
def validate_profile(df: DataFrame, binary_cols=None, target: str | None = None) -> DataFrame:
    """Long-form profile: (section, column, metric, value DOUBLE).

    Sections: ``table`` (rows, columns, nan_count, duplicate_rows,
    checks_passed), ``range`` (min/max per numeric column), ``nulls`` (per
    column), ``target`` (share per class), ``binary`` (non-binary count)."""
    num = numeric_cols(df)
    bins = [c for c in df.columns if c in (binary_cols if binary_cols is not None else VALIDATED_BINARY)
            or "_is_missing" in c]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(df.columns)]
    aggs += [F.min(F.col(c).cast("double")).alias(f"_min_{i}") for i, c in enumerate(num)]
    aggs += [F.max(F.col(c).cast("double")).alias(f"_max_{i}") for i, c in enumerate(num)]
    aggs += [F.count_if(F.col(c).isNotNull() & ~F.col(c).cast("double").isin(0.0, 1.0)).alias(f"_bin_{i}")
             for i, c in enumerate(bins)]
    a = df.agg(*aggs)
    rows_after = dedup_report(df).select("rows_before", "rows_after")
    null_total = " + ".join(f"_null_{i}" for i in range(len(df.columns))) or "0"
    parts = [("'table'", "''", "'rows'", "_rows"),
             ("'table'", "''", "'columns'", str(len(df.columns))),
             ("'table'", "''", "'nan_count'", f"({null_total})"),
             ("'table'", "''", "'checks_passed'", f"CASE WHEN ({null_total}) = 0 THEN 1 ELSE 0 END")]
    parts += [("'nulls'", f"'{c}'", "'null_count'", f"_null_{i}") for i, c in enumerate(df.columns)]
    parts += [("'range'", f"'{c}'", "'min'", f"_min_{i}") for i, c in enumerate(num)]
    parts += [("'range'", f"'{c}'", "'max'", f"_max_{i}") for i, c in enumerate(num)]
    parts += [("'binary'", f"'{c}'", "'non_binary'", f"_bin_{i}") for i, c in enumerate(bins)]
    stack = ", ".join(f"{s}, {c}, {m}, CAST({v} AS DOUBLE)" for s, c, m, v in parts)
    prof = a.selectExpr(f"stack({len(parts)}, {stack}) AS (section, column, metric, value)")
    dup = rows_after.selectExpr("'table' AS section", "'' AS column", "'duplicate_rows' AS metric",
                                "CAST(rows_before - rows_after AS DOUBLE) AS value")
    out = prof.unionByName(dup)
    if target and target in df.columns:
        from cohortlens.operators.fairness import class_shares
        t = class_shares(df, target).selectExpr(
            "'target' AS section", "CAST(cls AS STRING) AS column", "'share' AS metric",
            "bround(share, 4) AS value")
        out = out.unionByName(t)
    return out


def binary_violations(df: DataFrame, binary_cols) -> DataFrame:
    """(column, non_binary, bad_values) — values outside {0, 1} per binary
    column, all columns in one aggregate pass; bad values listed sorted
    (bounded by the column's cardinality)."""
    cols = [c for c in binary_cols if c in df.columns]
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        bad = v.isNotNull() & ~v.isin(0.0, 1.0)
        aggs += [F.count_if(bad).alias(f"n{i}"), F.sort_array(F.collect_set(F.when(bad, v))).alias(f"b{i}")]
    stack = ", ".join(f"'{c}', n{i}, b{i}" for i, c in enumerate(cols))
    return df.agg(*aggs).selectExpr(f"stack({len(cols)}, {stack}) AS (column, non_binary, bad_values)")


# ------------------------------------------------------------- I4 pipelines
@dataclass
class CleanSpec:
    """What a cleaning run does; presets mirror the reference's datasets."""
    keyword_col: str | None = None
    keywords: dict = field(default_factory=dict)
    drop: list = field(default_factory=list)
    floors: dict = field(default_factory=dict)
    binary: list = field(default_factory=list)
    integer: list = field(default_factory=list)
    impute: str = "median"            # 'median' | 'mice_linear' | 'mice_gbt'
    winsor_exclude: list = field(default_factory=list)
    threshold: float = MISSINGNESS_THRESHOLD


# The two tabular presets.
DIABETES = CleanSpec(keyword_col="Diagnosis_Temp",
                     keywords={"Has_Hypertension": "HYPERTENSION", "Has_Hypothyroidism": "HYPOTHYROID"},
                     drop=["Diabetes_Status"], floors=CLINICAL_FLOORS,
                     binary=BINARY_COLS_DIABETES, integer=INTEGER_COLS_DIABETES, impute="mice_gbt")
FRAMINGHAM = CleanSpec(binary=BINARY_COLS_FRAMINGHAM, integer=INTEGER_COLS_FRAMINGHAM, impute="mice_gbt")


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """dedup → flags → keyword features → drop → floors → winsorize → impute
    → round types. Three small statistics actions (null shares, percentiles,
    medians); the rest is one plan."""
    from cohortlens.operators.privacy import reuse
    df = reuse(nan_to_null(dedup(df)))        # read by the statistics passes below
    flags = missing_flag_columns(df, spec.threshold)
    df = add_missing_flags(df, cols=flags)
    if spec.keyword_col and spec.keyword_col in df.columns:
        df = keyword_flags(df, spec.keyword_col, spec.keywords)
    df = drop_cols(df, *spec.drop)
    num = [c for c in numeric_cols(df) if "_is_missing" not in c]
    df = apply_floors(df, spec.floors)
    df = winsorize(df, [c for c in num if c not in spec.winsor_exclude])
    flag_cols = [f"{c}_is_missing" for c in flags]
    if spec.impute == "median":
        df = fill_median_mode(df, [c for c in df.columns if c not in flag_cols])
    else:
        from cohortlens.operators.impute import mice
        est = "linear" if spec.impute == "mice_linear" else "gbt"
        df = mice(df, [c for c in numeric_cols(df) if c not in flag_cols], estimator=est)
    return round_types(df, spec.binary, spec.integer, flag_cols)
