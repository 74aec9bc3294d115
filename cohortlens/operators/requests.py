"""Plain-language cohort requests as a batch job over a text column
(N1–N4). Pure column expressions: regex extraction, JSON parsing, clamps —
no UDF, so they run unchanged on a streaming DataFrame too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The offline parser's vocabulary.
KNOWN_CONDITIONS = ["diabetes", "hypertension", "hypothyroidism", "asthma", "obesity"]
SEVERITIES = ["mild", "moderate", "severe"]
RE_NUM = r"\b(\d+)\b"
RE_MALE = r"\b(male|men|man)\b"
RE_FEMALE = r"\b(female|women|woman)\b"
RE_AGE_MIN = r"(?:over|older than|>)\s*(?:age)?\s*(\d+)"
RE_AGE_MAX = r"(?:under|younger than|<)\s*(?:age)?\s*(\d+)"
RE_FENCE = r"```(?:json)?\s*([\s\S]*?)```"
RE_BRACES = r"\{[\s\S]*\}"
# Normalisation maps.
GENDER_MAP = {"male": 1, "m": 1, "female": 0, "f": 0}
SEVERITY_DIABETES = {"mild": 1, "moderate": 1, "severe": 2}
CONDITION_COLUMNS = {"diabetes": "Diabetes_Target", "hypertension": "Has_Hypertension",
                     "hypothyroidism": "Has_Hypothyroidism"}
DEFAULT_N, MAX_N, MAX_AGE = 100, 10000, 120

REQUEST_SCHEMA = ("num_patients bigint, gender string, age_min bigint, age_max bigint, "
                  "conditions array<string>, severity string")


def _extract_int(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("bigint")


def parse_requests(df: DataFrame, text_col: str) -> DataFrame:
    """Offline regex parse (N1): first integer → num_patients; male words
    before female words (word boundaries); over/older than/> → age_min;
    under/younger than/< → age_max; known conditions by substring, in list
    order; first of mild/moderate/severe. Missing → NULL (empty list for
    conditions)."""
    t = F.col(text_col)
    low = F.lower(t)
    gender = (F.when(low.rlike(RE_MALE), F.lit("male")).when(low.rlike(RE_FEMALE), F.lit("female")))
    conds = F.filter(F.array(*[F.lit(c) for c in KNOWN_CONDITIONS]), lambda c: F.instr(low, c) > 0)
    sev = None
    for s in SEVERITIES:
        sev = F.when(F.instr(low, s) > 0, F.lit(s)) if sev is None else sev.when(F.instr(low, s) > 0, F.lit(s))
    return df.select("*", _extract_int(t, RE_NUM).alias("num_patients"), gender.alias("gender"),
                     _extract_int(low, RE_AGE_MIN).alias("age_min"), _extract_int(low, RE_AGE_MAX).alias("age_max"),
                     F.coalesce(conds, F.array().cast("array<string>")).alias("conditions"),
                     sev.alias("severity"))


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def extract_json(df: DataFrame, text_col: str) -> DataFrame:
    """JSON object from fenced / noisy model output (N2): strip; take the
    fenced block if present; parse; else the first '{' … last '}' span.
    Failures give NULL fields and ``parse_ok`` false instead of raising."""
    t0 = _strip(F.col(text_col))
    t1 = F.when(t0.rlike(RE_FENCE), _strip(F.regexp_extract(t0, RE_FENCE, 1))).otherwise(t0)
    valid = lambda x: F.get_json_object(x, "$").isNotNull() & _strip(x).startswith("{")
    braces = F.regexp_extract(t1, RE_BRACES, 0)
    js = F.when(valid(t1), t1).when(valid(braces), braces)
    parsed = F.from_json(js, REQUEST_SCHEMA)
    return df.select("*", *[parsed[f].alias(f) for f in
                            ["num_patients", "gender", "age_min", "age_max", "conditions", "severity"]],
                     js.isNotNull().alias("parse_ok"))


def _clamp(c: Column, lo: int, hi: int) -> Column:
    """Clamp keeping NULL (``greatest``/``least`` skip NULL arguments)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def normalize_requests(df: DataFrame) -> DataFrame:
    """Validation and normalisation (N3): n default 100, clamped 1..10,000;
    gender → 1/0 (unknown labels → NULL, label kept); ages clamped 0..120;
    conditions lower/trimmed (unknown ones kept, they filter nothing);
    severity → Diabetes_Target value (mild/moderate 1, severe 2) only when
    diabetes is requested."""
    g_label = F.lower(F.trim(F.col("gender")))
    g = None
    for k, v in GENDER_MAP.items():
        g = F.when(g_label == k, F.lit(v)) if g is None else g.when(g_label == k, F.lit(v))
    conds = F.transform(F.coalesce(F.col("conditions"), F.array().cast("array<string>")),
                        lambda c: F.lower(F.trim(c)))
    sev = F.lower(F.trim(F.col("severity")))
    sev_t = F.when(F.array_contains(conds, "diabetes") & sev.isNotNull(),
                   F.when(sev.isin("mild", "moderate"), F.lit(1)).when(sev == "severe", F.lit(2)))
    keep = [c for c in df.columns if c not in
            ("num_patients", "gender", "age_min", "age_max", "conditions", "severity")]
    return df.select(
        *keep,
        _clamp(F.coalesce(F.col("num_patients"), F.lit(DEFAULT_N)), 1, MAX_N).cast("int").alias("num_patients"),
        g.cast("int").alias("gender"), g_label.alias("gender_label"),
        _clamp(F.col("age_min"), 0, MAX_AGE).cast("int").alias("age_min"),
        _clamp(F.col("age_max"), 0, MAX_AGE).cast("int").alias("age_max"),
        conds.alias("conditions"), sev.alias("severity"), sev_t.cast("int").alias("severity_target"))


def _cap(c: Column) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def summarize_requests(df: DataFrame) -> DataFrame:
    """Readable constraint summary (N4), markdown lines joined by blank lines."""
    amin, amax = F.col("age_min"), F.col("age_max")
    age = (F.when(amin.isNotNull() & amax.isNotNull(),
                  F.concat(F.lit("**Age range:** "), amin.cast("string"), F.lit(" – "), amax.cast("string")))
           .when(amin.isNotNull(), F.concat(F.lit("**Age:** ≥ "), amin.cast("string")))
           .when(amax.isNotNull(), F.concat(F.lit("**Age:** ≤ "), amax.cast("string"))))
    conds = F.when(F.size("conditions") > 0, F.concat(
        F.lit("**Conditions:** "), F.array_join(F.transform("conditions", _cap), ", ")))
    gl = F.col("gender_label")
    lines = [F.concat(F.lit("**Patients to generate:** "), F.col("num_patients").cast("string")),
             F.when(gl.isNotNull() & (gl != ""), F.concat(F.lit("**Gender:** "), _cap(gl))),
             age, conds,
             F.when(F.col("severity").isNotNull() & (F.col("severity") != ""),
                    F.concat(F.lit("**Severity:** "), _cap(F.col("severity"))))]
    return df.select("*", F.concat_ws("\n\n", *lines).alias("summary"))
