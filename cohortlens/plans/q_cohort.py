"""Registered queries: request parsing → normalisation → cohort matching,
cohort filters, summaries, seeded sampling and perturbed generation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.functions.expr import sql_hash_normal, sql_hash_uniform
from cohortlens.operators import cohort as co
from cohortlens.operators import requests as rq
from cohortlens.plans import fixtures as fx
from cohortlens.plans import sqlbits as sb
from cohortlens.plans.fixtures import with_views
from cohortlens.plans.registry import register
from cohortlens.sources import io

# ------------------------------------------------------------ SQL fragments
_LOW = "lower(prompt)"
_PARSE = f"""SELECT request_id,
  TRY_CAST(NULLIF(regexp_extract(prompt, '{rq.RE_NUM}', 1), '') AS BIGINT) AS num_patients,
  CASE WHEN regexp_matches({_LOW}, '{rq.RE_MALE}') THEN 'male'
       WHEN regexp_matches({_LOW}, '{rq.RE_FEMALE}') THEN 'female' END AS gender,
  TRY_CAST(NULLIF(regexp_extract({_LOW}, '{rq.RE_AGE_MIN}', 1), '') AS BIGINT) AS age_min,
  TRY_CAST(NULLIF(regexp_extract({_LOW}, '{rq.RE_AGE_MAX}', 1), '') AS BIGINT) AS age_max,
  list_filter({rq.KNOWN_CONDITIONS!r}, lambda c: contains({_LOW}, c)) AS conditions,
  CASE {' '.join(f"WHEN contains({_LOW}, '{s}') THEN '{s}'" for s in rq.SEVERITIES)} END AS severity
FROM requests"""


def _clamp(x, lo, hi):
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE least(greatest({x}, {lo}), {hi}) END"


_NORM = f"""SELECT request_id,
  CAST(least(greatest(coalesce(num_patients, 100), 1), 10000) AS INT) AS num_patients,
  CAST(CASE lower(trim(gender)) {' '.join(f"WHEN '{k}' THEN {v}" for k, v in rq.GENDER_MAP.items())} END AS INT)
    AS gender,
  lower(trim(gender)) AS gender_label,
  CAST({_clamp('age_min', 0, 120)} AS INT) AS age_min, CAST({_clamp('age_max', 0, 120)} AS INT) AS age_max,
  list_transform(coalesce(conditions, []::VARCHAR[]), lambda c: lower(trim(c))) AS conditions,
  lower(trim(severity)) AS severity,
  CAST(CASE WHEN list_contains(list_transform(coalesce(conditions, []::VARCHAR[]), lambda c: lower(trim(c))),
                               'diabetes') AND severity IS NOT NULL
            THEN CASE WHEN lower(trim(severity)) IN ('mild', 'moderate') THEN 1
                      WHEN lower(trim(severity)) = 'severe' THEN 2 END END AS INT) AS severity_target
FROM pr"""


def _cap(x):
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


_SUMMARY = f"""concat_ws(chr(10) || chr(10),
  '**Patients to generate:** ' || CAST(num_patients AS VARCHAR),
  CASE WHEN gender_label IS NOT NULL AND gender_label <> '' THEN '**Gender:** ' || {_cap('gender_label')} END,
  CASE WHEN age_min IS NOT NULL AND age_max IS NOT NULL
         THEN '**Age range:** ' || CAST(age_min AS VARCHAR) || ' – ' || CAST(age_max AS VARCHAR)
       WHEN age_min IS NOT NULL THEN '**Age:** ≥ ' || CAST(age_min AS VARCHAR)
       WHEN age_max IS NOT NULL THEN '**Age:** ≤ ' || CAST(age_max AS VARCHAR) END,
  CASE WHEN len(conditions) > 0
       THEN '**Conditions:** ' || array_to_string(list_transform(conditions, lambda c: {_cap('c')}), ', ') END,
  CASE WHEN severity IS NOT NULL AND severity <> '' THEN '**Severity:** ' || {_cap('severity')} END)"""

_MATCH = """SELECT r.request_id, r.num_patients, p.patient_id FROM rn r JOIN patients p ON
  (r.gender IS NULL OR p.Sex = r.gender) AND (r.age_min IS NULL OR p.Age >= r.age_min)
  AND (r.age_max IS NULL OR p.Age <= r.age_max)
  AND (NOT list_contains(r.conditions, 'diabetes') OR p.Diabetes_Target >= 1)
  AND (NOT list_contains(r.conditions, 'hypertension') OR p.Has_Hypertension = 1)
  AND (NOT list_contains(r.conditions, 'hypothyroidism') OR p.Has_Hypothyroidism = 1)
  AND (r.severity_target IS NULL OR p.Diabetes_Target = r.severity_target)"""

_REQ_CTES = [("pr", _PARSE), ("rn", _NORM)]


def _parsed(spark, d):
    return rq.parse_requests(fx.requests(spark, d), "prompt").drop("prompt")


def _normalized(spark, d):
    return rq.normalize_requests(_parsed(spark, d))


# ------------------------------------------------------------------ N1–N4
@register("parse_requests", with_views(
    "SELECT request_id, num_patients, gender, age_min, age_max, conditions, severity FROM pr", "requests",
    ctes=_REQ_CTES[:1]))
def q_parse_requests(spark, d):
    return _parsed(spark, d)


@register("parse_turns", with_views(_PARSE.replace("request_id", "conv_id, turn").replace("prompt", "text")
                                    .replace("FROM requests", "FROM conversations")))
def q_parse_turns(spark, d):
    """The regex parser over every conversation turn, whole texts."""
    t = io.table(spark, d, "conversations").select("conv_id", "turn", "text")
    return rq.parse_requests(t, "text").drop("text")


_JSON_SRC_SPARK = None


def _model_outputs(spark, d):
    p = _parsed(spark, d)
    js = F.to_json(F.struct("num_patients", "gender", "age_min", "age_max", "conditions", "severity"))
    k = F.col("request_id") % 5
    txt = (F.when(k == 0, F.concat(F.lit("```json\n"), js, F.lit("\n```")))
           .when(k == 1, F.concat(F.lit("  ```\n"), js, F.lit("\n```  ")))
           .when(k == 2, F.concat(F.lit("Here is the result: "), js, F.lit(" Hope it helps.")))
           .when(k == 3, js)
           .otherwise(F.concat(F.lit('{"num_patients": '), F.col("num_patients").cast("string"), F.lit(","))))
    return p.select("request_id", txt.alias("raw"))


_JSON_SQL_SRC = """SELECT request_id, CASE request_id % 5
    WHEN 0 THEN '```json' || chr(10) || js || chr(10) || '```'
    WHEN 1 THEN '  ```' || chr(10) || js || chr(10) || '```  '
    WHEN 2 THEN 'Here is the result: ' || js || ' Hope it helps.'
    WHEN 3 THEN js
    ELSE '{"num_patients": ' || CAST(num_patients AS VARCHAR) || ',' END AS raw
  FROM (SELECT *, CAST(to_json(struct_pack(num_patients := num_patients, gender := gender, age_min := age_min,
                                       age_max := age_max, conditions := conditions, severity := severity))
                       AS VARCHAR) AS js
        FROM pr) x"""


def _strip(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


_FENCE = rq.RE_FENCE
_JSON_SQL = with_views(f"""
SELECT request_id, CAST(js->>'num_patients' AS BIGINT) AS num_patients, js->>'gender' AS gender,
       CAST(js->>'age_min' AS BIGINT) AS age_min, CAST(js->>'age_max' AS BIGINT) AS age_max,
       CASE WHEN js IS NULL THEN NULL ELSE CAST(json_extract(js, '$.conditions') AS VARCHAR[]) END AS conditions,
       js->>'severity' AS severity, js IS NOT NULL AS parse_ok
FROM (SELECT request_id,
        CASE WHEN json_valid(t1) AND starts_with({_strip('t1')}, '{{') THEN t1
             WHEN json_valid(regexp_extract(t1, '{rq.RE_BRACES}', 0))
                  AND starts_with(regexp_extract(t1, '{rq.RE_BRACES}', 0), '{{')
               THEN regexp_extract(t1, '{rq.RE_BRACES}', 0) END AS js
      FROM (SELECT request_id,
              CASE WHEN regexp_matches(t0, '{_FENCE}') THEN {_strip(f"regexp_extract(t0, '{_FENCE}', 1)")}
                   ELSE t0 END AS t1
            FROM (SELECT request_id, {_strip('raw')} AS t0 FROM src) a) b) c""", "requests",
                       ctes=_REQ_CTES[:1] + [("src", _JSON_SQL_SRC)])


@register("extract_json", _JSON_SQL)
def q_extract_json(spark, d):
    return rq.extract_json(_model_outputs(spark, d), "raw").drop("raw")


@register("normalize_requests", with_views(
    "SELECT request_id, num_patients, gender, gender_label, age_min, age_max, conditions, severity, "
    "severity_target FROM rn", "requests", ctes=_REQ_CTES))
def q_normalize_requests(spark, d):
    return _normalized(spark, d)


@register("summarize_requests", with_views(f"SELECT request_id, {_SUMMARY} AS summary FROM rn", "requests",
                                           ctes=_REQ_CTES))
def q_summarize_requests(spark, d):
    return rq.summarize_requests(_normalized(spark, d)).select("request_id", "summary")


# ---------------------------------------------------------- P10 / P12 / A11
FIXED = {"gender": 0, "age_min": 40, "age_max": 65, "conditions": ["diabetes", "hypertension"],
         "severity_target": None}
_FIXED_SQL = """Sex = 0 AND Age >= 40 AND Age <= 65 AND Diabetes_Target >= 1 AND Has_Hypertension = 1"""


@register("cohort_filter", with_views(f"SELECT * FROM patients WHERE {_FIXED_SQL}", "patients"))
def q_cohort_filter(spark, d):
    return co.cohort_filter(fx.patients(spark, d), FIXED)


@register("cohort_topn", with_views(
    f"SELECT * FROM patients WHERE {_FIXED_SQL.replace('Sex = 0 AND ', '')} ORDER BY patient_id LIMIT 200",
    "patients"))
def q_cohort_topn(spark, d):
    c = dict(FIXED, gender=None)
    return co.head(co.cohort_filter(fx.patients(spark, d), c), 200, ["patient_id"])


@register("cohort_summary", with_views(f"""
SELECT (SELECT count(*) FROM patients) AS total_real_rows, count(*) AS matched_rows, count(*) AS generated_rows,
       8 AS num_columns, {sb.br('avg(Age)', 1)} AS age_mean, CAST(min(Age) AS BIGINT) AS age_min,
       CAST(max(Age) AS BIGINT) AS age_max,
       {sb.br('count_if(Sex = 1) * 100.0 / greatest(count(*), 1)', 1)} AS male_pct,
       {sb.br('100.0 - count_if(Sex = 1) * 100.0 / greatest(count(*), 1)', 1)} AS female_pct,
       {sb.br('count_if(Diabetes_Target >= 1) * 100.0 / greatest(count(*), 1)', 1)} AS diabetes_pct,
       {sb.br('count_if(Has_Hypertension = 1) * 100.0 / greatest(count(*), 1)', 1)} AS hypertension_pct,
       {sb.br('count_if(Has_Hypothyroidism = 1) * 100.0 / greatest(count(*), 1)', 1)} AS hypothyroidism_pct
FROM patients WHERE Age >= 30 AND Age <= 60""", "patients"))
def q_cohort_summary(spark, d):
    p = fx.patients(spark, d)
    return co.cohort_summary(p, None, None, where=co.cohort_predicate(p, {"age_min": 30, "age_max": 60}))


# ------------------------------------------------------------------ J6
@register("match_cohorts", with_views(f"""
SELECT request_id, patient_id, rank FROM (
  SELECT request_id, patient_id, num_patients,
         row_number() OVER (PARTITION BY request_id ORDER BY patient_id) AS rank FROM m) x
WHERE rank <= num_patients""", "requests", "patients", ctes=_REQ_CTES + [("m", _MATCH)]))
def q_match_cohorts(spark, d):
    r = co.match_cohorts(_normalized(spark, d), fx.patients(spark, d))
    return r.select("request_id", "patient_id", F.col("rank").cast("bigint").alias("rank"))


@register("cohort_counts", with_views("""
SELECT rn.request_id, rn.num_patients AS requested, CAST(coalesce(c.matched, 0) AS BIGINT) AS matched,
       CAST(least(rn.num_patients, coalesce(c.matched, 0)) AS BIGINT) AS delivered
FROM rn LEFT JOIN (SELECT request_id, count(*) AS matched FROM m GROUP BY request_id) c USING (request_id)""",
                                      "requests", "patients", ctes=_REQ_CTES + [("m", _MATCH)]))
def q_cohort_counts(spark, d):
    return co.match_cohorts(_normalized(spark, d), fx.patients(spark, d), with_counts=True)


# ------------------------------------------------------------------ G1 / G7
LI_KEY = fx.LI_KEY


@register("sample_hash", with_views(f"""
SELECT {', '.join(LI_KEY)}, l_extendedprice,
       row_number() OVER (ORDER BY {sql_hash_uniform(42, LI_KEY)}, {', '.join(LI_KEY)}) - 1 AS draw
FROM li ORDER BY {sql_hash_uniform(42, LI_KEY)}, {', '.join(LI_KEY)} LIMIT 1000""", "li"))
def q_sample_hash(spark, d):
    r = fx.li(spark, d).select(*LI_KEY, "l_extendedprice")
    return co.sample_n(r, 1000, 42, LI_KEY).withColumn("draw", F.col("draw").cast("bigint"))


_N_REPL = 5000


@register("sample_replace", with_views(f"""
SELECT d.draw, p.patient_id, p.Age FROM
  (SELECT i AS draw, CAST(floor({sql_hash_uniform(7, ['i'], 'draw')} * (SELECT count(*) FROM patients)) AS BIGINT)
     AS rk FROM range({_N_REPL}) t(i)) d
  JOIN (SELECT patient_id, Age, row_number() OVER (ORDER BY {sql_hash_uniform(7, ['patient_id'])}, patient_id) - 1
          AS rk FROM patients) p ON d.rk = p.rk""", "patients"))
def q_sample_replace(spark, d):
    p = fx.patients(spark, d).select("patient_id", "Age")
    return co.sample_n(p, _N_REPL, 7, ["patient_id"], replace=True).select("draw", "patient_id", "Age")


GEN = {"gender": 1, "age_min": 30, "age_max": 60, "conditions": ["diabetes"], "severity_target": None}
_GEN_WHERE = "Sex = 1 AND Age >= 30 AND Age <= 60 AND Diabetes_Target >= 1"
_GEN_N = 100
_NUMS = ["Sex", "Age", "Diabetes_Target", "Has_Hypertension", "Has_Hypothyroidism", "bmi_like"]


def _gen_sql():
    """Both sampling regimes: the n first rows in hash order when enough
    rows match, else n draws with replacement over the hash-ordered ranks."""
    h = sql_hash_uniform(42, ["patient_id"])
    ranked = f"SELECT *, row_number() OVER (ORDER BY {h}, patient_id) - 1 AS rk FROM patients WHERE {_GEN_WHERE}"
    cols = "patient_id, Sex, Age, Diabetes_Target, Has_Hypertension, Has_Hypothyroidism, bmi_like, segment"
    sample = (f"SELECT {cols}, rk AS draw FROM ranked, mc WHERE mc.m >= {_GEN_N} AND rk < {_GEN_N} "
              f"UNION ALL SELECT {', '.join('r.' + c.strip() for c in cols.split(','))}, d.i AS draw "
              f"FROM range({_GEN_N}) d(i), mc, ranked r WHERE mc.m < {_GEN_N} "
              f"AND r.rk = CAST(floor({sql_hash_uniform(42, ['d.i'], 'draw')} * mc.m) AS BIGINT)")
    st = "SELECT " + ", ".join(f"stddev_samp(CAST({c} AS DOUBLE)) AS s_{c}" for c in _NUMS) + " FROM smp"
    out = []
    for c in _NUMS:
        noise = f"CASE WHEN s_{c} > 0 THEN {sql_hash_normal(42, ['draw'], 'n' + c)} * (s_{c} * 0.05) ELSE 0.0 END"
        x = f"(CAST({c} AS DOUBLE) + {noise})"
        out.append(f"CAST(round_even({x}, 0) AS BIGINT) AS {c}" if c != "bmi_like" else f"{sb.r6(x)} AS {c}")
    body = f"SELECT patient_id, {', '.join(out)}, segment, draw FROM smp, st"
    return with_views(body, "patients", ctes=[("ranked", ranked), ("mc", "SELECT count(*) AS m FROM ranked"),
                                              ("smp", sample), ("st", st)])


@register("generate_perturbed", _gen_sql())
def q_generate_perturbed(spark, d):
    rows, _ = co.generate_perturbed(fx.patients(spark, d), _GEN_N, GEN, 42, ["patient_id"])
    return rows.select("patient_id", *_NUMS, "segment", F.col("draw").cast("bigint").alias("draw"))


@register("generate_empty", with_views("""
SELECT (SELECT count(*) FROM patients) AS total_real_rows, CAST(0 AS BIGINT) AS matched_rows,
       CAST(0 AS BIGINT) AS generated_rows,
       'No patients matched the specified criteria. Try broader constraints.' AS message""", "patients"))
def q_generate_empty(spark, d):
    _, summary = co.generate_perturbed(fx.patients(spark, d), 10, {"age_min": 120}, 42, ["patient_id"])
    return summary


@register("generate_quota")
def q_generate_quota(spark, d):
    return co.generate_until(fx.patients(spark, d), 50, {"gender": 0, "conditions": ["hypertension"]}, 42,
                             ["patient_id"])
