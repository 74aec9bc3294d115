"""Registered queries: FHIR flattening. The Spark side builds JSON bundles
from ``events`` and parses them; the oracle computes the expected rows from
``events`` directly (never sees JSON), so the two paths are independent."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import fhir as fh
from cohortlens.plans import fixtures as fx
from cohortlens.plans.fixtures import with_views
from cohortlens.plans.registry import register

_VIT = """SELECT user_id,
  arg_max(value, event_id) FILTER (WHERE event_type = 'view') AS weight_kg,
  arg_max(value, event_id) FILTER (WHERE event_type = 'click') AS heart_rate,
  arg_max(value, event_id) FILTER (WHERE event_type = 'purchase') AS systolic_bp,
  arg_max(value / 2, event_id) FILTER (WHERE event_type = 'purchase') AS diastolic_bp,
  arg_max('s' || CAST(event_id % 3 AS VARCHAR), event_id) FILTER (WHERE event_type = 'error') AS smoking_status
FROM events GROUP BY user_id"""
_COND = """SELECT u.user_id, coalesce(c.conditions, []::VARCHAR[]) AS conditions
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (
  SELECT user_id, list('Finding ' || CAST(event_id % 25 AS VARCHAR) || ' (disorder)' ORDER BY event_id) AS conditions
  FROM events WHERE event_type = 'signup' AND event_id % 2 = 0 GROUP BY user_id) c USING (user_id)"""
_PAT = """SELECT DISTINCT user_id, CASE WHEN user_id % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
  CASE WHEN user_id % 5 = 0 THEN 'Unknown' WHEN user_id % 2 = 0 THEN 'M' ELSE 'S' END AS maritalStatus,
  'race' || CAST(user_id % 3 AS VARCHAR) AS race,
  CASE WHEN user_id % 40 = 0 THEN NULL ELSE CAST(floor(date_diff('day', DATE '1950-01-01' + CAST(37 * user_id AS INT),
       DATE '2026-01-01') / 365) AS BIGINT) END AS age
FROM events"""
_TOP = """SELECT condition, count(*) AS n FROM (SELECT unnest(conditions) AS condition FROM cond) x
GROUP BY condition ORDER BY n DESC, condition LIMIT 20"""


def _safe_sql(x):
    for a, b in [(" (finding)", ""), (" (disorder)", ""), (" ", "_"), (",", ""), ("(", ""), (")", "")]:
        x = f"replace({x}, '{a}', '{b}')"
    return f"('Cond_' || {x})"


_CTES = [("vit", _VIT), ("cond", _COND), ("pat", _PAT), ("top", _TOP)]


def _raw(spark, d):
    return fh.flatten_raw(fx.bundles(spark, d))


@register("fhir_vitals", with_views(
    "SELECT CAST(user_id AS VARCHAR) AS patient_id, weight_kg, heart_rate, systolic_bp, diastolic_bp, "
    "smoking_status FROM vit", ctes=_CTES[:1]))
def q_fhir_vitals(spark, d):
    return _raw(spark, d).select(F.col("id").alias("patient_id"), "weight_kg", "heart_rate", "systolic_bp",
                                 "diastolic_bp", "smoking_status")


@register("fhir_conditions", with_views(
    "SELECT CAST(user_id AS VARCHAR) AS patient_id, conditions FROM cond", ctes=_CTES[1:2]))
def q_fhir_conditions(spark, d):
    return _raw(spark, d).select(F.col("id").alias("patient_id"), "conditions")


@register("top_conditions", with_views("SELECT condition, n FROM top", ctes=_CTES[1:2] + _CTES[3:]))
def q_top_conditions(spark, d):
    return fh.top_conditions(_raw(spark, d))


@register("condition_onehot", with_views(f"""
SELECT CAST(c.user_id AS VARCHAR) AS patient_id, {_safe_sql('t.condition')} AS column,
       CAST(list_contains(c.conditions, t.condition) AS INT) AS flag
FROM cond c, top t""", ctes=_CTES[1:2] + _CTES[3:]))
def q_condition_onehot(spark, d):
    oh = fh.onehot_conditions(_raw(spark, d))
    cc = [c for c in oh.columns if c.startswith("Cond_")]
    stack = ", ".join(f"'{c}', `{c}`" for c in cc)
    return oh.selectExpr("id AS patient_id", f"stack({len(cc)}, {stack}) AS (column, flag)")


@register("fhir_flatten", with_views(f"""
SELECT gender, maritalStatus, race, 'Unknown' AS ethnicity, age,
       round(coalesce(weight_kg, (SELECT quantile_cont(weight_kg, 0.5) FROM base)), 6) + 0.0 AS weight_kg,
       round(coalesce(heart_rate, (SELECT quantile_cont(heart_rate, 0.5) FROM base)), 6) + 0.0 AS heart_rate,
       round(coalesce(systolic_bp, (SELECT quantile_cont(systolic_bp, 0.5) FROM base)), 6) + 0.0 AS systolic_bp,
       round(coalesce(diastolic_bp, (SELECT quantile_cont(diastolic_bp, 0.5) FROM base)), 6) + 0.0 AS diastolic_bp,
       coalesce(smoking_status, (SELECT smoking_status FROM base WHERE smoking_status IS NOT NULL
                                 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS smoking_status,
       cond_flags, n_cond_cols
FROM base""", ctes=_CTES + [("base", f"""
SELECT DISTINCT p.gender, p.maritalStatus, p.race, p.age, v.weight_kg, v.heart_rate, v.systolic_bp,
       v.diastolic_bp, v.smoking_status,
       list_sort(list_filter((SELECT list({_safe_sql('condition')}) FROM top),
                             lambda n: list_contains(list_transform(c.conditions, lambda x: {_safe_sql('x')}), n)))
         AS cond_flags,
       (SELECT count(*) FROM top) AS n_cond_cols
FROM pat p JOIN vit v USING (user_id) JOIN cond c USING (user_id) WHERE p.age IS NOT NULL""")]))
def q_fhir_flatten(spark, d):
    df = fh.flatten(fx.bundles(spark, d))
    cc = [c for c in df.columns if c.startswith("Cond_")]
    flags = F.array_sort(F.filter(F.array(*[F.when(F.col(c) == 1, F.lit(c)) for c in cc]), lambda x: x.isNotNull()))
    from cohortlens.functions.expr import r6
    vit = ["weight_kg", "heart_rate", "systolic_bp", "diastolic_bp"]
    return df.select(*[r6(F.col(c)).alias(c) if c in vit else F.col(c) for c in df.columns if c not in cc],
                     flags.alias("cond_flags"),
                     F.lit(len(cc)).cast("bigint").alias("n_cond_cols"))
