"""FHIR flattening (F1–F7): bundles → one row per patient.

A bundle is one row, so patient fields, active conditions and vitals are
array functions over its entries (last in file order wins — the reference
keeps the last value seen, not the latest date): no explode, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import clean as cl

# Observation code text → column, blood-pressure panel.
VITAL_MAP = {
    "Body Height": "height_cm",
    "Body Weight": "weight_kg",
    "Body mass index (BMI) [Ratio]": "bmi",
    "Heart rate": "heart_rate",
    "Glucose [Mass/volume] in Serum or Plasma": "glucose_mg_dL",
    "Cholesterol [Mass/volume] in Serum or Plasma": "cholesterol_mg_dL",
    "Cholesterol in HDL [Mass/volume] in Serum or Plasma": "hdl_mg_dL",
    "Low Density Lipoprotein Cholesterol": "ldl_mg_dL",
    "Triglycerides": "triglycerides_mg_dL",
    "Creatinine [Mass/volume] in Serum or Plasma": "creatinine_mg_dL",
    "Tobacco smoking status": "smoking_status",
}
BP_PANEL_TEXT = "Blood pressure panel with all children optional"
BP_COMPONENT_MAP = {"Systolic Blood Pressure": "systolic_bp", "Diastolic Blood Pressure": "diastolic_bp"}
TEXT_VITALS = {"smoking_status"}
VITAL_COLS = list(VITAL_MAP.values()) + list(BP_COMPONENT_MAP.values())
AGE_ASOF = "2026-01-01"
DEMOGRAPHICS = ["race", "ethnicity", "maritalStatus", "gender"]
TOP_K = 20
# Replacements that make a condition text a column name.
NAME_REPLACEMENTS = [(" (finding)", ""), (" (disorder)", ""), (" ", "_"), (",", ""), ("(", ""), (")", "")]


def _map_expr(m: dict, key: Column) -> Column:
    e = None
    for k, v in m.items():
        e = F.when(key == k, F.lit(v)) if e is None else e.when(key == k, F.lit(v))
    return e


def entries(bundles: DataFrame) -> DataFrame:
    """(bundle_id, pos, resource) — one row per entry; a bundle without
    entries still yields a row (NULL resource)."""
    return bundles.select("bundle_id", F.posexplode_outer("bundle.entry").alias("pos", "e")).select(
        "bundle_id", "pos", F.col("e.resource").alias("r"))


def _ext_text(r: Column, tag: str) -> Column:
    """valueString of the last sub-extension with url 'text' inside any
    extension whose url contains ``tag``."""
    exts = F.filter(F.coalesce(r["extension"], F.array()), lambda e: F.coalesce(e["url"], F.lit("")).contains(tag))
    vals = F.flatten(F.transform(exts, lambda e: F.transform(
        F.filter(F.coalesce(e["extension"], F.array()), lambda s: s["url"] == "text"), lambda s: s["valueString"])))
    return F.when(F.size(vals) > 0, F.element_at(vals, -1))


def _facts(resources: Column) -> Column:
    """Vitals of a bundle in file order: array of (col, num, txt)."""
    kind = "array<struct<col:string,num:double,txt:string>>"
    none = F.array().cast(kind)

    def fact(col: Column, num: Column, txt: Column) -> Column:
        return F.struct(col.alias("col"), num.cast("double").alias("num"), txt.cast("string").alias("txt"))

    def panel(r: Column) -> Column:
        return F.transform(F.coalesce(r["component"], F.array()), lambda c: fact(
            _map_expr(BP_COMPONENT_MAP, c["code"]["text"]), c["valueQuantity"]["value"], F.lit(None)))

    def single(r: Column) -> Column:
        q = r["valueQuantity"]["value"]
        s = F.nullif(r["valueString"], F.lit(""))
        cc = F.nullif(r["valueCodeableConcept"]["text"], F.lit(""))
        col = _map_expr(VITAL_MAP, r["code"]["text"])
        is_text = F.coalesce(col.isin(*TEXT_VITALS), F.lit(False))
        return F.array(fact(col, F.when(~is_text, F.coalesce(q, s.try_cast("double"), cc.try_cast("double"))),
                            F.when(is_text, F.coalesce(q.cast("string"), s, cc))))

    found = F.transform(F.filter(resources, lambda r: r["resourceType"] == "Observation"), lambda r: F.coalesce(
        F.when(r["code"]["text"] == BP_PANEL_TEXT, panel(r)).otherwise(single(r)), none))
    return F.filter(F.flatten(found), lambda f: f["col"].isNotNull() & (f["num"].isNotNull() | f["txt"].isNotNull()))


def flatten_raw(bundles: DataFrame) -> DataFrame:
    """One row per bundle: id, gender, birthDate, maritalStatus, race,
    ethnicity, conditions (active, file order, duplicates kept) and every
    vital column (F1–F4). A bundle is one row already, so everything is an
    array function over its entries: no shuffle."""
    base = bundles.select("bundle_id", F.filter(
        F.transform(F.coalesce(F.col("bundle.entry"), F.array()), lambda e: e["resource"]), lambda r: r.isNotNull()).alias("_r"))
    last = lambda a: F.try_element_at(a, F.lit(-1))

    def active(r: Column) -> Column:
        status = F.get(F.coalesce(r["clinicalStatus"]["coding"], F.array()), 0)["code"]
        return F.coalesce((r["resourceType"] == "Condition") & (status == "active") & (F.length(r["code"]["text"]) > 0),
                          F.lit(False))

    base = base.select("bundle_id", last(F.filter("_r", lambda r: r["resourceType"] == "Patient")).alias("_p"),
                       F.transform(F.filter("_r", active), lambda r: r["code"]["text"]).alias("conditions"),
                       _facts(F.col("_r")).alias("_f"))
    p = F.col("_p")
    marital = F.when(p.isNotNull(), F.coalesce(p["maritalStatus"]["text"], F.lit("Unknown")))
    vital = lambda c: last(F.filter("_f", lambda f: f["col"] == c))["txt" if c in TEXT_VITALS else "num"]
    return base.select("bundle_id", p["id"].alias("id"), p["gender"].alias("gender"), p["birthDate"].alias("birthDate"),
                       marital.alias("maritalStatus"), _ext_text(p, "us-core-race").alias("race"),
                       _ext_text(p, "us-core-ethnicity").alias("ethnicity"), "conditions",
                       *[vital(c).alias(c) for c in VITAL_COLS])


def patient_age(birth: Column, asof: str = AGE_ASOF) -> Column:
    """floor(days to ``asof`` / 365); unparseable dates → NULL."""
    d = F.try_to_date(birth)
    return F.floor(F.datediff(F.lit(asof).cast("date"), d) / F.lit(365)).cast("bigint")


def safe_condition_name(c: Column) -> Column:
    """Condition text → column-safe name (same replacement chain as the
    reference)."""
    for a, b in NAME_REPLACEMENTS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.concat(F.lit("Cond_"), c)


def top_conditions(df: DataFrame, col: str = "conditions", k: int = TOP_K) -> DataFrame:
    """(condition, n) top-k list elements counted with multiplicity, ties by
    name (A5)."""
    return (df.select(F.explode(col).alias("condition")).groupBy("condition")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("condition")).limit(k))


def sanitize_name(name: str) -> str:
    return name.replace(",", "").replace("(", "").replace(")", "")


def safe_name(name: str) -> str:
    """Python twin of ``safe_condition_name`` for the k collected names."""
    for a, b in NAME_REPLACEMENTS:
        name = name.replace(a, b)
    return "Cond_" + name


def onehot_conditions(df: DataFrame, col: str = "conditions", k: int = TOP_K) -> DataFrame:
    """Add ``Cond_<safe name>`` 0/1 columns for the top-k conditions (F6);
    the k names are the only driver round trip."""
    names = [row["condition"] for row in top_conditions(df, col, k).collect()]
    return df.select("*", *[F.array_contains(F.col(col), n).cast("int").alias(safe_name(n)) for n in names])


def flatten(bundles: DataFrame, drop_empty_vitals: bool = True) -> DataFrame:
    """Whole pipeline (F7): flatten → age → one-hot top-20 → drop id and
    conditions → de-duplicate → drop NULL age → vitals median/mode fill →
    demographics 'Unknown' → sanitise names. Vital columns never observed
    are dropped, as the reference never creates them."""
    from cohortlens.operators.privacy import reuse
    # several small statistics actions follow (top-20, observed vitals, medians): read the bundles once
    raw = reuse(flatten_raw(bundles).withColumn("age", patient_age(F.col("birthDate"))).drop("birthDate"))
    oh = onehot_conditions(raw).drop("conditions", "id", "bundle_id")
    if drop_empty_vitals:
        seen = oh.agg(*[F.count(F.col(c)).alias(c) for c in VITAL_COLS]).first()
        oh = oh.drop(*[c for c in VITAL_COLS if not seen[c]])
    oh = cl.dedup(oh).where(F.col("age").isNotNull())
    vit = [c for c in VITAL_COLS if c in oh.columns]
    oh = cl.fill_median_mode(oh, vit)
    oh = cl.fill_values(oh, {c: "Unknown" for c in DEMOGRAPHICS})
    return oh.toDF(*[sanitize_name(c) for c in oh.columns])
