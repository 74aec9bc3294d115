"""Derived test views over the driver's tables, in Spark *and* DuckDB SQL.

Each view exists twice: a DataFrame builder (used by ``queries()``) and a SQL
text (inlined as a CTE into ``oracle_sql()``). The two must stay equal.
Both sides read whole tables: one-table operators use ``li`` (all rows of
``lineitem``); two-table operators compare its two halves ``real_li`` and
``synth_li`` (the latter with a shifted price and re-labelled classes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.io import spread, table

# Row key of the lineitem views (l_orderkey, l_linenumber alone repeat).
LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# Metric columns: the four doubles, the 3-class target and the binary flag.
LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "flag_cls", "status_bin"]
LI_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _li(spark, d, synthetic: bool | None) -> DataFrame:
    li = table(spark, d, "lineitem")
    if synthetic:   # class shift: late lines of returned orders count as not returned
        li = li.withColumn("l_returnflag", F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") > 3), "N")
                           .otherwise(F.col("l_returnflag")))
    flag = (F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "A", 1)
            .otherwise(2))
    status = F.when(F.col("l_linestatus") == "F", 1).otherwise(0)
    price = F.col("l_extendedprice") * F.lit(1.1) if synthetic else F.col("l_extendedprice")
    if synthetic is not None:
        li = li.where(F.col("l_orderkey") % 2 == int(synthetic))
    return li.select(*LI_KEY[:2], "l_partkey", "l_suppkey", "l_quantity",
                     price.alias("l_extendedprice"), "l_discount", "l_tax",
                     flag.alias("flag_cls"), status.alias("status_bin"),
                     "l_returnflag", "l_linestatus").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "flag_cls", "status_bin", "l_returnflag", "l_linestatus")


def li(spark: SparkSession, d: str) -> DataFrame:
    return _li(spark, d, None)


def real_li(spark: SparkSession, d: str) -> DataFrame:
    return _li(spark, d, False)


def synth_li(spark: SparkSession, d: str) -> DataFrame:
    return _li(spark, d, True)


def dirty_ord(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    b = o.select(
        k,
        F.when(k % 7 == 0, F.lit(None).cast("double")).when(k % 101 == 0, F.lit(-1.0))
        .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 50 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.when(k % 9 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
        .alias("diagnosis_text"),
        "o_orderstatus")
    return b.unionAll(b.where(k % 10 == 0))


def patients(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("patient_id"), (k % 2).cast("int").alias("Sex"), (18 + k % 73).cast("int").alias("Age"),
        (k % 3).cast("int").alias("Diabetes_Target"),
        F.when(k % 4 == 0, 1).otherwise(0).alias("Has_Hypertension"),
        F.when(k % 9 == 0, 1).otherwise(0).alias("Has_Hypothyroidism"),
        F.col("c_acctbal").alias("bmi_like"), F.col("c_mktsegment").alias("segment"))


def requests(spark: SparkSession, d: str) -> DataFrame:
    """One plain-language cohort request per customer row (the driver's text
    tables hold no requests). The text varies with the key so that every
    parser branch is hit: first-integer quirk, both genders, over/under/
    range, known, unknown and severity words, and empty text."""
    c = spread(table(spark, d, "customer").select("c_custkey", "c_nationkey"))
    k = F.col("c_custkey")
    s = lambda x: x.cast("string")
    n = s(5 + k % 50)
    gender = (F.when(k % 3 == 0, F.lit("male ")).when(k % 3 == 1, F.lit("female "))
              .otherwise(F.lit("")))
    age = (F.when(k % 4 == 0, F.concat(F.lit(" over age "), s(20 + k % 40)))
           .when(k % 4 == 1, F.concat(F.lit(" under "), s(30 + k % 50)))
           .when(k % 4 == 2, F.concat(F.lit(" older than "), s(18 + k % 30),
                                      F.lit(" and younger than "), s(50 + k % 40)))
           .otherwise(F.lit("")))
    cond = (F.when(F.col("c_nationkey") % 6 == 0, F.lit(" with diabetes"))
            .when(F.col("c_nationkey") % 6 == 1, F.lit(" with hypertension"))
            .when(F.col("c_nationkey") % 6 == 2, F.lit(" with diabetes and hypertension"))
            .when(F.col("c_nationkey") % 6 == 3, F.lit(" with severe diabetes"))
            .when(F.col("c_nationkey") % 6 == 4, F.lit(" with mild hypothyroidism"))
            .otherwise(F.lit(" with asthma")))
    text = F.when(k % 97 == 0, F.lit("")).otherwise(
        F.concat(F.lit("Generate "), n, F.lit(" "), gender, F.lit("patients"), age, cond))
    return c.select(k.alias("request_id"), text.alias("prompt"))


def bundles(spark: SparkSession, d: str) -> DataFrame:
    """One FHIR Bundle (JSON text, parsed back with the explicit schema) per
    ``events.user_id``: a Patient entry, then one entry per event in
    event_id order (view → Body Weight, click → Heart rate, purchase → BP
    panel, error → smoking status, signup → Condition)."""
    from cohortlens.sources.fhir import bundle_json, bundles_from_json
    ev = table(spark, d, "events")
    u = F.col("user_id")
    users = ev.select("user_id").distinct()
    race_ext = F.array(F.struct(
        F.lit("http://hl7.org/fhir/us/core/StructureDefinition/us-core-race").alias("url"),
        F.array(F.struct(F.lit("text").alias("url"), F.concat(F.lit("race"), (u % 3).cast("string"))
                         .alias("valueString"))).alias("extension")))
    patient = F.struct(
        F.lit("Patient").alias("resourceType"), u.cast("string").alias("id"),
        F.when(u % 2 == 0, "male").otherwise("female").alias("gender"),
        F.when(u % 40 == 0, F.lit("not-a-date")).otherwise(
            F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (u * 37).cast("int")), "yyyy-MM-dd"))
        .alias("birthDate"),
        F.when(u % 5 == 0, F.lit(None)).otherwise(
            F.struct(F.when(u % 2 == 0, "M").otherwise("S").alias("text"))).alias("maritalStatus"),
        race_ext.alias("extension"))
    pe = users.select("user_id", F.lit(-1).cast("bigint").alias("event_id"),
                      F.to_json(F.struct(patient.alias("resource"))).alias("js"))
    et, e, v = F.col("event_type"), F.col("event_id"), F.col("value")
    obs = lambda text, **kw: F.struct(F.lit("Observation").alias("resourceType"),
                                      F.struct(F.lit(text).alias("text")).alias("code"),
                                      *[c.alias(k) for k, c in kw.items()])
    tj = lambda r: F.to_json(F.struct(r.alias("resource")))
    comp = lambda name, x: F.struct(F.struct(F.lit(name).alias("text")).alias("code"),
                                    F.struct(x.alias("value")).alias("valueQuantity"))
    weight = obs("Body Weight", valueQuantity=F.struct(v.alias("value")))
    heart = obs("Heart rate", valueQuantity=F.struct(v.alias("value")))
    bp = obs("Blood pressure panel with all children optional",
             component=F.array(comp("Systolic Blood Pressure", v), comp("Diastolic Blood Pressure", v / 2)))
    smoke = obs("Tobacco smoking status", valueString=F.concat(F.lit("s"), (e % 3).cast("string")))
    cond = F.struct(
        F.lit("Condition").alias("resourceType"),
        F.struct(F.array(F.struct(F.when(e % 2 == 0, "active").otherwise("resolved").alias("code"))).alias("coding"))
        .alias("clinicalStatus"),
        F.struct(F.concat(F.lit("Finding "), (e % 25).cast("string"), F.lit(" (disorder)")).alias("text")).alias("code"))
    res = (F.when(et == "view", tj(weight)).when(et == "click", tj(heart)).when(et == "purchase", tj(bp))
           .when(et == "error", tj(smoke)).when(et == "signup", tj(cond)))
    ee = ev.select("user_id", "event_id", res.alias("js")).where(F.col("js").isNotNull())
    docs = (pe.unionByName(ee).groupBy("user_id")
            .agg(F.sort_array(F.collect_list(F.struct("event_id", "js"))).alias("es"))
            .select("user_id", bundle_json(F.transform("es", lambda x: x["js"])).alias("doc")))
    return bundles_from_json(docs, "doc", "user_id")


def emb_split(spark: SparkSession, d: str, parity: int) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.where(F.col("vec_id") % 2 == parity).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")


def emb_real(spark, d):
    return emb_split(spark, d, 0)


def emb_synth(spark, d):
    return emb_split(spark, d, 1)


# --------------------------------------------------------------------------
# SQL text of the same views (runs unchanged in DuckDB; CTE bodies)
# --------------------------------------------------------------------------

_LI_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS flag_cls,
       CASE l_linestatus WHEN 'F' THEN 1 ELSE 0 END AS status_bin, l_returnflag, l_linestatus
FROM lineitem"""

SQL = {
    "li": _LI_SQL,
    "real_li": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS flag_cls,
       CASE l_linestatus WHEN 'F' THEN 1 ELSE 0 END AS status_bin, l_returnflag, l_linestatus
FROM lineitem WHERE l_orderkey % 2 = 0""",
    "synth_li": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice * 1.1 AS l_extendedprice,
       l_discount, l_tax,
       CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS flag_cls,
       CASE l_linestatus WHEN 'F' THEN 1 ELSE 0 END AS status_bin, l_returnflag, l_linestatus
FROM (SELECT * REPLACE (CASE WHEN l_returnflag = 'R' AND l_linenumber > 3 THEN 'N' ELSE l_returnflag END AS l_returnflag)
      FROM lineitem) AS lineitem WHERE l_orderkey % 2 = 1""",
    "dirty_b": """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN -1.0 ELSE o_totalprice END
         AS o_totalprice,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS diagnosis_text,
       o_orderstatus
FROM orders""",
    "dirty_ord": "SELECT * FROM dirty_b UNION ALL SELECT * FROM dirty_b WHERE o_orderkey % 10 = 0",
    "patients": """
SELECT c_custkey AS patient_id, CAST(c_custkey % 2 AS INT) AS Sex, CAST(18 + c_custkey % 73 AS INT) AS Age,
       CAST(c_custkey % 3 AS INT) AS Diabetes_Target,
       CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS Has_Hypertension,
       CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END AS Has_Hypothyroidism,
       c_acctbal AS bmi_like, c_mktsegment AS segment
FROM customer""",
    "requests": """
SELECT c_custkey AS request_id,
  CASE WHEN c_custkey % 97 = 0 THEN '' ELSE
  'Generate ' || CAST(5 + c_custkey % 50 AS VARCHAR) || ' ' ||
  CASE c_custkey % 3 WHEN 0 THEN 'male ' WHEN 1 THEN 'female ' ELSE '' END || 'patients' ||
  CASE c_custkey % 4 WHEN 0 THEN ' over age ' || CAST(20 + c_custkey % 40 AS VARCHAR)
       WHEN 1 THEN ' under ' || CAST(30 + c_custkey % 50 AS VARCHAR)
       WHEN 2 THEN ' older than ' || CAST(18 + c_custkey % 30 AS VARCHAR) || ' and younger than '
                   || CAST(50 + c_custkey % 40 AS VARCHAR)
       ELSE '' END ||
  CASE c_nationkey % 6 WHEN 0 THEN ' with diabetes' WHEN 1 THEN ' with hypertension'
       WHEN 2 THEN ' with diabetes and hypertension' WHEN 3 THEN ' with severe diabetes'
       WHEN 4 THEN ' with mild hypothyroidism' ELSE ' with asthma' END
  END AS prompt
FROM customer""",
    "emb_real": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings WHERE vec_id % 2 = 0",
    "emb_synth": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings WHERE vec_id % 2 = 1",
}

# views whose SQL references another derived view
_DEPS = {"dirty_ord": ["dirty_b"]}


def with_views(body: str, *views: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the CTEs for ``views`` (and extra ``ctes``)."""
    order: list[str] = []

    def add(v):
        for dep in _DEPS.get(v, []):
            add(dep)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    parts = [f"{v} AS ({SQL[v]})" for v in order]
    parts += [f"{n} AS ({s})" for n, s in (ctes or [])]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
