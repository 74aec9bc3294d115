"""Registered queries: privacy metrics (nearest-record distance, re-id risk,
copies, k-anonymity, attack-style risks) on the whole lineitem halves."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.functions.expr import r6
from cohortlens.operators import privacy as pv
from cohortlens.plans import fixtures as fx
from cohortlens.plans import sqlbits as sb
from cohortlens.plans.fixtures import with_views
from cohortlens.plans.registry import register

FEAT = fx.LI_FEATURES
KEY = fx.LI_KEY
COPY_COLS = ["l_quantity", "l_discount", "l_tax", "flag_cls", "status_bin"]
QIS = ["l_quantity", "l_extendedprice", "flag_cls"]


def _dcr_rows(spark, d):
    return pv.nearest_distance(fx.real_li(spark, d), fx.synth_li(spark, d), FEAT, keep=KEY)


# ---------------------------------------------------------------- oracle text
def _z(c, i):
    return f"((CAST({c} AS DOUBLE) - st.m{i}) / st.s{i})"


_ST = ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS m{i}, CASE WHEN stddev_samp(CAST({c} AS DOUBLE)) IS NULL "
    f"OR stddev_samp(CAST({c} AS DOUBLE)) = 0 THEN 1.0 ELSE stddev_samp(CAST({c} AS DOUBLE)) END AS s{i}"
    for i, c in enumerate(FEAT))
_DCR_CTES = [
    ("st", f"SELECT {_ST} FROM real_li"),
    ("rz", "SELECT DISTINCT " + ", ".join(f"{_z(c, i)} AS z{i}" for i, c in enumerate(FEAT)) + " FROM real_li, st"),
    ("sz", "SELECT " + ", ".join(KEY) + ", " + ", ".join(f"{_z(c, i)} AS z{i}" for i, c in enumerate(FEAT))
     + " FROM synth_li, st"),
    ("dr", "SELECT " + ", ".join(f"s.{k}" for k in KEY) + ", sqrt(min("
     + " + ".join(f"(s.z{i} - r.z{i}) * (s.z{i} - r.z{i})" for i in range(len(FEAT)))
     + ")) AS dcr FROM sz s, rz r GROUP BY " + ", ".join(f"s.{k}" for k in KEY)),
]


def _dcr_sql(body):
    return with_views(body, "real_li", "synth_li", ctes=_DCR_CTES)


# ------------------------------------------------------------------ J1 DCR
@register("dcr_rows", _dcr_sql(f"SELECT {', '.join(KEY)}, {sb.r6('dcr')} AS dcr FROM dr"))
def q_dcr_rows(spark, d):
    return _dcr_rows(spark, d).select(*KEY, r6(F.col("dcr")).alias("dcr"))


_SUM = """{br_avg} AS avg_dcr, {br_med} AS median_dcr, {br_min} AS min_dcr{maxcol},
count_if(dcr < 1e-6) AS exact_match_count, {br_pct} AS exact_match_percent FROM dr"""


def _summary_sql(full: bool):
    return _dcr_sql("SELECT " + _SUM.format(
        br_avg=sb.br("avg(dcr)", 4), br_med=sb.br("quantile_cont(dcr, 0.5)", 4), br_min=sb.br("min(dcr)", 4),
        maxcol=(", " + sb.br("max(dcr)", 4) + " AS max_dcr") if full else "",
        br_pct=sb.br("count_if(dcr < 1e-6) / count(*) * 100", 2)))


@register("dcr_core", _summary_sql(False))
def q_dcr_core(spark, d):
    return pv.dcr_summary(_dcr_rows(spark, d), "core")


@register("dcr_full", _summary_sql(True))
def q_dcr_full(spark, d):
    return pv.dcr_summary(_dcr_rows(spark, d), "full")


# ------------------------------------------------------------------ J2 re-id
@register("reid_core", _dcr_sql(f"""
SELECT {sb.br('avg(exp(-dcr))', 4)} AS avg_risk_score, {sb.br('max(exp(-dcr))', 4)} AS max_risk_score,
       count_if(exp(-dcr) > 0.5) AS high_risk_count,
       {sb.br('count_if(exp(-dcr) > 0.5) / count(*) * 100', 2)} AS high_risk_percent FROM dr"""))
def q_reid_core(spark, d):
    return pv.reid_risk(_dcr_rows(spark, d), "core")


@register("reid_full", _dcr_sql(f"""
SELECT {sb.br('avg(1.0 / (1.0 + dcr))', 4)} AS avg_risk_score, {sb.br('max(1.0 / (1.0 + dcr))', 4)} AS max_risk_score,
       {sb.br('min(1.0 / (1.0 + dcr))', 4)} AS min_risk_score,
       {sb.br('count_if(1.0 / (1.0 + dcr) > 0.5) / count(*) * 100', 2)} AS pct_high_risk FROM dr"""))
def q_reid_full(spark, d):
    return pv.reid_risk(_dcr_rows(spark, d), "full")


# ------------------------------------------------------------- embeddings
@register("dcr_embeddings", with_views("""
SELECT s.vec_id, round(min(list_distance(s.embedding, r.embedding)), 6) + 0.0 AS dcr
FROM emb_synth s, emb_real r GROUP BY s.vec_id""", "emb_real", "emb_synth"))
def q_dcr_embeddings(spark, d):
    r = pv.nearest_distance(fx.emb_real(spark, d), fx.emb_synth(spark, d), vector_col="embedding",
                            keep=["vec_id"])
    return r.select("vec_id", r6(F.col("dcr")).alias("dcr"))


# --------------------------------------------------------------- J3 copies
_COPY_COND = " AND ".join(f"r.{c} IS NOT DISTINCT FROM s.{c}" for c in COPY_COLS)


@register("exact_copies", with_views(f"""
SELECT {', '.join(KEY + COPY_COLS)} FROM synth_li s
WHERE EXISTS (SELECT 1 FROM real_li r WHERE {_COPY_COND})""", "real_li", "synth_li"))
def q_exact_copies(spark, d):
    return pv.exact_copies(fx.real_li(spark, d), fx.synth_li(spark, d).select(*KEY, *COPY_COLS), COPY_COLS)


@register("novel_rows", with_views(f"""
SELECT {', '.join(KEY + COPY_COLS)} FROM synth_li s
WHERE NOT EXISTS (SELECT 1 FROM real_li r WHERE {_COPY_COND})""", "real_li", "synth_li"))
def q_novel_rows(spark, d):
    return pv.novel_rows(fx.real_li(spark, d), fx.synth_li(spark, d).select(*KEY, *COPY_COLS), COPY_COLS)


# ------------------------------------------------------------ A6 k-anonymity
_DEC = "[" + ", ".join(f"{i / 10}" for i in range(11)) + "]"
_KB_CORE = [
    ("e", f"""SELECT list_sort(list_distinct(list_transform(quantile_cont(l_quantity, {_DEC}), lambda y: round(y, 6))))
                AS eq,
              list_sort(list_distinct(list_transform(quantile_cont(l_extendedprice, {_DEC}), lambda y: round(y, 6))))
                AS ep FROM li"""),
    ("g", """SELECT len(list_filter(eq[2:len(eq) - 1], lambda y: y < l_quantity)) AS l_quantity,
                    len(list_filter(ep[2:len(ep) - 1], lambda y: y < l_extendedprice)) AS l_extendedprice,
                    flag_cls, count(*) AS k
             FROM li, e GROUP BY ALL"""),
]


def _inner(mn, mx):
    return "[" + ", ".join(f"{mn} + {j} * (({mx} - {mn}) / 10)" for j in range(1, 10)) + "]"


_KB_FULL = [
    ("e", """SELECT min(l_quantity) AS qa, max(l_quantity) AS qb, min(l_extendedprice) AS pa,
                    max(l_extendedprice) AS pb FROM li"""),
    ("g", f"""SELECT len(list_filter({_inner('qa', 'qb')}, lambda y: y < l_quantity)) AS l_quantity,
                     len(list_filter({_inner('pa', 'pb')}, lambda y: y < l_extendedprice)) AS l_extendedprice,
                     flag_cls, count(*) AS k
              FROM li, e GROUP BY ALL"""),
]

_BUCKETS = [("d_1_5", "k <= 5"), ("d_6_10", "k > 5 AND k <= 10"), ("d_11_20", "k > 10 AND k <= 20"),
            ("d_21_50", "k > 20 AND k <= 50"), ("d_51_plus", "k > 50")]


def _kanon_sql(full: bool):
    unit = "k" if full else "1"
    dist = ", ".join(f"CAST(sum(CASE WHEN {c} THEN {unit} ELSE 0 END) AS BIGINT) AS {n}" for n, c in _BUCKETS)
    pct = sb.br("sum(CASE WHEN k <= 5 THEN k ELSE 0 END) / sum(k) * 100", 2)
    if full:
        head = f"CAST(min(k) AS BIGINT) AS k_min, CAST(max(k) AS BIGINT) AS k_max, {sb.br('avg(k)', 1)} AS k_mean"
    else:
        head = (f"CAST(min(k) AS BIGINT) AS k_min, CAST(floor(quantile_cont(k, 0.5)) AS BIGINT) AS k_median, "
                f"{sb.br('avg(k)', 2)} AS k_mean")
    return with_views(f"SELECT {head}, {pct} AS pct_records_k_leq_5, {dist} FROM g", "li",
                      ctes=_KB_FULL if full else _KB_CORE)


@register("kanon_core", _kanon_sql(False))
def q_kanon_core(spark, d):
    return pv.k_anonymity(fx.li(spark, d), QIS, "core")


@register("kanon_full", _kanon_sql(True))
def q_kanon_full(spark, d):
    return pv.k_anonymity(fx.li(spark, d), QIS, "full")


@register("kanon_groups", with_views("SELECT l_quantity, l_extendedprice, flag_cls, k FROM g", "li",
                                     ctes=_KB_CORE))
def q_kanon_groups(spark, d):
    return pv.k_groups(fx.li(spark, d), QIS, "core").select(
        F.col("l_quantity").cast("bigint").alias("l_quantity"),
        F.col("l_extendedprice").cast("bigint").alias("l_extendedprice"), "flag_cls", "k")


# ----------------------------------------------------------- D1 singling out
_SO = ", ".join(COPY_COLS)


@register("singling_out", with_views(f"""
SELECT count(*) AS unique_synth_combos, count_if(r.nr = 1) AS singled_out,
       {sb.r6('coalesce(count_if(r.nr = 1) / nullif(count(*), 0), 0.0)')} AS singling_out_risk
FROM (SELECT {_SO} FROM synth_li GROUP BY {_SO} HAVING count(*) = 1) s
LEFT JOIN (SELECT {_SO}, count(*) AS nr FROM real_li GROUP BY {_SO}) r
  ON {" AND ".join(f"s.{c} IS NOT DISTINCT FROM r.{c}" for c in COPY_COLS)}""", "real_li", "synth_li"))
def q_singling_out(spark, d):
    return pv.singling_out(fx.real_li(spark, d), fx.synth_li(spark, d), COPY_COLS)


# ---------------------------------------------------- D2 / D3 (rows-only)
def _nearest_ctes(name: str, cols: list[str], payload: str) -> list[tuple[str, str]]:
    """Payload of the nearest synthetic row (smallest among equidistant ones)
    for every distinct real vector: the CTE ``<name>n`` (z…, p)."""
    at = [FEAT.index(c) for c in cols]
    z = [f"z{i}" for i in at]
    zs = ", ".join(f"{_z(c, i)} AS z{i}" for c, i in zip(cols, at))
    d2 = " + ".join(f"(q.{x} - r.{x}) * (q.{x} - r.{x})" for x in z)
    qz = ", ".join(f"q.{x}" for x in z)
    return [(f"{name}s", f"SELECT {zs}, min({payload}) AS p FROM synth_li, st GROUP BY {', '.join(map(str, range(1, len(z) + 1)))}"),
            (f"{name}q", f"SELECT DISTINCT {zs} FROM real_li, st"),
            (f"{name}m", f"SELECT {qz}, min({d2}) AS d FROM {name}q q, {name}s r GROUP BY {qz}"),
            (f"{name}n", f"SELECT {qz}, min(r.p) AS p FROM {name}m q, {name}s r WHERE {d2} = q.d GROUP BY {qz}")]


def _nearest_sql(body: str, *searches) -> str:
    ctes = [c for s in searches for c in _nearest_ctes(*s)]
    return with_views(body, "real_li", "synth_li", ctes=[("st", f"SELECT {_ST} FROM real_li"), *ctes])


_SID = "concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in KEY) + ")"
_LINK_A, _LINK_B = ["l_quantity", "l_extendedprice"], ["l_discount", "l_tax", "flag_cls"]
_GUESS = ["l_quantity", "l_extendedprice", "l_discount"]


def _same(name: str, cols: list[str]) -> str:
    return " AND ".join(f"{name}.z{FEAT.index(c)} = {_z('t.' + c, FEAT.index(c))}" for c in cols)


@register("linkability", _nearest_sql(f"""
SELECT count(*) AS n_real, count_if(a.p = b.p) AS linked, round(count_if(a.p = b.p) / count(*), 6) + 0.0 AS linkability_risk
FROM real_li t, st, nn_an a, nn_bn b WHERE {_same('a', _LINK_A)} AND {_same('b', _LINK_B)}""",
                                      ("nn_a", _LINK_A, _SID), ("nn_b", _LINK_B, _SID)))
def q_linkability(spark, d):
    return pv.linkability(fx.real_li(spark, d), fx.synth_li(spark, d), _LINK_A, _LINK_B, synth_key=KEY)


@register("attribute_inference", _nearest_sql(f"""
SELECT count(*) AS n_real, count_if(a.p = CAST(t.status_bin AS VARCHAR)) AS correct,
       round(count_if(a.p = CAST(t.status_bin AS VARCHAR)) / count(*), 6) + 0.0 AS inference_accuracy
FROM real_li t, st, nn_an a WHERE {_same('a', _GUESS)}""", ("nn_a", _GUESS, "CAST(status_bin AS VARCHAR)")))
def q_attribute_inference(spark, d):
    return pv.attribute_inference(fx.real_li(spark, d), fx.synth_li(spark, d), _GUESS, "status_bin", real_key=KEY)
