"""Registered queries: cleaning operators over ``dirty_ord`` / ``orders`` /
the lineitem views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import clean as cl
from cohortlens.plans import fixtures as fx
from cohortlens.plans.fixtures import with_views
from cohortlens.plans.registry import register
from cohortlens.sources import io

ORD_COLS = ["o_orderkey", "o_totalprice", "o_custkey", "diagnosis_text", "o_orderstatus"]
# floors for the orders-shaped fixture (same role as the clinical floors)
FLOORS_ORD = {"o_totalprice": 0, "o_custkey": 1}
KEYWORDS_ORD = {"Has_Urgent": "URGENT", "Has_High": "HIGH"}


# ------------------------------------------------------------------ A1 dedup
@register("dedup", with_views("SELECT DISTINCT * FROM dirty_ord", "dirty_ord"))
def q_dedup(spark, d):
    return cl.dedup(fx.dirty_ord(spark, d))


@register("dedup_report", with_views("""
SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after,
       CAST(sum(n) AS BIGINT) - count(*) AS duplicates_removed
FROM (SELECT count(*) AS n FROM dirty_ord GROUP BY o_orderkey, o_totalprice, o_custkey, diagnosis_text, o_orderstatus) g""", "dirty_ord"))
def q_dedup_report(spark, d):
    return cl.dedup_report(fx.dirty_ord(spark, d))


# -------------------------------------------------------------- P3 drop nulls
@register("drop_nulls", with_views(
    "SELECT * FROM dirty_ord WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in ORD_COLS), "dirty_ord"))
def q_drop_nulls(spark, d):
    return cl.drop_nulls(fx.dirty_ord(spark, d))


# ----------------------------------------------------------- P6 missing flags
@register("missing_flags", with_views("""
SELECT *, CAST(o_totalprice IS NULL AS INT) AS o_totalprice_is_missing,
       CAST(diagnosis_text IS NULL AS INT) AS diagnosis_text_is_missing
FROM dirty_ord""", "dirty_ord"))
def q_missing_flags(spark, d):
    # the flag set is decided by the data (null share > 5 %)
    return cl.add_missing_flags(fx.dirty_ord(spark, d))


# ------------------------------------------------------------------ P7 floors
@register("floor_to_null", with_views("""
SELECT o_orderkey, CASE WHEN o_totalprice < 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_custkey < 1 THEN NULL ELSE o_custkey END AS o_custkey, diagnosis_text, o_orderstatus
FROM dirty_ord""", "dirty_ord"))
def q_floor_to_null(spark, d):
    return cl.apply_floors(fx.dirty_ord(spark, d), FLOORS_ORD)


@register("floor_violations", with_views("""
SELECT 'o_totalprice' AS column, 0.0::DOUBLE AS floor, count_if(o_totalprice < 0) AS violations FROM dirty_ord
UNION ALL
SELECT 'o_custkey', 1.0::DOUBLE, count_if(o_custkey < 1) FROM dirty_ord""", "dirty_ord"))
def q_floor_violations(spark, d):
    return cl.floor_violations(fx.dirty_ord(spark, d), FLOORS_ORD)


# --------------------------------------------------------------- P8 winsorize
def _clip_sql(c, b):
    return (f"CASE WHEN {c} IS NULL THEN NULL ELSE "
            f"least(greatest(CAST({c} AS DOUBLE), {b}.{c}__b[1]), {b}.{c}__b[2]) END")


_WINS_BOUNDS = """SELECT quantile_cont(CAST(o_totalprice AS DOUBLE), [0.01, 0.99]) AS o_totalprice__b,
                         quantile_cont(CAST(o_custkey AS DOUBLE), [0.01, 0.99]) AS o_custkey__b FROM dirty_ord"""


@register("winsorize", with_views(f"""
SELECT o_orderkey, round({_clip_sql('o_totalprice', 'b')}, 6) + 0.0 AS o_totalprice,
       round({_clip_sql('o_custkey', 'b')}, 6) + 0.0 AS o_custkey, diagnosis_text, o_orderstatus
FROM dirty_ord, b""", "dirty_ord", ctes=[("b", _WINS_BOUNDS)]))
def q_winsorize(spark, d):
    w = cl.winsorize(fx.dirty_ord(spark, d), ["o_totalprice", "o_custkey"])
    return _r6(w, ["o_totalprice", "o_custkey"])


def _r6(df, cols):
    """Interpolated percentiles differ between engines in the last ulp:
    compare at 6 dp."""
    from cohortlens.functions.expr import r6
    return df.select(*[r6(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


# ----------------------------------------------------------- P9 keyword flags
@register("keyword_flags", with_views("""
SELECT o_orderkey, o_totalprice, o_custkey, o_orderstatus,
       CAST(coalesce(contains(upper(diagnosis_text), 'URGENT'), false) AS INT) AS Has_Urgent,
       CAST(coalesce(contains(upper(diagnosis_text), 'HIGH'), false) AS INT) AS Has_High
FROM dirty_ord""", "dirty_ord"))
def q_keyword_flags(spark, d):
    return cl.keyword_flags(fx.dirty_ord(spark, d), "diagnosis_text", KEYWORDS_ORD)


# -------------------------------------------------------- A3/I1 median & mode
def _mode_sql(view, c):
    return (f"(SELECT {c} FROM {view} WHERE {c} IS NOT NULL GROUP BY 1 "
            f"ORDER BY count(*) DESC, 1 ASC LIMIT 1)")


@register("fill_median_mode", with_views(f"""
SELECT o_orderkey,
       round(coalesce(CAST(o_totalprice AS DOUBLE), (SELECT quantile_cont(o_totalprice, 0.5) FROM dirty_ord)), 6)
         + 0.0 AS o_totalprice,
       round(coalesce(CAST(o_custkey AS DOUBLE), (SELECT quantile_cont(CAST(o_custkey AS DOUBLE), 0.5)
         FROM dirty_ord)), 6) + 0.0 AS o_custkey,
       coalesce(diagnosis_text, {_mode_sql('dirty_ord', 'diagnosis_text')}) AS diagnosis_text, o_orderstatus
FROM dirty_ord""", "dirty_ord"))
def q_fill_median_mode(spark, d):
    f = cl.fill_median_mode(fx.dirty_ord(spark, d), ["o_totalprice", "o_custkey", "diagnosis_text"])
    return _r6(f, ["o_totalprice", "o_custkey"])


# ---------------------------------------------------------- S2 NA tokens
_NA_SRC = """SELECT o_orderkey,
  CASE WHEN o_orderkey % 13 = 0 THEN 'NA' WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN 'n/a?'
       ELSE CAST(o_totalprice AS VARCHAR) END AS price_text,
  CASE WHEN o_orderkey % 11 = 0 THEN 'NA' ELSE o_orderpriority END AS priority_text
FROM orders"""


def _na_src(spark, d):
    o = io.table(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k, F.when(k % 13 == 0, "NA").when(k % 17 == 0, "").when(k % 19 == 0, "n/a?")
        .otherwise(F.col("o_totalprice").cast("string")).alias("price_text"),
        F.when(k % 11 == 0, "NA").otherwise(F.col("o_orderpriority")).alias("priority_text"))


@register("na_tokens", with_views("""
SELECT o_orderkey,
       TRY_CAST(CASE WHEN trim(price_text) IN ('NA', '') THEN NULL ELSE price_text END AS DOUBLE) AS price_text,
       CASE WHEN trim(priority_text) IN ('NA', '') THEN NULL ELSE priority_text END AS priority_text
FROM src""", ctes=[("src", _NA_SRC)]))
def q_na_tokens(spark, d):
    return io.normalize_na(_na_src(spark, d), ("NA", ""), types={"price_text": "double"})


# ------------------------------------------------------ set op: union distinct
_UD_COLS = "flag_cls, status_bin, l_quantity, l_discount"


@register("union_distinct", with_views(
    f"SELECT DISTINCT * FROM (SELECT {_UD_COLS} FROM real_li UNION ALL SELECT {_UD_COLS} FROM synth_li) u",
    "real_li", "synth_li"))
def q_union_distinct(spark, d):
    cols = [c.strip() for c in _UD_COLS.split(",")]
    return fx.real_li(spark, d).select(*cols).unionByName(fx.synth_li(spark, d).select(*cols)).dropDuplicates()


# ----------------------------------------------------------- I3 round types
_RT_SRC = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount * 10 AS disc_bin,
                    l_extendedprice / 100 AS price_int, l_tax FROM li"""


@register("round_types", with_views(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(least(greatest(round_even(CAST(disc_bin AS DOUBLE), 0), 0.0), 1.0) AS INT) AS disc_bin,
       CAST(round_even(CAST(price_int AS DOUBLE), 0) AS BIGINT) AS price_int, l_tax
FROM src""", "li", ctes=[("src", _RT_SRC)]))
def q_round_types(spark, d):
    r = fx.li(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                   (F.col("l_discount") * 10).alias("disc_bin"),
                                   (F.col("l_extendedprice") / 100).alias("price_int"), "l_tax")
    return cl.round_types(r, binary=["disc_bin"], integer=["price_int"])


# --------------------------------------------------------- A2 validation
_VAL_BIN = ["status_bin", "flag_cls"]


_VP_A = """SELECT count(*) AS rows, count_if(flag_cls IS NULL) AS nf, count_if(status_bin IS NULL) AS ns,
                  count_if(l_quantity IS NULL) AS nq, min(l_quantity) AS qmin, max(l_quantity) AS qmax,
                  min(CAST(flag_cls AS DOUBLE)) AS fmin, max(CAST(flag_cls AS DOUBLE)) AS fmax,
                  min(CAST(status_bin AS DOUBLE)) AS smin, max(CAST(status_bin AS DOUBLE)) AS smax,
                  count_if(status_bin NOT IN (0, 1)) AS sb, count_if(flag_cls NOT IN (0, 1)) AS fb FROM v"""
_VP_DD = "SELECT count(*) AS g, sum(n) AS n FROM (SELECT count(*) AS n FROM v GROUP BY l_quantity, flag_cls, status_bin) x"
_VP_T = """SELECT cls, count(*) / sum(count(*)) OVER () AS share FROM
            (SELECT CAST(round_even(CAST(flag_cls AS DOUBLE), 0) AS INT) AS cls FROM v WHERE flag_cls IS NOT NULL) y
           GROUP BY cls"""


@register("validate_profile", with_views("""
SELECT 'table' AS section, '' AS column, 'rows' AS metric, CAST(rows AS DOUBLE) AS value FROM a
UNION ALL SELECT 'table', '', 'columns', 3.0 FROM a
UNION ALL SELECT 'table', '', 'nan_count', CAST(nf + ns + nq AS DOUBLE) FROM a
UNION ALL SELECT 'table', '', 'checks_passed', CASE WHEN nf + ns + nq = 0 THEN 1.0 ELSE 0.0 END FROM a
UNION ALL SELECT 'nulls', 'l_quantity', 'null_count', CAST(nq AS DOUBLE) FROM a
UNION ALL SELECT 'nulls', 'flag_cls', 'null_count', CAST(nf AS DOUBLE) FROM a
UNION ALL SELECT 'nulls', 'status_bin', 'null_count', CAST(ns AS DOUBLE) FROM a
UNION ALL SELECT 'range', 'l_quantity', 'min', qmin FROM a
UNION ALL SELECT 'range', 'l_quantity', 'max', qmax FROM a
UNION ALL SELECT 'range', 'flag_cls', 'min', fmin FROM a
UNION ALL SELECT 'range', 'flag_cls', 'max', fmax FROM a
UNION ALL SELECT 'range', 'status_bin', 'min', smin FROM a
UNION ALL SELECT 'range', 'status_bin', 'max', smax FROM a
UNION ALL SELECT 'binary', 'flag_cls', 'non_binary', CAST(fb AS DOUBLE) FROM a
UNION ALL SELECT 'binary', 'status_bin', 'non_binary', CAST(sb AS DOUBLE) FROM a
UNION ALL SELECT 'table', '', 'duplicate_rows', CAST(n - g AS DOUBLE) FROM dd
UNION ALL SELECT 'target', CAST(cls AS VARCHAR), 'share', round_even(share, 4) FROM t""", "li",
    ctes=[("v", "SELECT l_quantity, flag_cls, status_bin FROM li"), ("a", _VP_A), ("dd", _VP_DD),
          ("t", _VP_T)]))
def q_validate_profile(spark, d):
    v = fx.li(spark, d).select("l_quantity", "flag_cls", "status_bin")
    return cl.validate_profile(v, _VAL_BIN, target="flag_cls")


@register("binary_violations", with_views("""
SELECT 'status_bin' AS column, count_if(status_bin NOT IN (0, 1)) AS non_binary,
       coalesce(list_sort(list_distinct(list(CAST(status_bin AS DOUBLE)) FILTER (WHERE status_bin NOT IN (0, 1)))), []::DOUBLE[])
         AS bad_values FROM li
UNION ALL
SELECT 'flag_cls', count_if(flag_cls NOT IN (0, 1)),
       coalesce(list_sort(list_distinct(list(CAST(flag_cls AS DOUBLE)) FILTER (WHERE flag_cls NOT IN (0, 1)))), []::DOUBLE[]) FROM li""",
                                          "li"))
def q_binary_violations(spark, d):
    return cl.binary_violations(fx.li(spark, d), _VAL_BIN)


# ----------------------------------------------------- I4 cleaning pipeline
ORD_SPEC = cl.CleanSpec(keyword_col="diagnosis_text", keywords=KEYWORDS_ORD, floors=FLOORS_ORD,
                        binary=list(KEYWORDS_ORD), integer=["o_orderkey", "o_custkey"], impute="median")

_CLEAN_SQL = with_views(f"""
, dd AS (SELECT DISTINCT * FROM dirty_ord),
fl AS (SELECT *, CAST(o_totalprice IS NULL AS INT) AS o_totalprice_is_missing,
              CAST(diagnosis_text IS NULL AS INT) AS diagnosis_text_is_missing FROM dd),
kw AS (SELECT o_orderkey, o_totalprice, o_custkey, o_orderstatus, o_totalprice_is_missing,
              diagnosis_text_is_missing,
              CAST(coalesce(contains(upper(diagnosis_text), 'URGENT'), false) AS INT) AS Has_Urgent,
              CAST(coalesce(contains(upper(diagnosis_text), 'HIGH'), false) AS INT) AS Has_High FROM fl),
fo AS (SELECT o_orderkey, CASE WHEN o_totalprice < 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
              CASE WHEN o_custkey < 1 THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus,
              o_totalprice_is_missing, diagnosis_text_is_missing, Has_Urgent, Has_High FROM kw),
b AS (SELECT quantile_cont(CAST(o_orderkey AS DOUBLE), [0.01, 0.99]) AS o_orderkey__b,
             quantile_cont(o_totalprice, [0.01, 0.99]) AS o_totalprice__b,
             quantile_cont(CAST(o_custkey AS DOUBLE), [0.01, 0.99]) AS o_custkey__b,
             quantile_cont(CAST(Has_Urgent AS DOUBLE), [0.01, 0.99]) AS Has_Urgent__b,
             quantile_cont(CAST(Has_High AS DOUBLE), [0.01, 0.99]) AS Has_High__b FROM fo),
w AS (SELECT {_clip_sql('o_orderkey', 'b')} AS o_orderkey, {_clip_sql('o_totalprice', 'b')} AS o_totalprice,
             {_clip_sql('o_custkey', 'b')} AS o_custkey, {_clip_sql('Has_Urgent', 'b')} AS Has_Urgent,
             {_clip_sql('Has_High', 'b')} AS Has_High, o_orderstatus, o_totalprice_is_missing,
             diagnosis_text_is_missing FROM fo, b),
m AS (SELECT quantile_cont(o_orderkey, 0.5) AS o_orderkey, quantile_cont(o_totalprice, 0.5) AS o_totalprice,
             quantile_cont(o_custkey, 0.5) AS o_custkey, quantile_cont(Has_Urgent, 0.5) AS Has_Urgent,
             quantile_cont(Has_High, 0.5) AS Has_High, {_mode_sql('w', 'o_orderstatus')} AS o_orderstatus FROM w)
SELECT CAST(round_even(coalesce(w.o_orderkey, m.o_orderkey), 0) AS BIGINT) AS o_orderkey,
       round(coalesce(w.o_totalprice, m.o_totalprice), 6) + 0.0 AS o_totalprice,
       CAST(round_even(coalesce(w.o_custkey, m.o_custkey), 0) AS BIGINT) AS o_custkey,
       coalesce(w.o_orderstatus, m.o_orderstatus) AS o_orderstatus,
       CAST(least(greatest(round_even(CAST(o_totalprice_is_missing AS DOUBLE), 0), 0.0), 1.0) AS INT)
         AS o_totalprice_is_missing,
       CAST(least(greatest(round_even(CAST(diagnosis_text_is_missing AS DOUBLE), 0), 0.0), 1.0) AS INT)
         AS diagnosis_text_is_missing,
       CAST(least(greatest(round_even(coalesce(w.Has_Urgent, m.Has_Urgent), 0), 0.0), 1.0) AS INT) AS Has_Urgent,
       CAST(least(greatest(round_even(coalesce(w.Has_High, m.Has_High), 0), 0.0), 1.0) AS INT) AS Has_High
FROM w, m""", "dirty_ord").replace("\n, dd AS", ",\ndd AS", 1)


@register("clean_pipeline", _CLEAN_SQL)
def q_clean_pipeline(spark, d):
    return _r6(cl.clean(fx.dirty_ord(spark, d), ORD_SPEC), ["o_totalprice"])
