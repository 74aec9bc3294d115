"""Registered queries: encoders, stratified split and class balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.functions.expr import r6, sql_hash_uniform
from cohortlens.operators import encode as en
from cohortlens.operators import sampling as sa
from cohortlens.plans import fixtures as fx
from cohortlens.plans import sqlbits as sb
from cohortlens.plans.fixtures import with_views
from cohortlens.plans.registry import register

KEY = fx.LI_KEY
CAT = ["l_returnflag", "l_linestatus"]
MM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "flag_cls", "l_returnflag"]

_CODES = """SELECT feature, value, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY value) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT feature, value FROM (
  SELECT 'l_returnflag' AS feature, coalesce(l_returnflag, 'nan') AS value FROM real_li
  UNION ALL SELECT 'l_linestatus', coalesce(l_linestatus, 'nan') FROM real_li
  UNION ALL SELECT 'l_returnflag', coalesce(l_returnflag, 'nan') FROM synth_li
  UNION ALL SELECT 'l_linestatus', coalesce(l_linestatus, 'nan') FROM synth_li) u) d"""


@register("label_encode", with_views("SELECT feature, value, code FROM codes", "real_li", "synth_li",
                                     ctes=[("codes", _CODES)]))
def q_label_encode(spark, d):
    return en.label_codes(fx.real_li(spark, d), fx.synth_li(spark, d), CAT)


def _enc_sql(v, side):
    return (f"SELECT '{side}' AS side, {', '.join(KEY)}, "
            f"(SELECT code FROM codes WHERE feature = 'l_returnflag' AND value = coalesce(t.l_returnflag, 'nan'))"
            f" AS l_returnflag, "
            f"(SELECT code FROM codes WHERE feature = 'l_linestatus' AND value = coalesce(t.l_linestatus, 'nan'))"
            f" AS l_linestatus FROM {v} t")


@register("prepare_pair", with_views(f"{_enc_sql('real_li', 'real')} UNION ALL {_enc_sql('synth_li', 'synth')}",
                                     "real_li", "synth_li", ctes=[("codes", _CODES)]))
def q_prepare_pair(spark, d):
    r, s = en.prepare_pair(fx.real_li(spark, d).select(*KEY, *CAT), fx.synth_li(spark, d).select(*KEY, *CAT),
                           "core", CAT)
    return (r.withColumn("side", F.lit("real")).unionByName(s.withColumn("side", F.lit("synth")))
            .select("side", *KEY, *CAT))


# ---------------------------------------------------------------- min-max
_MM_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "flag_cls"]
_MM_P = ("SELECT " + ", ".join(
    f"min(CAST({c} AS DOUBLE)) AS a_{c}, max(CAST({c} AS DOUBLE)) AS b_{c}, "
    f"CASE WHEN max(CAST({c} AS DOUBLE)) - min(CAST({c} AS DOUBLE)) >= 1e-12 "
    f"THEN max(CAST({c} AS DOUBLE)) - min(CAST({c} AS DOUBLE)) ELSE 1.0 END AS d_{c}, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in _MM_NUM)
    + ", list_sort(list_distinct(list(l_returnflag))) AS k_rf FROM li")


def _mm_enc(c):
    return f"((coalesce(CAST({c} AS DOUBLE), m_{c}) - a_{c}) / d_{c})"


_RF_ENC = ("(coalesce(list_position(k_rf, l_returnflag) - 1, 0) / greatest(len(k_rf) - 1, 1))")


@register("minmax_encode", with_views(
    f"SELECT {', '.join(KEY)}, " + ", ".join(f"{sb.r6(_mm_enc(c))} AS {c}" for c in _MM_NUM)
    + f", {sb.r6(_RF_ENC)} AS l_returnflag FROM li, p", "li", ctes=[("p", _MM_P)]))
def q_minmax_encode(spark, d):
    r = fx.li(spark, d)
    enc = en.MinMaxEncoder.fit(r.select(*MM_COLS))
    t = enc.transform(r.select(*KEY, *MM_COLS))
    return t.select(*KEY, *[r6(F.col(c)).alias(c) for c in MM_COLS])


def _mm_dec(c):
    x = f"(least(greatest({_mm_enc(c)}, 0.0), 1.0) * d_{c} + a_{c})"
    return f"CAST(round_even({x}, 0) AS BIGINT)" if c == "flag_cls" else sb.r6(x)


_RF_DEC = ("k_rf[CAST(least(greatest(round_even(" + _RF_ENC + " * greatest(len(k_rf) - 1, 1), 0), 0), "
           "len(k_rf) - 1) AS INT) + 1]")


@register("minmax_roundtrip", with_views(
    f"SELECT {', '.join(KEY)}, " + ", ".join(f"{_mm_dec(c)} AS {c}" for c in _MM_NUM)
    + f", {_RF_DEC} AS l_returnflag FROM li, p", "li", ctes=[("p", _MM_P)]))
def q_minmax_roundtrip(spark, d):
    r = fx.li(spark, d)
    enc = en.MinMaxEncoder.fit(r.select(*MM_COLS))
    back = enc.inverse(enc.transform(r.select(*KEY, *MM_COLS)))
    return back.select(*KEY, *[r6(F.col(c)).alias(c) if c not in ("flag_cls", "l_returnflag") else F.col(c)
                               for c in MM_COLS])


# ---------------------------------------------------------------- z-score
_NUM = fx.LI_NUMERIC
_ZS = ("SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_samp({c}) IS NULL OR stddev_samp({c}) = 0 THEN 1.0 "
    f"ELSE stddev_samp({c}) END AS s_{c}" for c in _NUM) + " FROM real_li")


@register("zscore", with_views(
    f"SELECT {', '.join(KEY)}, " + ", ".join(f"{sb.r6(f'(CAST({c} AS DOUBLE) - m_{c}) / s_{c}')} AS {c}"
                                             for c in _NUM) + " FROM synth_li, st",
    "real_li", "synth_li", ctes=[("st", _ZS)]))
def q_zscore(spark, d):
    z = en.zscore(fx.synth_li(spark, d).select(*KEY, *_NUM), _NUM, stats_from=fx.real_li(spark, d))
    return z.select(*KEY, *[r6(F.col(c)).alias(c) for c in _NUM])


# ------------------------------------------------------------ G2 / G5
_H = sql_hash_uniform(42, KEY)
_RANKED = (f"SELECT *, CAST(round_even(CAST(flag_cls AS DOUBLE), 0) AS INT) AS cls, "
           f"row_number() OVER (PARTITION BY CAST(round_even(CAST(flag_cls AS DOUBLE), 0) AS INT) "
           f"ORDER BY {_H}, {', '.join(KEY)}) - 1 AS rk FROM {{v}}")


@register("stratified_split", with_views(f"""
SELECT {', '.join(KEY)}, CASE WHEN rk < ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split
FROM ranked JOIN (SELECT cls, count(*) AS n FROM ranked GROUP BY cls) c USING (cls)""", "li",
                                         ctes=[("ranked", _RANKED.format(v="li"))]))
def q_stratified_split(spark, d):
    r = sa.stratified_split(fx.li(spark, d).select(*KEY, "flag_cls"), "flag_cls", 0.2, 42, KEY)
    return r.select(*KEY, "split")


_BAL_CTES = [
    ("ranked", _RANKED.format(v="li")),
    ("cnt", "SELECT cls, count(*) AS n FROM ranked GROUP BY cls"),
    ("tt", "SELECT CAST(floor(quantile_cont(n, 0.5)) AS BIGINT) AS t FROM cnt"),
    ("bal", f"""SELECT cls, rk AS draw, {', '.join(KEY)} FROM ranked, tt
              WHERE cls IN (SELECT cls FROM cnt, tt WHERE n >= t) AND rk < t
              UNION ALL
              SELECT r.cls, d.draw, {', '.join('r.' + k for k in KEY)} FROM
                (SELECT cls, draw, CAST(floor({sql_hash_uniform(42, ['cls', 'draw'], 'bal')} * n) AS BIGINT) AS rk
                 FROM (SELECT c.cls, c.n, unnest(range(0, tt.t)) AS draw FROM cnt c, tt WHERE c.n < tt.t) x) d
                JOIN ranked r ON r.cls = d.cls AND r.rk = d.rk"""),
]


@register("balance", with_views("SELECT cls, count(*) AS n FROM bal GROUP BY cls", "li", ctes=_BAL_CTES))
def q_balance(spark, d):
    b = sa.balance(fx.li(spark, d).select(*KEY, "flag_cls"), "flag_cls", 42, KEY)
    return b.groupBy("cls").agg(F.count(F.lit(1)).alias("n"))


@register("balance_rows", with_views(f"SELECT cls, draw, {', '.join(KEY)} FROM bal", "li", ctes=_BAL_CTES))
def q_balance_rows(spark, d):
    b = sa.balance(fx.li(spark, d).select(*KEY, "flag_cls"), "flag_cls", 42, KEY)
    return b.select("cls", F.col("draw").cast("bigint").alias("draw"), *KEY)


# ------------------------------------------------------- E4 (rows only)
@register("quantile_normal")
def q_quantile_normal(spark, d):
    r = fx.li(spark, d).select(*KEY, *_NUM, "l_returnflag")
    enc = en.QuantileNormalEncoder.fit(r.select(*_NUM, "l_returnflag"))
    z = enc.transform(r)
    back = enc.inverse(z)
    return back.select(*KEY, *[r6(F.col(c)).alias(c) for c in _NUM], "l_returnflag")
