"""Registered queries: distribution, fairness, fidelity and privacy metrics
over the ``real_li`` / ``synth_li`` views (and ``patients`` for groups)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import fairness as fa
from cohortlens.plans import fixtures as fx
from cohortlens.plans import sqlbits as sb
from cohortlens.plans.fixtures import with_views
from cohortlens.plans.registry import register

TARGET = "flag_cls"

# ---------------------------------------------------------------- M5 class_jsd
_JSD_SQL = with_views(f"""
SELECT {sb.br(f"sqrt(greatest(sum({sb.xlogy('p', 'm')} + {sb.xlogy('q', 'm')}) / 2, 0.0))", 4)}
       AS jensen_shannon_divergence
FROM (SELECT p, q, (p + q) / 2 AS m FROM {sb.aligned('real_li', 'synth_li', TARGET)} a) t""",
                      "real_li", "synth_li")


@register("class_jsd", _JSD_SQL)
def q_class_jsd(spark, d):
    return fa.class_jsd(fx.real_li(spark, d), fx.synth_li(spark, d), TARGET)


# ------------------------------------------------------- J4 class_distribution
@register("class_distribution", with_views(f"""
SELECT cls, {sb.br('p * 100', 2)} AS real_pct, {sb.br('q * 100', 2)} AS synth_pct
FROM {sb.aligned('real_li', 'synth_li', TARGET)} a""", "real_li", "synth_li"))
def q_class_distribution(spark, d):
    return fa.class_distribution(fx.real_li(spark, d), fx.synth_li(spark, d), TARGET)


# -------------------------------------------------------------- A4 value_shares
@register("value_shares", with_views("""
SELECT value, n, n / sum(n) OVER () AS share FROM (
  SELECT l_returnflag AS value, count(*) AS n FROM li WHERE l_returnflag IS NOT NULL GROUP BY 1) h""",
                                     "li"))
def q_value_shares(spark, d):
    return fa.value_shares(fx.li(spark, d), "l_returnflag")


# -------------------------------------------------------------- P11 class_labels
_LAB_T = "TenYearCHD"  # labels 0 and 1; class 2 exercises the 'Class <v>' fallback


@register("class_labels", with_views(f"""
SELECT cls, n, {sb.label_case(_LAB_T, 'cls', fa.CLASS_LABELS[_LAB_T])} AS label FROM (
  SELECT CAST(round_even(CAST(flag_cls AS DOUBLE), 0) AS INT) AS cls, count(*) AS n
  FROM li WHERE flag_cls IS NOT NULL GROUP BY 1) h""", "li"))
def q_class_labels(spark, d):
    sh = fa.class_shares(fx.li(spark, d), TARGET).select("cls", "n")
    return fa.label_classes(sh, "cls", _LAB_T)


# ------------------------------------------------------------- M6 gender_drift
def _drift_sql():
    sh = lambda v, nm: f"""(SELECT value, n / sum(n) OVER () AS {nm} FROM (
      SELECT status_bin AS value, count(*) AS n FROM {v} WHERE status_bin IS NOT NULL GROUP BY 1) h)"""  # noqa
    return with_views(f"""
SELECT {sb.br('coalesce(max(abs(p - q)) * 100, 0.0)', 4)} AS drift_pct, count(*) AS shared_groups,
       CASE WHEN coalesce(max(abs(p - q)) * 100, 0.0) < 5 THEN 'excellent'
            WHEN coalesce(max(abs(p - q)) * 100, 0.0) < 15 THEN 'moderate' ELSE 'biased' END AS verdict
FROM {sh('real_li', 'p')} r JOIN {sh('synth_li', 'q')} s USING (value)""", "real_li", "synth_li")


@register("gender_drift", _drift_sql())
def q_gender_drift(spark, d):
    return fa.category_drift(fx.real_li(spark, d), fx.synth_li(spark, d), "status_bin")


# ---------------------------------------------------------------- M7 prevalence
_PREV_T = "Diabetes_Target"


@register("prevalence", with_views(f"""
SELECT cls, {sb.label_case(_PREV_T, 'cls', fa.CLASS_LABELS[_PREV_T])} AS condition,
       {sb.br('p * 100', 1)} AS real_pct, {sb.br('q * 100', 1)} AS synth_pct,
       {sb.br('abs(p - q) * 100', 1)} AS drift_pp
FROM {sb.aligned('real_li', 'synth_li', TARGET)} a""", "real_li", "synth_li"))
def q_prevalence(spark, d):
    return fa.prevalence(fx.real_li(spark, d), fx.synth_li(spark, d), TARGET, _PREV_T).select(
        "cls", "condition", "real_pct", "synth_pct", "drift_pp")


# --------------------------------------------------------- D4 parity_difference
@register("parity_difference", with_views(f"""
SELECT {sb.br('max(rate) - min(rate)', 6)} AS parity_difference, {sb.br('max(rate)', 6)} AS max_rate,
       {sb.br('min(rate)', 6)} AS min_rate, count(*) AS n_groups
FROM (SELECT segment, avg(CAST(Diabetes_Target >= 1 AS DOUBLE)) AS rate FROM patients GROUP BY segment) g""",
                                          "patients"))
def q_parity_difference(spark, d):
    p = fx.patients(spark, d)
    return fa.parity_difference(p, "segment", F.col("Diabetes_Target") >= 1)


# ==================================================================== fidelity
from cohortlens.operators import fidelity as fi  # noqa: E402

FEAT = fx.LI_FEATURES
NUM = fx.LI_NUMERIC


@register("corr_matrix", with_views(
    f"SELECT col_a, col_b, {sb.r6('corr')} AS corr FROM {sb.corr_long('li', FEAT)} c", "li"))
def q_corr_matrix(spark, d):
    return fi.correlation(fx.li(spark, d), FEAT).select("col_a", "col_b", fa_r6("corr"))


def fa_r6(c):
    from cohortlens.functions.expr import r6
    return r6(F.col(c)).alias(c)


_NULLABLE = ["o_orderkey", "o_totalprice", "o_custkey"]


@register("corr_nulls", with_views(
    f"SELECT col_a, col_b, {sb.r6('corr')} AS corr FROM {sb.corr_long('dirty_ord', _NULLABLE)} c", "dirty_ord"))
def q_corr_nulls(spark, d):
    return fi.correlation(fx.dirty_ord(spark, d), _NULLABLE).select("col_a", "col_b", fa_r6("corr"))


@register("corr_mae", with_views(f"""
SELECT {sb.br('avg(abs(coalesce(r.corr, 0.0) - coalesce(s.corr, 0.0)))', 4)} AS corr_matrix_mae
FROM {sb.corr_long('real_li', FEAT)} r JOIN {sb.corr_long('synth_li', FEAT)} s USING (col_a, col_b)""",
                                 "real_li", "synth_li"))
def q_corr_mae(spark, d):
    return fi.corr_mae(fx.real_li(spark, d), fx.synth_li(spark, d), FEAT)


def _pairs_in(cols):
    return ", ".join(f"'{a}|{b}'" for i, a in enumerate(cols) for b in cols[i + 1:])


@register("trend_core", with_views(f"""
SELECT {sb.br('count_if(coalesce(sign(r.corr) = sign(s.corr), false)) / greatest(count(*), 1) * 100', 1)}
         AS trend_accuracy_pct,
       count_if(coalesce(sign(r.corr) = sign(s.corr), false)) AS pairs_matched, count(*) AS pairs_total
FROM {sb.corr_long('real_li', FEAT)} r JOIN {sb.corr_long('synth_li', FEAT)} s USING (col_a, col_b)
WHERE col_a || '|' || col_b IN ({_pairs_in(FEAT)})""", "real_li", "synth_li"))
def q_trend_core(spark, d):
    return fi.pairwise_trends(fx.real_li(spark, d), fx.synth_li(spark, d), FEAT, "core")


_TF = "coalesce((r.corr > 0 AND s.corr > 0) OR (r.corr < 0 AND s.corr < 0) OR (abs(r.corr) < 0.05 AND abs(s.corr) < 0.05), false)"  # noqa


@register("trend_full", with_views(f"""
SELECT {sb.br(f'count_if({_TF}) / greatest(count(*), 1) * 100', 1)} AS trend_accuracy_pct, count(*) AS pairs_checked
FROM {sb.corr_long('real_li', FEAT)} r JOIN {sb.corr_long('synth_li', FEAT)} s USING (col_a, col_b)
WHERE col_a || '|' || col_b IN ({_pairs_in(FEAT)})""", "real_li", "synth_li"))
def q_trend_full(spark, d):
    return fi.pairwise_trends(fx.real_li(spark, d), fx.synth_li(spark, d), FEAT, "full")


@register("ks_stat", with_views(f"""
SELECT feature, {sb.r6('ks_statistic')} AS ks_statistic, n_real, n_synth
FROM {sb.ks_stats('real_li', 'synth_li', FEAT)} k""", "real_li", "synth_li"))
def q_ks_stat(spark, d):
    k = fi.ks_statistics(fx.real_li(spark, d), fx.synth_li(spark, d), FEAT)
    return k.select("feature", fa_r6("ks_statistic"), "n_real", "n_synth")


@register("ks_pass_rate", with_views(f"""
SELECT feature, {sb.br('ks_statistic', 4)} AS ks_statistic,
       {sb.br('p', 4)} AS p_value, {sb.br('p', 4)} > 0.05 AS passed
FROM {sb.ks_pvalues(sb.ks_stats('real_li', 'synth_li', FEAT))} kst""", "real_li", "synth_li"))
def q_ks_pass_rate(spark, d):
    k = fi.ks_columns(fx.real_li(spark, d), fx.synth_li(spark, d), FEAT)
    return k.withColumn("passed", F.col("p_value") > 0.05)


@register("shapes_core", with_views(f"""
SELECT {sb.br('avg(ks)', 4)} AS avg_ks_statistic,
       {sb.br('count_if(p > 0.05) / greatest(count(*), 1) * 100', 1)} AS columns_passed_pct
FROM (SELECT round_even(ks_statistic, 4) AS ks,
             round_even({sb.ks_pvalue('ks_statistic', 'n_real', 'n_synth')}, 4) AS p
      FROM {sb.ks_stats('real_li', 'synth_li', FEAT)} k) t""", "real_li", "synth_li"))
def q_shapes_core(spark, d):
    return fi.column_shapes(fx.real_li(spark, d), fx.synth_li(spark, d), FEAT, "core")


@register("shapes_full", with_views(f"""
SELECT {sb.br('avg(ks_statistic)', 4)} AS avg_ks_statistic, {sb.br('max(ks_statistic)', 4)} AS max_ks_statistic
FROM {sb.ks_stats('real_li', 'synth_li', FEAT)} k""", "real_li", "synth_li"))
def q_shapes_full(spark, d):
    return fi.column_shapes(fx.real_li(spark, d), fx.synth_li(spark, d), FEAT, "full")


_RNG = """SELECT least(min(r.l_extendedprice), (SELECT min(l_extendedprice) FROM synth_li)) AS lo,
                 greatest(max(r.l_extendedprice), (SELECT max(l_extendedprice) FROM synth_li)) AS hi FROM real_li r"""


def _hist_sql(view, name):
    return f"""(SELECT b AS bin, count(*) AS {name} FROM (
      SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 30)), 29) AS INT) AS b
      FROM {view}, rng WHERE l_extendedprice IS NOT NULL) x GROUP BY b)"""


@register("histogram_overlay", with_views(f"""
SELECT bin, {sb.r6('lo + bin * ((hi - lo) / 30)')} AS bin_lo, {sb.r6('lo + (bin + 1) * ((hi - lo) / 30)')} AS bin_hi,
       coalesce(real_n, 0) AS real_n, coalesce(synth_n, 0) AS synth_n
FROM (SELECT coalesce(r.bin, s.bin) AS bin, real_n, synth_n
      FROM {_hist_sql('real_li', 'real_n')} r FULL OUTER JOIN {_hist_sql('synth_li', 'synth_n')} s ON r.bin = s.bin) j,
     rng""", "real_li", "synth_li", ctes=[("rng", _RNG)]))
def q_histogram_overlay(spark, d):
    return fi.histogram_overlay(fx.real_li(spark, d), fx.synth_li(spark, d), "l_extendedprice", 30)


@register("box_stats", with_views(f"""
SELECT {sb.r6('min(l_extendedprice)')} AS min, {sb.r6('quantile_cont(l_extendedprice, 0.25)')} AS q1,
       {sb.r6('quantile_cont(l_extendedprice, 0.5)')} AS median, {sb.r6('quantile_cont(l_extendedprice, 0.75)')} AS q3,
       {sb.r6('max(l_extendedprice)')} AS max, {sb.r6('avg(l_extendedprice)')} AS mean FROM li""", "li"))
def q_box_stats(spark, d):
    return fi.box_stats(fx.li(spark, d), "l_extendedprice")


@register("moments", with_views(f"""
SELECT coalesce(r.feature, s.feature) AS feature, real_mean, real_std, synth_mean, synth_std FROM
 (SELECT feature, {sb.r6('avg(value)')} AS real_mean, {sb.r6('stddev_samp(value)')} AS real_std
  FROM ({sb.unpivot('real_li', NUM)}) u GROUP BY feature) r
 FULL OUTER JOIN
 (SELECT feature, {sb.r6('avg(value)')} AS synth_mean, {sb.r6('stddev_samp(value)')} AS synth_std
  FROM ({sb.unpivot('synth_li', NUM)}) u GROUP BY feature) s ON r.feature = s.feature""", "real_li", "synth_li"))
def q_moments(spark, d):
    return fi.moments(fx.real_li(spark, d), fx.synth_li(spark, d), NUM)


def _overlap_sql():
    rng = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, least((SELECT min({c}) FROM real_li), (SELECT min({c}) FROM synth_li)) AS lo, "
        f"greatest((SELECT max({c}) FROM real_li), (SELECT max({c}) FROM synth_li)) AS hi" for c in NUM)

    def side(v, nm):
        return f"""(SELECT feature, bin, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS {nm} FROM (
          SELECT u.feature, CAST(least(floor((value - lo) / CASE WHEN hi > lo THEN (hi - lo) / 30 ELSE 1.0 END), 29)
                 AS INT) AS bin
          FROM ({sb.unpivot(v, NUM)}) u JOIN rng ON u.feature = rng.feature) x GROUP BY feature, bin)"""
    return with_views(f"""
SELECT coalesce(r.feature, s.feature) AS feature,
       {sb.br('sum(least(coalesce(p, 0.0), coalesce(q, 0.0)))', 6)} AS overlap
FROM {side('real_li', 'p')} r FULL OUTER JOIN {side('synth_li', 'q')} s ON r.feature = s.feature AND r.bin = s.bin
GROUP BY 1""", "real_li", "synth_li", ctes=[("rng", rng)])


@register("density_overlap", _overlap_sql())
def q_density_overlap(spark, d):
    return fi.density_overlap(fx.real_li(spark, d), fx.synth_li(spark, d), NUM)
