"""Reusable DuckDB SQL fragments for the oracles (kept next to the Spark
operators they mirror)."""

from __future__ import annotations


def class_shares(view: str, target: str, share: str) -> str:
    return f"""(SELECT cls, n / sum(n) OVER () AS {share} FROM (
  SELECT CAST(round_even(CAST({target} AS DOUBLE), 0) AS INT) AS cls, count(*) AS n
  FROM {view} WHERE {target} IS NOT NULL GROUP BY 1) h)"""


def aligned(real: str, synth: str, target: str) -> str:
    return f"""(SELECT coalesce(r.cls, s.cls) AS cls, coalesce(r.p, 0.0) AS p, coalesce(s.q, 0.0) AS q
  FROM {class_shares(real, target, 'p')} r FULL OUTER JOIN {class_shares(synth, target, 'q')} s
  ON r.cls = s.cls)"""


def xlogy(p: str, q: str) -> str:
    return f"(CASE WHEN {p} > 0 THEN {p} * ln({p} / {q}) ELSE 0.0 END)"


def label_case(target: str, col: str, labels: dict) -> str:
    whens = " ".join(f"WHEN {col} = {k} THEN '{v}'" for k, v in labels.items())
    fb = f"'Class ' || CAST({col} AS VARCHAR)"
    return f"(CASE {whens} ELSE {fb} END)" if whens else f"({fb})"


def br(x: str, dp: int) -> str:
    return f"(round_even({x}, {dp}) + 0.0)"


def r6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


def corr_long(view: str, cols: list[str]) -> str:
    """Long-form Pearson matrix (col_a, col_b, corr) as a subquery: DuckDB's
    own ``corr`` over the rows where both are present."""
    cell = lambda a, b: (f"CASE WHEN max({a}) > min({a}) AND max({b}) > min({b}) THEN "
                         + ("1.0" if a == b else f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))") + " END")
    return "(" + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST({cell(a, b)} AS DOUBLE) AS corr FROM {view} "
        f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a in cols for b in cols) + ")"


def unpivot(view: str, cols: list[str], side: int | None = None) -> str:
    s = "" if side is None else f", {side} AS s"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value{s} FROM {view} WHERE {c} IS NOT NULL"
        for c in cols)


def ks_stats(real: str, synth: str, cols: list[str]) -> str:
    """(feature, ks_statistic, n_real, n_synth) subquery."""
    return f"""(WITH u AS ({unpivot(real, cols, 0)} UNION ALL {unpivot(synth, cols, 1)}),
  h AS (SELECT feature, value, sum(1 - s) AS cr, sum(s) AS cs FROM u GROUP BY feature, value),
  c AS (SELECT feature,
          sum(cr) OVER w / sum(cr) OVER (PARTITION BY feature) - sum(cs) OVER w / sum(cs) OVER (PARTITION BY feature)
            AS gap,
          sum(cr) OVER (PARTITION BY feature) AS nr, sum(cs) OVER (PARTITION BY feature) AS ns FROM h
        WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  SELECT feature, max(abs(gap)) AS ks_statistic, CAST(max(nr) AS BIGINT) AS n_real,
         CAST(max(ns) AS BIGINT) AS n_synth FROM c GROUP BY feature)"""


def kolmogorov_sf(z: str) -> str:
    series = (f"(SELECT 2.0 * sum(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * ({z}) * ({z}))) "
              f"FROM range(1, 101) t_k(k))")
    return f"(CASE WHEN ({z}) < 0.27 THEN 1.0 ELSE least(1.0, greatest(0.0, {series})) END)"


def ks_pvalue(d: str, nr: str, ns: str) -> str:
    en = f"(CAST({nr} AS DOUBLE) * CAST({ns} AS DOUBLE) / CAST({nr} + {ns} AS DOUBLE))"
    return kolmogorov_sf(f"sqrt({en}) * {d}")


def ks_pvalues(src: str, exact_rows: int = 10_000) -> str:
    """(feature, ks_statistic, n_real, n_synth, p) subquery of ``src``: the exact
    law by the lattice-path recursion, one diagonal an iteration, where both
    samples are small, the series beyond."""
    return f"""(WITH RECURSIVE kst AS (SELECT * FROM {src} s0),
  sized AS (SELECT feature, ks_statistic AS d, least(n_real, n_synth) AS n, greatest(n_real, n_synth) AS m FROM kst),
  path(feature, n, m, a, b, lim, k, w) USING KEY (feature) AS (
    SELECT feature, n, m, lcm(n, m) // n, lcm(n, m) // m, CAST(ceil(d * lcm(n, m) - 1e-9) AS BIGINT), CAST(0 AS BIGINT),
           list_transform(range(0, n + 1), lambda i: CASE WHEN i = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)
    FROM sized WHERE m <= {exact_rows} AND n > 0 AND d > 0
    UNION
    SELECT feature, n, m, a, b, lim, k + 1, list_transform(range(0, n + 1), lambda i:
             CASE WHEN k + 1 - i < 0 OR k + 1 - i > m OR abs(i * a - (k + 1 - i) * b) >= lim THEN CAST(0 AS DOUBLE)
                  ELSE (CASE WHEN i > 0 THEN w[i] * (n - i + 1) ELSE 0 END + w[i + 1] * (m - (k - i))) / (n + m - k) END)
    FROM path WHERE k < n + m)
  SELECT kst.*, coalesce((SELECT greatest(0.0, least(1.0, 1.0 - w[n + 1])) FROM path WHERE path.feature = kst.feature),
                         {ks_pvalue('kst.ks_statistic', 'kst.n_real', 'kst.n_synth')}) AS p FROM kst)"""
