"""Exact two-sample KS law against enumeration of all paths and a DuckDB recursion."""

import itertools

import duckdb
import numpy as np
from pyspark.sql import functions as F

from cohortlens.operators import fidelity as fi
from cohortlens.plans import sqlbits as sb


def by_enumeration(n, m):
    """Number of orders of the pooled sample per statistic (times n m)."""
    out = {}
    for c in itertools.combinations(range(n + m), n):
        i = j = top = 0
        real = set(c)
        for k in range(n + m):
            i, j = (i + 1, j) if k in real else (i, j + 1)
            top = max(top, abs(i * m - j * n))
        out[top] = out.get(top, 0) + 1
    return out


def test_exact_law_equals_enumeration():
    for n in range(1, 6):
        for m in range(1, 7):
            count = by_enumeration(n, m)
            total = sum(count.values())
            for d in range(1, n * m + 1):
                want = sum(c for top, c in count.items() if top >= d) / total
                assert abs(fi.ks_exact_pvalue(d / (n * m), n, m) - want) < 1e-12, (n, m, d)
    assert fi.ks_exact_pvalue(0.0, 5, 5) == 1.0 and fi.ks_exact_pvalue(1.0, 0, 5) == 1.0


def test_small_samples_are_exact_and_large_ones_asymptotic(spark):
    rng = np.random.default_rng(4)
    real = spark.createDataFrame([(float(x), float(y)) for x, y in rng.normal(size=(40, 2))], "a double, b double")
    synth = spark.createDataFrame([(float(x), float(y) + 0.4) for x, y in rng.normal(size=(63, 2))], "a double, b double")
    stats = fi.ks_statistics(real, synth, ["a", "b"])
    got = {r.feature: r for r in fi.ks_pvalues(stats).collect()}
    rows = ", ".join(f"('{f}', {r.ks_statistic!r}, {r.n_real}, {r.n_synth})" for f, r in got.items())
    src = f"(SELECT * FROM (VALUES {rows}) v(feature, ks_statistic, n_real, n_synth))"
    want = {f: p for f, p in duckdb.sql(f"SELECT feature, p FROM {sb.ks_pvalues(src)} x").fetchall()}
    assert all(abs(got[f]._p - want[f]) < 1e-9 for f in want) and len(want) == 2
    series = {r.feature: r for r in fi.ks_pvalues(stats, exact_rows=50).withColumn(
        "s", fi.ks_pvalue(F.col("ks_statistic"), F.col("n_real"), F.col("n_synth"))).collect()}
    assert all(r._p == r.s and abs(r.s - got[f]._p) > 1e-6 for f, r in series.items())
