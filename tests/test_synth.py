"""Generators: bounds on quality (the copula keeps marginals and the one
strong dependence), ε = ∞ marginals equal the exact histogram, DCR sampling
option, window-free label codes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import encode as en
from cohortlens.operators import fidelity as fi
from cohortlens.operators import privacy as pv
from cohortlens.operators import synth as sy


def _real(spark, n=3000):
    rng = np.random.default_rng(5)
    x = rng.normal(50, 10, n)
    y = 2 * x + rng.normal(0, 5, n)
    c = np.where(x > 50, "hi", "lo")
    return spark.createDataFrame([(float(a), float(b), str(k)) for a, b, k in zip(x, y, c)], "x double, y double, c string")


def test_copula_preserves_marginals_and_dependence(spark):
    real = _real(spark)
    model = sy.CopulaSynthesizer.fit(real)
    s = model.sample(spark, 3000, seed=1).drop("row_id")
    ks = {r["feature"]: r["ks_statistic"] for r in fi.ks_statistics(real, s, ["x", "y"]).collect()}
    assert max(ks.values()) < 0.06
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in fi.correlation(s, ["x", "y"]).collect()}
    assert corr[("x", "y")] > 0.9
    assert set(r[0] for r in s.select("c").distinct().collect()) == {"hi", "lo"}


def test_dp_infinite_epsilon_is_exact(spark):
    real = _real(spark)
    m = sy.DPMarginalSynthesizer(float("inf"), 8, {"x": (0.0, 100.0)})
    h = m.histogram(real, ["x", "c"]).collect()
    assert all(r["noisy"] == r["n"] for r in h)
    assert abs(sum(r["p"] for r in h if r["feature"] == "x") - 1.0) < 1e-12
    exact = {r["bin"]: r["n"] for r in h if r["feature"] == "x"}
    noisy = sy.DPMarginalSynthesizer(1.0, 8, {"x": (0.0, 100.0)}).histogram(real, ["x"], seed="s3cret").collect()
    assert any(r["noisy"] != exact[r["bin"]] for r in noisy) and all(r["noisy"] >= 0 for r in noisy)


def test_dp_release_has_public_support_only(spark):
    real = _real(spark)
    rare = real.unionByName(spark.createDataFrame([(50.0, 1.0, "only one record")], real.schema))
    m = sy.DPMarginalSynthesizer(1.0, 8, {"x": (0.0, 100.0)}, {"c": ["lo", "hi", "never"]})
    a, b = (m.histogram(df, ["x", "c"], seed="s") for df in (real, rare))
    assert a.columns == ["feature", "bin", "noisy", "p"]                  # no exact count is released
    keys = lambda h: sorted((r["feature"], r["bin"]) for r in h.collect())
    assert keys(a) == keys(b) and ("c", "never") in keys(a)
    assert len({m.fit(real, ["x", "c"], seed=f"s{k}").size for k in range(4)}) > 1     # a noisy number of rows
    with pytest.raises(ValueError):
        m.histogram(real, ["x", "c"])                                     # no default seed
    with pytest.raises(ValueError):
        sy.DPMarginalSynthesizer(1.0, 8, {"x": (0.0, 100.0)}).fit(real, ["x", "c"], seed="s")


def test_dcr_reference_sampling_option(spark):
    real = _real(spark).withColumn("k", F.monotonically_increasing_id())
    synth = _real(spark, 2500).withColumn("k", F.monotonically_increasing_id())
    full = pv.dcr(real, synth, ["x", "y"], "full").first()
    samp = pv.dcr(real, synth, ["x", "y"], "full", sample_size=500, real_key=["k"], synth_key=["k"]).first()
    x, y = (np.array(df.select("x", "y").collect(), float) for df in (real, synth))
    mean, std = x.mean(0), x.std(0)
    zx, zy = (x - mean) / std, (y - mean) / std
    want = np.concatenate([np.sqrt(((zy[i:i + 500, None] - zx[None]) ** 2).sum(2)).min(1) for i in range(0, 2500, 500)])
    assert full["exact_match_count"] == (want < 1e-6).sum()
    assert abs(full["avg_dcr"] - want.mean()) < 1e-3
    assert samp["avg_dcr"] >= want.mean()                                  # fewer records to be near to


def test_label_codes_sorted_union(spark):
    a = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    b = spark.createDataFrame([("c",), ("a",)], "s string")
    codes = {r["value"]: r["code"] for r in en.label_codes(a, b, ["s"]).collect()}
    assert codes == {"a": 0, "b": 1, "c": 2, "nan": 3}
    ra, rb = en.label_encode(a, b, ["s"])
    assert sorted(r[0] for r in ra.collect()) == [0, 1, 3]


def test_copula_with_many_classes_as_tables(spark, monkeypatch):
    """Class domains beyond the inline limit: same shares, every class drawable, dependence kept."""
    monkeypatch.setattr(sy, "INLINE_CLASSES", 10)
    monkeypatch.setattr(sy, "RANGE_ROWS", 7)
    df = spark.range(4000).select((F.col("id") % 50).cast("double").alias("x"),
                                  F.when(F.col("id") % 3 == 0, "k00").otherwise(F.format_string("k%02d", F.col("id") % 50)).alias("c"))
    ranges = sy.class_ranges(df, "c").orderBy("lo").collect()
    assert ranges[0]["lo"] == 0.0 and ranges[-1]["hi"] == 1.0 and len(ranges) == 50
    assert all(a["hi"] == b["lo"] and a["v"] < b["v"] for a, b in zip(ranges, ranges[1:]))
    model = sy.CopulaSynthesizer.fit(df)
    assert "c" in model.tables and not model.classes
    s = model.sample(spark, 4000, seed=3)
    assert s.count() == 4000 and s.columns == ["row_id", "x", "c"]
    share = s.where("c = 'k00'").count() / 4000
    assert abs(share - (ranges[0]["hi"] - ranges[0]["lo"])) < 0.03
    assert s.select("c").distinct().count() >= 45


def test_vector_probit_and_phi():
    p = np.array([1e-6, 0.01, 0.3, 0.5, 0.9, 0.99, 1 - 1e-6])
    assert np.allclose(sy._phi(sy._probit(p)), p, atol=1e-9)
