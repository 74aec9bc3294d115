from pyspark.sql import functions as F

from cohortlens.operators import impute as im
from cohortlens.operators import utility as ut


def test_mice_linear_recovers_exact_linear_column(spark):
    rows = [(float(i), float(i % 7), (3.0 * i - 2.0 * (i % 7) + 1.0) if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    out = im.mice(df, ["a", "b", "y"], rounds=3, estimator="linear")
    err = out.select(F.max(F.abs(F.col("y") - (3 * F.col("a") - 2 * F.col("b") + 1)))).first()[0]
    assert err < 1e-6


def test_classification_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "label int, prediction int")
    m = {r["cls"]: r for r in ut.classification_metrics(df).collect()}
    assert m["1"]["precision"] == 0.0 and m["1"]["f1"] == 0.0
    assert m["accuracy"]["f1"] == 0.75 and m["0"]["recall"] == 1.0


def test_mice_linear_is_exact_on_large_offsets(spark):
    import numpy as np
    from cohortlens.operators.impute import mice
    rng = np.random.default_rng(0)
    for offset in (0.0, 1e6, 1e9):
        x = rng.normal(size=400)
        rows = [(offset + float(v), None if i % 5 == 0 else 3.0 * float(v) + 1.0, float(v)) for i, v in enumerate(x)]
        got = mice(spark.createDataFrame(rows, "k double, y double, z double").select("k", "y", "z"), ["k", "y"], rounds=2)
        err = max(abs(r.y - (3.0 * r.z + 1.0)) for r in got.collect())
        assert err < 1e-6 * max(1.0, offset * 1e-3), (offset, err)


def test_forests_use_all_columns_and_trees(spark, monkeypatch):
    import inspect

    from cohortlens.operators import utility
    from cohortlens.plans import fixtures, q_ml

    assert inspect.signature(utility.rf_model).parameters["trees"].default == 100
    used = []
    monkeypatch.setattr(utility, "tstr", lambda real, synth, target, features, *a, **k: used.append(features))
    monkeypatch.setattr(utility, "fairness_gain", lambda real, synth, target, features, *a, **k: used.append(features))
    q_ml.q_tstr(spark, "/root/testdata/sf0.001")
    q_ml.q_fairness_gain(spark, "/root/testdata/sf0.001")
    assert [set(f) for f in used] == [set(fixtures.LI_FEATURES) - {q_ml.TARGET}] * 2
