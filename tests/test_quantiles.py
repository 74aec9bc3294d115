import numpy as np

from cohortlens.functions.quantiles import exact_quantiles, sorted_count
from pyspark.sql import functions as F


def test_exact_quantiles_match_numpy_with_refinement(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=4000), np.full(2000, 1.25), rng.integers(0, 5, 1000).astype(float)])
    df = spark.createDataFrame([(float(v), float(v) * 2) for v in x], "a double, b double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = exact_quantiles(df, ["a", "b"], probs, buckets=16, max_collect=50)
    assert np.allclose(got["a"], np.percentile(x, [p * 100 for p in probs]), rtol=0, atol=1e-12)
    assert np.allclose(got["b"], np.percentile(2 * x, [p * 100 for p in probs]), rtol=0, atol=1e-12)


def test_sorted_count(spark):
    g = F.array(*[F.lit(float(v)) for v in [1, 2, 2, 3, 5]])
    rows = spark.range(7).select("id", sorted_count(g, F.col("id").cast("double"), True, 5).alias("lt"),
                                 sorted_count(g, F.col("id").cast("double"), False, 5).alias("le")).collect()
    assert [(r.lt, r.le) for r in rows] == [(0, 0), (0, 1), (1, 3), (3, 4), (4, 4), (4, 5), (5, 5)]


def test_exact_quantiles_nan_infinity_and_spread(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=3000), [np.inf, -np.inf, 1e300, -1e300, np.nan, np.nan], np.full(500, 0.5)])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "a double")
    probs = [0.001, 0.25, 0.5, 0.75, 0.999]
    clean = np.sort(x[~np.isnan(x)])
    for collect in (10, 10_000):
        got = exact_quantiles(df, ["a"], probs, buckets=8, max_collect=collect)["a"]
        assert np.allclose(got, np.percentile(clean, [p * 100 for p in probs]), rtol=1e-12, atol=0)
    assert exact_quantiles(df, ["a"], [0.0, 1.0])["a"] == [-np.inf, np.inf]
    assert exact_quantiles(df.where("a IS NULL"), ["a"], [0.5]) == {"a": [None]}


def test_exact_quantiles_fetch_few_rows(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    fetched, real = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: fetched.append(rows := real(self)) or rows)
    df = spark.range(30_000).selectExpr("cast(id * 7919 % 30011 as double) as a").union(
        spark.sql("select double('Infinity')"))
    exact_quantiles(df, ["a"], [0.5], buckets=64, max_collect=200)
    assert sum(map(len, fetched)) < 1500
