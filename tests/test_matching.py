"""Request matching without barren joins, quota filling without a cap."""

from pyspark.sql import functions as F

from cohortlens.operators import cohort as co
from cohortlens.operators import fidelity as fi
from cohortlens.plans import fixtures as fx

SF = "/root/testdata/sf0.001"
SCHEMA = ("request_id long, num_patients int, gender int, age_min int, age_max int, conditions array<string>, "
          "severity_target int")


def test_requests_that_match_nobody_join_no_patient(spark):
    patients = fx.patients(spark, SF)
    barren = spark.createDataFrame([(i, 10, None, 500 + i, 600 + i, [], None) for i in range(50)], SCHEMA)
    r = co.match_cohorts(barren, patients)
    assert r.count() == 0
    counts = co.match_cohorts(barren, patients, with_counts=True)
    assert counts.agg(F.sum("matched")).first()[0] == 0 and counts.count() == 50


def test_matching_small_blocks(spark):
    patients = fx.patients(spark, SF)
    reqs = spark.createDataFrame([(1, 7, 1, 20, 60, ["diabetes"], None), (2, 10_000, None, None, None, [], None),
                                  (3, 3, 0, 30, None, ["hypertension"], None)], SCHEMA)
    got = co.match_cohorts(reqs, patients, block_rows=16)
    for r in reqs.collect():
        c = {"gender": r.gender, "age_min": r.age_min, "age_max": r.age_max, "conditions": r.conditions}
        want = [x.patient_id for x in co.cohort_filter(patients, c).orderBy("patient_id").limit(r.num_patients).collect()]
        assert [x.patient_id for x in got.where(F.col("request_id") == r.request_id).orderBy("rank").collect()] == want


def test_quota_is_filled_in_draw_order(spark):
    patients = fx.patients(spark, SF)
    narrow = {"gender": 1, "age_min": 40, "age_max": 41}
    few = co.generate_until(patients, 40, narrow, 42, ["patient_id"])
    assert few.count() == 40 and few.dropDuplicates().count() == 40
    assert co.cohort_filter(few, narrow).count() == 40
    ids = [r.patient_id for r in co.generate_until(patients, 50, {"gender": 0}, 42, ["patient_id"]).collect()]
    assert ids != sorted(ids)                                  # not the smallest ids of a pool
    assert co.generate_until(patients, 5, {"age_min": 400}, 42, ["patient_id"]).count() == 0


def test_quota_of_a_rare_match(spark):
    df = spark.range(4000).select(F.col("id").alias("patient_id"), (F.rand(1) * 100).alias("x"), (F.col("id") == 1234).cast("int")
                                  .alias("male"))
    got = co.generate_until(df, 2, {"gender": 1}, 42, ["patient_id"])
    assert [r.patient_id for r in got.collect()] == [1234, 1234] and got.dropDuplicates().count() == 2


def test_correlation_pairs_are_complete(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(2)
    x = rng.normal(size=200)
    f = pd.DataFrame({"a": x, "b": 2 * x + rng.normal(size=200) * 0.1, "c": rng.normal(size=200), "k": 1.0})
    f.loc[::2, "b"] = None
    f.loc[150:, "a"] = None
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in f.itertuples(index=False)]
    got = {(r.col_a, r.col_b): r["corr"] for r in fi.correlation(
        spark.createDataFrame(rows, "a double, b double, c double, k double"), list("abck")).collect()}
    want = f.corr()
    for (p, q), v in got.items():
        assert (v is None and np.isnan(want.loc[p, q])) or abs(v - want.loc[p, q]) < 1e-9, (p, q)
    assert len(got) == 16


def test_wide_correlation_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(fi, "WIDE_PAIRS", 4)
    df = spark.range(50).selectExpr("id as a", "id * id as b", "id % 7 as c", "id % 3 as d")
    whole = {(r.col_a, r.col_b): round(r["corr"], 9) for r in fi.correlation(df, list("abcd")).collect()}
    monkeypatch.setattr(fi, "WIDE_PAIRS", 1000)
    assert whole == {(r.col_a, r.col_b): round(r["corr"], 9) for r in fi.correlation(df, list("abcd")).collect()}


def test_matching_on_other_schemas(spark, monkeypatch):
    """Gender as Sex / male / gender, fractional ages, text ids, absent columns, many parts and blocks."""
    from cohortlens.operators import matching
    monkeypatch.setattr(matching, "PART_ROWS", 100)
    monkeypatch.setattr(matching, "SIGNATURES", 3)
    base = spark.range(5000).select(
        F.format_string("p%05d", F.col("id")).alias("pid"), F.when(F.col("id") % 11 != 0, F.col("id") * 0.37 % 90).alias("age"),
        (F.col("id") % 2).cast("int").alias("male"), (F.col("id") % 3).cast("int").alias("Diabetes_Target"),
        F.when(F.col("id") % 13 == 0, 1).otherwise(0).alias("Has_Hypertension"))
    asks = [(1, 7, 1, 20, 60, ["diabetes"], None), (2, 4000, None, None, None, [], None), (3, 30, 0, 30, None, ["hypertension"], None),
            (4, 5, 1, 20, 60, ["diabetes"], None), (5, 9, 0, None, 12, ["asthma", "hypothyroidism"], 2), (6, 3, 1, 500, None, [], None)]
    reqs = spark.createDataFrame(asks, SCHEMA)
    text = base.withColumn("gender", F.when(F.col("male") == 1, F.when(F.col("pid") > "p02", "Male").otherwise("M")).otherwise("f")).drop("male")
    none = base.drop("male", "age", "Diabetes_Target")
    sex = base.withColumnRenamed("male", "Sex").withColumnRenamed("age", "Age")
    for patients in (base, text, none, sex):
        got = {}
        for r in co.match_cohorts(reqs, patients, id_col="pid", block_rows=4).orderBy("request_id", "rank").collect():
            got.setdefault(r.request_id, []).append(r.pid)
        counts = {r.request_id: r for r in co.match_cohorts(reqs, patients, id_col="pid", block_rows=64, with_counts=True).collect()}
        for i, n, g, lo, hi, conds, sev in asks:
            want = [x.pid for x in co.cohort_filter(patients, {"gender": g, "age_min": lo, "age_max": hi, "conditions": conds,
                                                               "severity_target": sev}).select("pid").orderBy("pid").collect()]
            assert got.get(i, []) == want[:n]
            assert (counts[i].requested, counts[i].matched, counts[i].delivered) == (n, len(want), min(n, len(want)))
