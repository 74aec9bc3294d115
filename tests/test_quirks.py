"""Reference quirks and edge cases on literal fixtures (FIXTURES.md)."""

from pyspark.sql import functions as F

from cohortlens.operators import clean as cl
from cohortlens.operators import fairness as fa
from cohortlens.operators import fidelity as fi
from cohortlens.operators import privacy as pv
from cohortlens.operators import requests as rq

REQUESTS = [
    (1, "Generate 50 male patients over age 50 with diabetes and hypertension"),
    (2, "Generate 200 female patients under age 40 with diabetes"),
    (3, "10 women older than 30 with severe diabetes"),
    (4, "patients over 50"),
    (5, "Need some men with mild hypothyroidism, under 65"),
    (6, "all patients with asthma"),
    (7, ""),
    (8, "99999 patients > 20 and < 60 with obesity"),
]


def _parsed(spark):
    df = spark.createDataFrame(REQUESTS, "request_id int, prompt string")
    return {r["request_id"]: r for r in rq.normalize_requests(rq.parse_requests(df, "prompt")).collect()}


def test_request_parser_quirks(spark):
    p = _parsed(spark)
    assert p[1]["num_patients"] == 50 and p[1]["gender"] == 1 and p[1]["age_min"] == 50
    assert p[1]["conditions"] == ["diabetes", "hypertension"]
    assert p[2]["gender"] == 0 and p[2]["age_max"] == 40 and p[2]["num_patients"] == 200
    assert p[3]["gender"] == 0 and p[3]["severity"] == "severe" and p[3]["severity_target"] == 2
    assert p[4]["num_patients"] == 50                      # first integer wins
    assert p[5]["num_patients"] == 65 and p[5]["gender"] == 1 and p[5]["severity_target"] is None
    assert p[6]["conditions"] == ["asthma"]                # kept, filters nothing
    assert p[7]["num_patients"] == 100 and p[7]["age_min"] is None
    assert p[8]["num_patients"] == 10000 and p[8]["age_min"] == 20 and p[8]["age_max"] == 60


def test_summary_text(spark):
    df = spark.createDataFrame(REQUESTS[:1], "request_id int, prompt string")
    s = rq.summarize_requests(rq.normalize_requests(rq.parse_requests(df, "prompt"))).first()["summary"]
    assert s == ("**Patients to generate:** 50\n\n**Gender:** Male\n\n**Age:** ≥ 50\n\n"
                 "**Conditions:** Diabetes, Hypertension")


def test_extract_json_fenced_and_noisy(spark):
    rows = [(1, '```json\n{"num_patients": 5, "gender": "male"}\n```'),
            (2, 'Sure! {"num_patients": 7, "conditions": ["asthma"]} thanks'),
            (3, '{"num_patients": 3,')]
    r = {x["id"]: x for x in rq.extract_json(spark.createDataFrame(rows, "id int, t string"), "t").collect()}
    assert r[1]["num_patients"] == 5 and r[1]["gender"] == "male" and r[1]["parse_ok"]
    assert r[2]["conditions"] == ["asthma"] and r[2]["parse_ok"]
    assert not r[3]["parse_ok"] and r[3]["num_patients"] is None


def test_mode_smallest_on_ties_and_unknown(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    assert cl.fill_median_mode(df).where(F.col("s").isNull()).count() == 0
    assert cl.column_mode(df, "s").first()[0] == "a"
    allnull = spark.createDataFrame([(None,)], "s string")
    assert cl.medians_and_modes(allnull, [], ["s"])["s"] == "Unknown"


def test_missing_flag_strictly_above_threshold(spark):
    rows = [(None if i < 5 else 1.0, None if i < 6 else 2.0) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert cl.missing_flag_columns(df, 0.05) == ["b"]      # 5 % exactly is not flagged


def test_constant_column_correlation_is_null_and_counts_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0, float(i)) for i in range(10)], "c double, c2 double, x double")
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in fi.correlation(df, ["c", "x"]).collect()}
    assert corr[("c", "x")] is None and corr[("c", "c")] is None and corr[("x", "x")] == 1.0
    assert fi.corr_mae(df, df, ["c", "x"]).first()[0] == 0.0


def test_single_row_std_and_zscore(spark):
    df = spark.createDataFrame([(3.0,)], "x double")
    means, stds = pv.standardize_stats(df, ["x"])
    assert stds == [1.0] and means == [3.0]


def test_empty_group_intersection_drift(spark):
    a = spark.createDataFrame([("M",)], "g string")
    b = spark.createDataFrame([("F",)], "g string")
    r = fa.category_drift(a, b, "g").first()
    assert r["drift_pct"] == 0.0 and r["shared_groups"] == 0 and r["verdict"] == "excellent"


def test_class_on_one_side_only(spark):
    a = spark.createDataFrame([(0,), (1,)], "t int")
    b = spark.createDataFrame([(0,), (2,)], "t int")
    d = {r["cls"]: r for r in fa.class_distribution(a, b, "t").collect()}
    assert d[1]["synth_pct"] == 0.0 and d[2]["real_pct"] == 0.0
    assert 0 < fa.class_jsd(a, b, "t").first()[0] <= 0.8326


def test_quantile_edges_collapse(spark):
    # 25 distinct values but 90 % of rows on one value: decile edges collapse
    rows = [(0.0,)] * 900 + [(float(i),) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "x double")
    g = pv.k_groups(df, ["x"], "core").collect()
    assert sum(r["k"] for r in g) == 1000 and len(g) <= 10


def test_bundle_without_patient_and_empty_coding(spark):
    from cohortlens.operators import fhir
    from cohortlens.sources.fhir import bundles_from_json
    docs = [("b1", '{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"Condition",'
                   '"clinicalStatus":{"coding":[]},"code":{"text":"X (disorder)"}}}]}'),
            ("b2", '{"resourceType":"Bundle"}'),
            ("b3", '{"resourceType":"Other"}')]
    b = bundles_from_json(spark.createDataFrame(docs, "id string, doc string"), "doc", "id")
    raw = {r["bundle_id"]: r for r in fhir.flatten_raw(b).collect()}
    assert set(raw) == {"b1", "b2"}
    assert raw["b1"]["id"] is None and raw["b1"]["conditions"] == []
    assert raw["b2"]["conditions"] == []
