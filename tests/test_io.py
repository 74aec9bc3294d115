"""Sources and sinks: CSV with NA tokens, parquet round trip, report JSON,
encoder parameters, FHIR bundle files."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from cohortlens.operators import encode as en
from cohortlens.operators import fhir
from cohortlens.operators import reports as rp
from cohortlens.sources import io
from cohortlens.sources.fhir import read_bundles


def test_csv_na_tokens_and_roundtrip(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write("a,b,c\n1,2.5,x\nNA,,y\n3,NA,\n")
    df = io.read_table(spark, p, na_tokens=["NA", ""])
    rows = sorted(df.collect(), key=lambda r: (r["a"] is None, r["a"] or 0))
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "string"}
    assert rows[0]["a"] == 1 and rows[2]["a"] is None and rows[1]["b"] is None and rows[1]["c"] is None
    out = os.path.join(d, "out")
    io.write_table(df, out, "parquet")
    assert io.read_table(spark, out, "parquet").count() == 3


def test_report_json_roundtrip(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "report_tvae_diabetes_full.json"), "w") as f:
        json.dump({"utility": {"tstr_accuracy": 0.9, "tstr_f1": 0.8},
                   "privacy_dcr": {"avg_dcr": 3.0, "exact_match_count": 0}}, f)
    r = rp.read_reports(spark, os.path.join(d, "*.json"))
    got = {(x["model"], x["dataset"], x["metric"]): x["value"] for x in r.collect()}
    assert got[("tvae", "diabetes", "tstr_accuracy")] == 0.9 and got[("tvae", "diabetes", "exact_match_count")] == 0
    rp.write_reports(r, os.path.join(d, "out"))
    assert spark.read.json(os.path.join(d, "out")).count() == 4


def test_report_sections_need_no_schema(spark):
    """A section of one file alone, clashing types, NaN, odd names, texts, arrays and files without numbers."""
    d = tempfile.mkdtemp()
    reports = {"report_a_x.json": {"s": {"m": 1, "t": "7"}, "top": 3, "list": [1, 2]},
               "report_b.json": {"s": {"m": {"deep": {"er": 2.5}}, "n": None}, "new sec.tion": {"k.1": -1e300, "big": 2**60}},
               "report_c_full.json": {"s": {"m": "text"}}, "report_d.json": []}
    for name, body in reports.items():
        with open(os.path.join(d, name), "w") as f:
            json.dump(body, f, indent=1)
    got = {tuple(r) for r in rp.read_reports(spark, d + "/*.json").collect()}
    assert got == {("a", "x", "s", "m", 1.0), ("b", "", "s", "m.deep.er", 2.5), ("b", "", "new sec.tion", "k.1", -1e300),
                   ("b", "", "new sec.tion", "big", float(2**60))}


def test_encoder_params_save_load(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (3, None, "b"), (2, 4.0, "a")], "i int, x double, s string")
    enc = en.MinMaxEncoder.fit(df)
    p = tempfile.mkdtemp()
    enc.save(p + "/params")
    enc2 = en.MinMaxEncoder.load(spark, p + "/params")
    back = enc2.inverse(enc2.transform(df)).orderBy("i").collect()
    assert [r["i"] for r in back] == [1, 2, 3] and back[0]["s"] == "a" and back[2]["x"] == 3.0


def test_read_bundle_files(spark):
    d = tempfile.mkdtemp()
    b = {"resourceType": "Bundle", "entry": [
        {"resource": {"resourceType": "Patient", "id": "p1", "gender": "female", "birthDate": "1980-06-01",
                      "extension": [{"url": "x/us-core-race", "extension": [{"url": "text", "valueString": "R1"}]}]}},
        {"resource": {"resourceType": "Observation", "code": {"text": "Heart rate"},
                      "valueQuantity": {"value": 70.0}}},
        {"resource": {"resourceType": "Observation", "code": {"text": "Heart rate"},
                      "valueQuantity": {"value": 72.0}}}]}
    for i in range(3):
        with open(os.path.join(d, f"b{i}.json"), "w") as f:
            json.dump(b, f, indent=1)
    bundles = read_bundles(spark, d, max_files=2)
    raw = fhir.flatten_raw(bundles).collect()
    assert len(raw) == 2 and raw[0]["heart_rate"] == 72.0 and raw[0]["race"] == "R1"
    assert [r["bundle_id"][-7:] for r in bundles.orderBy("bundle_id").collect()] == ["b0.json", "b1.json"]
    assert read_bundles(spark, tempfile.mkdtemp(), max_files=2).count() == 0
    assert fhir.flatten_raw(bundles).select(fhir.patient_age(F.col("birthDate"))).first()[0] == 45


def test_requests_are_dealt_to_tasks_by_their_number(spark, tmp_path):
    """A file split holds millions of customers; a task gets about 20,000 of their requests."""
    from cohortlens.plans import q_cohort

    rows = spark.range(50_001).selectExpr("id AS c_custkey", "id % 25 AS c_nationkey").coalesce(1)
    rows.write.parquet(f"{tmp_path}/customer.parquet")
    got = q_cohort.q_extract_json(spark, str(tmp_path))
    sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 50_001 and len(sizes) == 3 and max(sizes) < 20_000
    assert got.select("request_id").distinct().count() == 50_001
