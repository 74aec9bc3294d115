"""Plan-shape guard: key queries keep equi-joins, pruned scans and no
row-at-a-time Python (see tools/scan_plans.py for all queries)."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

BAD = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]


@pytest.mark.parametrize("name", ["class_jsd", "dcr_core", "match_cohorts", "exact_copies", "cohort_summary",
                                  "kanon_core", "ks_stat", "fhir_vitals", "stratified_split"])
def test_no_unscalable_operators(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BAD if b in plan]


def test_scan_prunes_columns(spark):
    df = E.queries()["class_jsd"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    cols = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert cols and all(len(c.split(",")) <= 3 for c in cols)   # lineitem has 11 columns


def test_fhir_flatten_does_not_shuffle(spark):
    from cohortlens.operators import fhir
    from cohortlens.sources.fhir import bundles_from_json
    docs = spark.createDataFrame([(1, '{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"Patient","id":"7"}}]}')],
                                 "bundle_id long, doc string")
    raw = fhir.flatten_raw(bundles_from_json(docs, "doc", "bundle_id"))
    assert "Exchange" not in raw._jdf.queryExecution().executedPlan().toString()
    row = raw.first()
    assert row["id"] == "7" and row["maritalStatus"] == "Unknown" and row["conditions"] == [] and row["bmi"] is None
