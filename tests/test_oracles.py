"""Registered queries against their DuckDB oracles on the smallest scale
(the driver's gate runs all of them at sf0.01; ``tools/check_oracles.py``)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
FAST = ["class_jsd", "class_distribution", "value_shares", "gender_drift", "prevalence", "dedup_report",
        "missing_flags", "floor_violations", "winsorize", "keyword_flags", "fill_median_mode", "na_tokens",
        "validate_profile", "corr_mae", "trend_core", "trend_full", "ks_stat", "shapes_core", "histogram_overlay",
        "moments", "kanon_core", "kanon_full", "exact_copies", "singling_out", "dcr_rows", "parse_requests",
        "normalize_requests", "summarize_requests", "extract_json", "match_cohorts", "cohort_counts",
        "sample_hash", "sample_replace", "generate_perturbed", "fhir_vitals", "fhir_flatten", "label_encode",
        "minmax_roundtrip", "stratified_split", "balance_rows", "classification_metrics", "tstr_centroid",
        "dp_histogram_inf"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, df.collect()
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [x[0] for x in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    key = lambda cols, rows: sorted((tuple(_norm(r[i]) for i in sorted(range(len(cols)), key=lambda j: cols[j]))
                                     for r in rows), key=repr)
    assert key(s_cols, s_rows) == key(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["section", "metric", "value"] and len(rows) == 30


def test_every_query_registered_with_callable():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 90 and set(o) <= set(q)
