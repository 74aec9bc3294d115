"""The report tables search all synthetic variants in one index of the real half."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import privacy as pv
from cohortlens.plans import fixtures as fx
from cohortlens.plans import q_reports as qr


def test_variants_share_one_index(spark, tmp_path, monkeypatch):
    rows = [(k, k % 5, k % 7, k % 3, float(k % 11) if k % 13 else None, 100.0 + k * k % 97, k % 4 / 10, k % 5 / 10,
             "NAR"[k % 3], "FO"[k % 2]) for k in [*range(60), 7, 7, 8]]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                                "l_discount double, l_tax double, l_returnflag string, l_linestatus string"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    built, given, index = [], [], pv.NearestIndex

    def scorecard(real, synth, *args, distances=None, **kw):
        given.append((synth, distances))
        return spark.range(1).select(F.lit("s").alias("section"), F.lit("m").alias("metric"), F.lit(1.0).alias("value"))

    monkeypatch.setattr(pv, "NearestIndex", lambda *a, **kw: built.append(a) or index(*a, **kw))
    monkeypatch.setattr(qr.rp, "scorecard", scorecard)
    assert qr.model_reports(spark, str(tmp_path)).count() == len(qr.VARIANTS)
    assert len(built) == 1
    real = fx.real_li(spark, str(tmp_path))
    for synth, distances in given:
        want = pv.nearest_distance(real, synth, [*fx.LI_FEATURES]).collect()
        key = lambda x: -1.0 if x is None else x
        assert sorted(key(r.dcr) for r in distances.collect()) == pytest.approx(sorted(key(r.dcr) for r in want))
