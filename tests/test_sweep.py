"""The ε sweep holds few variants at a time and leaves nothing of them behind."""

import os

from pyspark.sql import functions as F

from cohortlens.operators import synth as sy
from cohortlens.session import checkpoint_dir, materialize, scratch


def test_sweep_one_variant_at_a_time(spark, monkeypatch):
    real = spark.range(3000).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)).cast("int").alias("c"))

    def sweep(together):
        monkeypatch.setattr(sy, "ROWS_TOGETHER", together)
        return sy.epsilon_sweep(real, "c", ["x", "y"], ["id"], {"x": (0.0, 1000.0), "y": (0.0, 7.0)}, (1.0, float("inf")), 8, 42, {"c": [0, 1, 2]})

    peak = [0]
    sample = sy.DPMarginalSynthesizer.sample

    def counted(*args, **kw):
        peak[0] = max(peak[0], len([f for f in os.listdir(folder) if f.startswith("scratch-")]))
        return sample(*args, **kw)

    folder = checkpoint_dir(spark).removeprefix("file:")
    monkeypatch.setattr(sy.DPMarginalSynthesizer, "sample", counted)
    alone = sorted(map(tuple, sweep(1).collect()))
    assert [r[0] for r in alone] == ["1.0", "inf"] and all(None not in r[1:7] and r[7] is None for r in alone)
    assert peak[0] <= 2 and not [f for f in os.listdir(folder) if f.startswith("scratch-")]      # was: all variants until the end
    assert alone == sorted(map(tuple, sweep(10 ** 6).collect()))


def test_scratch_is_removed(spark):
    folder = checkpoint_dir(spark).removeprefix("file:")
    with scratch(spark):
        kept = materialize(spark.range(10))
        assert kept.count() == 10
        assert [f for f in os.listdir(folder) if f.startswith("scratch-")]
    assert not [f for f in os.listdir(folder) if f.startswith("scratch-")]
    assert materialize(spark.range(5)).count() == 5
