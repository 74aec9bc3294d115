"""Class-distribution and fairness operators.

All of them reduce the input to a per-class (or per-group) histogram with a
map-side partial aggregate first, so only O(classes) rows are shuffled; the
share computation then runs on that tiny table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.expr import br, xlogy_ratio

# Class labels of the reference's targets.
CLASS_LABELS = {
    "Diabetes_Target": {0: "No Diabetes", 1: "Pre-Diabetes", 2: "Diabetes"},
    "TenYearCHD": {0: "No CHD Risk", 1: "CHD Risk"},
    "Cond_Essential_hypertension": {0: "No Hypertension", 1: "Hypertension"},
    "Has_Hypertension": {0: "No Hypertension", 1: "Hypertension"},
    "Has_Hypothyroidism": {0: "No Hypothyroidism", 1: "Hypothyroidism"},
}


def class_code(c) -> Column:
    """Round half-even and cast to int (pandas ``.round().astype(int)``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(c.cast("double"), 0).cast("int")


def class_shares(df: DataFrame, target: str, name: str = "cls") -> DataFrame:
    """(cls, n, share) — value counts normalised. Shares come from a window
    over the per-class aggregate (O(classes) rows), not over the data."""
    h = df.where(F.col(target).isNotNull()).groupBy(class_code(target).alias(name)).agg(
        F.count(F.lit(1)).alias("n"))
    return h.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """(value, n, share) of a column as is (A4)."""
    total = df.select(F.count(col)).first()[0]
    h = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    return h.withColumn("share", F.col("n") / F.lit(total))


def _aligned(real: DataFrame, synth: DataFrame, target: str) -> DataFrame:
    r = class_shares(real, target).select("cls", F.col("share").alias("p"))
    s = class_shares(synth, target).select("cls", F.col("share").alias("q"))
    return (r.join(s, "cls", "full_outer")
            .select("cls", F.coalesce("p", F.lit(0.0)).alias("p"),
                    F.coalesce("q", F.lit(0.0)).alias("q")))


def class_distribution(real: DataFrame, synth: DataFrame, target: str) -> DataFrame:
    """Per class real % and synthetic %, 2 dp."""
    a = _aligned(real, synth, target)
    return a.select("cls", br(F.col("p") * 100, 2).alias("real_pct"),
                    br(F.col("q") * 100, 2).alias("synth_pct"))


def class_jsd(real: DataFrame, synth: DataFrame, target: str, dp: int | None = 4) -> DataFrame:
    """Jensen–Shannon *distance* (sqrt of the divergence, natural log) of the
    two class distributions (M5). One row."""
    a = _aligned(real, synth, target).withColumn("m", (F.col("p") + F.col("q")) / 2)
    js = a.agg((F.sum(xlogy_ratio(F.col("p"), F.col("m")) + xlogy_ratio(F.col("q"), F.col("m")))
                / 2).alias("js"))
    d = F.sqrt(F.greatest(F.col("js"), F.lit(0.0)))
    return js.select((br(d, dp) if dp is not None else d).alias("jensen_shannon_divergence"))


def category_drift(real: DataFrame, synth: DataFrame, col: str) -> DataFrame:
    """Max over shared groups of |p_r − p_s|·100 and a verdict (M6)."""
    r = value_shares(real, col).select("value", F.col("share").alias("p"))
    s = value_shares(synth, col).select("value", F.col("share").alias("q"))
    j = r.join(s, "value", "inner")
    d = j.agg(F.coalesce(F.max(F.abs(F.col("p") - F.col("q"))) * 100, F.lit(0.0)).alias("drift"),
              F.count(F.lit(1)).alias("shared_groups"))
    return d.select(br(F.col("drift"), 4).alias("drift_pct"), "shared_groups",
                    F.when(F.col("drift") < 5, "excellent").when(F.col("drift") < 15, "moderate")
                    .otherwise("biased").alias("verdict"))


def label_expr(target: str, cls: Column) -> Column:
    """Class code → label, fallback ``Class <v>``."""
    labels = CLASS_LABELS.get(target, {})
    e = None
    for k, v in labels.items():
        e = (F.when(cls == k, F.lit(v)) if e is None else e.when(cls == k, F.lit(v)))
    fb = F.concat(F.lit("Class "), cls.cast("string"))
    return fb if e is None else e.otherwise(fb)


def label_classes(df: DataFrame, col: str, target: str, out: str = "label") -> DataFrame:
    return df.withColumn(out, label_expr(target, F.col(col)))


def prevalence(real: DataFrame, synth: DataFrame, target: str,
               label_target: str | None = None) -> DataFrame:
    """Per class: label, real %, synthetic %, drift in pp, 1 dp (M7).
    ``label_target`` picks the label map (defaults to ``target``)."""
    a = _aligned(real, synth, target)
    lt = label_target or target
    return a.select("cls", label_expr(lt, F.col("cls")).alias("condition"),
                    br(F.col("p") * 100, 1).alias("real_pct"),
                    br(F.col("q") * 100, 1).alias("synth_pct"),
                    br(F.abs(F.col("p") - F.col("q")) * 100, 1).alias("drift_pp"))


def parity_difference(df: DataFrame, group: str, outcome: Column) -> DataFrame:
    """Demographic parity: positive rate per group, max − min."""
    g = df.groupBy(group).agg(F.avg(outcome.cast("double")).alias("rate"))
    return g.agg(br(F.max("rate") - F.min("rate"), 6).alias("parity_difference"),
                 br(F.max("rate"), 6).alias("max_rate"), br(F.min("rate"), 6).alias("min_rate"),
                 F.count(F.lit(1)).alias("n_groups"))
