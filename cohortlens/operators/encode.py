"""Encoding operators (E1–E6, S7): fit → small parameter table, transform →
one projection.

Fitted parameters are a DataFrame ``(col, kind, min, max, median, classes)``
that can be saved as parquet and loaded back; applying them turns the (small)
parameter rows into literal expressions, so transform is a single narrow
projection with no join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.expr import r6
from cohortlens.functions.quantiles import exact_quantiles, rank_in
from cohortlens.operators.clean import categorical_cols, numeric_cols

PARAM_SCHEMA = ("col string, kind string, min double, max double, median double, "
                "classes array<string>, is_int boolean")


# ---------------------------------------------------------- E1 label encode
def label_codes(real: DataFrame, synth: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, code): sorted classes of the *union* of both tables
    (values as text; NULL becomes the class 'nan', as ``astype(str)`` does).
    Codes are ranks within each feature computed without a per-feature
    window (range-partitioned ``group_rank``), so a high-cardinality column
    is spread over many tasks."""
    from cohortlens.operators.sampling import group_rank

    def vals(df):
        stack = ", ".join(f"'{c}', coalesce(CAST(`{c}` AS STRING), 'nan')" for c in cols)
        return df.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, value)")
    u = vals(real).unionByName(vals(synth)).distinct()
    return group_rank(u, "feature", F.col("value"), ["value"], out="code").select("feature", "value", "code")


def apply_codes(df: DataFrame, codes: DataFrame, cols: list[str]) -> DataFrame:
    """Replace each categorical column by its code: an equi-join per column
    (Spark broadcasts a code table that is small)."""
    order = df.columns
    for c in cols:
        cc = codes.where(F.col("feature") == c).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_k_{c}"))
        df = (df.withColumn(f"_v_{c}", F.coalesce(F.col(c).cast("string"), F.lit("nan")))
              .join(cc, f"_v_{c}", "left").drop(c, f"_v_{c}").withColumnRenamed(f"_k_{c}", c))
    return df.select(*order)


def label_encode(real: DataFrame, synth: DataFrame, cols: list[str] | None = None):
    """Encode categorical columns of both tables on their union's sorted
    classes → (real_encoded, synth_encoded)."""
    cols = cols if cols is not None else categorical_cols(real)
    if not cols:
        return real, synth
    codes = label_codes(real, synth, cols)
    return apply_codes(real, codes, cols), apply_codes(synth, codes, cols)


# ------------------------------------------------------------ E6 prepare pair
def align(real: DataFrame, synth: DataFrame):
    """Common columns in the real table's order."""
    common = [c for c in real.columns if c in set(synth.columns)]
    return real.select(*common), synth.select(*common)


def prepare_pair(real: DataFrame, synth: DataFrame, profile: str = "core", cols: list[str] | None = None):
    """Shared front of every metric: align → (core: drop nulls, encode |
    full: encode with NULL as class 'nan', drop nulls)."""
    r, s = align(real, synth)
    cat = [c for c in (cols if cols is not None else categorical_cols(r)) if c in r.columns]
    if profile == "core":
        r, s = r.na.drop(), s.na.drop()
        return label_encode(r, s, cat)
    r, s = label_encode(r, s, cat)
    return r.na.drop(), s.na.drop()


# ---------------------------------------------------------------- E5 z-score
def zscore(df: DataFrame, cols: list[str], stats_from: DataFrame | None = None) -> DataFrame:
    """(x − mean) / std with ddof-1 statistics of ``stats_from`` (default:
    ``df``); std 0 or undefined → 1."""
    from cohortlens.operators.privacy import standardize_stats
    means, stds = standardize_stats(stats_from if stats_from is not None else df, cols)
    m = dict(zip(cols, zip(means, stds)))
    return df.select(*[((F.col(c).cast("double") - F.lit(m[c][0])) / F.lit(m[c][1])).alias(c) if c in m
                       else F.col(c) for c in df.columns])


# ---------------------------------------------------------- E2 / E3 min-max
@dataclass
class MinMaxEncoder:
    """Numeric → (x − min)/(max − min) (NULL → median, zero range → 1);
    categorical → sorted class index / max(n−1, 1) (NULL or unseen → 0)."""
    params: DataFrame

    @classmethod
    def fit(cls, df: DataFrame) -> "MinMaxEncoder":
        spark = df.sparkSession
        num, cat = numeric_cols(df), categorical_cols(df)
        med = exact_quantiles(df, num, [0.5]) if num else {}
        a = df.agg(*[F.min(F.col(c).cast("double")).alias(f"a_{i}") for i, c in enumerate(num)],
                   *[F.max(F.col(c).cast("double")).alias(f"b_{i}") for i, c in enumerate(num)],
                   *[F.sort_array(F.collect_set(F.col(c).cast("string"))).alias(f"k_{i}")
                     for i, c in enumerate(cat)]).first() if (num or cat) else None
        types = {f.name: f.dataType for f in df.schema.fields}
        rows = [(c, "num", a[f"a_{i}"], a[f"b_{i}"], med[c][0], None,
                 isinstance(types[c], (T.IntegerType, T.LongType, T.ShortType, T.ByteType)))
                for i, c in enumerate(num)]
        rows += [(c, "cat", None, None, None, list(a[f"k_{i}"]), False) for i, c in enumerate(cat)]
        return cls(spark.createDataFrame(rows, PARAM_SCHEMA))

    # Parameters as a table
    def save(self, path: str) -> None:
        self.params.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "MinMaxEncoder":
        return cls(spark.read.parquet(path))

    def _p(self):
        return {r["col"]: r for r in self.params.collect()}

    def transform(self, df: DataFrame) -> DataFrame:
        p = self._p()
        out = []
        for c in df.columns:
            r = p.get(c)
            if r is None:
                out.append(F.col(c))
            elif r["kind"] == "num":
                lo, hi, med = r["min"], r["max"], r["median"]
                den = (hi - lo) if (lo is not None and hi - lo >= 1e-12) else 1.0
                x = F.coalesce(F.col(c).cast("double"), F.lit(med).cast("double"))
                out.append(((x - F.lit(lo if lo is not None else 0.0)) / F.lit(den)).alias(c))
            else:
                classes = list(r["classes"])
                m = F.create_map(*[x for i, k in enumerate(classes) for x in (F.lit(k), F.lit(i))])
                idx = F.coalesce(m[F.col(c).cast("string")], F.lit(0))
                out.append((idx / F.lit(max(len(classes) - 1, 1))).cast("double").alias(c))
        return df.select(*out)

    def inverse(self, df: DataFrame, restore_int: bool = True) -> DataFrame:
        """Clip to [0, 1], rescale; categorical index = round-half-even of
        v·(n−1) clipped to the class range. With ``restore_int`` integer
        columns are rounded back to integers (the reference leaves them
        fractional)."""
        p = self._p()
        out = []
        for c in df.columns:
            r = p.get(c)
            if r is None:
                out.append(F.col(c))
            elif r["kind"] == "num":
                lo, hi = r["min"] or 0.0, r["max"] or 0.0
                den = (hi - lo) if hi - lo >= 1e-12 else 1.0
                x = F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(1.0)) * F.lit(den) + F.lit(lo)
                out.append((F.bround(x, 0).cast("bigint") if (restore_int and r["is_int"]) else x).alias(c))
            else:
                classes = list(r["classes"])
                n = max(len(classes) - 1, 1)
                i = F.least(F.greatest(F.bround(F.col(c) * F.lit(n), 0), F.lit(0.0)),
                            F.lit(float(len(classes) - 1))).cast("int")
                arr = F.array(*[F.lit(k) for k in classes]) if classes else F.array().cast("array<string>")
                out.append(F.element_at(arr, i + 1).alias(c))
        return df.select(*out)


# --------------------------------------------------- E4 quantile → normal
@dataclass
class QuantileNormalEncoder:
    """Numeric columns → normal scores through their empirical quantile grid
    (≤ ``n_quantiles`` points, exact), categoricals → sorted code scaled to
    [−1, 1]; ``inverse`` maps back through Φ and the grid."""
    grids: dict
    classes: dict
    medians: dict

    @classmethod
    def fit(cls, df: DataFrame, n_quantiles: int = 1000) -> "QuantileNormalEncoder":
        num, cat = numeric_cols(df), categorical_cols(df)
        probs = [i / (n_quantiles - 1) for i in range(n_quantiles)]
        got = exact_quantiles(df, num, [*probs, 0.5])       # grid and median in one selection
        grids = {c: got[c][:-1] for c in num}
        a = df.agg(*[F.sort_array(F.collect_set(F.col(c).cast("string"))).alias(c) for c in cat]).first() \
            if cat else {}
        return cls(grids, {c: list(a[c]) for c in cat}, {c: got[c][-1] for c in num})

    def transform(self, df: DataFrame) -> DataFrame:
        """Staged projections: binary-search positions first, then the
        interpolated uniform, then the probit — so no expensive expression
        is evaluated more than once per value."""
        from cohortlens.functions.expr import probit
        from cohortlens.operators.privacy import const_array
        num = [c for c in df.columns if c in self.grids]
        # stage 1: filled value and grid positions
        s1 = df.select("*", *[x for i, c in enumerate(num) for x in (
            F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c])).alias(f"_x{i}"),)])
        s1 = s1.select("*", *[x for i, c in enumerate(num) for x in (
            rank_in(self.grids[c], F.col(f"_x{i}"), strict=False).alias(f"_le{i}"),
            rank_in(self.grids[c], F.col(f"_x{i}")).alias(f"_lt{i}"))])

        def frac(i, pos_col, c):
            g = self.grids[c]
            n = len(g)
            ga = const_array(g, "double")
            k = F.col(pos_col)
            x = F.col(f"_x{i}")
            return F.when(k <= 0, F.lit(0.0)).when(k >= n, F.lit(1.0)).otherwise(
                ((k - 1) + (x - F.element_at(ga, k)) /
                 F.greatest(F.element_at(ga, k + 1) - F.element_at(ga, k), F.lit(1e-300))) / F.lit(n - 1))
        # stage 2: uniform (forward/backward interpolation averaged, clipped)
        s2 = s1.select("*", *[F.least(F.greatest((frac(i, f"_le{i}", c) + frac(i, f"_lt{i}", c)) / 2,
                                                 F.lit(1e-7)), F.lit(1 - 1e-7)).alias(f"_u{i}")
                              for i, c in enumerate(num)])
        out = []
        for c in df.columns:
            if c in self.grids:
                out.append(probit(F.col(f"_u{num.index(c)}")).alias(c))
            elif c in self.classes:
                k = self.classes[c]
                m = F.create_map(*[x for i, v in enumerate(k) for x in (F.lit(v), F.lit(i))])
                out.append((m[F.col(c).cast("string")] / F.lit(max(1, len(k) - 1)) * 2 - 1).alias(c))
            else:
                out.append(F.col(c))
        return s2.select(*out)

    def inverse(self, df: DataFrame) -> DataFrame:
        from cohortlens.functions.expr import normal_cdf
        from cohortlens.operators.privacy import const_array
        out = []
        for c in df.columns:
            if c in self.grids:
                g = self.grids[c]
                n = len(g)
                ga = const_array(g, "double")
                pos = normal_cdf(F.col(c)) * F.lit(n - 1)
                i = F.least(F.floor(pos), F.lit(n - 2)).cast("int")
                t = pos - i
                out.append((F.element_at(ga, i + 1) + (F.element_at(ga, i + 2) - F.element_at(ga, i + 1)) * t)
                           .alias(c))
            elif c in self.classes:
                k = self.classes[c]
                idx = F.least(F.greatest(F.bround((F.col(c) + 1) / 2 * F.lit(max(1, len(k) - 1)), 0), F.lit(0.0)),
                              F.lit(float(len(k) - 1))).cast("int")
                out.append(F.element_at(F.array(*[F.lit(v) for v in k]), idx + 1).alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)


def round_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[r6(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])
