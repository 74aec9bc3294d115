"""Table scans and sinks (CSV / parquet / JSON lines).

``read_table`` is the one entry point for tabular inputs: parquet is read
as-is (predicates and projections push down to the scan), CSV gets a header
and either an explicit schema or inferred types. NA tokens are turned into
NULL *before* typing so that ``"NA"`` and ``""`` both mean missing, as a
pandas ``read_csv(na_values=[...])`` would treat them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """``df`` in tasks of about ``rows`` rows: for tables of few bytes a row, of which a file
    split holds millions, in front of work that costs much per row."""
    parts = -(-df.count() // rows)
    return df.repartition(parts) if parts > 1 else df


def na_to_null(c: Column, tokens=("NA", "")) -> Column:
    """NULL when the (trimmed) text is one of ``tokens``."""
    return F.when(F.trim(c).isin(list(tokens)), F.lit(None)).otherwise(c)


def normalize_na(df: DataFrame, tokens=("NA", ""), cols=None,
                 types: dict[str, str] | None = None) -> DataFrame:
    """Replace NA tokens in string columns by NULL, then ``try_cast`` to
    ``types[col]`` (ANSI-safe: bad text becomes NULL instead of failing)."""
    types = types or {}
    str_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    cols = [c for c in (cols or df.columns) if c in str_cols]
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in cols:
            c = na_to_null(c, tokens)
            if f.name in types:
                c = c.try_cast(types[f.name])
        out.append(c.alias(f.name))
    return df.select(*out)


def infer_numeric_types(df: DataFrame, cols=None) -> dict[str, str]:
    """For string columns: 'bigint' when every non-null value parses as an
    integer, 'double' when every one parses as a number. One aggregate pass
    (small action; returns O(columns) values)."""
    str_cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, T.StringType) and (cols is None or f.name in cols)]
    if not str_cols:
        return {}
    aggs = []
    for c in str_cols:
        v = F.col(c)
        aggs.append(F.count(v).alias(f"n_{c}"))
        aggs.append(F.count(v.try_cast("bigint")).alias(f"i_{c}"))
        aggs.append(F.count(v.try_cast("double")).alias(f"d_{c}"))
    r = df.agg(*aggs).first()
    out = {}
    for c in str_cols:
        n, i, d = r[f"n_{c}"], r[f"i_{c}"], r[f"d_{c}"]
        if n and i == n:
            out[c] = "bigint"
        elif n and d == n:
            out[c] = "double"
    return out


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema: T.StructType | str | None = None,
               na_tokens=None) -> DataFrame:
    """Scan a table. ``fmt`` defaults from the extension (csv / parquet / json).

    With ``na_tokens`` (CSV), all columns are read as text, the tokens become
    NULL, then the numeric columns are typed (explicit ``schema`` wins over
    inference)."""
    fmt = fmt or ("csv" if path.endswith(".csv") else
                  "json" if path.endswith(".json") else "parquet")
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df if schema is None else df.select(*[F.col(f.name).cast(f.dataType)
                                                     for f in _as_struct(schema).fields])
    if fmt == "json":
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.json(path)
    r = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    if na_tokens is None:
        if schema is not None:
            return r.schema(schema).csv(path)
        return r.option("inferSchema", "true").csv(path)
    raw = r.csv(path)  # every column is text
    if schema is not None:
        types = {f.name: f.dataType.simpleString() for f in _as_struct(schema).fields}
    else:
        tmp = normalize_na(raw, na_tokens)
        types = infer_numeric_types(tmp)
    return normalize_na(raw, na_tokens, types=types)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def _as_struct(schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T._parse_datatype_string(schema)
