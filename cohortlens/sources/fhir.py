"""FHIR bundle source (S3): explicit schema, JSON files or a JSON column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()
_D = T.DoubleType()


def _st(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


SUBEXT = _st(("url", _S), ("valueString", _S))
EXTENSION = _st(("url", _S), ("extension", T.ArrayType(SUBEXT)))
QUANTITY = _st(("value", _D))
CODE = _st(("text", _S))
COMPONENT = _st(("code", CODE), ("valueQuantity", QUANTITY))
RESOURCE = _st(
    ("resourceType", _S), ("id", _S), ("gender", _S), ("birthDate", _S),
    ("maritalStatus", _st(("text", _S))), ("extension", T.ArrayType(EXTENSION)),
    ("clinicalStatus", _st(("coding", T.ArrayType(_st(("code", _S)))))),
    ("code", CODE), ("component", T.ArrayType(COMPONENT)), ("valueQuantity", QUANTITY),
    ("valueString", _S), ("valueCodeableConcept", CODE))
BUNDLE_SCHEMA = _st(("resourceType", _S), ("entry", T.ArrayType(_st(("resource", RESOURCE)))))


def read_bundles(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """One row per bundle file: (bundle_id = file path, bundle). Non-Bundle
    documents are skipped. ``max_files`` reads the first files by path only
    (of Spark's own listing, so any file system it reads will do)."""
    paths = path
    if max_files:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).select("path")
        paths = [r["path"] for r in listed.orderBy("path").limit(max_files).collect()]
        if not paths:
            return spark.createDataFrame([], _st(("bundle_id", _S), ("bundle", BUNDLE_SCHEMA)))
    df = spark.read.schema(BUNDLE_SCHEMA).option("multiLine", "true").json(paths)
    return (df.where(F.col("resourceType") == "Bundle")
            .select(F.input_file_name().alias("bundle_id"), F.struct(*df.columns).alias("bundle")))


def bundles_from_json(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """Bundles held as JSON text in a column → (bundle_id, bundle)."""
    b = F.from_json(F.col(col), BUNDLE_SCHEMA)
    return df.select(F.col(id_col).alias("bundle_id"), b.alias("bundle")).where(
        F.col("bundle.resourceType") == "Bundle")


def bundle_json(entries: Column) -> Column:
    """JSON text of a Bundle from an array of entry-JSON strings."""
    return F.concat(F.lit('{"resourceType":"Bundle","entry":['), F.array_join(entries, ","), F.lit("]}"))
