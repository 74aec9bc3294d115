"""Structured Streaming wrappers for the stateless operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.operators.requests import normalize_requests, parse_requests
from cohortlens.session import checkpoint_dir

REQUEST_SCHEMA = "request_id bigint, prompt string"


def read_stream(spark: SparkSession, source_dir: str, schema: str, fmt: str = "json",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(source_dir)


def request_stream(spark: SparkSession, source_dir: str, fmt: str = "json") -> DataFrame:
    """Incoming request files → parsed and normalised request rows."""
    return normalize_requests(parse_requests(read_stream(spark, source_dir, REQUEST_SCHEMA, fmt), "prompt"))


def stream_transform(spark: SparkSession, source_dir: str, schema: str, fn: Callable[[DataFrame], DataFrame],
                     fmt: str = "json") -> DataFrame:
    """Any stateless operator ``fn`` applied to a file stream."""
    return fn(read_stream(spark, source_dir, schema, fmt))


def write_available(df: DataFrame, sink_dir: str, name: str, fmt: str = "parquet",
                    checkpoint: str | None = None) -> None:
    """Process everything available now into ``sink_dir`` (exactly-once file
    sink; progress kept under the cluster checkpoint folder)."""
    ckpt = checkpoint or os.path.join(checkpoint_dir(df.sparkSession), "streams", name)
    q = (df.writeStream.format(fmt).option("path", sink_dir).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
