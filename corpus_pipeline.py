"""Corpus pipeline: quality classifier, line de-duplication, near-duplicate
removal, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet in the shared folder and read again as the next stage's documents,
so a lost executor never costs an earlier stage. All but the last stage return
the columns of ``documents``. Stages only drop what their decision names: a
document the classifier rejects, lines that repeat an earlier passage (and a
document nothing else is left of), all but one document of a near-duplicate
group. Secrets are replaced, their documents stay.

Defined results: rows with a NULL doc_id are never rejected as copies; rows
that repeat a doc_id share its decision; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import kn_quality, line_dedup, minhash_dedup, packing, secret_scan
from cohortlens.llm.queries import VOCAB
from cohortlens.llm.tables import stored, table


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` whose doc_id is not in ``ids`` (doc_id)."""
    return docs.join(ids.distinct().hint("shuffle_hash"), "doc_id", "left_anti").select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = kn_quality.classify(docs, table(spark, sf_dir, "labels"))
    return _without(docs, judged.where("rejected").select("doc_id"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_deleted") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    length = F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return out.where(~F.coalesce(emptied, F.lit(False))).withColumn(
        "n_chars", length.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(docs, percent=80, width=5)
    return _without(docs, found.where("NOT kept").select("doc_id"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(
        docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, VOCAB)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("minhash near-dedup", near_duplicates),
          ("secret scans", secrets), ("best-fit packing", pack)]

#: SQL cannot express the language model, the packing and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
