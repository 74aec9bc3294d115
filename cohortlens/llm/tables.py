"""Shared helpers: reading tables, cutting lineage in the cluster's shared
folder, connected components of an edge table."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, what: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back:
    lineage is cut and a lost executor costs nothing that was written."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def share(spark: SparkSession, name: str, content: bytes) -> None:
    """Write a file to the shared folder and let every node fetch it
    (``SparkFiles.get(name)`` in tasks)."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/{name}")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path)
    out.write(bytearray(content))
    out.close()
    sc.addFile(fs.makeQualified(path).toString())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large-star and small-star.

    ``edges`` holds one row per link; the result is (id, component) for every
    id that has a link, component = smallest id reachable. Every round joins
    edges with per-node minima (map-side combined) and is written to the
    shared folder, so links never meet in one task and no round is repeated
    after a loss. Self-links and NULL ends are ignored; no edges, no rows.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    e = stored(e, "edges")
    seen = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("x"), "m"),
                                           F.struct(F.col("u").alias("x"), "m"))).alias("p"))
                 .select(F.col("p.x").alias("u"), F.col("p.m").alias("v")).where("u != v").distinct())
        e = stored(small, "edges")
    members = e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
    roots = e.select(F.col("v").alias("id")).distinct().join(members.select("id"), "id", "left_anti")
    return members.unionByName(roots.select("id", F.col("id").alias("component")))


def hot_join(big: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key``, unique in ``small``, that may be common in
    ``big``: keys above a 256th of big's rows (so fewer than 256 of them) are
    joined by broadcast, all others, none of them large, by a shuffle."""
    counts = big.groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = stored(counts.where(F.col("count") * 256 > total).select(key), "hot")
    some = big.join(F.broadcast(small.join(F.broadcast(hot), key, "left_semi")), key)
    return some.unionByName(big.join(F.broadcast(hot), key, "left_anti").join(small, key))


def finite(vector: str | Column) -> Column:
    """True where an array column is non-null and all its components are
    present and finite."""
    c = F.col(vector) if isinstance(vector, str) else vector
    ok = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & ok, F.lit(False))


def group_labels(mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id of each row's and column's group in a bipartite graph."""
    a, b = a.copy(), b.copy()
    big = np.iinfo(np.int64).max
    while True:
        new_b = np.minimum(b, np.where(mask, a[:, None], big).min(0, initial=big))
        new_a = np.minimum(a, np.where(mask, new_b[None, :], big).min(1, initial=big))
        if (new_a == a).all() and (new_b == b).all():
            return a, b
        a, b = new_a, new_b
