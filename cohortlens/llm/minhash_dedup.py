"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct word shingles, hashed to 64 bits by one
function; its bottom-k sketch is the k smallest values. Two sets with Jaccard
similarity s share each of the k smallest values of their union with
probability s, and all of those lie in both sketches.

1. One scan gives every document's set size, a 128-bit digest of the set and
   its 16 smallest values. Documents with equal sets are one class, whose
   smallest id stands for it from here on (a group of copies is one row).
2. Inverted lists of the 16 values: only classes that share at least a
   quarter of them with others go on (below 1e-8 for a link of 0.85).
3. Their texts are read again for full sets; the sketch is now 256 values.
   Values are ordered by rarity, and a class enters the inverted lists of its
   rarest ones only, as many as any link must hit (prefix rule), together with
   a size band, as linked sets differ in size by at most the threshold. Common
   passages thus rarely open a list.
4. Lists of up to LIST_ALL classes generate all their pairs. A pair is dropped
   if the similarity estimated from the union of the two sketches is far (5
   standard deviations) below the threshold, else verified on the full sets.
5. Classes that meet in longer lists form a crowd (connected through lists).
   Pairs of a crowd are not made: its classes, by size band, are packed into
   blocks of bounded size, blocks are compared by one product of their
   incidence matrices, which verifies every pair on the full sets, and a
   comparison returns the smallest member of each class's group only.
6. Links give connected components.

Defined results: NULL or empty texts and texts without words have an empty
set, n_shingles 0, and link with nothing; rows that repeat an id count as one
document and each get its row; a NULL id keeps its row, links with nothing and
is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tables import components, group_labels, stored
from cohortlens.llm.words import ngram_hashes, text_slices, word_hashes

LOW = 16          # values of the first sketch
SKETCH = 256      # values of the second sketch
LIST_ALL = 32     # classes in a list up to which all its pairs are generated
BLOCK = 1024      # classes in a block of a crowd, about
BLOCK_VALUES = 400_000   # shingles in a block of a crowd, about


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (lower-cased A-Z)."""
    words, first = word_hashes(column, lower=True)
    out = []
    grams = ngram_hashes(words, width)
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(grams[a:b - width + 1]))
        elif b > a:
            out.append(ngram_hashes(words[a:b], b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))


def low_sketches(docs: DataFrame, width: int, id_col: str, column: str) -> DataFrame:
    """(id, n, digest, low): set size, 128-bit digest and LOW smallest values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, column):
                sets = shingle_sets(part.column(column), width)
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    _lists([s[:LOW] for s in sets])], ["id", "n", "digest", "low"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), column)
            .mapInArrow(run, "id long, n long, digest binary, low array<long>"))


def full_sets(docs: DataFrame, classes: DataFrame, width: int, id_col: str, column: str) -> DataFrame:
    """(id, set) of ``classes`` (doc, digest, node), read again from the
    document that stands for each; id is the node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, column):
                sets = shingle_sets(part.column(column), width)
                yield pa.RecordBatch.from_arrays([
                    part.column("node"), part.column("digest"),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "digest", "own", "set"])

    return (docs.select(F.col(id_col).cast("long").alias("doc"), column).join(classes.hint("shuffle_hash"), "doc")
            .mapInArrow(run, "id long, digest binary, own binary, set binary")
            .where(F.col("digest") == F.col("own")).select("id", "set").dropDuplicates(["id"]))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for x, y, sx, sy in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "set_a", "set_b"))):
                sx, sy = np.frombuffer(sx, np.uint64), np.frombuffer(sy, np.uint64)
                k = min(SKETCH, max(len(sx), len(sy)))
                both, n = np.unique(np.concatenate((sx[:k], sy[:k])), return_counts=True)
                got = float((n[:k] == 2).mean())
                if got < percent / 100 - 5 * math.sqrt(percent / 100 * (1 - percent / 100) / len(both[:k])):
                    continue
                common = len(np.intersect1d(sx, sy, assume_unique=True))
                if common * 100 >= (len(sx) + len(sy) - common) * percent:
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return (pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
            .mapInArrow(run, "a long, b long"))


def prefix_lists(sets: DataFrame, percent: int) -> DataFrame:
    """(value, band, id, n): inverted lists of each class's rarest values."""
    low = percent / 100

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, values = [], [], []
            for i, s in zip(batch.column("id").to_pylist(), batch.column("set").to_pylist()):
                s = np.frombuffer(s, np.int64)
                ids.append(i)
                sizes.append(len(s))
                values.append(s[:SKETCH])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                                              _lists(values)], ["id", "n", "values"])

    base = sets.mapInArrow(sketch, "id long, n long, values array<long>")
    each = base.select("id", "n", F.explode("values").alias("value"))
    df = each.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = each.join(df, "value")
    # values that a link must share: exactly known where a partner's sketch is its whole set, else 5 deviations off
    m = F.least("n", F.lit(SKETCH))
    whole = F.col("n") <= int(SKETCH * low)
    need = F.when(whole, F.ceil(F.col("n") * low - 1e-9)).otherwise(
        F.floor(m * (low - 5 * math.sqrt(low * (1 - low) / SKETCH))))
    rare = (shared.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("s"))
            .withColumn("take", m - need + 1 - (m - F.size("s")))      # values of df 1 come first and open no list
            .where("take > 0").select("id", "n", F.explode(F.slice("s", F.lit(1), F.col("take").cast("int"))).alias("s")))
    band = F.floor(F.log(F.col("n")) / F.lit(-math.log(low) + 1e-12))
    return rare.select(F.col("s.value").alias("value"), F.explode(F.array(band, band + 1)).alias("band"), "id", "n")


def packed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sets as (distinct values, their positions set by set, offsets)."""
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    return values, where.astype(np.int32), np.concatenate(([0], np.cumsum([len(s) for s in sets])))


def overlaps(x: tuple, y: tuple, columns: int = 2048) -> np.ndarray:
    """Sizes of the intersections of all sets of two blocks."""
    _, in_x, in_y = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    out = np.zeros((len(x[2]) - 1, len(y[2]) - 1), np.float32)

    def incidence(block: tuple, chosen: np.ndarray) -> np.ndarray:
        column = np.full(len(block[0]), -1, np.int64)
        column[chosen] = np.arange(len(chosen))
        at = column[block[1]]
        row = np.repeat(np.arange(len(block[2]) - 1), np.diff(block[2]))
        m = np.zeros((len(block[2]) - 1, len(chosen)), np.float32)
        m[row[at >= 0], at[at >= 0]] = 1
        return m

    for k in range(0, len(in_x), columns):
        out += incidence(x, in_x[k:k + columns]) @ incidence(y, in_y[k:k + columns]).T
    return out.astype(np.int64)


def crowds(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what is similar within long lists: every pair
    of classes that meet in one is verified, in blocks."""
    lists = stored(lists.select("value", "band", "id", "n"), "long")
    hub = lists.groupBy("value", "band").agg(F.min("id").alias("hub"))
    crowd = components(lists.join(hub, ["value", "band"]).select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct())
    member = lists.select("id", "band", "n").distinct().join(crowd, "id").withColumnRenamed("component", "crowd")
    blocks = member.groupBy("crowd", "band").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_VALUES)).alias("blocks"))
    member = (member.join(blocks, ["crowd", "band"])
              .withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks"))))

    def build(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("id")
        own = [np.frombuffer(s, np.uint64) for s in f["set"]]
        body = zstandard.ZstdCompressor(level=1).compress(pickle.dumps((f["id"].to_numpy(), packed(own)), 5))
        return pd.DataFrame({"crowd": f["crowd"].iloc[:1], "band": f["band"].iloc[:1], "block": f["block"].iloc[:1],
                             "blocks": f["blocks"].iloc[:1], "body": [body]})

    bodies = stored(member.join(sets, "id").groupBy("crowd", "band", "block")
                    .applyInPandas(build, "crowd long, band long, block long, blocks long, body binary"), "blocks")
    second = bodies.select("crowd", "band", F.col("block").alias("other"), F.col("body").alias("body_b"))
    pairs = (bodies.withColumn("other", F.explode(F.sequence("block", F.col("blocks") - 1)))
             .join(second, ["crowd", "band", "other"]))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples():
                load = lambda b: pickle.loads(zstandard.ZstdDecompressor().decompress(b))
                ids, x = load(r.body)
                other, y = (ids, x) if r.block == r.other else load(r.body_b)
                inter = overlaps(x, y)
                mask = inter * 100 >= (np.diff(x[2])[:, None] + np.diff(y[2])[None, :] - inter) * percent
                low, low_b = group_labels(mask, ids, other)
                out = pd.DataFrame({"a": np.r_[ids, other], "b": np.r_[low, low_b]}).astype("int64")
                yield out[out["a"] != out["b"]].drop_duplicates()

    return pairs.mapInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, id_col: str = "doc_id",
                    column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    sketches = stored(low_sketches(docs, width, id_col, column), "sketches")
    usable = sketches.where("id IS NOT NULL AND n > 0")
    classes = stored(usable.groupBy("digest").agg(F.min("id").alias("doc"), F.first("low").alias("low"))
                     .withColumn("node", F.xxhash64("digest")), "classes")
    # classes that share enough of their smallest values with any others
    each = classes.select("node", F.size("low").alias("m"), F.explode("low").alias("value"))
    df = each.groupBy("value").agg(F.count("*").alias("df")).where("df > 1").select("value")
    live = (each.join(df, "value").groupBy("node").agg(F.count("*").alias("hits"), F.first("m").alias("m"))
            .where("hits >= greatest(1, floor(m / 4))").select("node"))
    live = classes.join(live, "node").select("doc", "digest", "node")
    sets = stored(full_sets(docs, live, width, id_col, column), "sets")
    lists = stored(prefix_lists(sets, percent), "lists")
    near = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)

    size = lists.groupBy("value", "band").agg(F.count("*").alias("len")).where("len > 1")
    sized = stored(lists.join(size, ["value", "band"]), "sized")
    small = sized.where(F.col("len") <= LIST_ALL)
    left = small.select("value", "band", F.col("id").alias("a"), F.col("n").alias("n_a"))
    right = small.select("value", "band", F.col("id").alias("b"), F.col("n").alias("n_b"))
    pairs = left.join(right, ["value", "band"]).where(F.col("a") < F.col("b")).where(near).select("a", "b").distinct()
    edges = verified(pairs, sets, percent)

    long = sized.where(F.col("len") > LIST_ALL)
    edges = edges.unionByName(crowds(long, sets, percent))
    # a document that repeats an id with another text joins the classes of both
    node = F.xxhash64("digest")
    twice = usable.groupBy("id").agg(F.min(node).alias("a"), F.max(node).alias("z")).where("a <> z").select("id", "a")
    edges = edges.unionByName(usable.join(twice, "id").select("a", node.alias("b")))
    groups = components(edges).withColumnRenamed("id", "node")
    grouped = stored(classes.select("digest", "doc", "node").join(groups, "node", "left")
                     .withColumn("component", F.coalesce("component", "node")), "grouped")
    least = grouped.groupBy("component").agg(F.min("doc").alias("component_id"))
    of_class = grouped.join(least, "component").select("digest", "component_id")
    return (sketches.select("id", "n", "digest").join(of_class, "digest", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
