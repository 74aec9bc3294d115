"""Vector code compression: product codes found through tries of parts.

Every vector is taken as the integers floor(scale * x) and cut into equal
consecutive parts. The distinct parts of a position, sorted lexicographically,
form a trie: parts that begin with the same components share the nodes of that
prefix. A task walks its tries depth first; a node adds its component's squared
distance to every codebook entry to the vector of distances accumulated by its
parent, so a shared prefix is computed once, and a leaf takes the nearest entry
and adds its part, weighted by its number of copies, to that entry's sums.

Plan: one aggregate of distinct parts with counts (copies are combined before
the shuffle, so a very common vector is one row), one range partitioning by
(position, part), which puts neighbours of the trie next to each other, and
blocks of bounded size written once. Each of the rounds reads the blocks and
returns sums per (position, entry); codebooks have a fixed number of entries and
travel with the tasks. The last assignment walks tries of each batch of rows, so
codes need no join.

Defined results: rows whose vector is NULL or holds NULL, NaN or infinite
components are left out, all other rows stay (rows that repeat an id each get
a row, a NULL id too); the codebook starts from the smallest distinct ids, of a
repeated id the smallest vector; shorter vectors, and lengths that do not divide
by the number of parts, are read as padded with zeros; a table with fewer ids
than entries has smaller codebooks; components beyond 10^18 after scaling and
errors beyond 64 bits are clipped; an empty table gives no rows; other columns
are ignored, a missing label counts as NULL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tables import finite, stored

BLOCK = 1 << 15          # distinct parts of a block
SLAB = 1 << 12           # trie nodes held at once on each level
FAR = 10 ** 18
EXACT = 1 << 26          # components below this are computed in 64 bits
LONG = 2 ** 63 - 1


def grid_of(vectors: pa.Array, dims: int, scale: float) -> np.ndarray:
    """floor(scale * x) of a list column as int64, padded with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), dims))
    row = np.repeat(np.arange(len(vectors)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * out), -float(FAR), float(FAR)).astype(np.int64)


def to_key(parts: np.ndarray) -> list[bytes]:
    """Bytes of integer rows whose order is the order of the rows."""
    flat = np.ascontiguousarray((parts.astype(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")).tobytes()
    w = 8 * parts.shape[1]
    return [flat[i * w:(i + 1) * w] for i in range(len(parts))]


def from_key(keys: list[bytes], width: int) -> np.ndarray:
    flat = np.frombuffer(b"".join(keys), ">u8").astype(np.uint64) ^ np.uint64(1 << 63)
    return flat.view(np.int64).reshape(len(keys), width)


class PartTrie:
    """Trie over lexicographically sorted distinct rows: of every level the
    components of its nodes and the first child of each."""

    def __init__(self, parts: np.ndarray):
        self.parts = parts
        n, width = parts.shape
        new = np.zeros(n, bool)
        new[:1] = True
        starts = []
        for d in range(width):
            new[1:] |= parts[1:, d] != parts[:-1, d]
            starts.append(np.flatnonzero(new))
        self.values = [parts[s, d] for d, s in enumerate(starts)]
        self.child = [np.searchsorted(starts[d + 1], np.append(starts[d], n)) for d in range(width - 1)]

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each row's nearest entry, ties to the
        lower index, by one depth-first walk."""
        n, width = self.parts.shape
        exact = max(np.abs(self.parts).max(initial=0), np.abs(entries).max(initial=0)) >= EXACT
        kind = object if exact else np.int64
        entries = entries.astype(kind)
        best, error = np.zeros(n, np.int64), np.zeros(n, kind)
        if not width:
            return best, error

        def walk(level: int, lo: int, hi: int, parent: np.ndarray, above: np.ndarray) -> None:
            for a in range(lo, hi, SLAB):
                b = min(a + SLAB, hi)
                gap = self.values[level][a:b, None].astype(kind) - entries[None, :, level]
                total = above[parent[a - lo:b - lo]] + gap * gap
                if level == width - 1:          # leaves stand for the rows, in order
                    best[a:b] = total.argmin(1)
                    error[a:b] = total[np.arange(b - a), best[a:b]]
                else:
                    first = self.child[level][a:b + 1]
                    walk(level + 1, int(first[0]), int(first[-1]), np.repeat(np.arange(b - a), np.diff(first)), total)

        walk(0, 0, len(self.values[0]), np.zeros(len(self.values[0]), np.int64), np.zeros((1, len(entries)), kind))
        return best, error


def weighted_sums(parts: np.ndarray, weights: np.ndarray, entry: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
    """(entry, number of parts, componentwise sums) of the used entries."""
    if int(weights.sum()) * max(1, int(np.abs(parts).max(initial=0))) >= 2 ** 62:
        parts, weights = parts.astype(object), weights.astype(object)
    for e in np.unique(entry):
        on = entry == e
        yield int(e), int(weights[on].sum()), [int(s) for s in (parts[on] * weights[on, None]).sum(0)]


def _distinct_parts(rows: DataFrame, n_parts: int, width: int, scale: float) -> DataFrame:
    """(part, key, n): distinct parts with their number of copies."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            grid = grid_of(batch.column(0), n_parts * width, scale)
            for p in range(n_parts):
                part, n = np.unique(grid[:, p * width:(p + 1) * width], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), p, np.int32)), pa.array(to_key(part), pa.binary()),
                                                  pa.array(n, pa.int64())], ["part", "key", "n"])

    return (rows.select("vector").mapInArrow(cut, "part int, key binary, n long")
            .groupBy("part", "key").agg(F.sum("n").alias("n")))


def _blocks(distinct: DataFrame, n_parts: int) -> DataFrame:
    """(part, keys, weights): runs of at most BLOCK parts in trie order."""
    distinct = stored(distinct, "parts")
    ranges = max(n_parts, -(-distinct.count() // BLOCK))

    def bind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, int]] = []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([held[0][0]], pa.int32()), pa.array([b"".join(k for _, k, _ in held)], pa.binary()),
                 pa.array([np.array([n for _, _, n in held], "<i8").tobytes()], pa.binary())], ["part", "keys", "weights"])
            held.clear()
            return out

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (len(held) >= BLOCK or held[0][0] != row[0]):
                    yield flush()
                held.append(row)
        if held:
            yield flush()

    return stored(distinct.repartitionByRange(ranges, "part", "key").sortWithinPartitions("part", "key")
                  .mapInArrow(bind, "part int, keys binary, weights binary"), "part-blocks")


def fit(rows: DataFrame, dims: int, parts: int, entries: int, rounds: int, scale: float) -> list[list[list[int]]]:
    """Codebooks [part][entry][component] of ``rows`` (id, vector)."""
    width = -(-dims // parts)
    ids = [r.id for r in rows.where(F.col("id").isNotNull()).select("id").distinct().orderBy("id").limit(entries).collect()]
    first = rows.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("vector").alias("vector")).orderBy("id").collect()
    start = grid_of(pa.array([r.vector for r in first], pa.list_(pa.float64())), parts * width, scale)
    books = [start[:, p * width:(p + 1) * width].tolist() for p in range(parts)]
    if not first or not width:
        return books
    blocks = _blocks(_distinct_parts(rows, parts, width, scale), parts)
    whole = "decimal(38,0)"
    for _ in range(rounds):
        def assign(frames: Iterator[pd.DataFrame], books=books) -> Iterator[pd.DataFrame]:
            for f in frames:
                out = []
                for r in f.itertuples():
                    part = np.frombuffer(r.keys, ">u8").astype(np.uint64) ^ np.uint64(1 << 63)
                    part, n = part.view(np.int64).reshape(-1, width), np.frombuffer(r.weights, "<i8")
                    entry, _ = PartTrie(part).nearest(np.array(books[r.part], np.int64))
                    out += [(r.part, e, c, d, s) for e, c, sums in weighted_sums(part, n, entry) for d, s in enumerate(sums)]
                yield pd.DataFrame({"part": [o[0] for o in out], "entry": [o[1] for o in out], "n": [o[2] for o in out],
                                    "dim": [o[3] for o in out], "s": [str(o[4]) for o in out]})

        sums = (blocks.mapInPandas(assign, "part int, entry int, n long, dim int, s string")
                .groupBy("part", "entry", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(whole)).alias("s")))
        for r in sums.collect():          # at most parts * entries * width numbers
            books[r.part][r.entry][r.dim] = int(r.s) // int(r.n)
    return books


def _label_errors(coded: DataFrame) -> DataFrame:
    """Sum of errors over equal labels for every row. Labels that hold more
    than a 256th of the rows (so fewer than 256 of them) are joined by
    broadcast, the others, none of them large, by a shuffle."""
    sums = stored(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"), F.count("*").alias("c"))
                  .select("label", F.least("s", F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"), "c"), "labels")
    total = sums.agg(F.sum("c")).first()[0] or 0
    hot = F.col("c") * 256 > total
    big = F.broadcast(sums.where(hot).select(F.col("label").alias("l"), F.col("label_error").alias("le"), F.lit(True).alias("is_big")))
    some = coded.join(big, F.col("label").eqNullSafe(F.col("l")), "left").drop("l")
    rare = sums.where(~hot).select(F.col("label").alias("l2"), "label_error")
    small = (some.where("is_big IS NULL").drop("le", "is_big")
             .join(rare, F.col("label").eqNullSafe(F.col("l2"))).drop("l2"))
    return some.where("is_big").drop("is_big").withColumnRenamed("le", "label_error").unionByName(small)


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: float = 4096.0,
             id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label, label_error, codebooks_sha256: one row per usable row."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    named = F.col(label) if label in vectors.columns else F.lit(None).cast("int")
    rows = (vectors.where(finite(vector))
            .select(F.col(id_col).alias("id"), F.col(vector).alias("vector"), named.alias("label")))
    dims = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    books = fit(rows, dims, parts, entries, rounds, scale)
    width = -(-dims // parts)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()

    def encode(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            if not batch.num_rows:
                continue
            grid = grid_of(batch.column(1), parts * width, scale)
            code, error = np.zeros((len(grid), parts), np.int64), np.zeros(len(grid), object)
            if width and books[0]:
                for p in range(parts):
                    part, back = np.unique(grid[:, p * width:(p + 1) * width], axis=0, return_inverse=True)
                    entry, far = PartTrie(part).nearest(np.array(books[p], np.int64))
                    code[:, p], error = entry[back.ravel()], error + far[back.ravel()].astype(object)
            hexed = [bytes(c).hex() for c in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(hexed, pa.string()),
                 pa.array([min(int(e), LONG) for e in error], pa.int64())], ["id", "label", "code", "error"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    coded = stored(rows.mapInArrow(encode, f"id {kind['id']}, label {kind['label']}, code string, error long"), "codes")
    return _label_errors(coded).select(F.col("id").alias("vec_id"), "code", "error", "label", "label_error",
                                       F.lit(digest).alias("codebooks_sha256"))
