"""Quality classifier: interpolated modified Kneser-Ney bigram model of
trusted text, scored by sharded count joins.

Training. Bigrams of all trusted documents (labelled 1) but every fifth, chosen
by hash, which sets the thresholds, are counted; discounts come from their counts of counts, lower-order probabilities from continuation counts,
unseen words share the mass left over. For scoring the model is written as a
sum: log p(w|v) of an unseen bigram is log backoff(v) + log p(w), a seen one
adds a correction. So the log-likelihood of a document is a constant per
token plus a value for each of its words and each of its seen bigrams, and the
model is a table from n-gram to value.

What is moved. Texts are read where they lie: trusted ids are bits of a small
table (one row for 32,768 neighbouring ids), not a join of texts, unless ids lie so
far apart that it has more than ``BITMAPS`` rows. Words are coded by their rank; the
``LOCAL_WORDS`` most frequent ones, which every task holds, are thus small numbers,
any others keep their hash. Tasks send the bigrams they counted as sorted, delta-coded
blobs, dealt by first word (the ``SPREAD`` most frequent first words by both), so
that a bigram is three bytes rather than a row. Values of bigrams of held words
need no join; bigrams of other words join theirs.

Scoring. Every task holds the values of those words and of the ``LOCAL_BIGRAMS``
most frequent bigrams and adds them up itself. It asks only for the others, and
where all of the model's words are held only for bigrams of known words, as no other can have been
seen; else words go through the shards as well. Blocks of documents send their
distinct n-grams with the documents they occur in (sorted fingerprints, delta
coded) to the shard of the n-gram; empty requests are not sent. Shards grow in
number with the corpus until the model has no more than ``SHARD_ROWS`` rows a shard;
beyond that the blocks are dealt to batches and every batch joins a copy of the
shards, so a group holds about ``SHARD_BYTES`` of text's requests at any size and
a block sends no more requests than the model has shards: all that is moved is
proportional to the corpus. A shard joins the requests of a block
with its part of the model and returns one sum per document with such an n-gram; the shards' sums
of a block are added to the block's document rows, which travel under the block's own key.

Thresholds are quantiles of the perplexity of trusted documents that were not
trained on, by language and by length (short texts scatter more), over all of
them; a language with too few uses those of all languages. A document is
rejected if its perplexity is above ``slack`` times that quantile.

Defined results: documents without words (NULL, empty, blank) have 0 tokens, a
NULL perplexity and are kept; a NULL language counts as a language of its own;
rows that repeat an id are scored as they are; documents with contradictory
labels are not trusted; without trusted text nothing is rejected and perplexity
is NULL; an empty table gives no rows; other columns are not read.

N-gram fingerprints have 40 bits and the shard's, and shards follow the model's
rows up to one per ``SHARD_BYTES`` of text: an unseen n-gram meets a seen one by a
chance of the rows of a shard in 2 ** 40 (1e-6 at a million rows).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tables import stored
from cohortlens.llm.words import mix, text_slices, word_numbers

TRAIN_SHARE = 0.8     # of the trusted documents; the others set the thresholds
BLOCK_BYTES = 12 << 20
SHARD_BYTES = 64 << 20
SHARD_ROWS = 4096
KEY_BITS = 40
LOCAL_WORDS = 2_000_000
LOCAL_BIGRAMS = 1 << 21
HELD_PAIRS = 1 << 20  # bigrams a task counts before it sends them
COUNT_TOKENS = 1 << 22    # tokens of trusted text per group of counts
SPREAD = 4096         # most frequent first words, whose bigrams are dealt by both words
BITMAPS = 4096        # rows of 32,768 ids
QUANTILE = 0.99
SLACK = 1.5
LEAST_TRUSTED = 50
BROADCAST_ROWS = 10_000
DOCUMENTS = -1        # in the place of a shard: the documents of a block
BEGIN, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
BEGIN_CODE, END_CODE, FIRST_CODE, RARE = np.uint64(0), np.uint64(1), np.uint64(2), np.uint64(1 << 63)


def bigrams(words: np.ndarray, first: np.ndarray, begin=BEGIN, end=END) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(v, w, row) of all bigrams of non-empty rows, with both ends marked."""
    size = np.diff(first)
    full = np.flatnonzero(size)
    n = int(size.sum()) + len(full)
    row = np.repeat(full, size[full] + 1)
    ends = np.cumsum(size[full] + 1)
    w = np.full(n, end)
    inner = np.ones(n, bool)
    inner[ends - 1] = False
    w[inner] = words
    v = np.empty(n, np.uint64)
    v[1:] = w[:-1]
    v[np.r_[0, ends[:-1]][:len(full)]] = begin
    return v, w, row


def bigram_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * np.uint64(0x9E3779B97F4A7C15) + w * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(2))


def word_key(w: np.ndarray) -> np.ndarray:
    return mix(w + np.uint64(1))


def _pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _unpack(raw: bytes, n: int, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).reshape(-1).view(dtype)


def squeezed(*arrays: np.ndarray) -> list[tuple[str, int, bytes]]:
    """Arrays to broadcast, as compressed byte planes: every node keeps a file of them. Those of uint64 are in order and sent as differences."""
    steps = (np.diff(a, prepend=np.uint64(0)) if a.dtype == np.uint64 else a for a in arrays)
    return [(a.dtype.str, len(a), zstandard.ZstdCompressor(level=1).compress(_pack(np.ascontiguousarray(a)))) for a in steps]


def restored(parts: list[tuple[str, int, bytes]]) -> list[np.ndarray]:
    arrays = [_unpack(zstandard.ZstdDecompressor().decompress(raw), n, kind) for kind, n, raw in parts]
    return [np.cumsum(a, dtype=np.uint64) if a.dtype == np.uint64 else a for a in arrays]


def ranked(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, their codes): the rank by ``counts`` (any measure that grows with them), from FIRST_CODE on."""
    by_hash = np.argsort(hashes)
    hashes = hashes[by_hash]
    codes = np.empty(len(hashes), np.uint32)
    codes[np.argsort(-counts[by_hash], kind="stable")] = np.arange(len(hashes), dtype=np.uint32) + np.uint32(FIRST_CODE)
    return hashes, codes


def code_of(words: np.ndarray, known: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Codes of word hashes: those of ``ranked`` words, else the hash with its highest bit set."""
    if not len(known):
        return words | RARE
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return np.where(known[at] == words, codes[at].astype(np.uint64), words | RARE)


def count_words(docs: DataFrame, column: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, column):
                w, of, _ = word_numbers(part.column(column), lower=False)
                n = np.bincount(of, minlength=len(w))
                yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n.astype(np.int64))], ["w", "c"])

    return docs.select(column).mapInArrow(run, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int) -> tuple[Column, int]:
    """(condition, rows left out): the rows of highest count ``c``, at most ``most``, in steps of an eighth of an octave."""
    step = F.floor(F.log2("c") * 8)
    least, held, left = None, 0, 0
    for r in sorted(counts.groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"]):
        if left or held + r["count"] > most:
            left += r["count"]
        else:
            least, held = r["s"], held + r["count"]
    return (F.lit(False) if least is None else step >= least), left


def merged(v: np.ndarray, w: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (v, w) in order with the sums of their counts."""
    if not len(v):
        return v, w, c
    if max(v.max(), w.max()) < 1 << 32:
        order = np.argsort(v << np.uint64(32) | w)
    else:
        order = np.lexsort((w, v))
    v, w, c = v[order], w[order], c[order]
    at = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])])
    return v[at], w[at], np.add.reduceat(c, at)


def encode_counts(v: np.ndarray, w: np.ndarray, c: np.ndarray) -> bytes:
    """Sorted distinct pairs with their counts: differences of v, of w where v stays, as byte planes."""
    dw = np.diff(w, prepend=np.uint64(0))
    new = np.r_[True, v[1:] != v[:-1]]
    dw[new] = w[new]
    parts = [_pack(np.diff(v, prepend=np.uint64(0)).astype("<u8")), _pack(dw.astype("<u8")), _pack(c.astype("<u8"))]
    return np.array([len(v)], "<u8").tobytes() + zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def decode_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob[:8], "<u8")[0])
    raw = zstandard.ZstdDecompressor().decompress(blob[8:])
    dv, dw, c = (_unpack(raw[i * 8 * n:(i + 1) * 8 * n], n, "<u8") for i in range(3))
    v, w = np.cumsum(dv), np.cumsum(dw)
    at = np.flatnonzero(np.r_[True, dv[1:] != 0][:n])
    return v, w - np.repeat(w[at] - dw[at], np.diff(np.r_[at, n])), c.astype(np.int64)


def dealt(v: np.ndarray, w: np.ndarray, c: np.ndarray, shard: np.ndarray, shards: int) -> pa.RecordBatch:
    """(shard, blob) of sorted distinct pairs by their shard."""
    order = np.argsort(shard, kind="stable")          # pairs stay in order
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    some = np.flatnonzero(np.diff(cut)).tolist()
    blobs = [encode_counts(*(x[order[cut[i]:cut[i + 1]]] for x in (v, w, c))) for i in some]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def count_bigrams(docs: DataFrame, column: str, known, shards: int) -> DataFrame:
    """(v, w, c): codes of both words by the broadcast ``known`` and the number of their bigram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        words_known = restored(known.value)

        def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return merged(*(np.concatenate(x) for x in zip(*held)))

        def sent(v: np.ndarray, w: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
            return dealt(v, w, c, np.where(v < SPREAD, bigram_key(v, w), word_key(v)) & np.uint64(shards - 1), shards)

        for batch in batches:
            for part in text_slices(batch, column):
                words, of, first = word_numbers(part.column(column), lower=False)
                v, w, _ = bigrams(code_of(words, *words_known)[of], first, BEGIN_CODE, END_CODE)
                held.append(merged(v, w, np.ones(len(v), np.int64)))
                rows += len(held[-1][0])
                if rows > HELD_PAIRS:
                    held = [joined()]
                    rows = len(held[0][0])
                    if 2 * rows > HELD_PAIRS:
                        yield sent(*held[0])
                        held, rows = [], 0
        if rows:
            yield sent(*joined())

    def total(blobs: pa.Table) -> pa.Table:
        v, w, c = merged(*(np.concatenate(x) for x in zip(*(decode_counts(b) for b in blobs.column("blob").to_pylist()))))
        return pa.table({"v": v.view(np.int64), "w": w.view(np.int64), "c": c})

    return docs.select(column).mapInArrow(run, "shard int, blob binary").groupBy("shard").applyInArrow(total, "v long, w long, c long")


def _counts_of_counts(c: str) -> list[Column]:
    return [F.sum((F.col(c) == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more; one half of
    the count where the counts of counts do not determine them."""
    n = [n1 or 0, n2 or 0, n3 or 0, n4 or 0]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0
        out.append(d if 0 < d < k else k / 2)
    return out


def _discount(c: str, d: list[float]) -> Column:
    return F.when(F.col(c) == 1, d[0]).when(F.col(c) == 2, d[1]).otherwise(d[2])


def _fetched(rows: DataFrame, *kinds: str) -> list[np.ndarray]:
    """A bounded table as arrays, one per column (``kinds``: their types), packed by tasks."""
    names = rows.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [np.asarray(batch.column(c)).astype(k).tobytes() for c, k in zip(names, kinds)]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cols], names)

    parts = [[] for _ in names]
    for row in rows.mapInArrow(pack, ", ".join(f"{c} binary" for c in names)).toLocalIterator():    # a partition at a time
        for part, cell, k in zip(parts, row, kinds):
            part.append(np.frombuffer(cell, k))
    out = []
    while parts:                       # a column at a time
        column = parts.pop(0)
        out.append(np.concatenate([np.empty(0, kinds[len(out)]), *column]))
    return out


def pair_values(v: np.ndarray, w: np.ndarray, c: np.ndarray, scale: np.ndarray, p: np.ndarray, d: list[float]) -> np.ndarray:
    """Values of seen bigrams of held words: ``scale`` and ``p`` by code, discounts ``d``."""
    return np.log1p(np.maximum(c - np.asarray(d)[np.minimum(c, 3) - 1], 0.0) / scale[v] / p[w])


class Model:
    """Bigrams (v, w, c) of held words in codes, whose values are ``pair_values`` with ``weights``; ``types`` bigrams in all;
    the ``ranked`` words held by every task with their values by code; values (key, value) of all other
    words and bigrams, None if there are none; the constants of a trained model."""

    def __init__(self, bigrams: DataFrame, weights: tuple, known: tuple[np.ndarray, np.ndarray], values: np.ndarray,
                 rare: DataFrame | None, per_token: float, per_doc: float, types: int):
        self.bigrams, self.weights, self.known, self.values, self.rare = bigrams, weights, known, values, rare
        self.per_token, self.per_doc, self.types = per_token, per_doc, types


def train(docs: DataFrame, column: str = "text") -> Model | None:
    """Fit the bigram model on all rows of ``docs``; None without words."""
    spark = docs.sparkSession
    vocabulary = stored(count_words(docs, column), "vocabulary")
    tokens = vocabulary.agg(F.sum("c")).first()[0]
    if not tokens:
        return None
    local, others = frequent(vocabulary, LOCAL_WORDS)
    known = ranked(*_fetched(vocabulary.where(local).select("w", F.floor(F.log2("c") * 8).alias("c")), "<u8", "<i2"))
    shared = spark.sparkContext.broadcast(squeezed(*known))
    shards = 1 << max(0, math.ceil(math.log2(tokens / COUNT_TOKENS)))
    b = stored(count_bigrams(docs, column, shared, shards), "bigrams", "zstd")
    shared.destroy()
    top = b.agg(*_counts_of_counts("c"), F.count("*").alias("types")).first()
    d = discounts(top.n1, top.n2, top.n3, top.n4)
    mass = F.sum(_discount("c", d)) / F.sum("c")
    ctx = stored(b.groupBy("v").agg(F.sum("c").alias("total"), mass.alias("back")), "contexts", "zstd")
    cont = stored(b.groupBy("w").agg(F.count("*").alias("a")), "continuations", "zstd")
    low = cont.agg(*_counts_of_counts("a"), F.count("*").alias("vocabulary")).first()
    e = discounts(low.n1, low.n2, low.n3, low.n4)
    left = cont.agg(F.sum(_discount("a", e))).first()[0] / top.types
    unseen = left / (low.vocabulary + 1)
    p_low = F.greatest(F.col("a") - _discount("a", e), F.lit(0.0)) / top.types + unseen
    cont = cont.select("w", p_low.alias("p"))
    # held words by code; those of other words are negative
    scale, back, p = (np.full(len(known[0]) + 2, x) for x in (1.0, 1.0, unseen))
    v, x, y = _fetched(ctx.where("v >= 0").select("v", (F.col("total") * F.col("back")).alias("scale"), "back"), "<u4", "<f8", "<f8")
    scale[v], back[v] = x, y
    w, x = _fetched(cont.where("w >= 0"), "<u4", "<f8")
    p[w] = x
    values = np.log(p / unseen) + np.log(back)
    held, rare = (F.col("v") >= 0) & (F.col("w") >= 0), None
    if others:
        seen = (b.where(~held).join(ctx, "v").join(cont, "w")
                .select("v", "w", F.log1p(F.greatest(F.col("c") - _discount("c", d), F.lit(0.0)) / F.col("total")
                                          / F.col("back") / F.col("p")).alias("value")))
        word = (cont.where("w < 0").select("w", F.log(F.col("p") / unseen).alias("x"))
                .unionByName(ctx.where("v < 0").select(F.col("v").alias("w"), F.log("back").alias("x")))
                .groupBy("w").agg(F.sum("x").alias("value")))
        rare = (seen.mapInArrow(_bigram_keys, "key long, value double")
                .unionByName(word.mapInArrow(_word_keys, "key long, value double")))
    return Model(b.where(held), (scale, p, d), known, values, rare, math.log(unseen),
                 float(np.log(p[1] / unseen) + np.log(back[0])), top.types)


# -- sharded scoring -----------------------------------------------------------

def encode_request(code: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted distinct codes (fingerprint, document number in the low 16 bits)
    with their counts, as delta-coded byte planes."""
    key, at = np.unique(code >> np.uint64(16), return_index=True)
    per_key = np.diff(np.r_[at, len(code)]).astype("<u2")
    parts = [_pack(np.diff(key, prepend=np.uint64(0)).astype("<u8")), _pack(per_key),
             _pack((code & np.uint64(0xFFFF)).astype("<u2")), _pack(np.minimum(count, 2 ** 32 - 1).astype("<u4"))]
    return np.array([len(key), len(code)], "<u8").tobytes() + zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def decode_request(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    k, n = (int(x) for x in np.frombuffer(blob[:16], "<u8"))
    raw = zstandard.ZstdDecompressor().decompress(blob[16:])
    cut = np.cumsum([0, 8 * k, 2 * k, 2 * n, 4 * n])
    part = lambda i: raw[cut[i]:cut[i + 1]]
    return (np.cumsum(_unpack(part(0), k, "<u8")), _unpack(part(1), k, "<u2"), _unpack(part(2), n, "<u2"),
            _unpack(part(3), n, "<u4"))


def requests(docs: DataFrame, shards: int, column: str, local=None) -> DataFrame:
    """(shard, block, blob, ids, langs, tokens, own): what each block asks of
    the shards, and one row with shard ``DOCUMENTS`` for the block's documents. ``local`` is the
    broadcast part of the model that every task holds: (``squeezed`` ranked words, values by code, pairs of codes in order
    and their values), whether the model has other words, other bigrams; own are the sums of those values."""
    bits, mask = KEY_BITS + shards.bit_length() - 1, np.uint64((1 << KEY_BITS) - 1)
    number = np.uint16 if shards <= 1 << 16 else np.uint32
    schema = "shard int, block long, blob binary, ids array<long>, langs array<string>, tokens array<long>, own array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, no = TaskContext.get().partitionId() << 24, 0
        codes, of_shard, ids, langs, tokens, own, size = [], [], [], [], [], [], 0
        if local is not None:
            arrays, more_words, more_bigrams = local.value
            known, codes_of, value, held, held_value = restored(arrays)

        def flush() -> pa.RecordBatch:
            # shards are dealt apart from the codes: fingerprint and document number fill 56 bits, more shards than 256 the rest
            code, shard = np.concatenate(codes), np.concatenate(of_shard)
            order = np.argsort(shard, kind="stable")
            code, cut = code[order], np.searchsorted(shard[order], np.arange(shards + 1))
            asked = np.flatnonzero(np.diff(cut)).tolist()
            blobs = [encode_request(*np.unique(code[cut[i]:cut[i + 1]], return_counts=True)) for i in asked]
            head = lambda x: [x] + [None] * len(asked)
            return pa.RecordBatch.from_arrays(
                [pa.array([DOCUMENTS, *asked], pa.int32()), pa.array([base + no] * (len(asked) + 1), pa.int64()), pa.array([None, *blobs], pa.binary()),
                 pa.array(head(ids), pa.list_(pa.int64())), pa.array(head(langs), pa.list_(pa.string())),
                 pa.array(head(tokens), pa.list_(pa.int64())), pa.array(head(own), pa.list_(pa.float64()))],
                ["shard", "block", "blob", "ids", "langs", "tokens", "own"])

        for batch in batches:
            for part in text_slices(batch, column):
                for at in range(0, part.num_rows, 20_000):      # document numbers of a block fit 16 bits
                    some = part.slice(at, 20_000)
                    words, of, first = word_numbers(some.column(column), lower=False)
                    if local is not None:
                        words = code_of(words, known, codes_of)[of]
                        of = np.repeat(np.arange(len(first) - 1), np.diff(first))
                        there = words < RARE
                        sums = np.bincount(of[there], value[words[there]], len(first) - 1)
                        v, w, row = bigrams(words, first, BEGIN_CODE, END_CODE)
                        there = (v < RARE) & (w < RARE)
                        pair, which = np.unique(v[there] << np.uint64(32) | w[there], return_inverse=True)
                        known_pair = np.zeros(len(pair), bool)
                        if len(held):
                            at = np.minimum(np.searchsorted(held, pair), len(held) - 1)
                            known_pair = held[at] == pair
                            got = np.where(known_pair, held_value[at], 0.0)
                            sums += np.bincount(row[there], got[which], len(first) - 1)
                        own += sums.tolist()
                        ask = np.full(len(v), more_words)
                        ask[there] = ~known_pair[which] & more_bigrams
                        key, row = bigram_key(v[ask], w[ask]), row[ask]
                        if more_words:
                            others = words >= RARE
                            key, row = np.concatenate((key, word_key(words[others]))), np.concatenate((row, of[others]))
                    else:
                        words = words[of]
                        v, w, row = bigrams(words, first)
                        own += [0.0] * some.num_rows
                        key, row = np.concatenate((bigram_key(v, w), word_key(words))), np.concatenate((row, row[w != END]))
                    key = key >> np.uint64(64 - bits)
                    of_shard.append((key >> np.uint64(KEY_BITS)).astype(number))
                    codes.append((key & mask) << np.uint64(16) | (row + len(ids)).astype(np.uint64))
                    ids += some.column("id").to_pylist()
                    langs += some.column("lang").to_pylist()
                    tokens += np.diff(first).tolist()
                    size += some.column(column).nbytes
                    if size >= BLOCK_BYTES or len(ids) > 40_000:
                        yield flush()
                        codes, of_shard, ids, langs, tokens, own, size, no = [], [], [], [], [], [], 0, no + 1
        if ids:
            yield flush()

    return docs.mapInArrow(run, schema)


def _answer(asked: pd.DataFrame, values: pd.DataFrame, bits: int, weights) -> pd.DataFrame:
    """One shard: sums of the values of each block's documents. Values come as rows or as pairs with
    their counts, which have the broadcast ``weights``."""
    rows = values["pairs"].isna().to_numpy()
    known, value = [values["k"].to_numpy()[rows].astype(np.uint64)], [values["value"].to_numpy()[rows]]
    scale, p, d = (*restored(weights.value[0]), weights.value[1]) if not rows.all() else (None, None, None)
    for blob in values["pairs"][~rows]:
        v, w, c = decode_counts(blob)
        known.append(bigram_key(v, w) >> np.uint64(64 - bits) & np.uint64((1 << KEY_BITS) - 1))
        value.append(pair_values(v, w, c, scale, p, d))
    known, value = np.concatenate(known), np.concatenate(value)
    order = np.argsort(known, kind="stable")
    known, value = known[order], value[order]
    sums = []
    for blob in asked["blob"]:
        key, per_key, doc, count = decode_request(blob)
        got = np.zeros(len(key))
        if len(known):
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            got = np.where(known[at] == key, value[at], 0.0)
        total = np.bincount(doc, np.repeat(got, per_key) * count)
        some = np.flatnonzero(total)
        sums.append(np.array([len(some)], "<u4").tobytes() + some.astype("<u2").tobytes() + total[some].astype("<f8").tobytes())
    return asked.drop(columns=["blob"]).assign(sums=sums)


def _collected(parts: pd.DataFrame) -> pd.DataFrame:
    """One block: the shards' sums added per document."""
    parts = parts.sort_values("shard")
    head = parts.iloc[0]
    total = np.array(head["own"], float)
    for s in parts["sums"].iloc[1:]:
        n = int(np.frombuffer(s[:4], "<u4")[0])
        total[np.frombuffer(s[4:4 + 2 * n], "<u2")] += np.frombuffer(s[4 + 2 * n:], "<f8")
    ids = pd.array([None if pd.isna(x) else int(x) for x in head["ids"]], dtype="Int64")
    return pd.DataFrame({"id": ids, "lang": list(head["langs"]), "n_tokens": np.asarray(head["tokens"], np.int64), "total": total})


def layout(size: int, rows: int) -> tuple[int, int]:
    """(shards, a power of two; batches) for a corpus of ``size`` bytes and a model of ``rows`` rows."""
    by_corpus = 1 << max(0, math.ceil(math.log2(max(size, 1) / SHARD_BYTES)))
    by_model = 1 << max(0, math.ceil(math.log2(max(rows, 1) / SHARD_ROWS)))
    shards = min(by_corpus, by_model)
    return shards, max(1, math.ceil(size / SHARD_BYTES / shards))


def perplexity(docs: DataFrame, model: Model | None, id_col: str = "doc_id", lang_col: str = "lang",
               column: str = "text") -> DataFrame:
    """(id, lang, n_tokens, perplexity) of every row."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), column)
    size = base.agg(F.sum(F.octet_length(column))).first()[0] or 0
    spark = docs.sparkSession
    local = weights = others = None
    if model:
        at_hand, others = frequent(model.bigrams, min(LOCAL_BIGRAMS, LOCAL_WORDS))
        v, w, c = _fetched(model.bigrams.where(at_hand), "<u4", "<u4", "<i8")
        asked = F.sum(F.when(at_hand, 0).otherwise(F.col("c"))) / F.sum("c")
        share = model.bigrams.agg(asked).first()[0] or 0.0
        pair = v.astype(np.uint64) << np.uint64(32) | w
        order = np.argsort(pair)
        local = spark.sparkContext.broadcast((squeezed(*model.known, model.values, pair[order], pair_values(v, w, c, *model.weights)[order]),
                                              model.rare is not None, others > 0))
    rare = model.rare if model and model.rare is not None else spark.createDataFrame([], "key long, value double")
    # texts ask for less where tasks hold bigrams; unseen ones are asked for as well, so half is reckoned with at least
    shards, batches = layout(size if others is None or model.rare is not None else math.ceil(size * max(share, 0.5)), model.types if model else 0)
    bits = KEY_BITS + shards.bit_length() - 1
    fingerprint = F.shiftrightunsigned("key", 64 - bits)
    values = rare.select(F.shiftright(fingerprint, KEY_BITS).cast("int").alias("shard"),
                         fingerprint.bitwiseAND(F.lit((1 << KEY_BITS) - 1)).alias("k"), "value", F.lit(None).cast("binary").alias("pairs"))
    if others:
        def deal(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows = [], 0
            for batch in frames:
                held.append([np.asarray(batch.column(c)).view(np.uint64 if c != "c" else np.int64) for c in ("v", "w", "c")])
                rows += batch.num_rows
                if rows > HELD_PAIRS:
                    yield packed(held)
                    held, rows = [], 0
            if rows:
                yield packed(held)

        def packed(held: list) -> pa.RecordBatch:
            v, w, c = merged(*(np.concatenate(x) for x in zip(*held)))
            return dealt(v, w, c, bigram_key(v, w) >> np.uint64(64 - bits) >> np.uint64(KEY_BITS), shards)

        weights = spark.sparkContext.broadcast((squeezed(*model.weights[:2]), model.weights[2]))
        pairs = model.bigrams.where(~at_hand).mapInArrow(deal, "shard int, blob binary")
        values = values.unionByName(pairs.select("shard", F.lit(None).cast("long").alias("k"), F.lit(None).cast("double").alias("value"),
                                                 F.col("blob").alias("pairs")))
    values = values.withColumn("batch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(batches - 1).cast("long"))))
    kind = "shard int, block long, ids array<long>, langs array<string>, tokens array<long>, own array<double>, sums binary"
    batch = F.when(F.col("shard") == DOCUMENTS, F.col("block")).otherwise(F.pmod(F.xxhash64("block"), F.lit(batches)))
    asked = requests(base, shards, column, local).withColumn("batch", batch)

    def answered(asked: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        asked = asked.drop(columns="batch")
        if not len(asked) or asked["shard"].iloc[0] == DOCUMENTS:
            return asked.drop(columns="blob").assign(sums=pd.Series([None] * len(asked), dtype=object))
        return _answer(asked, values, bits, weights)

    sums = asked.groupBy("shard", "batch").cogroup(values.groupBy("shard", "batch")).applyInPandas(answered, kind)
    scored = sums.groupBy("block").applyInPandas(_collected, "id long, lang string, n_tokens long, total double")
    log = F.col("total") + F.lit(model.per_doc if model else None).cast("double") + (F.col("n_tokens") + 1) * F.lit(
        model.per_token if model else None).cast("double")
    return scored.select("id", "lang", "n_tokens", F.when(F.col("n_tokens") > 0, F.exp(-log / (F.col("n_tokens") + 1)))
                         .alias("perplexity"))


def _bigram_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = bigram_key(*(np.asarray(batch.column(c)).view(np.uint64) for c in ("v", "w")))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("value")], ["key", "value"])


def _word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = word_key(np.asarray(batch.column("w")).view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("value")], ["key", "value"])


def length_class(n: Column) -> Column:
    """Texts of up to 7, 31 and more tokens."""
    return F.when(n < 8, 0).when(n < 32, 1).otherwise(2)


def _chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``id`` is among the distinct ``ids``. Texts stay where they are: ids are
    bits of a broadcast table, unless they lie so far apart that it grows too long."""
    bucket = F.bitmap_bucket_number("id")
    if ids.select(bucket).distinct().count() > BITMAPS:
        return docs.join(ids, "id", "left_semi")
    bits = stored(ids.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("_bits")), "chosen")
    bit = F.bitmap_bit_position("id")
    byte = F.conv(F.hex(F.substr("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    # the bit's weight in its byte, without a shift by a column
    there = F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))) % 2 == 1
    return docs.join(F.broadcast(bits), (bucket == F.col("_bucket")) & there, "left_semi")


def classify(docs: DataFrame, labels: DataFrame, train_share: float = TRAIN_SHARE, quantile: float = QUANTILE,
             slack: float = SLACK, id_col: str = "doc_id", lang_col: str = "lang", column: str = "text") -> DataFrame:
    """One row per document: doc_id, lang, n_tokens, perplexity, threshold,
    rejected. ``labels`` holds (doc_id, quality), 1 for trusted."""
    trusted = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id"))
               .agg(F.min("quality").alias("q")).where("q = 1").select("id"))
    in_train = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(train_share * (1 << 20))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), column)
    model = train(_chosen(texts, trusted.where(in_train)), column)
    scores = stored(perplexity(docs, model, id_col, lang_col, column), "perplexity")
    held_out = scores.join(trusted.where(~in_train), "id").where("perplexity IS NOT NULL")
    q = F.percentile_approx("perplexity", F.lit(quantile), 10_000)
    held_out = held_out.withColumn("size_class", length_class(F.col("n_tokens"))).withColumn("lang", F.coalesce("lang", F.lit("")))
    # a few languages by three classes: rows that are broadcast, unless the languages are too many
    by_lang = stored(held_out.groupBy("lang", "size_class").agg(q.alias("q"), F.count("*").alias("n")).where(F.col("n") >= LEAST_TRUSTED), "thresholds")
    few = F.broadcast if by_lang.count() <= BROADCAST_ROWS else (lambda x: x)
    by_size = held_out.groupBy("size_class").agg(q.alias("q_size"))
    every = held_out.agg(q.alias("q_all")).withColumn("one", F.lit(1))
    threshold = slack * F.coalesce("q", "q_size", "q_all")
    return (scores.withColumn("size_class", length_class(F.col("n_tokens"))).withColumn("one", F.lit(1))
            .withColumn("_l", F.coalesce("lang", F.lit("")))
            .join(few(by_lang.select(F.col("lang").alias("_l"), "size_class", "q")), ["_l", "size_class"], "left")
            .join(F.broadcast(by_size), "size_class", "left").join(F.broadcast(every), "one", "left")
            .select(F.col("id").alias("doc_id"), "lang", "n_tokens", "perplexity", threshold.alias("threshold"),
                    F.coalesce(F.col("perplexity") > threshold, F.lit(False)).alias("rejected")))
