"""Line de-duplication by winnowing over line hashes.

Texts are sequences of lines (split at "\\n", compared without the ASCII white
space at both ends). A gram is the shortest run of lines from some line on
that holds at least ``gram_words`` words; a window is the shortest run that
holds at least ``min_words``. Of the grams inside a window the one with the
smallest hash is its fingerprint (the last such, if tied), so any two equal
runs of ``min_words`` words share a fingerprint at the same place. A document
reports each fingerprint once with the windows it stands for, as positions.

Fingerprints that occur once are done with. The positions of the others are
joined on the content of the window: its first occurrence, in the order of
(doc_id, text digest, line), is the source, all others are repeats. A repeat is
extended line by line both ways as long as the lines equal those around the
source, and the lines of every extended repeat are deleted. Every deleted line
has an equal earlier one; the first copy of a line is never deleted.

Only line hashes and positions are shuffled for this; texts are joined with
the lines to delete at the end. A window content held by a third of all rows
is one row per occurrence after a map-side combined minimum, and its source's
hashes are joined by document, so no group is gathered in a task.

Defined results: NULL text stays NULL, empty text stays empty, and neither
repeats anything; rows that repeat doc_id and text count as one document (each
is returned, alike); rows without doc_id are returned unchanged; ties between
runs cannot occur, as positions differ; an empty table gives no rows. All
input columns are returned, whatever their names (n_lines and n_deleted are
replaced if present).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tables import stored
from cohortlens.llm.words import _SPACE, buffer_of, hash64, mix, pieces, spans_of, text_slices

MIN_WORDS = 50
GRAM_WORDS = 20
_MULT = np.uint64(0x9E3779B97F4A7C15)


def line_table(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and number of words of every line of a column, and row offsets."""
    data, offs = buffer_of(column)
    n = len(data)
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offs[:-1], breaks + 1)), kind="stable")     # every text has a first line
    row_first = np.arange(len(offs) - 1) + np.searchsorted(breaks, offs[:-1])
    first = np.append(row_first, len(starts))
    ends = np.append(starts[1:], n)
    ends = ends - ((ends > starts) & (ends > 0) & (data[np.maximum(ends - 1, 0)] == 10) if n else 0)
    last = first[1:] - 1                                # a text's last line ends with the text
    ends[last] = offs[1:]
    w_start, w_end, _ = spans_of(data, offs, _SPACE)
    a, b = np.searchsorted(w_start, starts), np.searchsorted(w_start, ends)
    words = b - a
    kept_from = np.where(words > 0, w_start[np.minimum(a, max(len(w_start) - 1, 0))] if len(w_start) else 0, 0)
    kept_to = np.where(words > 0, w_end[np.maximum(b - 1, 0)] if len(w_end) else 0, 0)
    full = np.flatnonzero(words > 0)
    hashes = np.zeros(len(starts), np.uint64)
    if len(full):
        bounds = np.empty(2 * len(full) + 1, np.int64)   # line, gap, line, gap, ...
        bounds[0:-1:2], bounds[1::2], bounds[-1] = kept_from[full], kept_to[full], n
        lines = pieces(data, bounds).take(pa.array(np.arange(len(full)) * 2))
        coded = lines.dictionary_encode()
        hashes[full] = hash64(coded.dictionary)[np.asarray(coded.indices)]
    return hashes, words, first


def _runs(words: np.ndarray, need: int) -> np.ndarray:
    """End (exclusive) of the shortest run from each line with ``need`` words;
    len + 1 where there is none."""
    total = np.concatenate(([0], np.cumsum(words)))
    return np.searchsorted(total, total[:-1] + need, side="left")


def fingerprints(hashes: np.ndarray, words: np.ndarray, min_words: int, gram_words: int):
    """(window starts, ends, hashes, their fingerprint lines; gram hash by line)
    of a text. Blank lines never start a run."""
    n = len(hashes)
    end, gram_end = _runs(words, min_words), _runs(words, gram_words)
    at = np.flatnonzero((end <= n) & (words > 0))
    if not len(at):
        return at, at, np.empty(0, np.uint64), at, np.empty(0, np.uint64)
    # run hash = sum of hash * mult^position from the run's start, through prefix sums of a text-wide sum
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _MULT))))
    prefix = np.concatenate(([np.uint64(0)], np.cumsum(mix(hashes + np.uint64(1)) * power[:n])))
    inverse = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, np.uint64(pow(int(_MULT), -1, 1 << 64))))))
    run_hash = lambda a, b: mix((prefix[b] - prefix[a]) * inverse[a] + (b - a).astype(np.uint64))
    grams = np.flatnonzero((gram_end <= n) & (words > 0))
    gram_hash = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    gram_hash[grams] = run_hash(grams, gram_end[grams])
    finger = np.empty(len(at), np.int64)
    for k, s in enumerate(at.tolist()):
        inside = gram_hash[s:end[s]].copy()
        inside[gram_end[s:end[s]] > end[s]] = np.iinfo(np.uint64).max
        finger[k] = s + len(inside) - 1 - int(np.argmin(inside[::-1]))
    return at, end[at], run_hash(at, end[at]), finger, gram_hash


def positions(docs: DataFrame, min_words: int, gram_words: int) -> DataFrame:
    """Per document a row with its line hashes (``gram`` NULL), then a row per
    fingerprint: the gram's hash and the windows it is the minimum of."""
    kind = "id long, digest long, lines binary, gram long, windows array<struct<key:long,start:int,finish:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                hashes, words, first = line_table(part.column("text"))
                rows, lines, grams, keys, starts, ends, sizes = [], [], [], [], [], [], []
                for r, (a, b) in enumerate(zip(first.tolist(), first[1:].tolist())):
                    if words[a:b].sum() < min_words:
                        continue
                    s, e, h, finger, gram = fingerprints(hashes[a:b], words[a:b], min_words, gram_words)
                    cut = np.flatnonzero(np.r_[True, finger[1:] != finger[:-1], True])
                    rows += [r] * len(cut)
                    lines += [hashes[a:b].tobytes()] + [None] * (len(cut) - 1)
                    grams += [None] + gram[finger[cut[:-1]]].view(np.int64).tolist()
                    sizes += [0] + np.diff(cut).tolist()
                    keys.append(h.view(np.int64))
                    starts.append(s)
                    ends.append(e)
                if not rows:
                    continue
                flat = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(starts).astype(np.int32)),
                     pa.array(np.concatenate(ends).astype(np.int32))], ["key", "start", "finish"])
                at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                part = part.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("digest"), pa.array(lines, pa.binary()),
                     pa.array(grams, pa.int64()), pa.ListArray.from_arrays(pa.array(at), flat)],
                    ["id", "digest", "lines", "gram", "windows"])

    return docs.select("id", "digest", "text").mapInArrow(run, kind)


def _equal_ahead(x: np.ndarray, y: np.ndarray) -> int:
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    return int(differ[0]) if len(differ) else n


def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to delete of each (document, source) pair: its repeats extended
    both ways against the source's lines."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            x, y = np.frombuffer(r["lines"], np.uint64), np.frombuffer(r["source_lines"], np.uint64)
            drop, done = np.zeros(len(x), bool), {}
            for a, b, s in sorted((m["start"], m["finish"], m["source_start"]) for m in r["matches"]):
                if done.get(s - a, -1) >= b:      # inside a run of the same shift
                    continue
                back = _equal_ahead(x[:a][::-1], y[:s][::-1])
                ahead = _equal_ahead(x[b:], y[b + s - a:])
                drop[a - back:b + ahead] = True
                done[s - a] = b + ahead
            out.append(np.flatnonzero(drop).astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"),
                                          pa.array(out, pa.list_(pa.int32()))], ["id", "digest", "drop"])


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS,
                   id_col: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, digest, drop array<int>) of the documents that have lines to delete."""
    base = docs.where(F.col(id_col).isNotNull() & F.col(column).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(column).alias("digest"), F.col(column).alias("text"))
    found = stored(positions(base, min_words, gram_words), "positions")
    grams = found.where("gram IS NOT NULL")
    twice = grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    each = stored(grams.join(twice, "gram").select("id", "digest", F.explode("windows").alias("w"))
                  .select("id", "digest", "w.*"), "windows")
    first = (each.groupBy("key").agg(F.min(F.struct("id", "digest", "start")).alias("source"), F.count("*").alias("n"))
             .where("n > 1").select("key", "source"))
    later = (each.join(first, "key")
             .where(F.struct("id", "digest", "start") > F.col("source"))
             .select("id", "digest", F.col("source.id").alias("source_id"), F.col("source.digest").alias("source_digest"),
                     F.struct("start", "finish", F.col("source.start").alias("source_start")).alias("m"))
             .groupBy("id", "digest", "source_id", "source_digest").agg(F.collect_set("m").alias("matches")))
    lines = found.where("gram IS NULL").select("id", "digest", "lines").dropDuplicates(["id", "digest"])
    source = lines.select(F.col("id").alias("source_id"), F.col("digest").alias("source_digest"),
                          F.col("lines").alias("source_lines"))
    return (later.join(source, ["source_id", "source_digest"]).join(lines, ["id", "digest"])
            .mapInArrow(extended, "id long, digest long, drop array<int>")
            .select("id", "digest", F.explode("drop").alias("line"))
            .groupBy("id", "digest").agg(F.collect_set("line").alias("drop")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS,
                id_col: str = "doc_id", column: str = "text") -> DataFrame:
    """``docs`` with the repeated lines deleted from ``column``, and the
    columns n_lines and n_deleted added (an input column of such a name is
    replaced)."""
    drop = stored(repeated_lines(docs, min_words, gram_words, id_col, column), "drops").select(
        F.col("id").alias("_cl_id"), F.col("digest").alias("_cl_digest"), F.col("drop").alias("_cl_drop"))
    lines = F.split(F.col(column), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_cl_drop", i)), "\n")
    # the texts are dealt out by key at every size; only the lines to delete are held
    return (docs.join(drop.hint("shuffle_hash"), (F.col(id_col) == F.col("_cl_id")) & (F.xxhash64(column) == F.col("_cl_digest")), "left")
            .withColumn("n_lines", F.when(F.col(column).isNull(), 0).otherwise(F.size(lines)))
            .withColumn("n_deleted", F.coalesce(F.size("_cl_drop"), F.lit(0)))
            .withColumn(column, F.when(F.col("_cl_drop").isNull(), F.col(column)).otherwise(kept))
            .drop("_cl_id", "_cl_digest", "_cl_drop"))
