"""Best-fit packing of tokenised documents by bulk-synchronous successor sweeps.

Documents become pieces of at most ``window`` tokens (only longer documents
are cut; the remainder comes first, so all other pieces are full). Pieces are
range-sorted by length with a rank inside their length; sequences with room
left ("gaps") are kept the same way, as runs of equal size. Pieces of one
length are interchangeable for packing, so documents and gaps are swept as
(size, count) runs, pre-aggregated by Spark: at most ``window`` of them,
whatever the input's size.

A superstep takes the longest lengths still unplaced and sweeps the gaps
upwards from the successor of that length (the smallest gap that holds it);
the pieces that want the same run of gaps are served by rank, the first n
pieces get the run's first n gaps. What stays unserved opens new sequences,
as many pieces side by side as fit. Then the gaps are updated and the next
superstep starts. The plan that comes out says which ranks of a length go to
which sequences at which offset; pieces look theirs up by (length, rank).

Ranks need no global sort: a task numbers the pieces of each length it wrote,
and a window over the per-task counts of one length adds the offsets.

Defined results: NULL text counts as empty; an empty document is its end id
alone; rows that repeat a document are packed like any other row; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.bpe import bpe_of
from cohortlens.llm.tables import stored
from cohortlens.llm.words import text_slices

WINDOW = 2048


def cut(n_tokens: int, window: int) -> list[int]:
    """Lengths of a document's pieces: the remainder, then full windows."""
    rest = n_tokens % window
    return ([rest] if rest else []) + [window] * (n_tokens // window)


def pieces_of(docs: DataFrame, vocab: str, window: int = WINDOW, end_id: int = 0, id_col: str = "doc_id",
              column: str = "text", with_ids: bool = False) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, part, rank_in_part) of every
    document; ``rank_in_part`` counts the pieces of one length within a task.
    ``with_ids`` adds the pieces' token ids."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part_no, seen = bpe_of(vocab), TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in text_slices(batch, column):
                ids, rows = bpe.encode(part.column(column))
                raw, rows = ids.tobytes(), rows.tolist()
                row, no, start, length, crc, rank, tokens = [], [], [], [], [], [], []
                for r, (a, b) in enumerate(zip(rows, rows[1:])):
                    text = raw[4 * a:4 * b] + end
                    at = 0
                    for k, size in enumerate(cut(b - a + 1, window)):
                        row.append(r)
                        no.append(k)
                        start.append(at)
                        length.append(size)
                        own = text[4 * at:4 * (at + size)]
                        crc.append(zlib.crc32(own))
                        if with_ids:
                            tokens.append(np.frombuffer(own, "<u4").astype(np.int32))
                        rank.append(int(seen[size]))
                        seen[size] += 1
                        at += size
                cols = [part.column(id_col).take(pa.array(row, pa.int64())), pa.array(no, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                        pa.array([part_no] * len(row), pa.int32()), pa.array(rank, pa.int64())]
                names = [id_col, "piece", "start", "length", "ids_crc32", "part", "rank_in_part"]
                if with_ids:
                    cols.append(pa.array(tokens, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    more = ", ids array<int>" if with_ids else ""
    return docs.select(id_col, column).mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, part int, rank_in_part long{more}")


def sweep(counts: dict[int, int], window: int = WINDOW) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Best-fit plan for ``counts`` pieces per length.

    Returns per length the segments (first rank, n, first sequence, pieces
    side by side, offset): piece number j of the segment goes to sequence
    first + j // side at offset + (j % side) * length.
    """
    plan: dict[int, list] = {}
    sizes: list[int] = []                             # gap sizes in order
    runs: dict[int, list[tuple[int, int]]] = {}       # gap size -> [(first sequence, n)]
    opened = 0

    def give(size: int, first: int, n: int) -> None:
        if size and n:
            if size not in runs:
                runs[size] = []
                insort(sizes, size)
            runs[size].append((first, n))

    for length in sorted(counts, reverse=True):       # one superstep for each run of documents
        left, rank, out = counts[length], 0, plan.setdefault(length, [])
        while left:
            k = bisect_left(sizes, length)            # successor of the length among the gaps
            if k == len(sizes):
                break
            size = sizes[k]
            first, n = runs[size].pop()
            if not runs[size]:
                del runs[size], sizes[k]
            side = size // length                     # a gap of twice the length takes two, and so on
            used = min(n, -(-left // side))
            put = min(left, used * side)
            out.append((rank, put, first, side, window - size))
            whole, rest = divmod(put, side)
            give(size - side * length, first, whole)
            if rest:
                give(size - rest * length, first + whole, 1)
            give(size, first + used, n - used)
            left, rank = left - put, rank + put
        if left:                                      # unserved pieces open sequences of their own
            side = window // length
            whole, rest = divmod(left, side)
            out.append((rank, left, opened, side, 0))
            give(window - side * length, opened, whole)
            if rest:
                give(window - rest * length, opened + whole, 1)
            opened += whole + bool(rest)
    return plan


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` (stored) with ``rank``, their number within their length."""
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (pieces.join(base, ["length", "part"])
            .withColumn("rank", F.col("base") + F.col("rank_in_part")).drop("base", "part", "rank_in_part"))


def place(pieces: DataFrame, plan: dict[int, list]) -> DataFrame:
    """Look up (sequence_id, offset) of ranked pieces in the plan."""
    first = {length: np.array([s[0] for s in segs], np.int64) for length, segs in plan.items()}
    table = {length: np.array(segs, np.int64) for length, segs in plan.items()}
    schema = pieces.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            seq, off = np.empty(len(frame), np.int64), np.empty(len(frame), np.int64)
            order = np.argsort(length, kind="stable")
            ends = np.flatnonzero(np.r_[length[order][1:] != length[order][:-1], True]) + 1 if len(frame) else []
            at = 0
            for end in ends:
                rows = order[at:end]
                at, size = end, int(length[order[end - 1]])
                seg = table[size][np.searchsorted(first[size], rank[rows], side="right") - 1]
                j = rank[rows] - seg[:, 0]
                seq[rows] = seg[:, 2] + j // seg[:, 3]
                off[rows] = seg[:, 4] + (j % seg[:, 3]) * size
            yield frame.drop(columns="rank").assign(sequence_id=seq, offset=off)

    return pieces.mapInPandas(run, schema)


def pack(docs: DataFrame, vocab: str, window: int = WINDOW, end_id: int = 0, id_col: str = "doc_id",
         column: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id_col, piece, start, length, ids_crc32,
    sequence_id, offset (and ids). Sequences are filled from 0 without gaps."""
    pieces = stored(pieces_of(docs, vocab, window, end_id, id_col, column, with_ids), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    columns = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return place(ranked(pieces), sweep(counts, window)).select(columns)
