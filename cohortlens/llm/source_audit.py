"""Source divergence audit: how far the sources of a language differ, in all
and by term.

Terms are the maximal runs of letters and non-ASCII characters, A-Z
lower-cased. A language keeps the terms in at least ``min_docs`` of its
documents. A group (language, source) gives each kept term the scaled
probability p = 1 + floor(10^9 (count + 2) / (N + 2V)); two groups differ by the
sum over the kept terms of floor((p - q)^2 / (p + q)).

Method. Only terms that both sources hold need the joint counts. With p0 the
probability of a term a source lacks and f the floored term above,

    sum f(p, q) = V f(p0, q0) + sum over a's terms of f(p, q0) - f(p0, q0)
                + sum over b's terms of f(p0, q) - f(p0, q0)
                + sum over shared terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0).

The single sums need a source's distinct values of p with multiplicities. The
last, the pair correction, comes from a frequent-pattern tree: a term row is
the list of its sources with nonzero count, the most frequent source of the
language first, each with its p; equal rows are one row with a multiplicity.
Rows are range-partitioned in that order, so a partition holds neighbouring
branches of the tree, and sorted rows are inserted a block at a time: a node
starts at the first row with its prefix and carries the multiplicities of all
rows below. A correction is computed once for each node and ancestor, times the
node's multiplicity.

Plan: one pass over the texts gives counts per (language, source, term),
combined in the task and again before the shuffle, and names every group that
occurs; everything after works on that table. Probabilities are joined by
broadcast while the number of groups is at most ``BROADCAST_GROUPS`` and by a
salted join beyond, with the same result. All arithmetic is in integers.

Defined results: NULL text, language and source are read as empty strings;
repeated rows are documents of their own; a group or language without kept
terms has V = 0 or N = 0 and pair values follow the formula (0 if V = 0), its
term part is empty; ties are ordered by item; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.tables import stored
from cohortlens.llm.words import _LOWER, buffer_of, pieces, spans_of, text_slices

BROADCAST_GROUPS = 20_000
SALTS = 32
TREE_ROWS = 1 << 15      # rows of the pattern tree held at once
SCALE = 1_000_000_000

_GAP = np.ones(256, bool)
_GAP[65:91] = _GAP[97:123] = _GAP[128:] = False


def term_counts(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """(lang, source, term, n, docs) of one slice of (lang, source, text); a
    row without a term for every group."""
    data, offs = buffer_of(batch.column(2))
    data = _LOWER[data]
    starts, ends, first = spans_of(data, offs, _GAP)
    groups = pa.table({"l": batch.column(0), "s": batch.column(1)})
    named = groups.group_by(["l", "s"]).aggregate([])
    key = {g: i for i, g in enumerate(zip(named["l"].to_pylist(), named["s"].to_pylist()))}
    group = np.array([key[g] for g in zip(groups["l"].to_pylist(), groups["s"].to_pylist())], np.int64)
    at, term, n, docs = np.arange(len(key)), np.full(len(key), -1), np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    words = pa.array([], pa.string())
    if len(starts):
        kept = data[~_GAP[data]]
        coded = pieces(kept, np.concatenate(([0], np.cumsum(ends - starts)))).dictionary_encode()
        words = coded.dictionary.cast(pa.large_string()).cast(pa.string())
        code = np.asarray(coded.indices).astype(np.int64)
        size = len(words)
        doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
        pair, times = np.unique(doc * size + code, return_counts=True)
        cell, back = np.unique(group[pair // size] * size + pair % size, return_inverse=True)
        at, term = np.concatenate([at, cell // size]), np.concatenate([term, cell % size])
        n = np.concatenate([n, np.bincount(back, times).astype(np.int64)])
        docs = np.concatenate([docs, np.bincount(back).astype(np.int64)])
    named = named.combine_chunks()
    return pa.RecordBatch.from_arrays(
        [named["l"].combine_chunks().take(pa.array(at)), named["s"].combine_chunks().take(pa.array(at)),
         words.take(pa.array(term, mask=term < 0)), pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"])


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of positive integers up to 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), beyond 64 bits inside."""
    wide = "decimal(38,0)"
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.when(terms > 0, F.lit(1) + F.call_function("div", above.cast(wide), (total + 2 * terms).cast(wide)))


def _f(p, q):
    gap = p - q
    return gap * gap // (p + q)


def pair_corrections(rows: pd.DataFrame) -> dict[tuple[int, int], int]:
    """{(source, source): correction} of the pattern tree of sorted term rows
    of one language: columns at, p, p0 (lists, source-ordered) and n."""
    n = rows["n"].to_numpy(np.int64)
    lengths = rows["at"].map(len).to_numpy()
    depth = int(lengths.max(initial=0))
    at, p, p0 = (np.full((len(rows), depth), fill, np.int64) for fill in (-1, 1, 1))
    inside = np.arange(depth)[None, :] < lengths[:, None]
    for matrix, name in ((at, "at"), (p, "p"), (p0, "p0")):
        matrix[inside] = np.concatenate(rows[name].tolist()) if depth else []
    total = np.concatenate(([0], np.cumsum(n)))
    wide = int(total[-1]) * 4 * SCALE >= 2 ** 62
    out: dict[tuple[int, int], int] = {}
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for d in range(depth):
        new[1:] |= (at[1:, d] != at[:-1, d]) | (p[1:, d] != p[:-1, d])
        bounds = np.flatnonzero(new)
        below = total[np.append(bounds[1:], len(rows))] - total[bounds]          # multiplicity of each node
        is_node = at[bounds, d] >= 0
        node, below = bounds[is_node], below[is_node]
        # rows that end above this depth stand between nodes, never inside one
        a, pa_, pa0 = at[node, d], p[node, d], p0[node, d]
        for e in range(d):
            b, pb, pb0 = at[node, e], p[node, e], p0[node, e]
            value = _f(pa_, pb) - _f(pa_, pb0) - _f(pa0, pb) + _f(pa0, pb0)
            value = value.astype(object) * below if wide else value * below
            code = a * (1 << 31) + b
            order = np.argsort(code, kind="stable")
            keys, first = np.unique(code[order], return_index=True)
            for key, s in zip(keys.tolist(), np.add.reduceat(value[order], first).tolist() if len(first) else []):
                pair = (key >> 31, key & ((1 << 31) - 1))
                out[pair] = out.get(pair, 0) + int(s)
    return out


def _with_totals(rows: DataFrame, totals: DataFrame, few: bool) -> DataFrame:
    """``rows`` (lang, source, term, …) joined with their group's totals. A
    group may hold a third of the rows: it is broadcast or spread by salt."""
    if few:
        return rows.join(F.broadcast(totals), ["lang", "source"])
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
            .join(salted, ["lang", "source", "salt"]).drop("salt"))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    spark = docs.sparkSession
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                yield term_counts(part)

    counted = stored(named.mapInArrow(count, "lang string, source string, term string, n long, docs long")
                     .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    groups = counted.where("term IS NULL").select("lang", "source")
    whole = Window.partitionBy("lang", "term")       # one row per source
    kept = stored(counted.where("term IS NOT NULL")
                  .select("lang", "source", "term", "n", F.sum("n").over(whole).alias("n_lang"), F.sum("docs").over(whole).alias("d"))
                  .where(F.col("d") >= min_docs).drop("d"), "kept-terms")
    per_lang = (kept.groupBy("lang", "term").agg(F.first("n_lang").alias("n_lang"))
                .groupBy("lang").agg(F.sum("n_lang").alias("lang_total"), F.count("*").alias("terms")))
    per_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    totals = (groups.join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left").na.fill(0))
    order = Window.partitionBy("lang").orderBy(F.desc("held"), "source")       # rows: the sources of a language
    totals = stored(totals.withColumn("at", F.row_number().over(order) - 1)
                    .withColumn("p0", probability(F.lit(0), F.col("total"), F.col("terms"))), "groups")
    few = totals.count() <= BROADCAST_GROUPS
    rows = _with_totals(kept, totals, few).select(
        "lang", "source", "term", "at", "p0", probability(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        probability(F.col("n_lang"), F.col("lang_total"), F.col("terms")).alias("q"))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    by_term = (rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                          divergence(F.col("p"), F.col("q")).alias("value"))
               .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))

    # the pattern tree: equal rows are one, neighbours in order lie in one partition
    entry = F.struct("at", "p", "p0")
    pattern = (rows.groupBy("lang", "term").agg(F.sort_array(F.collect_list(entry)).alias("row"))
               .where(F.size("row") > 1).groupBy("lang", "row").agg(F.count("*").alias("n")))
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, TREE_ROWS):
                part = batch.slice(a, TREE_ROWS)
                entries = part.column(1)
                lists = {n: pa.ListArray.from_arrays(pc.subtract(entries.offsets, entries.offsets[0]), pc.struct_field(entries.flatten(), n))
                         for n in ("at", "p", "p0")}
                frame = pd.DataFrame({"lang": part.column(0).to_pylist(), "n": part.column(2).to_numpy(),
                                      **{n: list(v.to_numpy(zero_copy_only=False)) for n, v in lists.items()}})
                for of, some in frame.groupby("lang", sort=False):
                    found = pair_corrections(some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([of] * len(found), pa.string()), pa.array([k[0] for k in found], pa.int32()),
                         pa.array([k[1] for k in found], pa.int32()), pa.array([str(v) for v in found.values()], pa.string())],
                        ["lang", "a", "b", "value"])

    number = "decimal(38,0)"
    shared = (pattern.repartitionByRange(width, "lang", "row").sortWithinPartitions("lang", "row")
              .mapInArrow(corrections, "lang string, a int, b int, value string")
              .groupBy("lang", "a", "b").agg(F.sum(F.col("value").cast(number)).alias("value")))
    shared = shared.unionByName(shared.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))

    # every ordered pair of sources is a row of the result
    one = totals.select("lang", "source", "at", "p0", "terms")
    two = totals.select("lang", F.col("source").alias("item"), F.col("at").alias("b"), F.col("p0").alias("q0"))
    pairs = one.join(two, "lang").where("at <> b")
    level = F.coalesce(divergence(F.col("p0"), F.col("q0")), F.lit(0))
    base = pairs.select("lang", F.col("at").alias("a"), "b", (F.col("terms").cast(number) * level).alias("value"))
    values = rows.groupBy("lang", "at", "p").agg(F.count("*").alias("n"))
    alone = (pairs.join(values, ["lang", "at"])
             .select("lang", F.col("at").alias("a"), "b", ((divergence(F.col("p"), F.col("q0")) - level).cast(number) * F.col("n")).alias("value"))
             .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    alone = alone.unionByName(alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    every = [d.select("lang", "a", "b", F.col("value").cast(number).alias("value")) for d in (base, alone, shared)]
    summed = (every[0].unionByName(every[1]).unionByName(every[2]).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    by_pair = (pairs.select("lang", "source", "item", F.col("at").alias("a"), "b").join(summed, ["lang", "a", "b"])
               .select("lang", "source", F.lit("pair").alias("part"), "item", F.col("value").cast("long").alias("value"))
               .withColumn("rank", F.row_number().over(best)))
    return by_pair.unionByName(by_term)
