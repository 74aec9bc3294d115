"""Vector codes (11), neighbour graph (12) and source audit (13) against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import neighbour_graph, queries, source_audit, vector_codes
from cohortlens.llm.tables import hot_join

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int"


# ---------------------------------------------------------------- op 11
def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Product codes by loops over Python integers."""
    rows = [(i, v, lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max((len(v) for _, v, _ in rows), default=0)
    w = -(-dims // parts)
    grid = [[math.floor(scale * x) for x in v] + [0] * (w * parts - len(v)) for _, v, _ in rows]
    first = {}
    for (i, v, _), g in zip(rows, grid):
        if i is not None and (i not in first or v < first[i][0]):
            first[i] = (v, g)
    start = [first[i][1] for i in sorted(first)[:entries]]
    books = [[g[p * w:(p + 1) * w] for g in start] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            member = defaultdict(list)
            for g in grid:
                member[near(g[p * w:(p + 1) * w], books[p])[1]].append(g[p * w:(p + 1) * w])
            books[p] = [[sum(c) // len(member[k]) for c in zip(*member[k])] if k in member else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], Counter()
    for (i, _, lab), g in zip(rows, grid):
        hits = [near(g[p * w:(p + 1) * w], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in hits), sum(d for d, _ in hits), lab))
        by_label[lab] += out[-1][2]
    return sorted(((i, c, e, by_label[lab], digest) for i, c, e, lab in out), key=repr)


def got_codes(df, **kw):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.compress(df, **kw).collect()), key=repr)


def test_codes_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 40)
    monkeypatch.setattr(vector_codes, "SLAB", 7)
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=16).round(2).tolist(), int(i) % 4 if i % 7 else None) for i in range(150)]
    rows += [(i + 1000, rows[0][1], 2) for i in range(90)]                           # a common vector under a common label
    rows += [(7, [0.1] * 16, 1), (None, [0.2] * 16, 1), (-3, [-0.5] * 11, 0), (2000, [], 0)]  # repeated id, no id, short, empty
    rows += [(3000, None, 1), (3001, [None] * 16, 1), (3002, [math.inf] * 16, 1), (3003, [math.nan] * 16, 1)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("clash")).withColumn("part", F.lit(1))
    assert got_codes(df) == plain_codes(rows)
    assert got_codes(df, parts=3, entries=5, rounds=2, scale=10.0) == plain_codes(rows, 3, 5, 2, 10)


def test_codes_edges(spark):
    assert vector_codes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    few = [(1, [1e300, -1e300], 0), (2, [1e5, 1.0], 0), (3, [0.0, 0.0], None)]
    got = vector_codes.compress(spark.createDataFrame(few, VECTORS)).collect()
    assert len(got) == 3 and {r.error for r in got} == {0}          # every row has entries of its own
    assert got_codes(spark.createDataFrame([(1, [], 0)], VECTORS))[0][1] == "00" * 8
    big = [(i, [3e4 + 7 * i, -3e4 - 11 * i * i], i % 2) for i in range(40)]      # large components: whole numbers still exact
    assert got_codes(spark.createDataFrame(big, VECTORS)) == plain_codes(big)
    huge = [(i, [1e6 * i, -1e7 * i], 0) for i in range(40)]                       # errors beyond 64 bits are clipped
    assert [r[2] for r in got_codes(spark.createDataFrame(huge, VECTORS))] == [min(r[2], 2 ** 63 - 1) for r in plain_codes(huge)]


def test_part_trie_shares_prefixes():
    parts = np.unique(np.random.default_rng(0).integers(-3, 3, (200, 4)), axis=0)
    trie = vector_codes.PartTrie(parts)
    assert [len(v) for v in trie.values][0] == 6 and len(trie.values[-1]) == len(parts)
    book = np.array([[0, 0, 0, 0], [2, -1, 1, 0], [2, -1, 1, 0]])
    entry, error = trie.nearest(book)
    far = ((parts[:, None] - book[None]) ** 2).sum(2)
    assert (entry == far.argmin(1)).all() and (error == far.min(1)).all()


# ---------------------------------------------------------------- op 12
def brute(rows, k=20):
    use = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            use[i] = min(use.get(i, v), v)
    dims = max(map(len, use.values()))
    ids = np.array(sorted(use))
    x = np.array([use[i] + [0.0] * (dims - len(use[i])) for i in ids])
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        o = [j for j in np.lexsort((ids, -s.round(12))) if j != q][:k]
        out[int(ids[q])] = [(int(ids[j]), float(s[j])) for j in o]
    return out


def search(df, **kw):
    out = defaultdict(list)
    for r in neighbour_graph.nearest(df, F.col("id") % 20 == 0, 20, **kw).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_graph_search_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), (rng.normal(size=8) * (1 + i % 5)).tolist()) for i in range(300)]
    rows += [(i, rows[40][1]) for i in range(1000, 1200)]                             # copies, queries among them
    rows += [(5, [0.5] * 8), (301, [1.0, 2.0]), (None, [1.0] * 8), (320, None), (340, [0.0] * 8),
             (360, [math.nan] * 8), (380, [None] * 8)]
    want, got = brute(rows), search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")
                                    .withColumn("u", F.lit(0)).withColumn("block", F.lit("x")))
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])


def test_graph_recall_with_many_leaves_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbour_graph, "LEAF", 64)
    monkeypatch.setattr(neighbour_graph, "BLOCK", 128)
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=24).tolist()) for i in range(1500)]
    want, got = brute(rows), search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9


def test_graph_edges(spark):
    kind = "vec_id long, embedding array<float>"
    assert neighbour_graph.nearest(spark.createDataFrame([], kind), F.col("id") % 20 == 0, 20).count() == 0
    assert search(spark.createDataFrame([(20, [1.0])], kind)) == {}                   # a query without candidates
    assert search(spark.createDataFrame([(20, [1.0]), (21, [1.0]), (40, [-1.0])], kind)) == {
        20: [(21, 1.0), (40, -1.0)], 40: [(20, -1.0), (21, -1.0)]}


def test_local_join_finds_improving_pairs():
    x = np.eye(3)[[0, 0, 1, 1]] + 0.1
    u, v, s = neighbour_graph.local_joins(np.zeros(4, np.int64), np.arange(4), np.array([True, False, False, False]),
                                          np.array([-np.inf, -np.inf, 5.0, 0.2]), x, 2)
    want = {(a, b) for a, b in ((0, 1), (0, 2), (0, 3), (1, 0), (3, 0)) if x[a] @ x[b] > (-9, -9, 5.0, 0.2)[a]}
    found = set(zip(u.tolist(), v.tolist()))
    assert found <= want and (0, 1) in found and (3, 0) in found and len([1 for a, _ in found if a == 0]) == 2


def test_hot_join(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    small = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    got = hot_join(big, small, "k")
    assert got.count() == 3000 and got.where("x <> 2 * k").count() == 0
    assert hot_join(big.limit(0), small, "k").count() == 0


# ---------------------------------------------------------------- op 13
def plain_audit(rows, min_docs=10, top=10):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups, docs, count = set(), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = term.findall((text or "").translate(lower))
        docs[lang].update(set(words))
        count[lang, source].update(words)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = {t for t, n in docs[lang].items() if n >= min_docs}
        sources = sorted(s for g, s in groups if g == lang)
        whole = Counter()
        for s in sources:
            whole.update({t: n for t, n in count[lang, s].items() if t in kept})

        def p_of(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: p_of(count[lang, s]) for s in sources}, p_of(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            lists = {"pair": [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s],
                     "term": [(f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]}
            for part, items in lists.items():
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode())), 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
    return out


def audited(df, **kw):
    rows = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in source_audit.audit(df, **kw).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("groups", [20_000, 0])          # probabilities by broadcast, and by salted join
def test_audit_matches_brute_force(spark, monkeypatch, groups):
    monkeypatch.setattr(source_audit, "BROADCAST_GROUPS", groups)
    monkeypatch.setattr(source_audit, "TREE_ROWS", 5)
    rng = np.random.default_rng(5)
    words = ["Haus", "maison", "naïve", "日本", "été", "THE", "the", "x", "y", "zz", "éa", "Éa"]
    rows = [(" ".join(rng.choice(words, rng.integers(0, 30))), str(rng.choice(["de", "fr"])), f"s{int(rng.integers(0, 6)) if rng.random() > .4 else 0}")
            for _ in range(150)]
    rows += [(rows[0][0], "de", "s0")] * 40 + [(None, "de", "lone"), ("", None, None), ("a1b2", "en", "s1"), ("1 2 3", "en", "s2")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit(1)).withColumn("n", F.lit(2))
    assert audited(df) == plain_audit(rows)
    assert audited(df, min_docs=1, top=3) == plain_audit(rows, 1, 3)


def test_audit_edges(spark):
    kind = "text string, lang string, source string"
    assert audited(spark.createDataFrame([], kind)) == set()
    assert audited(spark.createDataFrame([("a", "en", "x"), (None, "en", "y")], kind)) == {
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)}
    long = [("w " * 200_000 + "v", "en", "x")] * 10 + [("w", "en", "y")]
    assert audited(spark.createDataFrame(long, kind)) == plain_audit(long)


def test_new_queries_are_registered():
    assert {"op11_trie_vector_codes", "op12_nn_descent", "op13_source_divergence"} <= queries.queries().keys()
    assert {"op11_trie_vector_codes", "op13_source_divergence"} <= queries.oracle_sql().keys()
