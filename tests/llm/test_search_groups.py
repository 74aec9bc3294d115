"""Blocks of vectors meet in groups of bounded size, never as rows of a join."""

import numpy as np
from pyspark.sql import functions as F

from cohortlens.llm import cover_tree, topk_search

KIND = "vec_id long, embedding array<float>"


def test_top_k_pairs_no_blocks_as_rows(spark, monkeypatch):
    for name, value in (("CANDIDATE_BLOCK", 20), ("QUERY_BLOCK", 4), ("CANDIDATE_GROUP", 2), ("QUERY_GROUP", 2)):
        monkeypatch.setattr(topk_search, name, value)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)).astype(np.float32)
    x[::3] = x[0]                                                # a third of the rows share a vector: ties go to smaller ids
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    found = topk_search.top_k(spark.createDataFrame(rows, KIND), F.col("id") % 20 == 0, 5)
    plan = found._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInPandas" not in plan     # was: a row with both bodies for each pair of blocks
    g = np.floor(64 * x.astype(float)).astype(int)
    want = set()
    for q in range(0, 400, 20):
        s = g @ g[q]
        best = sorted((-int(s[c]), c) for c in range(400) if c != q)[:5]
        want |= {(q, k + 1, c, -v) for k, (v, c) in enumerate(best)}
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)


def test_groups_are_bounded():
    for n_cand, n_query in ((1, 1), (13, 41), (10 ** 6, 10 ** 7)):
        c, q = topk_search.group_sizes(n_cand, n_query)
        assert 1 <= c <= topk_search.CANDIDATE_GROUP and 1 <= q <= topk_search.QUERY_GROUP
    for kind, values in ((np.int8, [-128.0, 127.0]), (np.int16, [200.0]), (np.int32, [-40000.0]), (np.float64, [2.0 ** 40])):
        packed = topk_search.packed(np.array([values]))
        assert packed.dtype == kind and packed.astype(float).tolist() == [values]


def test_trees_are_not_shuffled_for_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "CHUNK", 40)
    monkeypatch.setattr(cover_tree, "HELD", 5_000)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[200:] = x[:100] + rng.normal(size=(100, 8)).astype(np.float32) * 0.05
    x[::5] = x[0]
    x[5] = x[0] * 0.0
    x[10, 0] = -0.0
    x[15] = x[10]
    x[15, 0] = 0.0                                                    # equal, though written otherwise
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None)]
    seen = []
    monkeypatch.setattr(cover_tree, "rounds", lambda sizes, f=cover_tree.rounds: seen.append((sizes, f(sizes))) or seen[-1][1])
    found = cover_tree.near_duplicates(spark.createDataFrame(rows, KIND), 0.95)
    got = {r.vec_id: (r.n_links, r.component_id) for r in found.collect()}
    sizes, parts = seen[0]                                            # was: a row with both trees for each pair of trees
    assert len(parts) > 1 and parts[0][0] == sizes[0][0] and parts[-1][1] == sizes[-1][0]
    assert all(sum(n for t, n in sizes if a <= t <= b) <= 5_000 or a == b for a, b in parts)
    on = [i for i in range(300) if x[i].any()]
    u = cover_tree.unit(x[on].astype(float))
    near = {i: {j for j, c in zip(on, r) if c >= 0.95 and j != i} for i, r in zip(on, u @ u.T)}
    label = {i: i for i in on}
    for _ in on:
        label = {i: min([label[i], *(label[j] for j in near[i])]) for i in on}
    assert got == {i: (len(near[i]), label[i]) for i in on} | {5: (0, 5), 900: (0, 900)}


def test_tree_travels_whole():
    x = np.random.default_rng(1).normal(size=(500, 3))
    tree = cover_tree.CoverTree(cover_tree.unit(x))
    rep, n, y, back = cover_tree.unpacked(cover_tree.packed(np.arange(500), np.ones(500, int), x, tree))
    assert back.children == tree.children and back.span == [list(s) for s in tree.span] and (back.order == tree.order).all()
    assert np.abs(back.centres - tree.centres).max() < 1e-6 and y.dtype == float
    assert (cover_tree.linked(x, y, tree, back, 0.9) == cover_tree.linked(x, x, tree, tree, 0.9)).all()
