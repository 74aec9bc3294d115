"""The k-d partitioned nearest-record search is exact: compare with numpy
brute force, with several leaves, a hot duplicated value (a third of the
rows) and ties."""

import numpy as np
from pyspark.sql import functions as F

from cohortlens.operators import nearest as nn
from cohortlens.operators import privacy as pv


def _brute(R, Q):
    d = np.sqrt(((Q[:, None, :] - R[None, :, :]) ** 2).sum(axis=2))
    return d.min(axis=1)


def test_exact_against_brute_force_multi_leaf(spark):
    rng = np.random.default_rng(7)
    R = rng.normal(size=(3000, 3))
    R[:1000] = [0.5, -0.25, 1.0]                      # a third of the rows on one point
    R[1000:1200, 0] = 2.0                              # ties along one dimension
    Q = np.vstack([rng.normal(size=(800, 3)) * 1.5, R[1000:1010], [[0.5, -0.25, 1.0]]])
    real = spark.createDataFrame([tuple(map(float, r)) for r in R], "x double, y double, z double")
    synth = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(Q)],
                                  "i long, x double, y double, z double")
    got = {r["i"]: r["dcr"] for r in pv.nearest_distance(real, synth, ["x", "y", "z"], keep=["i"],
                                                         standardize=False, leaf_size=64, chunk=50).collect()}
    want = _brute(R, Q)
    assert len(got) == len(Q)
    assert max(abs(got[i] - want[i]) for i in range(len(Q))) < 1e-12
    assert got[len(Q) - 1] == 0.0


def test_vector_column_and_payload(spark):
    rng = np.random.default_rng(3)
    R = rng.normal(size=(300, 8))
    Q = rng.normal(size=(40, 8))
    real = spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in enumerate(R)], "rid long, v array<double>")
    synth = spark.createDataFrame([(int(i), [float(x) for x in q]) for i, q in enumerate(Q)], "qid long, v array<double>")
    out = pv.nearest_distance(real, synth, vector_col="v", keep=["qid"], leaf_size=32, payload="rid").collect()
    d = np.sqrt(((Q[:, None, :] - R[None, :, :]) ** 2).sum(axis=2))
    for r in out:
        assert abs(r["dcr"] - d[r["qid"]].min()) < 1e-12
        assert int(r["nn_payload"]) == int(d[r["qid"]].argmin())


def test_buckets_stay_small_beyond_the_driver_tree(spark):
    """A driver's tree of 4 cells only: the tasks' trees take over, to more
    than 4,096 buckets, and the answers stay those of a brute-force search."""
    rng = np.random.default_rng(11)
    R = np.vstack([rng.normal(size=(14000, 2)), np.tile([[0.25, 0.5]], (5000, 1)),
                   np.round(rng.normal(size=(4000, 2)), 1)])
    Q = np.vstack([rng.normal(size=(300, 2)) * 2, R[:20], [[0.25, 0.5]]])
    real = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(R)], "rid long, x double, y double")
    synth = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(Q)], "i long, x double, y double")
    index = nn.NearestIndex(real, ["x", "y"], standardize=False, leaf_size=2, max_cells=4, in_task=1, payload="rid")
    sizes = index.points.groupBy("bucket").count().agg({"count": "max", "bucket": "count"}).first()
    assert index.splits and sizes["count(bucket)"] > 4096 and sizes["max(count)"] <= 4
    got = {r["i"]: r for r in index.search(synth, ["i"], chunk=40).collect()}
    d = ((Q[:, None, :] - R[None, :, :]) ** 2).sum(axis=2)
    for i in range(len(Q)):
        assert abs(got[i]["dcr"] - np.sqrt(d[i].min())) < 1e-12
        ties = np.flatnonzero(d[i] == d[i].min())
        assert got[i]["nn_payload"] == min(map(str, ties.tolist()))


def test_task_tree_equals_brute_force():
    rng = np.random.default_rng(5)
    for dims in (1, 3, 20):
        R = np.round(rng.normal(size=(700, dims)), 1)
        Q = np.vstack([rng.normal(size=(90, dims)), R[:10]])
        d = ((Q[:, None, :] - R[None, :, :]) ** 2).sum(axis=2)
        for ties in (True, False):
            d2, arg = nn.nearest_in(Q, R, ties, 16)
            assert np.allclose(d2, d.min(axis=1), rtol=0, atol=1e-12)
            if ties:
                assert (d[np.arange(len(Q)), arg] == d.min(axis=1)).all()


def test_empty_tables_and_missing_features(spark):
    real = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "x double, y double")
    synth = spark.createDataFrame([(1, 1.0, 5.0), (2, None, 2.0), (3, float("nan"), 2.0)], "i long, x double, y double")
    got = {r["i"]: r["dcr"] for r in nn.nearest_distance(real, synth, ["x", "y"], ["i"], standardize=False).collect()}
    assert got == {1: 3.0, 2: None, 3: None}
    none = nn.nearest_distance(real.limit(0), synth, ["x", "y"], ["i"], standardize=False).collect()
    assert [r["dcr"] for r in none] == [None] * 3
    assert nn.nearest_distance(real, synth.limit(0), ["x", "y"], ["i"]).count() == 0


def test_a_query_vector_is_shipped_once_per_bucket(spark):
    """High dimensions prune nothing between leaves, but a vector still goes to one bucket."""
    rng = np.random.default_rng(9)
    real = spark.createDataFrame([([float(x) for x in r],) for r in rng.normal(size=(2000, 32))], "v array<double>")
    index = nn.NearestIndex(real, vector_col="v", leaf_size=4096)
    assert len(index.cell) == 1 and index.splits == 0


def test_boxes_are_looked_up_for_neighbouring_queries_together():
    """What a query costs follows the boxes near it, not their number: 4,096 boxes and tight
    bounds (a few loose ones among them) take few comparisons and find the boxes brute force finds."""
    rng = np.random.default_rng(13)
    at = np.stack(np.meshgrid(np.arange(64.0), np.arange(64.0), indexing="ij"), -1).reshape(-1, 2)
    lo, hi = at + 0.05, at + 0.95
    Q = np.repeat(at[rng.integers(0, len(at), 40)], 64, axis=0) + rng.random((2560, 2))
    home = (np.floor(Q[:, 0]) * 64 + np.floor(Q[:, 1])).astype(np.int64)
    limit = np.where(rng.random(len(Q)) < 0.01, 9.0, 0.02)
    limit[:5] = -1.0                                          # nothing nearer than a copy
    want, compared, got = nn.box_distances(Q, lo, hi), 0, set()
    for rows, boxes, far in nn.boxes_within(Q, limit, home, lo, hi):
        compared += far.size
        for i, j in zip(*np.nonzero(far < np.inf)):
            assert far[i, j] == want[rows[i], boxes[j]]
            got.add((int(rows[i]), int(boxes[j])))
    assert got == set(zip(*map(list, (x.tolist() for x in np.nonzero(want <= limit[:, None])))))
    assert compared < 100 * len(Q) < want.size / 40


def test_only_queries_with_cells_left_go_on(spark):
    """Rounds go on with the queries that have cells left; far queries, whose bound reaches many
    cells, and near ones both end at their nearest point."""
    rng = np.random.default_rng(17)
    R = rng.normal(size=(3000, 3))
    R /= np.linalg.norm(R, axis=1)[:, None]                    # a sphere: its centre is near all cells
    Q = np.vstack([R[:150] * 1.01, rng.normal(size=(20, 3)) * 1e-3])
    real = spark.createDataFrame([tuple(map(float, r)) for r in R], "x double, y double, z double")
    synth = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(Q)], "i long, x double, y double, z double")
    index = nn.NearestIndex(real, ["x", "y", "z"], standardize=False, leaf_size=100)
    start = synth.select("x", "y", "z").toDF(*index.z).withColumns({"bucket": F.lit(-1).cast("long"), "d2": F.lit(1.1)})
    listed = index._cells(start, 1, nn._FIRST)
    assert len(index.cell) > 4 * nn._FIRST and listed.where("more").count()
    got = {r["i"]: r["dcr"] for r in index.search(synth, ["i"]).collect()}
    want = _brute(R, Q)
    assert max(abs(got[i] - want[i]) for i in range(len(Q))) < 1e-12


def test_rows_without_another_cell_in_reach_are_done_at_home(spark, monkeypatch):
    """Cells far apart: every row is answered in the bucket it falls into, columns to keep and
    missing features included, and none goes on; copies come back one by one."""
    rng = np.random.default_rng(19)
    R = np.vstack([rng.random((400, 2)) + 1000.0 * k for k in range(8)])
    Q = np.vstack([R[::40] + 1e-3, np.tile([[0.5, 0.5]], (500, 1))])
    real = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(R)], "rid long, x double, y double")
    rows = [(2 ** 60 + i % 90, [i, None], *map(float, q)) for i, q in enumerate(Q)] + [(None, None, None, 1.0)]
    synth = spark.createDataFrame(rows, "p long, bucket array<int>, x double, y double")
    gone_on = []
    search = nn.NearestIndex._search
    monkeypatch.setattr(nn.NearestIndex, "_search", lambda self, q, chunk: gone_on.append(q.count()) or search(self, q, chunk))
    for payload in (None, "rid"):
        index = nn.NearestIndex(real, ["x", "y"], standardize=False, leaf_size=400, payload=payload)
        got = index.search(synth, ["p", "bucket"], chunk=50).collect()
        want = _brute(R, Q)
        assert len(index.cell) >= 8 and len(got) == len(rows)
        assert sum(r["dcr"] is None and r["p"] is None and r["nn_payload"] is None for r in got) == 1
        for r in got:
            if r["p"] is not None:
                i = r["bucket"][0]
                assert r["p"] == 2 ** 60 + i % 90 and r["bucket"] == [i, None] and abs(r["dcr"] - want[i]) < 1e-12
                if payload:
                    assert int(r["nn_payload"]) == int(((R - Q[i]) ** 2).sum(axis=1).argmin())
    assert sum(gone_on) < 40             # cells of one cluster, if the tree cut it


def test_copies_of_a_point_keep_the_smallest_payload(spark):
    """Copies of a point, spread over partitions, answer with the smallest payload (as text)."""
    real = spark.range(3000, numPartitions=7).selectExpr("id", "CAST(id % 3 AS double) AS x", "CAST(0 AS double) AS y")
    synth = spark.range(6).selectExpr("id AS i", "CAST(id % 3 AS double) AS x", "CAST(0.25 AS double) AS y")
    got = nn.nearest_distance(real, synth, ["x", "y"], ["i"], standardize=False, payload="id").collect()
    assert {r["i"]: (r["dcr"], r["nn_payload"]) for r in got} == {i: (0.25, min(map(str, range(i % 3, 3000, 3)))) for i in range(6)}


def test_only_vectors_are_sent_to_python_to_find_cells(spark):
    """Rows are placed by a column computed from their vectors: the columns to keep stay in the JVM.
    Missing features get no cell, and points, copies among them, the cell their tree deals them to."""
    rng = np.random.default_rng(23)
    R = np.vstack([rng.normal(size=(900, 2)), np.tile([[0.5, 0.25]], (60, 1))])
    Q = [*rng.normal(size=(200, 2)).tolist(), [1e6, -1e6], [None, 1.0], [float("nan"), 1.0]]
    real = spark.createDataFrame([tuple(map(float, r)) for r in R], "x double, y double")
    index = nn.NearestIndex(real, ["x", "y"], standardize=False, leaf_size=100)
    points = np.array([[*r] for r in index.points.select(*index.z, "bucket").collect()])
    assert len(index.cell) > 4 and len(points) == 901
    assert (nn.walk(points[:, :2], index.tree) == points[:, 2]).all()
    rows = spark.createDataFrame([(i, "kept " * 20, *q) for i, q in enumerate(Q)], "i long, text string, x double, y double")
    placed = index._placed(rows.select("i", "text", *index.vectors()))
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan and "MapInPandas" not in plan
    got = {r["i"]: r["bucket"] for r in placed.collect()}
    want = nn.home_cells(np.array(Q[:201]), index.tree, index.lo, index.hi, index.cell)
    assert [got[i] for i in range(len(Q))] == [*want.tolist(), -1, -1]
