"""Very large and very small finite components in the exact vector operators."""

import numpy as np
from pyspark.sql import functions as F

from cohortlens.llm import cover_tree, topk_search

KIND = "vec_id long, embedding array<double>"


def test_top_k_beyond_the_doubles(spark):
    rows = [(20, [1e308, 1.0]), (1, [1e308, -1e308]), (2, [-1e308, 0.0]), (3, [0.0, 0.5]), (4, [1e-300, 0.25])]
    got = [(r.vec_id, r.score) for r in topk_search.top_k(spark.createDataFrame(rows, KIND), F.col("id") % 20 == 0, 20).orderBy("rank").collect()]
    assert got == [(1, 2 ** 63 - 1), (3, 64 * 32), (4, 64 * 16), (2, -2 ** 63)]
    x = np.array([[1e308, 0.3], [-1e308, -0.3]])
    assert topk_search.on_grid(x, 64.0).tolist() == [[64 * int(1e308), 19], [-64 * int(1e308), -20]]
    assert topk_search.on_grid(np.array([[0.3, -0.3]]), 64.0).dtype == float


def test_cosine_links_do_not_depend_on_length(spark):
    rows = [(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 1e-200]), (4, [5e-324, 5e-324]), (5, [1e200, -1e200]), (6, [0.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.near_duplicates(spark.createDataFrame(rows, KIND), 0.95).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (0, 6)}
