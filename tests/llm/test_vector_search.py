import numpy as np
import pyspark.sql.functions as F
import pytest

from nestframe.llm.vector_search import Tree, chi_square, chi_square_quantile, nearest_vectors
from tests.llm import plain


@pytest.mark.parametrize("cell_size", [8192, 100])
def test_recall(spark, cell_size):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    expected = plain.nearest([(r.vec_id, r.embedding) for r in frame.collect()], lambda i: i % 50 == 0)
    found = {}
    for r in nearest_vectors(frame, F.col("vec_id") % 50 == 0, cell_size=cell_size).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(found) == set(expected)
    hits = 0
    for query, best in expected.items():
        assert sorted(found[query]) == [1, 2, 3, 4, 5]
        hits += len({i for i, _ in best} & {i for i, _ in found[query].values()})
        scores = [found[query][rank][1] for rank in range(1, 6)]
        assert scores == sorted(scores, reverse=True)
        assert all(abs(s - dict(best)[i]) < 1e-12 for i, s in found[query].values() if i in dict(best))
    assert hits >= 0.97 * 5 * len(expected)


def test_odd_vectors_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [2.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]),
        (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [-1.0, 0.0]), (0, [1.0, 0.0]), (8, [inf, 1.0]), (9, [1.0, 2.0, 3.0]), (10, []),
    ]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, key int")
    found = [(r.query_id, r["rank"], r.vec_id) for r in nearest_vectors(frame, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(found) == [(0, 1, 50), (0, 2, 1), (0, 3, 2), (0, 4, 7), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 7)]
    assert nearest_vectors(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_a_third_of_all_vectors_equal(spark):
    dice = np.random.default_rng(2)
    rows = [(i, (np.ones(6) if i % 3 == 0 else dice.normal(size=6)).tolist()) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = plain.nearest(rows, lambda i: i % 50 == 0)
    found = {}
    for r in nearest_vectors(frame, F.col("vec_id") % 50 == 0, cell_size=64).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    alike = [q for q in expected if q % 3 == 0]
    assert all(found[q] == [i for i, _ in expected[q]] for q in alike)


def test_tree_gives_leaves_from_near_to_far():
    points = np.random.default_rng(1).normal(size=(500, 8))
    tree, at = Tree(points, leaf=7), np.zeros(8)
    seen, last = [], 0.0
    order, leaf_at = tree.packed()
    for near, leaf in tree.leaves(at):
        rows = order[slice(*leaf_at[leaf])]
        assert near >= last and all((points[rows] ** 2).sum(axis=1) >= near - 1e-9)
        seen += rows.tolist()
        last = near
    assert sorted(seen) == list(range(500))
    inside = set(np.flatnonzero((points**2).sum(axis=1) <= 4).tolist())
    leaf_of = tree.cell_of(points)
    assert {int(leaf_of[i]) for i in inside} <= set(tree.within(at, 4.0))


def test_chi_square():
    assert abs(chi_square(15.507, 8) - 0.95) < 1e-4
    assert abs(chi_square_quantile(0.95, 8) - 15.507) < 1e-3
