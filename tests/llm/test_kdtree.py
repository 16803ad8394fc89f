"""KD-tree search against brute force."""

import random

import numpy as np
import pytest

from riskloom.llm import kdtree
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, v int, shard int, block string").select("vec_id", "embedding", "label", "v", "shard", "block")


def brute(vectors, asking, k):
    out = []
    for q in asking:
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, every=3, k=5):
    vectors = kdtree.whole_vectors(embeddings(spark, [(i, v, 0, 1, 2, "x") for i, v in rows]))
    return sorted(tuple(r) for r in kdtree.top_k(vectors, vectors.where(f"vec_id % {every} = 0"), k).collect())


def test_ties_odd_values_and_copies(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 0.251]) for _ in range(4)]) for i in range(200)]
    odd = [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0]), (203, [float("nan")] * 4), (204, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    want = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows} | {201: []}
    got = run(spark, rows + odd + rows[:50])
    assert got == brute(want, [i for i in want if i % 3 == 0], 5)


def test_large_numbers(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 10.0**6 for _ in range(3)]) for i in range(40)]
    want = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    assert run(spark, rows) == brute(want, [i for i in want if i % 3 == 0], 5)


def test_few_rows(spark):
    assert run(spark, [(0, [1.0, 2.0]), (1, [0.5, 0.5])]) == [(0, 1, 1, 256 * 128 + 512 * 128)]
    assert run(spark, [(0, [1.0])]) == [] == run(spark, [(None, None)])


@pytest.mark.parametrize("spread", [0.01, 1.0])
def test_tree_prunes_and_stays_exact(spread):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 6)) * 100
    vectors = np.floor(centres[rng.integers(0, 20, 2000)] + rng.normal(size=(2000, 6)) * 100 * spread)
    tree = kdtree.Tree(np.arange(2000), vectors)
    for q in range(0, 2000, 97):
        exact = sorted(((int(s), -i) for i, s in enumerate(vectors @ vectors[q]) if i != q), reverse=True)[:5]
        for reach in (-np.inf, float(exact[-1][0])):
            got = list(tree.search(vectors[q : q + 1], np.array([q]), np.array([reach]), 5))
            assert sorted(((s, -i) for _, i, s in got), reverse=True) == exact


def test_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF), kdtree.query, kdtree.SQL, SF)[0] is None
