"""NN-descent: recall against brute force, and odd rows."""

import random

import numpy as np

from riskloom.llm import nndescent

SCHEMA = "vec_id long, embedding array<float>, label int, node long, ids string"


def brute(vectors, asking, k):
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in asking:
        d = np.sqrt(((matrix - np.array(vectors[q], float)) ** 2).sum(axis=1))
        order = np.lexsort((ids, d))
        out[q] = [(int(ids[i]), d[i]) for i in order if ids[i] != q][:k]
    return out


def recall(rows, want):
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {q for q, near in want.items() if near}
    for q, near in got.items():
        assert [r for r in near] == sorted(near, key=lambda x: (x[1], x[0])) and q not in dict(near)
    return sum(len({i for i, _ in got[q]} & {i for i, _ in near}) for q, near in want.items() if near) / sum(map(len, want.values())), got


def test_recall_on_given_embeddings(spark):
    sf = "/root/testdata/sf0.1"
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    want = brute(vectors, [i for i in vectors if i % 100 == 0], 10)
    share, got = recall(nndescent.query(spark, sf).collect(), want)
    assert share >= 0.95
    for q, near in got.items():
        for i, score in near:
            assert np.isclose(score, np.linalg.norm(np.array(vectors[q], float) - np.array(vectors[i], float)), rtol=1e-12)


def test_copies_ties_and_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 1.0]) for _ in range(5)] + [1.0]) for i in range(120)] + [(200 + i, [3.0] * 6) for i in range(40)]
    odd = [(500, None), (501, [0.0] * 6), (502, [1.0, None, 0.0, 0.0, 0.0, 1.0]), (503, [float("nan")] * 6), (None, [1.0] * 6)]
    docs = spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows + odd + rows[:20]], SCHEMA)
    vectors = dict(rows)
    want = brute(vectors, [i for i in vectors if i % 10 == 0], 10)
    share, got = recall(nndescent.nearest_neighbours(docs, every=10).collect(), want)
    assert share == 1 and all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want)


def test_few_rows(spark):
    def run(rows):
        return [tuple(r) for r in nndescent.nearest_neighbours(spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA)).collect()]

    assert run([(0, [1.0, 0.0]), (1, [1.0, 2.0])]) == [(0, 1, 1, 2.0)]
    assert run([(0, [1.0])]) == [] and run([(7, None)]) == []


def test_near_copies_and_an_outlier(spark):
    """Thousands of near copies of one vector, among others and one with a huge component."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal(32)
    rows = np.concatenate([rng.standard_normal((500, 32)), base + 3e-5 * rng.standard_normal((2_500, 32)), [[1e30] + [0.0] * 31]])
    vectors = {i: [float(np.float32(x)) for x in v] for i, v in enumerate(rows)}
    docs = spark.createDataFrame([(i, v, 0, 1, "x") for i, v in vectors.items()], SCHEMA)
    want = brute(vectors, [i for i in vectors if i % 50 == 0], 10)
    assert recall(nndescent.nearest_neighbours(docs, every=50).collect(), want)[0] >= 0.95
