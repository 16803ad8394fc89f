"""Hard negatives against brute force."""

import random

import numpy as np
import pytest

from riskloom.llm import rtree
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, ask long, shard int, slab string, need double, w int, rank int"


def run(spark, rows, **options):
    table = spark.createDataFrame([(i, v, label, 1, 2, "x", 0.5, 3, 4) for i, v, label in rows], SCHEMA)
    return sorted(tuple(r) for r in rtree.hard_negatives(rtree.whole_rows(table), **options).collect())


def brute(vectors, every, low=30, high=90):
    """``vectors``: vec_id -> (label, whole numbers)."""
    out = []
    score = lambda a, b: max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b))))
    for q, (label, v) in vectors.items():
        if q % every:
            continue
        scored = sorted((-score(v, w), i) for i, (_, w) in vectors.items() if i != q)
        for s, p in [(s, i) for s, i in scored if vectors[i][0] == label][:5]:
            inside = [(t, i) for t, i in scored if vectors[i][0] != label and low * -s <= 100 * -t <= high * -s]
            out += [(q, p, rank + 1, i, -s, -t) for rank, (t, i) in enumerate(inside[:10])]
    return sorted(out)


def whole(rows):
    return {i: (label, [int(np.floor(256 * x)) for x in v]) for i, v, label in rows}


def test_ties_odd_rows_and_copies(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 0.251, 1.0]) for _ in range(4)], rng.choice([0, 0, 1, 2])) for i in range(200)]
    odd = [(300, None, 1), (303, [1.0, None, 1.0, 1.0], 1), (306, [float("nan")] * 4, 1), (309, [float("inf"), 0.0, 0.0, 0.0], 1), (None, [1.0] * 4, 1), (312, [1.0] * 4, None)]
    short = [(315, [], 0), (318, [1.0, 1.0], 1)]
    assert run(spark, rows + odd + short + rows[:50], every=3) == brute(whole(rows + short), 3)


def test_small_shards_and_a_hot_label(spark, monkeypatch):
    monkeypatch.setattr(rtree, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 5))
    rows = [(i, (centres[i % 8] + rng.normal(size=5) * 0.3).round(3).tolist(), 0 if i % 2 else int(rng.integers(1, 5))) for i in range(400)]
    rows += [(400 + i, [1.0, 0.0, 0.0, 0.0, 0.0], 0) for i in range(200)]
    monkeypatch.setattr(rtree.packed, "__defaults__", (40,))
    shards = rtree.packed(rtree.whole_rows(spark.createDataFrame([(i, v, label) for i, v, label in rows], "vec_id long, embedding array<double>, label int")))
    held = shards.groupBy("shard").count().collect()
    assert len(held) > 10 and sum(r["count"] for r in held) == 600 and max(r["count"] for r in held) < 120
    assert run(spark, rows, every=10) == brute(whole(rows), 10)


def test_large_numbers(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 10.0**7 for _ in range(3)], i % 2) for i in range(60)]
    assert run(spark, rows, every=5) == brute(whole(rows), 5)


def test_scores_beyond_a_long(spark):
    rows = [(i, [1e17 * (1 + i % 3), 1.0], i % 2) for i in range(12)]
    assert run(spark, rows, every=4) == brute(whole(rows), 4)


def test_few_rows(spark):
    assert run(spark, [(0, [1.0, 2.0], 1), (1, [0.5, 0.5], 1)]) == []
    assert run(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]) == [(0, 1, 1, 2, 65536, 32768)]
    assert run(spark, [(0, [1.0], 1)]) == [] == run(spark, [(None, None, None)])


@pytest.mark.parametrize("same", [True, False])
def test_tree_prunes_and_stays_exact(same):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 6)) * 100
    vectors, labels = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 6))), rng.integers(0, 3, 4000)
    tree = rtree.Tree(np.arange(4000), labels, vectors)
    for q in range(0, 4000, 397):
        scores = vectors @ vectors[q]
        least, most = [int(np.quantile(scores, 0.3)), int(np.quantile(scores, 0.8))], [int(np.quantile(scores, 0.5)), int(scores.max())]
        got = sorted(tree.search(vectors[q : q + 1], [(q, labels[q], least, most)], 7, same))
        want = []
        for w in range(2):
            fit = [(-s, i) for i, s in enumerate(scores) if i != q and (labels[i] == labels[q]) == same and least[w] <= s <= most[w]]
            want += [(0, w, i, int(-s)) for s, i in sorted(fit)[:7]]
        assert got == sorted(want)


def test_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF), rtree.query, rtree.SQL, SF)[0] is None
