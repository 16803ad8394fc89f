"""Near duplicates among embeddings against brute force."""

import numpy as np

from riskloom.llm import signs
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, node long, ball int, u string, weight int, n_links int, a int"


def run(spark, rows):
    found = signs.near_duplicates(spark.createDataFrame([(i, v, label, 1, 2, "x", 3, 4, 5) for i, v, label in rows], SCHEMA))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(tuple(r) for r in found.collect())


def brute(rows, cosine=0.93):
    rows = [(i, np.array(v, float), label) for i, v, label in rows]
    links = {i: set() for i, _, _ in rows}
    for i, x, a in rows:
        for j, y, b in rows:
            if i != j and a == b and len(x) == len(y) and x @ y >= cosine * np.linalg.norm(x) * np.linalg.norm(y):
                links[i].add(j)
    least = {i: i for i in links}
    while True:
        new = {i: min([least[i], *(least[j] for j in links[i])]) for i in links}
        if new == least:
            return sorted((i, len(links[i]), least[i], least[i] == i) for i in links)
        least = new


def clusters(rng, sizes, width, noise):
    out = []
    for size in sizes:
        centre = rng.normal(size=width)
        out += [(centre + rng.normal(size=width) * noise).tolist() for _ in range(size)]
    return out


def test_groups_of_near_copies(spark):
    rng = np.random.default_rng(1)
    # Tight groups, loose ones around the threshold, copies, and a group in two labels.
    vectors = clusters(rng, [150, 3, 2, 1, 1], 16, 0.05) + clusters(rng, [60, 40], 16, 0.22) + clusters(rng, [1] * 60, 16, 0)
    rows = [(7 * i % 1009, v, 0 if n % 5 else 1) for n, (i, v) in enumerate(enumerate(vectors))]
    rows += [(2000 + k, rows[k % 3][1], rows[k % 3][2]) for k in range(40)]
    rows += [(3000 + k, (np.array(rows[0][1]) * (k + 2)).tolist(), rows[0][2]) for k in range(3)]
    assert run(spark, rows) == brute(rows)


def test_small_cells(spark, monkeypatch):
    monkeypatch.setattr(signs, "CELL", 5)
    rng = np.random.default_rng(2)
    vectors = clusters(rng, [30, 30], 8, 0.25) + clusters(rng, [1] * 40, 8, 0)
    rows = [(i, v, 1) for i, v in enumerate(vectors)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    one = [1.0, 2.0, 3.0]
    odd = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0], 0), (4, [1.0, None, 3.0], 0), (5, [float("nan"), 2.0, 3.0], 0), (6, [float("inf"), 2.0, 3.0], 0), (7, one, None)]
    good = [(10, one, 0), (11, [1e-200, 2e-200, 3e-200], 0), (12, [1e200, 2e200, 3e200], 0), (13, [1.0, 2.0], 0), (14, one, 1), (15, [-1.0, -2.0, -3.0], 0)]
    got = run(spark, odd + good + good[:2] + [(None, one, 0), (10, [9.0, -1.0, 0.0], 3)])
    assert [r for r in got if r[0] < 10] == [(i, 0, i, True) for i in range(1, 8)]
    assert [r for r in got if r[0] >= 10] == [(10, 2, 10, True), (11, 2, 10, False), (12, 2, 10, False), (13, 0, 13, True), (14, 0, 14, True), (15, 0, 15, True)]


def test_empty_table_and_no_vector(spark):
    assert run(spark, [(None, None, None)]) == []
    assert run(spark, [(5, None, 1)]) == [(5, 0, 5, True)]


def test_enough_tables_at_every_size():
    for nodes in (1, 500, 50_000, 10**7, 10**10):
        bits, tables = signs.plan(nodes)
        agree = 1 - np.arccos(0.93) / np.pi
        assert (1 - agree**bits) ** tables <= signs.MISSED and nodes / 2**bits <= max(signs.COMPANY, nodes / 16)


def test_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF), signs.query, signs.SQL, SF)[0] is None
