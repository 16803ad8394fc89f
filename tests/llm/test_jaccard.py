"""N-gram Jaccard join against all pairs, and its parts one by one."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import jaccard
from riskloom.llm.components import components
from tests.llm.helpers import documents, words
from tests.oracle import compare, connect


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split("[\x20\x09-\x0d]+", lowered) if x]
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def brute(texts):
    """(n, component) by position, all pairs compared."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(["new", "other", "x" + str(rng.randrange(99))])
    return " ".join(w)


def corpus(rng):
    texts = [None, "", " \n", "a", "A", "a b", "b a", "a b c", "x\x0by z", "x y\x1fz", "é É", "É é"]
    for size in (10, 12, 19, 30, 60, 150, 400):
        base = words(rng, size)
        texts += [base, base.upper() if base.isascii() else base] + [edited(rng, base, rng.randint(0, 1 + size // 40)) for _ in range(12)]
        chain = base
        for _ in range(6):
            chain = edited(rng, chain, max(1, size // 45))
            texts.append(chain)
        texts.append(" ".join(base.split()[: -max(1, size // 20)]))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("cell", [96, 4])
def test_components_equal_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(jaccard, "CELL", cell)
    monkeypatch.setattr(jaccard, "SETS", cell)
    texts = corpus(random.Random(cell))
    docs = documents(spark, texts).selectExpr("*", "1 AS n", "2 AS node", "3 AS set_a")
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(docs).collect()}
    assert rows == dict(enumerate(brute(texts)))


def test_hot_group_with_stragglers(spark, monkeypatch):
    """A large group of near copies, some of them linked through few others only."""
    monkeypatch.setattr(jaccard, "CELL", 8)
    monkeypatch.setattr(jaccard, "SETS", 5)
    rng = random.Random(9)
    base = words(rng, 120)
    texts = [edited(rng, base, rng.randint(0, 6)) for _ in range(150)] + [base] * 50
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(documents(spark, texts)).collect()}
    assert rows == dict(enumerate(brute(texts)))


def test_similar_sets_share_a_digest():
    rng = np.random.default_rng(1)
    first = jaccard.size_classes(10_000)
    for _ in range(3000):
        n = int(rng.integers(9, 80)) if rng.random() < 0.7 else int(rng.integers(80, 900))
        common = rng.integers(0, 2**64, n, dtype=np.uint64)
        more = int(rng.integers(0, n // 9 + 1))
        split = int(rng.integers(0, more + 1))
        a = np.unique(np.append(common, rng.integers(0, 2**64, split, dtype=np.uint64)))
        b = np.unique(np.append(common, rng.integers(0, 2**64, more - split, dtype=np.uint64)))
        if 100 * n >= 90 * (len(a) + len(b) - n):
            assert set(jaccard.digests(a, first)) & set(jaccard.digests(b, first))


def test_merge_skip():
    rng = random.Random(3)
    for _ in range(500):
        lists = [sorted(rng.sample(range(30), rng.randint(1, 20))) for _ in range(rng.randint(1, 9))]
        least = rng.randint(1, len(lists))
        counts = Counter(v for values in lists for v in values)
        assert list(jaccard.merge_skip(lists, least)) == sorted((v, n) for v, n in counts.items() if n >= least)


def test_search_finds_all_similar_sets():
    rng = np.random.default_rng(4)
    for _ in range(60):
        pool = rng.integers(0, 400, 300)
        sets = [np.unique(np.where(rng.random(300) < rng.choice([0.0, 0.03, 0.1]), rng.integers(0, 400, 300), pool)) for _ in range(25)]
        lists = jaccard.Lists(sets)
        for q in sets:
            want = {(i, len(np.intersect1d(q, s))) for i, s in enumerate(sets) if 100 * len(np.intersect1d(q, s)) >= 90 * len(np.union1d(q, s))}
            assert set(lists.search(q)) == want


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(i, i + 1) for i in range(2000, 2060)]
    root = {}

    def find(i):
        while root.get(i, i) != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in pairs if a != b for n in (a, b)}


def test_repeated_and_unnamed_rows(spark):
    text = words(random.Random(1), 40)
    docs = documents(spark, [text, text + " end", text]).union(documents(spark, [text, None], first=1)).union(documents(spark, [text]).selectExpr("CAST(NULL AS long)", "text", "lang", "source", "n_chars"))
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.link_components(docs).collect())
    assert rows == [(False, 0, 38, 0), (False, 1, 38, 0), (False, 1, 39, 0), (False, 2, 0, 2), (False, 2, 38, 0), (True, 0, 38, None)]
    assert jaccard.link_components(docs.limit(0)).count() == 0


def test_query_agrees_with_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), jaccard.query, jaccard.SQL, sf)[0] is None


def brute_at(texts, size, percent):
    """Component by position for any shingle size and similarity, all pairs compared."""
    split = [[x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x] for t in texts]
    sets = [{tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set() for w in split]
    links = [(j, i) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and 100 * len(a & b) >= percent * len(a | b)]
    own = list(range(len(texts)))
    while (lower := [min([own[i], *(own[a + b - i] for a, b in links if i in (a, b))]) for i in range(len(texts))]) != own:
        own = lower
    return own


def test_five_words_at_eighty_percent(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL", 8)
    monkeypatch.setattr(jaccard, "SETS", 5)
    rng = random.Random(5)
    texts = corpus(rng)
    for size in (6, 9, 30, 100, 300):
        base = words(rng, size)
        texts += [base, base + " " + words(rng, max(1, size // 5)), " ".join(base.split()[: -max(1, size // 6)]), edited(rng, base, 1 + size // 40)]
    found = {r.doc_id: r.component_id for r in jaccard.link_components(documents(spark, texts), 5, 80).collect()}
    assert found == dict(enumerate(brute_at(texts, 5, 80))) != dict(enumerate(brute_at(texts, 3, 90)))


def test_similar_sets_share_a_digest_at_eighty_percent():
    rng = np.random.default_rng(2)
    first = jaccard.size_classes(10_000, 80)
    for _ in range(3000):
        n = int(rng.integers(4, 80)) if rng.random() < 0.7 else int(rng.integers(80, 900))
        split, more = int(rng.integers(0, n // 4 + 1)), n // 4
        a = np.arange(n + split, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        b = np.append(a[:n], rng.integers(0, 2**64, more - split, dtype=np.uint64))
        a, b = np.unique(a), np.unique(b)
        assert set(jaccard.digests(a, first, 80)) & set(jaccard.digests(b, first, 80))


def test_counts_bound_the_overlap_and_tell_chance_apart():
    rng = np.random.default_rng(6)
    for n in [1, 2, 3, 7, 50, 199, 200, 390, 5_000]:
        pool = rng.integers(0, 2**64, 3 * n + 4, dtype=np.uint64)
        sets = [np.unique(pool[start : start + size]) for start, size in ((0, n), (n // 3, n), (0, 2 * n), (2 * n, n + 4))]
        own = jaccard.counted([jaccard.counts(s) for s in sets], np.array(list(map(len, sets))))
        assert (own.sum(axis=1) == list(map(len, sets))).all()
        for i, a in enumerate(sets):
            assert all(np.minimum(own[i], own[j]).sum() >= len(np.intersect1d(a, b)) for j, b in enumerate(sets))
    # Two sets of nothing in common look it, in no more bytes than one for eight shingles.
    one, other = (np.unique(rng.integers(0, 2**64, 390, dtype=np.uint64)) for _ in range(2))
    texts = [jaccard.counts(one), jaccard.counts(other)]
    most = np.minimum(*jaccard.counted(texts, np.array([390, 390]))).sum()
    assert len(texts[0]) == 64 and 100 * most < 80 * 390 * 0.95
    # More than 15 in a group are told in whole bytes, and add up with halves.
    crowded = np.bincount(np.zeros(16, np.int64), minlength=64).astype(np.uint8).tobytes()
    assert jaccard.counted([crowded, jaccard.counts(one)], np.array([100, 390]))[0, 0] == 16
