"""Sharding: nothing lost, slots without gaps, shards of near equal bytes."""

import zlib
from collections import Counter, defaultdict

import pytest

from riskloom.llm.sharding import shard, splitters
from tests.llm.helpers import SF, documents


def check(rows, docs, shards, spare):
    want = Counter((d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes[i] for i in range(shards)) - min(sizes[i] for i in range(shards)) <= spare


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    longest = max(len(d.text.encode()) for d in docs) + 1
    check(shard(spark.read.parquet(f"{SF}/documents.parquet")).collect(), docs, 8, 2 * longest)


def test_one_text_holds_most_rows(spark):
    docs = documents(spark, ["same text"] * 700 + [None] * 100 + [f"other {i}" for i in range(200)]).selectExpr("*", "0 AS part", "'k' AS key")
    rows = shard(docs).collect()
    check(rows, docs.collect(), 8, 40)
    assert len({r.shard for r in rows if r.size == 10}) > 3


def test_same_row_again_and_again(spark):
    docs = documents(spark, ["x"]).crossJoin(spark.range(500).select()).unionByName(documents(spark, ["y" * 50], first=7))
    check(shard(docs, shards=4).collect(), docs.collect(), 4, 120)


@pytest.mark.parametrize("keys", [[5] * 40, [-(2**63), 2**63 - 1, 0, 1, 2], list(range(100)), [2**62 + i for i in range(50)]])
def test_borders_are_as_near_as_can_be(spark, keys):
    rows = spark.createDataFrame([(k, 1) for k in keys], "key long, size long")
    for target in (0, 1, len(keys) // 2, len(keys)):
        (border,) = splitters(rows, [target], 0, bins=4)
        reach = {sum(k <= b for k in keys) for b in [min(keys) - 1, *keys]}
        got = sum(k <= border for k in keys)
        assert abs(got - target) <= min(abs(x - target) for x in reach)


def test_empty_table(spark):
    assert shard(documents(spark, ["a"]).limit(0)).count() == 0
