"""Byte-level BPE against the tiktoken library, and exact round trips."""

import base64
import hashlib
import random
import unicodedata

import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import PATTERN

from riskloom.llm import bpe
from tests.llm.helpers import SF, documents

with open(bpe.RANKS, "rb") as lines:
    LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, special_tokens={})

ODD = [
    "", " ", "  ", "\n", " \n a", "a  b", "a \n\n b  ", "don't 'tis 'lla 'll's ''s x's' '", " 's", "\t's", "a　b  c", "\x00\x1c\x85 x", "1st2nd ½ Ⅻ",
    "ÀÉ ßüñ 漢字かな 🎉🎉 ́a", "....'s", "x" * 500, "ab" * 3000 + " 9" * 50, "'re're've'm'd", "a'", "a'v", "a've", "!'m", " 'm", "  'm", "\n'm",
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    ids, stops = bpe._merger(bpe.RANKS).encode(["x", text, "'s"])
    assert ids[stops[0] : stops[1]].tolist() == LIBRARY.encode_ordinary(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text(alphabet="ab1 '\n\tsrevmld.é")), max_size=6))
def test_slices_follow_the_pattern(texts):
    found, stops = bpe.slices(texts) if texts else ([], [])
    start = 0
    for text, stop in zip(texts, stops):
        if all(unicodedata.category(c) != "Cn" for c in text):  # unassigned points differ between editions of Unicode
            assert found[start:stop] == [m.encode() for m in regex.findall(PATTERN, text)]
        assert b"".join(found[start:stop]) == text.encode()
        start = stop


def test_long_merge_equals_short():
    rng = random.Random(2)
    merger = bpe._merger(bpe.RANKS)
    for _ in range(200):
        word = "".join(rng.choice("thenati éß") for _ in range(rng.randint(1, 40))).encode()
        assert merger._merge_long(word) == merger._merge_short(word)


def test_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(documents(spark, [*ODD, None], first=10_000).select("doc_id", "text"))
    rows = bpe.decode(bpe.encode(docs.selectExpr("*", "1 AS ids", "2 AS offsets")), offsets=True).collect()
    texts = {d.doc_id: d.text or "" for d in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert r.ids == LIBRARY.encode_ordinary(texts[r.doc_id]) and bytes(r.decoded) == data
        edges = [*r.offsets, len(data)]
        assert [data[a:b] for a, b in zip(edges, edges[1:])] == LIBRARY.decode_tokens_bytes(r.ids)


def test_query(spark):
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = bpe.query(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_no_ids_at_all(spark):
    assert [bytes(r.decoded) for r in bpe.decode(bpe.encode(documents(spark, [None, "", ""])), offsets=True).collect()] == [b""] * 3


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(documents(spark, ["a"]).limit(0))).count() == 0
