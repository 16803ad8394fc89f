"""Language identification: held-out accuracy, and vectors against their definition."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import langid
from tests.llm.helpers import documents


def plain_vector(text, dimensions):
    """Bundle of bound n-grams, one by one."""
    out, run = np.zeros(dimensions, np.int64), []
    for c in text.lower():
        if c.isalpha():
            run.append(ord(c))
        elif not run or run[-1]:
            run.append(0)
    run += [] if run and not run[-1] else [0]
    for i in range(len(run) - 2):
        if run[i + 1]:
            a, b, c = (langid._letter_vector(p, dimensions).astype(np.int64) for p in run[i : i + 3])
            out += np.roll(a, 2) * np.roll(b, 1) * c
    return out


@pytest.mark.parametrize("texts", [["The cat, the dog.", "", "é", "a b  c", "12", "Ünïcødé漢字"], ["x"], [""], ["abc"] * 3])
def test_vectors(texts):
    found = langid.grams(texts)
    vectors = langid.gram_vectors(found.distinct, 128).astype(np.int64)
    stops = [*found.starts[1:], len(found.which)]
    for text, a, b in zip(texts, found.starts, stops):
        assert (vectors[found.which[a:b]].sum(axis=0) == plain_vector(text, 128)).all(), text
    assert found.has_letter.tolist() == [any(c.isalpha() for c in t) for t in texts]


def test_held_out_accuracy(spark):
    docs = {d.doc_id: d for d in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = langid.query(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in tested) >= 0.97 * len(tested)


def test_held_out_language_is_never_seen(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2][:20]
    secret = spark.createDataFrame([(i, "qqq zzz", "xx", "s", 7) for i in ids], "doc_id long, text string, lang string, source string, n_chars long")
    rest = documents(spark, ["the cat and the dog"] * 60, first=1000)
    assert {r.lang_pred for r in langid.identify(secret.union(rest)).collect()} == {"en"}


def test_odd_rows(spark):
    docs = documents(spark, ["le chat", None, "", "12 !?", "le chat", "a" * 300_000], lang="fr", first=4).union(documents(spark, ["no lang"], lang=None, first=50))
    docs = docs.selectExpr("*", "0.5 AS score", "'x' AS lang_pred", "true AS held_out").union(docs.limit(1).selectExpr("null", "text", "lang", "source", "n_chars", "0.5", "'x'", "true"))
    rows = langid.identify(docs).collect()
    assert len(rows) == 8 and sorted(r.lang_pred for r in rows) == ["fr"] * 5 + ["und"] * 3
    assert langid.identify(docs.drop("score", "lang_pred", "held_out").limit(0)).count() == 0
    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")).drop("score", "lang_pred", "held_out")).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
