"""Importance resampling: models against counting one by one, junk out, clean documents in."""

from collections import Counter

import numpy as np

from riskloom.llm import quality
from tests.llm.helpers import SF, documents


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_shapes():
    def buckets(*texts):
        text, bucket = quality.shape_grams(list(texts))
        return [sorted(bucket[text == i].tolist()) for i in range(len(texts))]

    a, b, c = buckets("Cat dog", "Tree houses", "CAT dog")
    assert a == b != c and len(a) == 3
    assert buckets("wow!!! no") == buckets("wow!!!!! no") != buckets("wow!! no")
    assert buckets("is is") != buckets("is as")
    assert buckets("", " ", "\n") == [[], [], []]


def test_weights_are_log_ratios(spark):
    texts = ["Good text here.", "Good Text, too", "BAD!! BAD!!", "", None, "so so so", "Good text here."]
    docs = documents(spark, texts)
    ratio = quality.learn(docs, labels(spark, [(0, 1, 0), (1, 1, 1), (2, 0, 0), (None, 1, 0), (5, None, 0), (99, 1, 0)]))
    text, bucket = quality.shape_grams([t or "" for t in texts])
    raw, target = Counter(bucket.tolist()), Counter(bucket[text <= 1].tolist())
    n, m = sum(raw.values()), sum(target.values())
    for b in raw:
        chance = (1 - quality.PRIOR) * target[b] / m + quality.PRIOR * raw[b] / n
        assert np.isclose(ratio[b], np.log(chance / (raw[b] / n)))
    rows = {r.doc_id: r.log_weight for r in quality.weigh(docs, ratio).collect()}
    for i in range(len(texts)):
        assert np.isclose(rows[i], sum(ratio[b] for b in bucket[text == i]))
    assert rows[3] == rows[4] == 0


def test_keeps_clean_and_drops_junk(spark):
    sf = "/root/testdata/sf0.01"
    kept = {r.doc_id for r in quality.query(spark, sf).collect()}
    marks = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good, bad = [m for m in marks if m.quality == 1], [m for m in marks if m.quality == 0]
    assert sum(m.doc_id in kept for m in good) >= 0.995 * len(good) and sum(m.doc_id in kept for m in bad) <= 0.03 * len(bad)


def test_top_k_draws_by_weight(spark):
    weighed = spark.range(20_000).selectExpr("id AS doc_id", "IF(id % 2 = 0, ln(3D), 0D) AS log_weight")
    rows = quality.resample(weighed, 2_000).collect()
    assert len(rows) == 2_000
    heavy = sum(r.doc_id % 2 == 0 for r in rows) / 2_000
    assert 0.70 < heavy < 0.78  # a little under 3 in 4, as draws are without replacement
    least = min(r.gumbel_key for r in rows)
    assert sum(r.gumbel_key >= least for r in quality.resample(weighed, 20_000).collect()) == 2_000


def test_without_labels_and_without_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    ratio = quality.learn(docs, labels(spark, []))
    assert not ratio.any() and quality.resample(quality.weigh(docs, ratio)).count() == docs.count()
    empty = documents(spark, ["a"]).limit(0)
    assert quality.resample(quality.weigh(empty, quality.learn(empty, labels(spark, [(0, 1, 0)])))).count() == 0


def test_label_sample_is_bounded(spark):
    many = spark.range(500).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert quality.label_sample(many.union(many), 100).count() == 100


def test_long_words_are_evidence():
    good = ["Good text of some plain words here, with an end."] * 50
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"))
    junk = ["".join(rng.choice(letters, 5_000)), "a" * 400, "#$" * 300, "漢" * 400, "x=function(a){return" + "(b1+C)*" * 50]
    chinese = "".join(chr(0x4E00 + i) for i in rng.integers(0, 3_000, 400))
    texts = [*good, *junk, chinese]
    text, bucket = quality.shape_grams(texts)
    raw = np.bincount(bucket, minlength=quality.BUCKETS).astype(float)
    target = np.bincount(bucket[text < len(good)], minlength=quality.BUCKETS).astype(float)
    with np.errstate(all="ignore"):
        ratio = np.log((1 - quality.PRIOR) * target / target.sum() + quality.PRIOR * raw / raw.sum()) - np.log(raw / raw.sum())
    weight = np.bincount(text, weights=ratio[bucket]) * np.minimum(1, quality.EVIDENCE / np.bincount(text))
    assert (weight[: len(good)] > quality.WORTH).all() and weight[-1] > quality.WORTH
    assert (weight[len(good) : -1] < quality.WORTH).all()
