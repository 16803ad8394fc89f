"""The pipeline, stage by stage, against plain versions on small tables."""

import random

import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F
from riskloom.llm import secrets
from riskloom.llm.frequent import Filter
from tests.llm.helpers import SF, documents, words
from tests.llm.test_jaccard import brute_at, edited
from tests.llm.test_packing import check

STAGES = dict(corpus_pipeline.STAGES)


def near(texts):
    return brute_at(texts, corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT)


def test_order_and_columns(spark):
    assert list(STAGES) == ["quality classifier", "language id", "near duplicates", "secret scan", "best-fit packing"]
    extra = ["score", "lang_pred", "held_out", "log_weight", "weight", "kind", "n", "node", "component_id", "row", "h", "spans", "entities"]
    docs = documents(spark, ["Plain text of a few words."] * 3).selectExpr("*", *(f"{i} AS {c}" for i, c in enumerate(extra)))
    for name in list(STAGES)[:-1]:
        out = STAGES[name](spark, docs, SF)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", *extra] and out.count() == (1 if name == "near duplicates" else 3)


def test_near_duplicates(spark):
    rng = random.Random(3)
    texts = [None, "", "short"]
    for _ in range(5):
        base = words(rng, 150)
        texts += [base, base, edited(rng, base, 1), edited(rng, base, 40)]
    docs = documents(spark, texts).union(documents(spark, texts[3:5], first=3)).union(documents(spark, ["no id"] * 2).selectExpr("NULL", "text", "lang", "source", "n_chars"))
    kept = [r.doc_id for r in STAGES["near duplicates"](spark, docs, SF).collect()]
    want = [i for i, component in enumerate(near(texts)) if component == i]
    assert sorted(i for i in kept if i is not None) == want and kept.count(None) == 2


def test_copy_with_a_passage_added_goes(spark):
    rng = random.Random(8)
    base = words(rng, 200)
    texts = [base, base + " " + words(rng, 40), " ".join(base.split()[:165]), words(rng, 200)]
    assert sorted(r.doc_id for r in STAGES["near duplicates"](spark, documents(spark, texts), SF).collect()) == [0, 3]


def test_filter_of_ids_tells_which_rows_need_a_join(spark):
    held = Filter.of(spark.range(0, 300, 3).select(F.xxhash64("id").alias("h")))
    rows = spark.range(300).withColumn("may", held.held_by(spark)(F.xxhash64("id"))).collect()
    assert all(r.may for r in rows if r.id % 3 == 0) and sum(r.may for r in rows) < 120


def test_language_stage(spark):
    docs = documents(spark, ["the cat and the dog sat"] * 5 + ["123 !?", None, "漢字漢字"])
    assert sorted(r.doc_id for r in STAGES["language id"](spark, docs, SF).collect()) == [0, 1, 2, 3, 4, 7]
    train = documents(spark, ["the cat and the dog sat on the mat"] * 50).union(documents(spark, ["漢字漢字"], lang=None, first=60)).union(documents(spark, ["漢字かな" * 60], lang=None, first=61))
    assert 61 not in {r.doc_id for r in STAGES["language id"](spark, train, SF).collect()}


def test_empty_table(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert all(stage(spark, docs, SF).count() == 0 for stage in STAGES.values())


def test_whole_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    marks = {m.doc_id: m.quality for m in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    first = {r.doc_id for r in STAGES["quality classifier"](spark, docs, SF).collect()}
    assert not any(marks.get(i) == 0 for i in first) and all(i in first for i, q in marks.items() if q == 1)
    texts = {d.doc_id: d.text for d in docs.collect() if d.doc_id in first}
    order = sorted(texts)
    left = [order[i] for i, component in enumerate(near([texts[i] for i in order])) if component == i]
    rows = corpus_pipeline.run(spark, SF).collect()
    check(rows, [(i, secrets.without_secrets(texts[i])) for i in left], 2048)


def test_texts_go_to_python_in_small_batches(spark):
    """A stage that runs by itself bounds the bytes of a batch, not only its rows."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = documents(spark, ["A text. " * 2_000] * 1_500).coalesce(1)
    STAGES["best-fit packing"](spark, docs.limit(1), SF)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "rows"])

    found = docs.select("text").mapInArrow(sizes, "bytes long, rows long").collect()
    assert sum(r.rows for r in found) == 1_500 and max(r.bytes for r in found) < 5_000_000
