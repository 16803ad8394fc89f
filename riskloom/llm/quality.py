"""Quality classifier by importance resampling over hashed n-grams.

Two bag-of-n-grams models over hashed buckets: the *target* (documents labelled good) and
the *raw* corpus (all documents). A document's log importance weight is the log ratio of
its n-grams' probabilities. Adding Gumbel noise and keeping the k largest draws k documents
without replacement with chances in proportion to the weights; here k is the number of
documents worth drawing, those whose weight is not far below that of the raw corpus.

Units are word shapes, not words: runs of lower, upper and numeric characters shrink to one
mark, other characters stay (three in a row at most), and a word equal to the one before it
is marked. Shapes carry over to words and languages that no label covers. The n-grams are
single shapes and pairs, and in long words the kinds of characters of every ``BLOCK``
characters, so that encoded data or code in one word is as much evidence as its length.
Blocks of letters without case are left out, as such scripts need no white space, unless
they repeat few characters. Evidence counts as that of ``EVIDENCE`` n-grams at most, so that a
long document is not condemned for a slight bent.

Raw counts cover all documents. The target is learned from at most ``MAX_LABELS`` labelled
documents, those with the smallest hash of doc_id, and smoothed towards the raw model.

Null and empty texts, and those without a word, have weight 0 (no evidence) and stay. With
no label for a good document every weight is 0. Noise follows from doc_id: repeated rows
stay or go together, as do ties at the border. An empty table gives no rows. The columns
log_weight and gumbel_key are reserved; others are ignored or carried.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import mix64, table, text_chunks
from riskloom.llm.sharding import splitters
from riskloom.session import materialize

BUCKETS = 1 << 16
MAX_LABELS = 20_000
#: Characters of a block of a long word, and distinct ones up to which it repeats itself.
BLOCK, FEW = 32, 4
#: n-grams of evidence that a document can have, and the log weight below which none is drawn.
EVIDENCE = 200
WORTH = -15.0
#: Weight of the raw model in the target model.
PRIOR = 0.01
SEED = 17

_WHITE, _LOWER, _UPPER, _DIGIT = range(4)
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


@lru_cache(maxsize=1)
def _marks() -> np.ndarray:
    """Mark of every code point: its class, or a value of its own."""
    marks = np.arange(sys.maxunicode + 1, dtype=np.uint32) + 4
    for point in range(sys.maxunicode + 1):
        c = chr(point)
        kind = unicodedata.category(c)
        if kind[0] in "LM":
            marks[point] = _UPPER if kind in ("Lu", "Lt") else _LOWER
        elif kind[0] == "N":
            marks[point] = _DIGIT
        elif c.isspace() or not point:
            marks[point] = _WHITE
    return marks


@lru_cache(maxsize=1)
def _caseless() -> np.ndarray:
    return np.array([unicodedata.category(chr(p)) == "Lo" for p in range(sys.maxunicode + 1)])


def _blocks(points: np.ndarray, marks: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word number and hash of every whole block of the words, by the kinds of its characters."""
    number = lengths // BLOCK
    word = np.repeat(np.arange(len(starts)), number)
    if not len(word):
        return word, np.zeros(0, np.uint64)
    nth = np.arange(len(word)) - np.repeat(np.cumsum(number) - number, number)
    at = (starts[word] + nth * BLOCK)[:, None] + np.arange(BLOCK)
    own, mark = points[at], marks[at]
    few = (np.diff(np.sort(own, axis=1), axis=1) > 0).sum(axis=1) < FEW
    caseless = _caseless()[own].sum(axis=1) * 2 >= BLOCK
    kinds = [(mark == m).any(axis=1) for m in (_LOWER, _UPPER, _DIGIT)] + [(mark > _DIGIT).any(axis=1), few, caseless]
    code = sum(k.astype(np.uint64) << np.uint64(i) for i, k in enumerate(kinds))
    kept = few | ~caseless
    return word[kept], mix64(code[kept] + np.uint64(1 << 40))


def _sums(values: np.ndarray, place: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each segment; depends on the order of its values."""
    return np.add.reduceat((values.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 63], starts)


def shape_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every n-gram."""
    points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    marks = _marks()[points]
    words = np.flatnonzero(marks != _WHITE)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.append(True, np.diff(words) > 1)
    starts = np.flatnonzero(first)
    place = np.arange(len(words)) - np.repeat(starts, np.diff(starts, append=len(words)))
    whole = _sums(points[words], place, starts)
    mark = marks[words]
    same = np.append(False, mark[1:] == mark[:-1]) & ~first
    thrice = same.copy()
    thrice[2:] &= same[1:-1] & same[:-2]
    thrice[:2] = False
    kept = ~np.where(mark <= _DIGIT, same, thrice)
    own, first_kept = mark[kept], np.flatnonzero(first[kept])
    shape = _sums(own, np.arange(len(own)) - np.repeat(first_kept, np.diff(first_kept, append=len(own))), first_kept)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    text = np.searchsorted(ends, words[starts])
    again = np.append(False, (whole[1:] == whole[:-1]) & (text[1:] == text[:-1]))
    one = mix64(shape * np.uint64(2) + again.astype(np.uint64))
    pair = text[1:] == text[:-1]
    two = mix64(one[:-1] * np.uint64(3) + one[1:])[pair]
    long, block = _blocks(points[words], marks[words], starts, np.diff(starts, append=len(words)))
    return np.concatenate([text, text[1:][pair], text[long]]), (np.concatenate([one, two, block]) % np.uint64(BUCKETS)).astype(np.int64)


def label_sample(labels: DataFrame, most: int = MAX_LABELS) -> DataFrame:
    """doc_id and whether it is good, for a bounded sample of the labels."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", (F.col("quality") == 1).alias("good"))


def learn(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratio of target to raw probability, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for part, texts in text_chunks(batches):
            text, bucket = shape_grams(texts)
            good = np.array(part.column("good").to_pylist(), object) == True  # noqa: E712
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[text]], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"])

    marked = docs.select("doc_id", "text").join(F.broadcast(label_sample(labels)), "doc_id", "left").select("text", "good")
    counts = marked.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():  # one row per bucket
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    ratio, seen = np.zeros(BUCKETS), raw > 0
    if target.sum():
        chance = (1 - PRIOR) * target[seen] / target.sum() + PRIOR * raw[seen] / raw.sum()
        ratio[seen] = np.log(chance) - np.log(raw[seen] / raw.sum())
    return ratio


def weigh(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """All columns and the log importance weight of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            text, bucket = shape_grams(texts)
            number = np.bincount(text, minlength=len(texts))
            total = np.bincount(text, weights=ratio[bucket], minlength=len(texts))
            weight = total * np.minimum(1, EVIDENCE / np.maximum(number, 1))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(weight)], names=[*part.schema.names, "log_weight"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, log_weight double")


def resample(weighed: DataFrame, k: int | None = None, weights: DataFrame | None = None) -> DataFrame:
    """Gumbel top-k: the rows of the k largest perturbed log weights.

    Weights are read several times, so ``weighed`` should be a written table, or ``weights`` one
    that holds doc_id and log_weight of the same rows. Without ``k``, as many as have a weight
    of at least ``WORTH``.
    """
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    key = F.col("log_weight") - F.log(-F.log(uniform))
    keyed = weighed.withColumn("gumbel_key", key)
    scaled = (weighed if weights is None else weights).withColumn("gumbel_key", key).select(F.round(F.col("gumbel_key") * (1 << 30)).cast("long").alias("key"), F.lit(1).alias("size"), "log_weight")
    n = scaled.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("log_weight") >= WORTH).alias("worth")).first()
    k = min(n["worth"] if k is None else k, n["all"])
    if k == n["all"]:
        return keyed
    (border,) = splitters(scaled, [n["all"] - k], 0)
    return keyed.where(F.round(F.col("gumbel_key") * (1 << 30)).cast("long") > border)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` that are drawn, with their weights."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ratio = learn(docs, table(spark, sf_dir, "labels"))
    weighed = materialize(weigh(docs, ratio).drop("text"), "weights")
    return resample(weighed)
