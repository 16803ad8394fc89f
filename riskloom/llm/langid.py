"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a hash of its code point. An
n-gram's vector binds its letters: each letter's vector is permuted (rolled) by its place
and the vectors are multiplied. A text's vector bundles (adds) the vectors of its n-grams, a
language's prototype those of all its texts. A text gets the language whose prototype has
the largest cosine with it. Letters are lowered; any run of other characters is one
boundary, which may begin or end an n-gram but not stand inside it.

Bundling is linear. Prototypes are therefore sums of task-wise sums, one row per language
and task; documents' products with prototypes are sums over n-grams of known products.

A text that is null or has no letter gets ``und`` and score 0. Without any text to learn
from, all get ``und``. Texts without n-grams of their own language score near 0. Rows with
null lang are not learned from; null doc_id is never held out. Repeated rows get equal
results, ties in the cosine the first language by name. An empty table gives no rows.
Columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import mix64, table, text_chunks

DIMENSIONS = 512
GRAM = 3
UNKNOWN = "und"
HELD_OUT = 2
#: Characters a task turns into n-grams at a time, and n-gram vectors it holds at a time.
_CHARS = 500_000
_VECTORS = 8_192
_BOUNDARY = 0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(p))[0] == "L" for p in range(sys.maxunicode + 1)])


@lru_cache(maxsize=100_000)
def _letter_vector(point: int, dimensions: int) -> np.ndarray:
    words = mix64(mix64(np.arange(dimensions // 64 + 1, dtype=np.uint64) + np.uint64(1)) ^ np.uint64(point * 0x9E3779B97F4A7C15 % 2**64))
    bits = np.unpackbits(words.view(np.uint8), count=dimensions)
    return bits.astype(np.int8) * 2 - 1


@dataclass
class Grams:
    """N-grams of a chunk of texts: distinct ones as rows of code points, and each occurrence."""

    distinct: np.ndarray
    which: np.ndarray
    starts: np.ndarray  # of each text's occurrences
    has_letter: np.ndarray


def grams(texts: list[str], n: int = GRAM) -> Grams:
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\0".join([*lowered, ""]).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in lowered]) - 1
    letter = _letters()[points]
    text = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=-1))
    has = np.bincount(text[letter], minlength=len(texts)) > 0
    edge = np.append(True, letter[:-1]) & ~letter  # first of a run of others
    starts_text = np.zeros(len(points), bool)
    starts_text[np.append(0, ends[:-1] + 1)] = True
    kept = letter | edge | (starts_text & ~letter)
    alphabet, code = _dense(np.where(letter, points, _BOUNDARY)[kept], sys.maxunicode + 1)
    text = text[kept]
    size = len(alphabet)
    if len(code) < n:
        return Grams(np.zeros((0, n), np.uint32), np.zeros(0, np.int64), np.zeros(len(texts), np.int64), has)
    gram = np.zeros(len(code) - n + 1, np.int64)
    for k in range(n):
        gram = gram * size + code[k : len(code) - n + 1 + k]
    good = text[: len(gram)] == text[n - 1 :]
    if alphabet[0] == _BOUNDARY:
        for k in range(1, n - 1):
            good &= code[k : len(code) - n + 1 + k] != 0
    gram, text = gram[good], text[: len(good)][good]
    distinct, which = _dense(gram, size**n)
    rows = np.empty((len(distinct), n), np.uint32)
    for k in range(n - 1, -1, -1):
        rows[:, k] = alphabet[distinct % size]
        distinct = distinct // size
    return Grams(rows, which, np.searchsorted(text, np.arange(len(texts))), has)


def _dense(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and each one's index; without sorting where the range is small."""
    if limit > 4_000_000:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(limit, bool)
    seen[values] = True
    distinct = np.flatnonzero(seen)
    index = np.zeros(limit, np.int32)
    index[distinct] = np.arange(len(distinct))
    return distinct, index[values]


def gram_vectors(rows: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Bound vectors of n-grams given as rows of code points."""
    out = np.ones((len(rows), dimensions), np.int8)
    n = rows.shape[1] if len(rows) else 0
    for k in range(n):
        alphabet, at = np.unique(rows[:, k], return_inverse=True)
        vectors = np.stack([np.roll(_letter_vector(int(p), dimensions), n - 1 - k) for p in alphabet])
        out *= vectors[at]
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def learn(docs: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototype of every language in ``lang`` (one vector each) from all given texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for part, texts in text_chunks(batches, chars=_CHARS):
            names, lang = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            found = grams(texts)
            of = lang[np.searchsorted(found.starts, np.arange(len(found.which)), side="right") - 1]
            counts = np.bincount(of * len(found.distinct) + found.which, minlength=len(names) * len(found.distinct)).reshape(len(names), -1).astype(np.float64)
            for at in range(0, len(found.distinct), _VECTORS):
                sums = counts[:, at : at + _VECTORS] @ gram_vectors(found.distinct[at : at + _VECTORS], dimensions).astype(np.float64)
                for name, own in zip(names.tolist(), sums):
                    total[name] = total.get(name, 0) + own
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([v.tolist() for v in total.values()])], names=["lang", "vector"])

    learned = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang").mapInArrow(run, "lang string, vector array<double>")
    # Whole numbers far below 2^53: their sum does not depend on the order.
    places = learned.select("lang", F.posexplode("vector").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    rows = places.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "x"))).alias("vector")).collect()
    return {r["lang"]: np.array([x["x"] for x in r["vector"]]) for r in sorted(rows, key=lambda r: r["lang"])}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: bool = False) -> DataFrame:
    """doc_id (with ``keep``: all columns), lang_pred and score, the cosine where positive."""
    names = list(prototypes)
    dimensions = len(next(iter(prototypes.values()))) if names else DIMENSIONS
    unit = np.stack([v / (np.linalg.norm(v) or 1) for v in prototypes.values()], axis=1).astype(np.float32) if names else np.zeros((dimensions, 1), np.float32)
    docs = docs if keep else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, chars=_CHARS):
            found = grams(texts)
            vectors = np.zeros((len(texts), dimensions), np.float32)
            number = np.searchsorted(found.starts, np.arange(len(found.which)), side="right") - 1
            for at in range(0, len(found.distinct), _VECTORS):
                own = (found.which >= at) & (found.which < at + _VECTORS) if len(found.distinct) > _VECTORS else slice(None)
                bound = gram_vectors(found.distinct[at : at + _VECTORS], dimensions).astype(np.float32)
                counts = np.bincount(number[own] * len(bound) + found.which[own] - at, minlength=len(texts) * len(bound))
                vectors += counts.reshape(len(texts), -1).astype(np.float32) @ bound
            cosine = vectors @ unit / np.maximum(np.linalg.norm(vectors, axis=1), 1)[:, None]
            best = cosine.argmax(axis=1)
            known = found.has_letter & bool(names)
            lang = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
            score = np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0).astype(np.float64)
            columns = part.columns if keep else [part.column(0)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), pa.array(score)], names=[*(part.schema.names if keep else ["doc_id"]), "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) if keep else "doc_id long"
    return docs.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    return predict(docs, learn(docs.where(~held_out(F.col("doc_id"))))).withColumn("held_out", held_out(F.col("doc_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all ``documents``."""
    return identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")
