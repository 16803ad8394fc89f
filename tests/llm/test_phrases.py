"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np

from riskloom.llm import frequent, phrases
from riskloom.llm.common import mix64
from tests.llm.helpers import documents
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


def brute(rows, least, within=80, top=2000):
    """``rows``: (text, lang)."""
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    f[lang, words[at : at + size]] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for lang in total:
        found = []
        for (own, words), a in candidates.items():
            if own != lang:
                continue
            score, k = min((2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words)))
            around = [b for (other, longer), b in candidates.items() if other == lang and len(longer) > len(words) and any(longer[i : i + len(words)] == words for i in range(len(longer)))]
            if not any(100 * b >= within * a for b in around):
                found.append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
        out += [(lang, rank + 1, phrase.decode(), -a, l, r, total[lang], -score) for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


def run(spark, docs, **options):
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())


def test_small_texts_with_all_marks(spark):
    rng = random.Random(1)
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", ";", ":", "!", "?", "\n", "\r", "\x0b", "\x0c"]
    vocabulary = ["The", "the", "cat", "É", "é", "new", "York", "san", "\x00", "\x1f\x85", "don't", "a-b", "漢字"]
    texts = ["".join(rng.choice(vocabulary) + rng.choice(marks) for _ in range(rng.randint(0, 60))) for _ in range(120)] + [None, "", " ", "..."]
    langs = [rng.choice(["en", "de", None, "und"]) for _ in texts]
    rows = list(zip(texts, langs))
    docs = spark.createDataFrame([(t, lang, 1, "x", 2, 3.0) for t, lang in rows], "text string, lang string, n long, w1 string, rank int, score double")
    assert run(spark, docs, least=5) == brute(rows, 5)
    assert run(spark, docs, least=3, top=7) == brute(rows, 3, top=7)
    assert run(spark, docs, least=1) == brute(rows, 1)


def test_contained_and_overlapping_phrases(spark):
    texts = ["a a a a a a"] * 10 + ["new york city hall"] * 20 + ["new york"] * 4 + ["york city"] * 30 + ["city hall x"] * 5
    assert run(spark, documents(spark, texts), least=5) == brute([(t, "en") for t in texts], 5)


def test_long_text_in_steps(spark, monkeypatch):
    rng = random.Random(4)
    text = " ".join(rng.choice("abcde") + rng.choice(["", "", "", "."]) for _ in range(5000)) + " " + "x y " * 400
    for size in (50, 100_000):
        assert b"\n".join(p for p in _cut(text, size, monkeypatch)) == phrases_cut(text)
    monkeypatch.setattr(phrases, "STEP", 1000)
    chunks = list(phrases._chunks(_batches([("en", text)])))
    assert sum(len(c.code) for _, c in chunks) == len(text.replace(".", " ").split()) and len(chunks) > 2


def phrases_cut(text):
    return text.encode().lower().translate(phrases._CUTS)


def _cut(text, size, monkeypatch):
    monkeypatch.setattr(phrases, "STEP", size)
    return list(phrases._pieces(text.encode()))


def _batches(rows):
    import pyarrow as pa

    return iter([pa.RecordBatch.from_pylist([{"lang": a, "text": b} for a, b in rows])])


def test_salts_rank_alike(spark, monkeypatch):
    monkeypatch.setattr(phrases, "RANK_ROWS", 3)
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(40)) for _ in range(60)]
    assert run(spark, documents(spark, texts), least=4, top=11) == brute([(t, "en") for t in texts], 4, top=11)


def test_filter_holds_what_went_in(spark):
    rng = np.random.default_rng(3)
    for ranges in (16, 1 << 20):
        hashes = rng.integers(0, 2**64 - 1, 3000, np.uint64)
        kept = mix64(hashes >> np.uint64(33 - ranges.bit_length())).astype(np.int64)
        known = frequent.Filter.of(spark.createDataFrame([(int(h),) for h in kept], "h long"), ranges)
        assert known.has(hashes).all()
        assert known.has(rng.integers(0, 2**64 - 1, 20_000, np.uint64)).mean() < 0.05


def test_frequent_hashes_are_sent_in_steps(spark, monkeypatch):
    monkeypatch.setattr(frequent, "GATHER", 10)
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(50)) for _ in range(40)]
    assert run(spark, documents(spark, texts), least=300) == [] and run(spark, documents(spark, texts), least=15) == brute([(t, "en") for t in texts], 15)


def test_empty_table(spark):
    assert run(spark, documents(spark, ["a"]).limit(0)) == [] == run(spark, documents(spark, [None, ""]))


def test_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF), phrases.query, phrases.SQL, SF)[0] is None
