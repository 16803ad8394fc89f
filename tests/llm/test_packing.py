"""Packing against the tokenizer itself and best-fit decreasing over single pieces."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from riskloom.llm import packing
from riskloom.llm.packing import TOKENIZER, best_fit_plan, pack
from tests.llm.helpers import SF, documents, words


def one_by_one(lengths, capacity):
    """Number of sequences of best-fit decreasing, piece by piece."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def check(rows, texts, capacity):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want[doc_id, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) == one_by_one([r.length for r in rows], capacity)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(60):
        capacity = rng.randint(1, 40)
        lengths = [min(capacity, int(rng.expovariate(0.15)) + 1) for _ in range(rng.randint(0, 300))]
        counts = Counter(lengths)
        runs = best_fit_plan(counts, capacity)
        places = defaultdict(list)
        for length in counts:
            own = [r for r in runs if r[0] == length]
            for rank in range(counts[length]):
                _, first, sequence, each, offset = max(r for r in own if r[1] <= rank)
                places[sequence + (rank - first) // each].append((offset + (rank - first) % each * length, length))
        for own in places.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(places) == one_by_one(lengths, capacity)


def test_odd_texts(spark):
    rng = random.Random(5)
    texts = [None, "", "   ", "don't  STOP É 12 x" * 3, "ﬁ Ǆ İ\x1cq é ΑΣ Σ", "word" * 4000, words(rng, 3000), "a", "a"] + [words(rng, rng.randint(1, 30)) for _ in range(200)]
    docs = documents(spark, texts).selectExpr("*", "1 AS salt", "2 AS length", "3 AS rank")
    check(pack(docs, capacity=64).collect(), list(enumerate(texts)), 64)
    check(pack(docs.union(docs)).collect(), [*enumerate(texts), *enumerate(texts)], 2048)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], 2048)


def test_empty_table(spark):
    assert pack(documents(spark, ["a"]).limit(0)).count() == 0


def test_cache_forgets_only_words_not_used_of_late(monkeypatch):
    """The words that are kept stay few, and one that every text has is encoded once."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 100)
    tokenizer, encoder, learned = Tokenizer.from_file(TOKENIZER), packing.WordEncoder(TOKENIZER), Counter()
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new, long: (learned.update(new), learn(new, long)))
    rng = random.Random(7)
    for _ in range(60):
        texts = ["always, " + words(rng, 20), "always " + words(rng, 20), ""]
        want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4").tobytes() for t in texts]
        assert encoder.encode(texts) == want
        assert len(encoder.words) + len(encoder.before) <= 300
    assert learned[b"always"] == 1 and sum(learned.values()) > 1_000
