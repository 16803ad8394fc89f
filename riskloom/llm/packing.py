"""Best-fit packing of documents into sequences, planned on a histogram of lengths.

Every document becomes its token ids and a closing 0. Documents of more than ``capacity``
tokens are cut into pieces of ``capacity``; all others stay whole. Best-fit decreasing is
then run on the counts per length, at most ``capacity`` of them, and yields *runs*: pieces
of one length with ranks a..b take places in consecutive sequences. Pieces find their run
by length and by their rank within that length.

A rank needs no task to hold a whole length: pieces are dealt over salts, ranked within
(length, salt), and shifted by the pieces of the salts before.

Null text counts as empty (one token, the closing 0). Repeated rows are packed each for
itself; rows with null doc_id keep it. An empty table gives no rows. Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import salted, table, text_chunks
from riskloom.session import materialize

CAPACITY = 2048
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Pieces that share a (length, salt) at the most, on average.
ROWS_PER_RANKING = 20_000
#: Encoded words a task keeps: half of them new or used again of late, half those before them.
CACHE_WORDS = 500_000
#: Characters of text that are encoded at a time; what the tokenizer returns takes many times as much.
_CHARS = 500_000
_LONG_WORD = 64
#: Marks that may follow a word; the tokenizer always cuts between a word and them.
_TAIL = b".,;:!?*$&%#|)"
#: Words that are encoded as one text.
_TOGETHER = 256
_END = (0).to_bytes(4, "little")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordEncoder:
    """Ids of whole texts through a cache of words, of which those not used for long go.

    The tokenizer drops white space and never joins across it, so a text's ids are those
    of its white-space separated words in turn. ASCII letters are lowered first, as the
    tokenizer does anyway. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.words: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)  # tokens that end a word
        self.closes[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text, with the closing 0."""
        if len(self.words) > CACHE_WORDS // 2:
            self.words, self.before = {}, self.words
        split = [t.encode().lower().split() for t in texts]
        known, long = self.words, {}
        new = {w for words in split for w in words if w not in known}
        known.update((w, self.before[w]) for w in new if w in self.before)
        parts = {w: self._parts(w) for w in new if w not in known}
        new = {p for own in parts.values() for p in own if p not in known}
        known.update((p, self.before[p]) for p in new if p in self.before)
        self._learn({p for p in new if p not in known}, long)
        for word, own in parts.items():
            if len(own) > 1:
                (known if len(word) <= _LONG_WORD else long)[word] = b"".join(known.get(p) or long[p] for p in own)
        if not long:
            return [b"".join([*map(known.__getitem__, words), _END]) for words in split]
        return [b"".join([*(known.get(w) or long.get(w, b"") for w in words), _END]) for words in split]

    def _parts(self, word: bytes) -> tuple[bytes, ...]:
        """The word without the marks behind it, and these."""
        stem = word.rstrip(_TAIL)
        return (stem, word[len(stem) :]) if stem and len(stem) < len(word) and stem.decode()[-1].isalnum() else (word,)

    def _learn(self, new: set[bytes], long: dict[bytes, bytes]) -> None:
        """Encode new words: plain ones many at a time, told apart by tokens that end a word, others one by one."""
        plain = [w for w in new if len(w) <= _LONG_WORD and w.decode().isalpha()]
        rest = list(new.difference(plain))
        groups = [plain[i : i + _TOGETHER] for i in range(0, len(plain), _TOGETHER)]
        for words, e in zip(groups, self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)):
            ids = np.asarray(e.ids, "<u4")
            edges = [0, *(4 * np.flatnonzero(self.closes[ids]) + 4).tolist()]
            if len(edges) == len(words) + 1:
                data = ids.tobytes()
                self.words.update((w, data[a:b]) for w, a, b in zip(words, edges, edges[1:]))
            else:
                rest += words
        for word, e in zip(rest, self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)):
            (self.words if len(word) <= _LONG_WORD else long)[word] = np.asarray(e.ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
        for part, texts in text_chunks(batches, chars=_CHARS):
            rows = []
            for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def best_fit_plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, first sequence, pieces per sequence, offset) of best-fit decreasing.

    Long pieces go first; each takes the open sequence with the least room that holds it.
    Sequences with equal room are kept as ranges, so the work depends on the number of
    distinct lengths, not of pieces. The last run of a length may end within a sequence.
    """
    rooms: list[int] = []  # sorted; those that have open sequences
    opened: dict[int, list[tuple[int, int]]] = {}
    runs, sequences = [], 0

    def put(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in opened:
                opened[room] = []
                insort(rooms, room)
            opened[room].append((first, number))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = opened[room].pop()
                if not opened[room]:
                    del opened[room], rooms[at]
            else:
                room, first = capacity, sequences
                number = -(-left // (room // length))
                sequences += number
            each, offset = room // length, capacity - room
            full = min(number, left // each)
            runs.append((length, rank, first, each, offset))
            rank, left = rank + full * each, left - full * each
            put(room - each * length, first, full)
            if full < number and 0 < left:  # one sequence takes what is left, fewer than ``each``
                rank += left
                put(room - left * length, first + full, 1)
                full, left = full + 1, 0
            put(room, first + full, number - full)
    return runs


def place(ranked: DataFrame, runs: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """Sequence and offset of ranked pieces; the plan's size depends on the capacity only."""
    plan = np.array(sorted(runs), np.int64).reshape(-1, 5)
    keys = (plan[:, 0] << 44) + plan[:, 1]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = plan[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            step = rank - run[:, 1]
            sequence, offset = run[:, 2] + step // run[:, 3], run[:, 4] + step % run[:, 3] * length
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(look_up, PIECES + ", sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Pieces of all documents with the sequence and the offset that they take."""
    cut = materialize(pieces(docs, capacity, tokenizer), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    salts = max(64, sum(histogram.values()) // ROWS_PER_RANKING)
    dealt = salted(cut, salts, "doc_id", "piece", "ids_crc32")
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    shifts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    ranked = (
        dealt.withColumn("own", F.row_number().over(own))
        .join(shifts, ["length", "salt"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("shift") + F.col("own") - 1).alias("rank"))
    )
    return place(ranked, best_fit_plan(histogram, capacity))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of ``documents`` with their places."""
    return pack(table(spark, sf_dir, "documents"))
