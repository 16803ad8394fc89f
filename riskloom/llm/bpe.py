"""Byte-level BPE with vectorised pre-tokenisation, and decoding by offsets.

Texts of a batch become one array of code points. A table gives each point a class, and
neighbours settle what needs a look ahead (the last blank before a word, a contraction's
length). What is left is a small automaton, and each symbol is a function on its states.
Composing functions is associative, so the state before every character comes from a scan:
many lanes advance together over a composition table, then the lanes' totals are chained.
No regular expression runs on a text. The slices found are encoded by merging pairs in
order of rank, each distinct slice once while it stays in the task's cache.

Null text counts as empty: no ids. Repeated rows are encoded each for itself. An empty
table gives no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table, text_chunks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Encoded slices a task keeps; above it the cache starts anew.
CACHE_WORDS = 300_000
#: Slices of more bytes merge over a heap and are not kept.
LONG_WORD = 64

#: Characters, and ids, that a task handles at a time.
_STEP = 500_000

# The pre-tokenisation pattern's white space and contractions.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

LETTER, NUMBER, OTHER, APOSTROPHE, SPACE, WHITE, END = range(7)
#: Symbols of the automaton beyond LETTER, NUMBER and OTHER: contractions of one or two
#: letters, white space that more white space or the end follows, and the last before a word.
SHORT, LONG, GAP, LAST_SPACE, LAST_WHITE, STOP, NOTHING = range(3, 10)
#: States: what the character before belongs to. JOIN: a blank that the next slice takes in.
#: ONE, TWO: letters of a contraction still to come.
FREE, LETTERS, NUMBERS, OTHERS, GAPS, JOIN, ONE, TWO = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a slice starts, by symbol and state."""
    after = np.tile(np.arange(8, dtype=np.uint8), (10, 1))  # NOTHING keeps the state
    starts = np.zeros((10, 8), bool)
    for symbol, state in ((LETTER, LETTERS), (NUMBER, NUMBERS), (OTHER, OTHERS), (GAP, GAPS)):
        after[symbol] = state
        starts[symbol] = True
        starts[symbol, state] = False
        starts[symbol, JOIN] = symbol == GAP
    after[LETTER, [TWO, ONE]] = ONE, FREE
    starts[LETTER, [TWO, ONE]] = False
    for symbol, state in ((SHORT, ONE), (LONG, TWO)):
        after[symbol] = state
        after[symbol, [OTHERS, JOIN]] = OTHERS
        starts[symbol] = True
        starts[symbol, [OTHERS, JOIN]] = False
    for symbol, state in ((LAST_SPACE, JOIN), (LAST_WHITE, FREE), (STOP, FREE)):
        after[symbol] = state
        starts[symbol] = True
    return after, starts


def _closure(after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All functions that the symbols generate, symbols first, and the table of compositions."""
    known = [tuple(f) for f in after.tolist()]
    index = {f: i for i, f in reversed(list(enumerate(known)))}
    at = 0
    while at < len(known):
        for symbol in after.tolist():
            f = tuple(symbol[s] for s in known[at])
            if f not in index:
                index[f] = len(known)
                known.append(f)
        at += 1
    functions = np.array(known, np.uint8)
    table_ = np.array([[index[tuple(g[s] for s in f)] for g in known] for f in known], np.uint16)
    return functions, table_


AFTER, STARTS = _automaton()
FUNCTIONS, COMPOSED = _closure(AFTER)
_LANE = 256


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point, letters and numbers by the edition of Unicode that the library has.

    The library returns the bytes of a pattern's matches only, so one call per class lists its points.
    """
    import tiktoken

    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    single = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        matches = tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        out[np.frombuffer(bytes(matches).decode().encode("utf-32-le"), np.uint32)] = kind
    out[list(WHITE_SPACE)] = WHITE
    out[ord(" ")], out[ord("'")] = SPACE, APOSTROPHE
    return out


def _symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of the automaton; ``ends`` are the places of the characters between texts."""
    kind = classes()[points]
    kind[ends] = END
    follows = np.append(kind[1:], END)
    blank = (kind == SPACE) | (kind == WHITE)
    before_word = follows < SPACE
    out = kind.copy()
    out[kind == APOSTROPHE] = OTHER
    out[blank] = GAP
    out[(kind == SPACE) & before_word] = LAST_SPACE
    out[(kind == WHITE) & before_word] = LAST_WHITE
    out[kind == END] = STOP
    marks = np.flatnonzero(kind == APOSTROPHE)
    one = np.append(points, [0, 0])[marks + 1]
    two = np.append(points, [0, 0])[marks + 2]
    for letters in CONTRACTIONS:
        fits = one == ord(letters[0])
        if len(letters) == 2:
            fits &= two == ord(letters[1])
        out[marks[fits]] = LONG if len(letters) == 2 else SHORT
    return out


def states_before(symbols: np.ndarray) -> np.ndarray:
    """State before each symbol, by a scan over compositions of transition functions."""
    lanes = -(-len(symbols) // _LANE)
    scan = np.full(lanes * _LANE, NOTHING, np.uint16)
    scan[: len(symbols)] = symbols
    scan = np.ascontiguousarray(scan.reshape(lanes, _LANE).T)
    flat, width = COMPOSED.ravel(), np.uint32(len(COMPOSED))
    for step in range(1, _LANE):
        scan[step] = flat[scan[step - 1] * width + scan[step]]
    state, first = FREE, []
    for function in scan[-1].tolist():
        first.append(state)
        state = int(FUNCTIONS[function, state])
    first = np.array(first, np.uint8)
    before = np.empty((_LANE, lanes), np.uint8)
    before[0] = first
    before[1:] = FUNCTIONS[scan[:-1], first]
    return before.T.ravel()[: len(symbols)]


def slices(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Pre-tokens of all texts in turn, and for each text the number up to its end."""
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    symbols = _symbols(points, ends)
    begins = np.flatnonzero(STARTS[symbols, states_before(symbols)])
    width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
    places = (np.cumsum(width) - width)[begins]
    data = joined.encode()
    stops = np.searchsorted(begins, ends)  # each text's closing character is a slice of its own
    kept = np.ones(len(begins), bool)
    kept[stops] = False
    found = map(slice, places[kept].tolist(), np.append(places[1:], len(data))[kept].tolist())
    return list(map(data.__getitem__, found)), stops - np.arange(len(texts))


class Merger:
    """Ids of slices by merging the neighbours of least rank, leftmost first."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words: dict[bytes, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        if word in self.ranks:
            return [self.ranks[word]]
        return self._merge_long(word) if len(word) > LONG_WORD else self._merge_short(word)

    def _merge_short(self, word: bytes) -> list[int]:
        rank, none = self.ranks.get, 1 << 40
        parts = [word[i : i + 1] for i in range(len(word))]
        pairs = [rank(word[i : i + 2], none) for i in range(len(word) - 1)]
        while pairs and (least := min(pairs)) < none:
            at = pairs.index(least)
            parts[at] += parts.pop(at + 1)
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], none)
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], none)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, word: bytes) -> list[int]:
        """The same over a heap of pairs; stale entries are skipped."""
        rank, end = self.ranks.get, list(range(1, len(word) + 1))
        left = list(range(-1, len(word) - 1))
        heap = [(r, i, i + 2) for i in range(len(word) - 1) if (r := rank(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, at, stop = heapq.heappop(heap)
            middle = end[at]
            if not middle or middle == len(word) or end[middle] != stop:
                continue
            end[at], end[middle] = stop, 0
            if stop < len(word):
                left[stop] = at
                if (r := rank(word[at : end[stop]])) is not None:
                    heapq.heappush(heap, (r, at, end[stop]))
            if at and (r := rank(word[left[at] : stop])) is not None:
                heapq.heappush(heap, (r, left[at], stop))
        out, at = [], 0
        while at < len(word):
            out.append(self.ranks[word[at : end[at]]])
            at = end[at]
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in turn, and for each text the number of ids up to its end."""
        if len(self.words) > CACHE_WORDS:
            self.words = {}
        found, stops = slices(texts)
        known, long = self.words, {}
        for word in set(found):
            if word not in known:
                (known if len(word) <= LONG_WORD else long)[word] = np.array(self.merge(word), np.int32).tobytes()
        ids = [known.get(w) or long[w] for w in found] if long else list(map(known.__getitem__, found))
        counts = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) // 4
        return np.frombuffer(b"".join(ids), np.int32), np.append(counts, 0)[stops - 1] * (stops > 0)


@lru_cache(maxsize=2)
def _merger(path: str) -> Merger:
    return Merger(path)


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in a row, with each id's place and length."""
    by_id = {r: t for t, r in _merger(path).ranks.items()}
    tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    length = np.array(list(map(len, tokens)), np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(length) - length, length


def encode(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id and ids of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(ranks)
        for part, texts in text_chunks(batches, chars=_STEP):
            ids, stops = merger.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, stops), pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def _decoded(lists: pa.Array, data: np.ndarray, place: np.ndarray, length: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Bytes of each list of ids, and each token's first byte in them."""
    ids = lists.flatten().to_numpy()
    counts = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
    size = length[ids]
    stop = np.cumsum(size)
    decoded = data[np.repeat(place[ids] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]
    first = np.append(0, stop)[counts]
    binary = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(first.astype(np.int32)), pa.py_buffer(decoded)])
    own = (stop - size - np.repeat(first[:-1], np.diff(counts))).astype(np.int32)
    return binary, pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(own))


def decode(encoded: DataFrame, ranks: str = RANKS, offsets: bool = False) -> DataFrame:
    """Bytes that the ids stand for; with ``offsets``, also each token's first byte in them.

    The running sum of token lengths gives every token its place, and one gather from the
    vocabulary fills them all.
    """
    kinds = "doc_id long, ids array<int>, decoded binary" + (", offsets array<int>" if offsets else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(ranks)
        for batch in batches:
            counts = np.append(0, np.cumsum(batch.column(1).value_lengths().to_numpy()))
            edges = np.unique([0, *np.searchsorted(counts, np.arange(_STEP, counts[-1], _STEP)), batch.num_rows])
            for a, b in zip(edges, edges[1:]):  # a few rows, or one long one
                part = batch.slice(a, b - a)
                columns = [part.column(0), part.column(1), *_decoded(part.column(1), *vocabulary)]
                yield pa.RecordBatch.from_arrays(columns[: 4 if offsets else 3], names=["doc_id", "ids", "decoded", "offsets"][: 4 if offsets else 3])

    return encoded.select("doc_id", "ids").mapInArrow(run, kinds)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of all ``documents``."""
    return decode(encode(table(spark, sf_dir, "documents"))).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
