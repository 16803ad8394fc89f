"""Phrase collocations: counts of all phrases by marginalising the longest windows.

Text is lower-cased (A-Z only), cut into pieces at ``.,;:!?`` and line breaks, and pieces
into words. Every word occurrence opens one window: the word and the ``LONGEST`` - 1 words
that lead on from it, padded with nulls behind the end of the piece. Only these windows are
counted. ROLLUP over their columns then sums ever shorter prefixes, which are the counts of
all shorter phrases: every occurrence of a phrase is the prefix of exactly one window.

A phrase counted fewer than ``LEAST`` times can be neither a candidate nor a part of one,
nor can any phrase that holds it. So first words and neighbours, then phrases of three words
and so on are counted by a hash, each size only where the two next shorter phrases are
frequent enough, and a window is padded from where its prefix is too rare. Hashes travel
packed, a few bytes each, by ranges of their values. The frequent ones go into a Bloom filter
of bounded size. Equal hashes and what the filter lets through by chance are only counted for
nothing: words are compared in the windows, and no frequent phrase loses an occurrence.

For every cut of a candidate into a first part and a rest, their counts l and r and the
phrase's a give floor(2000000 * a / (l + r)); the lowest cut counts, ties to the shortest
first part. Candidates that lie within a longer one with at least ``WITHIN`` percent of
their count are dropped. Scores are computed in decimals of 38 digits.

Null and empty texts have no words; null languages count as ``und``. Repeated rows are
counted each. A text is cut in steps of bounded size, whatever its length. An empty table
gives no rows. Ranks follow score, count and the bytes of the phrase. Columns other than
text and lang are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import mix64, salted, table, text_chunks
from riskloom.llm.frequent import Filter, frequent, ranges_for
from riskloom.session import materialize

LONGEST, LEAST, WITHIN, TOP = 4, 30, 80, 2_000
UNKNOWN = "und"
#: Bytes of text for a word, to guess the number of hashes.
BYTES_A_WORD = 6
#: Bytes of text that are cut into words at a time.
STEP = 2_000_000
#: Candidates of a language that are ranked in one task at first.
RANK_ROWS = 200_000

_CUTS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
_SEED, _PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


def _pieces(text: bytes) -> Iterator[bytes]:
    """Parts of the lower-cased text that end at a cut, of about ``STEP`` bytes."""
    text, start = text.lower().translate(_CUTS), 0
    while start < len(text):
        stop = text.rfind(b"\n", start, start + STEP) if len(text) - start > STEP else len(text)
        if stop <= start:
            stop = text.find(b"\n", start + STEP)
            stop = len(text) if stop < 0 else stop
        yield text[start:stop]
        start = stop + 1


class Chunk:
    """The words of some texts of one language: ``code`` by occurrence, ``follows`` where the next is in the same piece."""

    def __init__(self, lang: str, parts: list[bytes]):
        codes: dict[bytes, int] = defaultdict(lambda: len(codes))
        code: list[int] = []
        ends: list[int] = []
        for part in parts:
            for piece in part.split(b"\n"):
                # A piece holds no ASCII white space but blanks and tabs.
                if words := piece.split():
                    code += [codes[w] for w in words]
                    ends.append(len(code) - 1)
        self.words = list(codes)
        self.code = np.array(code, np.int64)
        self.follows = np.ones(len(code), bool)
        self.follows[ends] = False
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        hashed = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))
        #: Hash of the word at each place.
        self.word = mix64(hashed)[self.code]

    def grams(self, filters: list[Filter | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """By size, the hash of the phrase at each place, and where it may be frequent.

        The filters tell by size; one more size is given where all shorter phrases may be.
        """
        hashed, some = self.word, np.ones(len(self.code), bool)
        words, following = np.append(self.word, np.uint64(0)), np.append(self.follows, False)
        for size in range(1, LONGEST + 1):
            if size > 1:
                last = np.minimum(np.arange(len(hashed)) + size - 1, len(hashed))
                hashed = mix64(hashed * _PAIR + words[last] + _SEED)
                # Both phrases that are one word shorter must be there.
                some = some & np.append(some[1:], False) & following[last - 1]
            if size > len(filters):
                yield hashed, some
                return
            if known := filters[size - 1]:
                some[some] = known.has(hashed[some])
            yield hashed, some

    def windows(self, filters: list[Filter | None]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct windows as rows of word codes (-1 for none) and their counts."""
        code, place = np.append(self.code, -1), np.arange(len(self.code))
        # The lead-th word behind each one, as long as the phrase up to it may be frequent.
        columns = [np.where(some, code[np.minimum(place + lead, len(place))], -1) for lead, (_, some) in enumerate(self.grams(filters))]
        if not len(self.code):
            return np.zeros((0, LONGEST), np.int64), np.zeros(0, np.int64)
        # Two codes, each below 2^31, fit one number: half as many columns to sort.
        order = np.lexsort([(columns[i] + 1) << 32 | (columns[i + 1] + 1) for i in range(0, LONGEST, 2)])
        new = np.any([np.diff(c[order], prepend=-2) != 0 for c in columns], axis=0)
        starts = np.flatnonzero(new)
        return np.stack([c[order[starts]] for c in columns], axis=1), np.diff(starts, append=len(order))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Chunk]]:
    for part, _ in text_chunks(batches):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
            for piece in _pieces(text or b""):
                if len(piece) >= STEP // 2:
                    yield lang, Chunk(lang, [piece])
                else:
                    by_lang.setdefault(lang, []).append(piece)
        for lang, pieces in by_lang.items():
            yield lang, Chunk(lang, pieces)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")


def frequent_hashes(docs: DataFrame, filters: list[Filter | None], ranges: int, least: int = LEAST) -> DataFrame:
    """Hashes of the phrases that occur often enough and are one word longer than the filters tell of.

    Where the filters tell nothing, shorter phrases are counted along.
    """
    shared = docs.sparkSession.sparkContext.broadcast([f and f.parts() for f in filters])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        known = [f and Filter(*f) for f in shared.value]
        for _, chunk in _chunks(batches):
            for (hashed, some), told in zip(chunk.grams(known), [*known, None]):
                if not told:
                    yield hashed[some]

    return frequent(_texts(docs), hashes, ranges, least)


def windows(docs: DataFrame, filters: list[Filter | None]) -> DataFrame:
    """lang, the words of the padded longest windows, and their number."""
    shared = docs.sparkSession.sparkContext.broadcast([f and f.parts() for f in filters])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [f and Filter(*f) for f in shared.value]
        for lang, chunk in _chunks(batches):
            rows, n = chunk.windows(known)
            words = pa.array(chunk.words, pa.binary())
            columns = [words.take(pa.array(np.where(c < 0, 0, c), mask=c < 0)).cast(pa.string()) for c in rows.T]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), *columns, pa.array(n.astype(np.int64))], names=["lang", *_WORDS, "n"])

    kinds = ", ".join(f"{w} string" for w in _WORDS)
    found = _texts(docs).mapInArrow(run, f"lang string, {kinds}, n long")
    return found.groupBy("lang", *_WORDS).agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Counts of the phrases with at least ``least`` occurrences, and the words of each language.

    The first has lang, words (an array) and f; the second lang and n.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranges = ranges_for(size // BYTES_A_WORD)
    filters: list[Filter | None] = [None]
    while len(filters) < LONGEST:
        found = Filter.of(materialize(frequent_hashes(docs, filters, ranges, least), "frequent-hashes"), ranges)
        filters = [found, found] if filters == [None] else [*filters, found]
    rolled = windows(docs, filters).rollup("lang", *_WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # At a level of k words the last LONGEST - k columns are summed over.
    size = LONGEST - F.round(F.log2(F.col("level") + 1)).cast("int")
    padded = F.array(*_WORDS)
    kept = rolled.select("lang", "f", size.alias("size"), F.slice(padded, 1, F.greatest(size, F.lit(0))).alias("words"))
    whole = (F.col("size") > 0) & (F.col("f") >= least) & F.get("words", F.col("size") - 1).isNotNull()
    kept = materialize(kept.where((F.col("size") == 0) | whole), "phrases")
    return kept.where("size > 0").select("lang", "words", "f"), kept.where("size = 0").select("lang", F.col("f").alias("n"))


def _joined(words: Column | str) -> Column:
    return F.array_join(words, " ")


def collocations(docs: DataFrame, least: int = LEAST, within: int = WITHIN, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` phrases of each language."""
    counts, totals = phrase_counts(docs, least)
    named = materialize(counts.select("lang", _joined("words").alias("phrase"), "words", "f"), "named-phrases")
    candidates = named.where(F.size("words") > 1)

    # The tables of phrases grow with the documents: one plan at every size, without a broadcast.
    lookup = named.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "words", cut)
    sides = cuts.select(
        "lang", "phrase", "a", "k",
        _joined(F.slice("words", 1, F.col("k"))).alias("first"),
        _joined(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))).alias("rest"),
    )
    with_first = sides.join(lookup.withColumnsRenamed({"part": "first", "part_f": "l"}).hint("merge"), ["lang", "first"])
    with_rest = with_first.join(lookup.withColumnsRenamed({"part": "rest", "part_f": "r"}).hint("merge"), ["lang", "rest"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    product = F.lit(2_000_000).cast("decimal(7,0)") * wide("a")
    # Whole-number division: exact, and never negative here.
    score = F.call_function("div", product.cast("decimal(38,0)"), (wide("l") + wide("r")).cast("decimal(38,0)"))
    lowest = with_rest.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("cut"))

    inner = candidates.where(F.size("words") > 2).select("lang", "words", F.col("f").alias("longer"))
    spans = [F.struct(F.lit(at).alias("at"), F.lit(size).alias("size")) for size in range(2, LONGEST) for at in range(1, LONGEST - size + 2)]
    span = inner.select("lang", "words", "longer", F.explode(F.array(*spans)).alias("s"))
    fits = (F.col("s.size") < F.size("words")) & (F.col("s.at") + F.col("s.size") - 1 <= F.size("words"))
    held = span.where(fits).select("lang", _joined(F.slice("words", F.col("s.at"), F.col("s.size"))).alias("phrase"), "longer")
    longest = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    exact = lambda c: F.col(c).cast("decimal(25,0)")
    swallowed = exact("longer") * F.lit(100) >= exact("a") * F.lit(within)
    kept = lowest.join(longest.hint("merge"), ["lang", "phrase"], "left").where(F.coalesce(~swallowed, F.lit(True)))
    scored = materialize(kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "scored")

    # First the best of each salt, so no task ranks a whole language.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salts = max(1, scored.count() // RANK_ROWS)
    some = salted(scored, salts, "phrase").withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    ranked = some.where(F.col("place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language of the ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
), grams AS (
  SELECT lang, g AS size, unnest(list_transform(generate_series(1, len(w) - g + 1), lambda i: array_to_string(w[i : i + g - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3), (4)) sizes(g) WHERE len(w) >= g
), f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 30),
cuts AS (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM c),
scored AS (
  SELECT cuts.lang, cuts.size, cuts.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score FROM cuts
  JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:k], ' ') JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (
  SELECT lang, a, array_to_string(w[i : i + g - 1], ' ') AS phrase FROM (SELECT *, unnest(generate_series(1, size - g + 1)) AS i FROM c, (VALUES (2), (3)) sizes(g) WHERE g < size)
), longest AS (SELECT lang, phrase, max(a) AS longer FROM spans GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
  SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest LEFT JOIN longest USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
) JOIN totals USING (lang) WHERE rank <= 2000
"""
