"""Secret scan: keyword automaton, anchored expressions near hits, checksums inside.

An Aho-Corasick automaton runs once over each text, on bytes with ASCII letters lowered, so
a place in it is a place in the text. Expressions are tried only where a keyword starts.
Long runs of hexadecimal digits have no keyword; they are found by folding each byte to
its class and searching the folded text for the shortest run.

Kinds, in the order in which they are listed: ``assign`` (a named value), ``access`` (an
access key id), ``hex`` (a long run of digits), and those that carry a checksum and count
only if it is right: ``forge`` and ``registry`` (tokens ending in a base-62 CRC-32),
``wallet`` (extended private keys, Base58Check). Matches of a kind do not overlap; kinds may.

Null text counts as empty: nothing found. Repeated rows are scanned each for itself. An
empty table gives no rows. Places are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table, text_chunks

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "forge", "registry", "wallet")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Keywords, token formats and alphabets.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "api_key", "apikey"),
    "access": ("akia",),
    "forge": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "registry": ("npm_",),
    "wallet": ("xprv",),
}
PATTERNS = {
    "assign": re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "forge": re.compile(rb"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "registry": re.compile(rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "wallet": re.compile(rb"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"),
}
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

_HEX = b"0123456789abcdef"
_FOLD = bytes(ord("h") if b in _HEX else ord(".") for b in range(256))
_RUN = b"h" * MIN_HEX

FOUND = "array<struct<kind: string, start: int, end: int>>"


def crc_in_base62(value: bytes) -> bytes:
    """CRC-32 of the value in six digits."""
    number, digits = zlib.crc32(value), []
    for _ in range(6):
        number, digit = divmod(number, 62)
        digits.append(BASE62[digit])
    return bytes(reversed(digits))


def base58check(text: bytes) -> bool:
    """The last four bytes are those of the double SHA-256 of the rest."""
    number = 0
    for c in text:
        number = number * 58 + BASE58.index(c)
    data = number.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


def _holds(kind: str, match: re.Match[bytes]) -> bool:
    """Whether a match is long enough or its checksum right; it takes up its place either way."""
    if kind == "assign":
        return len(match[1]) >= MIN_VALUE
    if kind == "access":
        return len(match[0]) >= MIN_ACCESS
    if kind == "wallet":
        return base58check(match[0])
    return crc_in_base62(match[1]) == match[2]


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets, by start and then by kind."""
    data = text.encode()
    hits = [(at + 1 - size, kind) for at, (kind, size) in _automaton().iter(data.lower().decode("latin-1"))]
    found, done = [], dict.fromkeys(KINDS, 0)
    for start, kind in sorted(hits):
        if start >= done[kind] and (match := PATTERNS[kind].match(data, start)):
            done[kind] = match.end()
            if _holds(kind, match):
                found.append((start, match.end(), kind))
    folded = data.translate(_FOLD)
    at = folded.find(_RUN)
    while at >= 0:
        end = folded.find(b".", at)
        end = len(data) if end < 0 else end
        found.append((at, end, "hex"))
        at = folded.find(_RUN, end)
    if not found:
        return []
    points, last, place = {}, 0, 0
    for edge in sorted({p for start, end, _ in found for p in (start, end)}):
        place += len(data[last:edge].decode())
        points[edge], last = place, edge
    return sorted(((k, points[a], points[b]) for a, b, k in found), key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and the secrets of every text."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in scan(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], names=["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, found {FOUND}")


def without_secrets(text: str) -> str:
    """The text with every stretch of secrets replaced by the name of its first kind."""
    parts, at = [], 0
    for kind, start, end in scan(text):
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, with secrets replaced in ``text`` and ``n_chars`` brought in line.

    Rows without a secret stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in text_chunks(batches):
            at = part.schema.get_field_index("text")
            old = part.column(at).to_pylist()
            new = [t and without_secrets(t) for t in old]
            columns = part.columns
            columns[at] = pa.array(new, part.schema.field(at).type)
            if (n := part.schema.get_field_index("n_chars")) >= 0:
                kept = part.column(n).to_pylist()
                columns[n] = pa.array([k if a == b else len(b) for k, a, b in zip(kept, old, new)], part.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def _of(kind: str) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the secrets in all ``documents``."""
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(_of(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
    )
