"""Personal data: detection and keyed surrogates of the same type.

Detected entities (e-mail addresses, phone, card, account and social security numbers,
network addresses, names after a title) are replaced by surrogates that follow from a key
and the entity alone, so every mention of an entity gets the same one, in any document:

* numbers keep their length, separators, leading country code and, where they had them,
  a valid Luhn digit or IBAN checksum; network addresses stay addresses;
* e-mail addresses keep letters as letters, digits as digits, and their last two labels;
* names keep the gender of their title and their script, and a surname its own surrogate
  with or without a given name before it. Capitals follow the mention. Once a title has
  given a name away, every capitalised mention of it in the same document is replaced.

Numbers and addresses go through a keyed permutation of their format (a Feistel network
over mixed radixes), names through a keyed choice of syllables. A table of all distinct
entities then checks collisions: a surrogate that is itself an entity of the corpus, or that
two entities share, is drawn anew until none is left. Texts are rewritten from that table.

Null and empty texts stay as they are. Repeated rows get equal texts. An empty table gives
no rows. The column ``entities`` is reserved; others are carried.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import table, text_chunks
from riskloom.session import materialize

KEY = "surrogates-1"

# Titles by gender, alphabets and syllables by script.
TITLES = {
    "m": ("Mr", "Herr", "Señor", "Monsieur", "г-н", "господин", "κ.", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "г-жа", "госпожа", "κα", "Κυρία"),
}
SYLLABLES = {
    "latin": ("al", "be", "cor", "da", "el", "fi", "gar", "ha", "il", "jo", "ka", "lo", "mar", "ne", "or", "pe", "ro", "sa", "ti", "ve"),
    "cyrillic": ("ал", "бе", "вор", "га", "ди", "же", "за", "ки", "ло", "мар", "не", "ор", "пе", "ро", "са", "ти", "фе", "ха", "ше", "ян"),
    "greek": ("αλ", "βε", "γα", "δη", "ελ", "ζα", "θε", "κα", "λο", "μαρ", "νε", "ορ", "πε", "ρο", "σα", "τι", "φε", "χα", "ψι", "ων"),
}
ENDINGS = {
    ("latin", "m"): "us", ("latin", "f"): "ina", ("latin", ""): "en",
    ("cyrillic", "m"): "ей", ("cyrillic", "f"): "ина", ("cyrillic", ""): "енко",
    ("greek", "m"): "ος", ("greek", "f"): "ινα", ("greek", ""): "ακης",
}

_NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_PATTERNS = (
    ("email", re.compile(r"[A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"), re.compile("@")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), re.compile(r"[A-Z]{2}[0-9]{2}")),
    ("card", re.compile(r"(?<![\w.+-])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![\w-]|\.[0-9])"), re.compile(r"[0-9]{4}")),
    ("ssn", re.compile(r"(?<![\w.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]|\.[0-9])"), re.compile(r"[0-9]-[0-9]")),
    ("phone", re.compile(r"(?<![\w.])(?:\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}){2,5}|\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![\w-]|\.[0-9])"), re.compile(r"[0-9]{2}")),
    ("ip", re.compile(r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|\.[0-9])"), re.compile(r"[0-9]\.[0-9]")),
)
#: Words that may be a name; a possessive ending is not part of one.
_WORD = re.compile(r"(?<![^\W_])[^\W\d_]+(?:[-'’](?!s\b)[^\W\d_]+)*(?![^\W_])")
_TITLED = re.compile(r"(?<!\w)(" + "|".join(re.escape(t) for own in TITLES.values() for t in own) + rf")\.?\x20({_NAME})(?:\x20({_NAME}))?")


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isascii() and c.isdigit())


def luhn(digits: str) -> int:
    """0 where the last digit is the right check digit."""
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10


def _iban_rest(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def canonical(kind: str, found: str) -> str | None:
    """The entity behind a mention; None where the mention is not one after all."""
    if kind == "email":
        return found.lower()
    if kind == "iban":
        plain = found.replace(" ", "")
        return plain if len(plain) >= 15 and _iban_rest(plain) == 1 else None
    if kind == "ip":
        parts = found.split(".")
        return ".".join(str(int(p)) for p in parts) if all(int(p) < 256 for p in parts) else None
    if kind in ("card", "ssn", "phone"):
        return _digits(found)
    return found.casefold()


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, entity) of mentions, which do not overlap; earlier kinds win."""
    found: list[tuple[int, int, str, str]] = []
    given: dict[str, str] = {}
    surnames: set[str] = set()

    def add(start: int, end: int, kind: str) -> None:
        if (entity := canonical(kind, text[start:end])) is not None and all(end <= a or b <= start for a, b, _, _ in found):
            found.append((start, end, kind, entity))

    for kind, pattern, hint in _PATTERNS:
        if hint.search(text):
            for m in pattern.finditer(text):
                add(*m.span(), kind)
    if any(t in text for own in TITLES.values() for t in own):
        for m in _TITLED.finditer(text):
            gender = "m" if m[1] in TITLES["m"] else "f"
            names = [k for k in (2, 3) if m[k] and m[k][0].isupper()]
            if names[:1] == [2]:
                if len(names) == 2:
                    add(*m.span(2), f"given_{gender}")
                    given.setdefault(m[2].casefold(), f"given_{gender}")
                add(*m.span(names[-1]), "surname")
                surnames.add(m[names[-1]].casefold())
        found = sorted(found + _untitled(text, found, given, surnames))
    return sorted(found)


def _untitled(text: str, found: list[tuple[int, int, str, str]], given: dict[str, str], surnames: set[str]) -> list[tuple[int, int, str, str]]:
    """Further capitalised mentions of the names found behind a title: each whole word of them."""
    if not surnames:
        return []
    starts, out, at = sorted((a, b) for a, b, _, _ in found), [], 0
    for m in _WORD.finditer(text):
        entity = m[0].casefold()
        kind = "surname" if entity in surnames else given.get(entity)
        if kind is None or not m[0][0].isupper():
            continue
        while at < len(starts) and starts[at][1] <= m.start():
            at += 1
        if at == len(starts) or m.end() <= starts[at][0]:
            out.append((*m.span(), kind, entity))
    return out


def _number(key: str, *parts: object) -> int:
    return int.from_bytes(hmac.new(key.encode(), "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest(), "big")


def permute(values: list[int], radixes: list[int], *key: object) -> list[int]:
    """A keyed permutation of all value lists with these radixes."""
    half = len(values) // 2
    sizes = [1, 1]
    sides = [0, 0]
    for i, (v, r) in enumerate(zip(values, radixes)):
        side = int(i >= half)
        sides[side], sizes[side] = sides[side] * r + v, sizes[side] * r
    for turn in range(8):
        to = turn % 2
        sides[to] = (sides[to] + _number(*key, turn, radixes, sides[1 - to])) % sizes[to]
    out = []
    for i in range(len(values) - 1, -1, -1):
        side = int(i >= half)
        sides[side], v = divmod(sides[side], radixes[i])
        out.append(v)
    return out[::-1]


def _alike(s: str, *key: object) -> str:
    """Letters and digits of a text in ASCII, permuted within their class; the rest stays."""
    spots = [(i, ord(c) - 48, 10) if c.isdigit() else (i, ord(c) - 97, 26) for i, c in enumerate(s) if c.isascii() and c.isalnum()]
    out = list(s)
    for (i, _, radix), v in zip(spots, permute([v for _, v, _ in spots], [r for _, _, r in spots], *key)):
        out[i] = chr(v + (48 if radix == 10 else 97))
    return "".join(out)


def script(name: str) -> str:
    point = ord(name[0])
    return "cyrillic" if 0x400 <= point < 0x530 else "greek" if 0x370 <= point < 0x400 else "latin"


def surrogate(kind: str, entity: str, attempt: int, key: str = KEY) -> str:
    """The entity's surrogate, as an entity of the same kind."""
    own = (key, kind, attempt)
    if kind == "email":
        labels = entity.rsplit(".", 2) if entity.count(".", entity.index("@")) > 1 else entity.rsplit(".", 1)
        return ".".join([_alike(labels[0], *own), *labels[1:]])
    if kind == "iban":
        plain = entity[:2] + "00" + _alike(entity[4:].lower(), *own, entity[:2]).upper()
        return f"{plain[:2]}{98 - _iban_rest(plain):02d}{plain[4:]}"
    if kind == "ip":
        number = 0
        for part in entity.split("."):
            number = number * 256 + int(part)
        usual = 1 <= number >> 24 < 224
        while True:  # walk the permutation until the address is a usual one again
            a, b = permute([number >> 16, number & 0xFFFF], [65536, 65536], *own)
            number = (a << 16) + b
            if not usual or 1 <= number >> 24 < 224:
                return ".".join(str(number >> s & 255) for s in (24, 16, 8, 0))
    if kind in ("card", "ssn", "phone"):
        kept, rest = (entity[:-10], entity[-10:]) if kind == "phone" else ("", entity)
        if kind == "card" and luhn(entity) == 0:
            body = _alike(entity[:-1], *own)
            return body + str(-luhn(body + "0") % 10)
        return kept + _alike(rest, *own, kept)
    letters, gender = script(entity), kind.removeprefix("given_") if kind != "surname" else ""
    number, name = _number(*own, entity), ""
    syllables = SYLLABLES[letters]
    for _ in range(2 + number % 2 + attempt // 4):
        number, at = divmod(number // 2, len(syllables))
        name += syllables[at]
    return name + ENDINGS[letters, gender]


def render(kind: str, entity: str, new: str, mention: str) -> str:
    """The surrogate in the format of the mention."""
    if kind == "ip":
        return new
    if kind in ("card", "ssn", "phone", "iban"):
        fill = iter(new)
        return "".join(next(fill) if c.isalnum() else c for c in mention)
    if kind == "email":
        return "".join(c.upper() if m.isupper() else c for c, m in zip(new, mention))
    return new.upper() if len(mention) > 1 and mention.isupper() else new.capitalize() if mention[0].isupper() else new


_ENTITIES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("entity", pa.string())]))
_ENTITIES_SQL = "array<struct<start: int, end: int, kind: string, entity: string>>"


def find_entities(docs: DataFrame) -> DataFrame:
    """All columns, and the mentions in ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            found = [[{"start": a, "end": b, "kind": k, "entity": e} for a, b, k, e in detect(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, _ENTITIES)], names=[*part.schema.names, "entities"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, entities {_ENTITIES_SQL}")


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """kind, entity and its surrogate, which no other entity is or has."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "entity", "attempt")))
            drawn = [surrogate(k, e, a, key) for k, e, a in rows]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "entity", "attempt")), pa.array(drawn, pa.string())], names=["kind", "entity", "attempt", "surrogate"])

    known = materialize(entities.select("kind", "entity").distinct(), "entities")
    drawn = known.withColumn("attempt", F.lit(0))
    while True:
        drawn = drawn.select("kind", "entity", "attempt").mapInArrow(draw, "kind string, entity string, attempt int, surrogate string")
        # Whoever was drawn at the earliest attempt keeps a surrogate that several have.
        sharing = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("attempt", "entity")) > 1
        taken = known.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("taken"))
        checked = materialize(drawn.withColumn("sharing", sharing).join(taken, ["kind", "surrogate"], "left"), "surrogates")
        clash = F.col("sharing") | F.col("taken").isNotNull()
        if checked.where(clash).isEmpty():
            return checked.select("kind", "entity", "surrogate")
        drawn = checked.select("kind", "entity", (F.col("attempt") + clash.cast("int")).alias("attempt"))


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """All rows and columns, with surrogates in ``text``; ``replaced`` counts them."""
    found = find_entities(docs)
    without = found.where(F.size("entities") == 0).drop("entities").withColumn("replaced", F.lit(0).cast("long"))
    holding = materialize(found.where(F.size("entities") > 0).withColumn("_row", F.monotonically_increasing_id()), "personal")
    mentions = holding.select("_row", F.explode("entities").alias("e")).select("_row", "e.kind", "e.entity").distinct()
    names = assign(mentions, key)
    own = mentions.join(names, ["kind", "entity"]).groupBy("_row").agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias("_names"))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            at = part.schema.get_field_index("text")
            new, counts = [], []
            for text, mentions, names in zip(texts, part.column("entities").to_pylist(), part.column("_names").to_pylist()):
                known = {(n["kind"], n["entity"]): n["surrogate"] for n in names}
                parts, last = [], 0
                for m in mentions:
                    parts += [text[last : m["start"]], render(m["kind"], m["entity"], known[m["kind"], m["entity"]], text[m["start"] : m["end"]])]
                    last = m["end"]
                new.append("".join([*parts, text[last:]]))
                counts.append(len(mentions))
            columns = [pa.array(new, part.schema.field(i).type) if i == at else c for i, c in enumerate(part.columns)]
            kept = [(n, c) for n, c in zip(part.schema.names, columns) if n not in ("entities", "_names")]
            yield pa.RecordBatch.from_arrays([*(c for _, c in kept), pa.array(counts, pa.int64())], names=[*(n for n, _ in kept), "replaced"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    rewritten = holding.join(own, "_row").drop("_row").mapInArrow(rewrite, f"{kinds}, replaced long")
    return without.union(rewritten)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with surrogates for personal data."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return replace(docs)
