"""Surrogates: nothing personal left, formats kept, distinct entities stay distinct."""

import random
import re

import pytest

from riskloom.llm import surrogates as s
from tests.llm.helpers import documents


def one(text):
    (found,) = s.detect(text)
    return found


@pytest.mark.parametrize(("text", "kind"), [
    ("mail der.55@mail4.example.com, now", "email"), ("call +1 (017) 555-7713.", "phone"), ("(030) 555-0199 rings", "phone"),
    ("415-555-2671", "phone"), ("card 4539578763621486 ok", "card"), ("4539 5787 6362 1486", "card"), ("ip 97.51.17.173.", "ip"),
    ("id 123-45-6789", "ssn"), ("DE89 3704 0044 0532 0130 00", "iban"),
])
def test_kinds_and_formats(text, kind):
    start, end, got, entity = one(text)
    assert got == kind
    mention = text[start:end]
    new = s.render(kind, entity, s.surrogate(kind, entity, 0), mention)
    assert new != mention and s.canonical(kind, new) == s.surrogate(kind, entity, 0)
    if kind != "ip":
        assert re.sub("[a-z]", "a", re.sub("[0-9]", "0", new)) == re.sub("[a-z]", "a", re.sub("[0-9]", "0", mention)) or kind == "iban"
        assert len(new) == len(mention)
    if kind == "card":
        assert s.luhn(s._digits(new)) == s.luhn(s._digits(mention)) == 0
    assert s.detect(text[:start] + new + text[end:])[0][2] == kind


@pytest.mark.parametrize("text", ["", "version 1.2.3.4.5", "999.1.1.1", "room 12345", "2024-01-02", "DE00 ABCD EFGH IJKL", "Die Frau ging", "a@b", "1234567", "12:30:45"])
def test_clean_texts(text):
    assert s.detect(text) == []


def test_names_keep_gender_and_script():
    text = "Mr John Smith met Frau Schmidt and г-жа Анна Иванова; Mr. SMITH left. Κυρία Μαρία."
    kinds = [(k, text[a:b]) for a, b, k, _ in s.detect(text)]
    assert kinds == [("given_m", "John"), ("surname", "Smith"), ("surname", "Schmidt"), ("given_f", "Анна"), ("surname", "Иванова"), ("surname", "SMITH"), ("surname", "Μαρία")]
    assert s.surrogate("given_f", "анна", 0).endswith("ина") and s.surrogate("given_m", "john", 0).endswith("us")
    assert s.render("surname", "smith", s.surrogate("surname", "smith", 0), "SMITH").isupper()


def test_permutations():
    seen = {tuple(s.permute([a, b, c], [3, 10, 4], "k")) for a in range(3) for b in range(10) for c in range(4)}
    assert len(seen) == 120 and all(a < 3 and b < 10 and c < 4 for a, b, c in seen)
    assert len({s.surrogate("ssn", f"{i:09d}", 0) for i in range(3000)}) == 3000
    assert len({s.surrogate("ip", f"{i % 223 + 1}.0.0.{i // 223}", 0) for i in range(2000)}) == 2000
    assert s.permute([], [], "k") == [] and s.permute([1], [2], "k") in ([0], [1])


def test_collisions_are_drawn_anew(spark):
    rows = [("surname", f"{a}{b}{c}") for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefgh"]
    rows += [("surname", s.surrogate("surname", rows[0][1], 0))]
    got = s.assign(spark.createDataFrame(rows, "kind string, entity string")).collect()
    assert len(got) == len(rows) and len({r.surrogate for r in got}) == len(rows)
    assert not {r.surrogate for r in got} & {e for _, e in rows}


def test_texts(spark):
    rng = random.Random(4)
    texts = [None, "", "clean text", "Mail a.b@c.org or A.B@c.org.", "Mr Smith: 4539578763621486, +1 (017) 555-7713 4539578763621486"]
    texts += [f"x {rng.randrange(256)}.{rng.randrange(256)}.1.{i} y" for i in range(50)] + ["x 1.1.1.1 " * 20_000]
    docs = documents(spark, texts).selectExpr("*", "1 AS kind", "'s' AS surrogate").union(documents(spark, ["a.b@c.org"], first=3).selectExpr("*", "1", "'s'"))
    rows = sorted(s.replace(docs).collect(), key=lambda r: (r.doc_id, -r.n_chars))
    assert len(rows) == len(texts) + 1 and [r.text for r in rows[:3]] == texts[:3]
    by_id = {r.doc_id: r for r in rows if r.text != rows[4].text}
    mail = re.findall(r"\S+@\S+[a-z]", rows[3].text)
    assert mail[0] == mail[1].lower() == rows[4].text and mail[0] != "a.b@c.org" and mail[1][0].isupper()
    cards = re.findall(r"\d{16}", by_id[4].text)
    assert cards[0] == cards[1] != "4539578763621486" and "Smith" not in by_id[4].text
    assert len({by_id[5 + i].text for i in range(50)}) == len(set(texts[5:55]))
    assert by_id[55].replaced == 20_000 and len(set(by_id[55].text.split())) == 2
    originals = {e for t in texts if t for _, _, _, e in s.detect(t)}
    assert not any(e in originals for r in rows if r.text for _, _, _, e in s.detect(r.text))


def test_given_documents_and_empty_table(spark):
    sf = "/root/testdata/sf0.01"
    before = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    after = {r.doc_id: r for r in s.query(spark, sf).collect()}
    assert set(before) == set(after) and any(r.replaced for r in after.values())
    for doc_id, text in before.items():
        found = s.detect(text)
        assert after[doc_id].replaced == len(found) and (found or after[doc_id].text == text)
        assert all(text[a:b] not in after[doc_id].text for a, b, _, _ in found)
    assert s.replace(documents(spark, ["a"]).limit(0)).count() == 0


def test_later_mentions_without_title():
    text = "Mr John Smith came. Smith left; John Smith wrote, SMITH's pen. John slept. A smith and Smithson stay, a.Smith@c.org too."
    got = [(k, text[a:b]) for a, b, k, _ in s.detect(text)]
    assert got == [("given_m", "John"), ("surname", "Smith"), ("surname", "Smith"), ("given_m", "John"), ("surname", "Smith"), ("surname", "SMITH"), ("given_m", "John"), ("email", "a.Smith@c.org")]
    assert s.detect("Smith left, John Smith wrote.") == []
