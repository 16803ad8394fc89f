"""Sentences of a case, on rows written by hand."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.functions import scalar as X
from riskloom.operators.decide import Sentence, case_reasons

AMOUNT, CEILING, NIGHT = "amount 5.0 times the 24 h mean of this card", "above the p95 of legitimate transactions", "at night, when the base rate of fraud is high"


def case(amount=2450.0, usual=490.0, above=1.0, night=1.0, **weights):
    values, parts = [0.0] * len(S.FEATURE_COLUMNS), [0.0] * len(S.FEATURE_COLUMNS)
    at = S.FEATURE_COLUMNS.index
    given = {"log1p_amt": None if amount is None else math.log1p(amount), "rolling_amt_mean_24h": usual, "amt_gt_p95_legit": above, "is_night": night}
    for name, v in given.items():
        values[at(name)] = v
    for name, w in ({"log1p_amt": 0.5, "amt_gt_p95_legit": 0.3, "is_night": 0.2} | weights).items():
        parts[at(name)] = w
    return values, parts


CASES = [
    (case(), f"{AMOUNT}; {CEILING}; {NIGHT}"),
    (case(rolling_amt_mean_24h=-0.25), f"{CEILING}; {AMOUNT}; {NIGHT}"),  # 0.25 together
    (case(hour_sin=0.4, hour=0.1), f"{NIGHT}; {AMOUNT}; {CEILING}"),
    (case(is_night=0.3), f"{AMOUNT}; {CEILING}; {NIGHT}"),  # equal weights stay in order
    (case(log1p_amt=-0.1), f"{CEILING}; {NIGHT}"),  # lowers the score
    (case(usual=None), f"{CEILING}; {NIGHT}"),
    (case(usual=0.0), f"{CEILING}; {NIGHT}"),
    (case(usual=-3.0), f"{CEILING}; {NIGHT}"),
    (case(usual=float("nan")), f"{CEILING}; {NIGHT}"),
    (case(amount=None), f"{CEILING}; {NIGHT}"),
    (case(amount=float("inf")), f"{CEILING}; {NIGHT}"),
    (case(amount=900.0, above=None, night=0.0), None),
    (case(amount=1e9, usual=1.0, above=0.0, night=None), "amount 1,000,000,000.0 times the 24 h mean of this card"),
    (case(is_night=None, amt_gt_p95_legit=float("nan")), AMOUNT),
    ((None, None), None),
]


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(i, *row) for i, (row, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "tx_id long, values array<double>, contributions array<double>")


def test_sentences_by_joint_weight(cases):
    found = {r.tx_id: r.r for r in cases.select("tx_id", case_reasons().alias("r")).collect()}
    assert found == {i: said for i, (_, said) in enumerate(CASES)}


def test_top_and_own_sentences(cases):
    one = cases.filter("tx_id = 0")
    assert one.select(case_reasons(top=1)).first()[0] == AMOUNT
    late = Sentence(("is_night",), lambda value: F.when(value("is_night") > 0, "late"))
    assert one.select(case_reasons(sentences=[late])).first()[0] == "late"
    assert cases.filter("false").select(case_reasons()).collect() == []


def test_times_from_the_border(spark):
    rows = spark.createDataFrame([(4.0, 2.0), (3.9, 2.0)], "a double, b double")
    assert [r[0] for r in rows.select(X.times_sentence(F.col("a"), F.col("b"), 2.0, "%s x")).collect()] == ["2.0 x", None]
