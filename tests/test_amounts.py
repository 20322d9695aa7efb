import pytest

from stormmart.functions.amounts import amount_number, amount_unit, parse_amount

CASES = [
    ("250K", 250000.0), ("2.5M", 2500000.0), ("1B", 1e9), ("3H", 300.0), ("K", None),
    ("0", 0.0), ("", 0.0), (None, 0.0), ("10", 10.0), ("3t", 3.0), ("1.5KK", None),
    ("-5k", -5000.0), ("ab1.5k", None), ("1d", 1.0), ("NaN", 0.0), ("  7 ", 7.0),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_parse_amount(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(parse_amount("t").alias("a")).first()["a"]
    assert got == expected


def test_first_letter_only_and_unit(spark):
    df = spark.createDataFrame([("ab1.5k",), ("12",), ("x",)], "t string")
    rows = df.select(amount_number("t").alias("n"), amount_unit("t").alias("u")).collect()
    assert [(r.n, r.u) for r in rows] == [(None, "k"), (12.0, None), (None, "x")]
