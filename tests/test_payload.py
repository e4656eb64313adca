"""Reading text: null, whole numbers, exact decimals and times."""

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import payload


def read(spark, values, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_empty_text_is_null(spark):
    assert read(spark, [None, "", " ", "x"], payload.text_or_null(F.col("s"))) == [(None,), (None,), (" ",), ("x",)]


def test_whole_numbers(spark):
    texts = [None, "", "42", "+42", "-42", " 42", "4.0", "9223372036854775808", "x", "42\n"]
    got = read(spark, texts, payload.long_or_null(F.col("s")), payload.long_unfit(F.col("s")))
    numbers = [None, None, 42, 42, -42] + [None] * 5
    assert got == [(n, t not in (None, "") and n is None) for t, n in zip(texts, numbers)]


@pytest.mark.parametrize(
    ("text", "number", "unfit"),
    [
        (None, None, False),
        ("123.45", "123.45", False),
        ("0.000000000000000001", "0.000000000000000001", False),
        ("-987654321.123456789", "-987654321.123456789", False),
        ("abc", None, False),
        ("NaN", None, False),
        ("", None, False),
        ("1E+3", "1000", False),
        (" 1", None, False),
        ("1\n", None, False),
        ("1.50000000000000000000", "1.5", False),
        ("1.2345678901234567891", None, True),
        ("123456789012345678901", None, True),
        ("1e400", None, True),
        ("0e400", "0", False),
        ("1e99999999999", None, False),
    ],
)
def test_decimal_cases(spark, text, number, unfit):
    [(got, bad)] = read(spark, [text], payload.decimal_or_null(F.col("s")), payload.decimal_unfit(F.col("s")))
    assert got == (None if number is None else Decimal(number))
    assert bad is unfit


def exact_reading(text):
    """The rule in exact arithmetic."""
    if not re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text):
        return None, False
    value = Decimal(text)
    sign, digits, exponent = value.as_tuple()
    whole = int("".join(map(str, digits))) * (10 ** max(exponent + 18, 0))
    if exponent + 18 < 0:
        whole, rest = divmod(whole, 10 ** -(exponent + 18))
        if rest:
            return None, True
    if whole >= 10**38:
        return None, True
    return Decimal((sign, tuple(int(d) for d in str(whole)), -18)), False


def test_decimals_against_exact_arithmetic(spark):
    draw = random.Random(7)
    texts = []
    for _ in range(3000):
        whole = "".join(draw.choice("0123456789") for _ in range(draw.choice([0, 1, 3, 19, 20, 21, 22])))
        part = "".join(draw.choice("00001234") for _ in range(draw.choice([0, 1, 5, 17, 18, 19, 25])))
        text = draw.choice(["", "+", "-"]) + whole + draw.choice(["", "."]) + part
        if draw.random() < 0.4:
            text += draw.choice("eE") + draw.choice(["", "+", "-"]) + str(draw.choice([0, 1, 2, 17, 18, 19, 20, 40]))
        texts.append(text)
    got = read(spark, texts, payload.decimal_or_null(F.col("s")), payload.decimal_unfit(F.col("s")))
    assert got == [exact_reading(t) for t in texts]


@pytest.mark.parametrize(
    ("text", "millis"),
    [
        ("2024-01-02T03:04:05Z", 1704164645000),
        ("2024-01-02T03:04:05+07:00", 1704164645000 - 7 * 3600_000),
        ("2024-01-02T03:04:05.123456Z", 1704164645123),
        ("2024-01-02T03:04Z", 1704164640000),
        ("2024-01-02t03:04:05z", 1704164645000),
        ("1969-12-31T23:59:59.9995Z", -1),
        ("2024-01-02", None),
        ("2024-01-02T03:04:05", None),
        ("2024-02-30T00:00:00Z", None),
        ("2024-01-02 03:04:05Z", None),
        (None, None),
    ],
)
def test_times(spark, text, millis):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            assert read(spark, [text], payload.iso_to_millis(F.col("s"))) == [(millis,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_micros_are_cut_toward_zero(spark):
    df = spark.createDataFrame([(-1500,), (1500,), (None,)], "t bigint")
    got = df.select(payload.ts_to_millis(F.col("t"), T.LongType())).collect()
    assert [r[0] for r in got] == [-1, 1, None]
