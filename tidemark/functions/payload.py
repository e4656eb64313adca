"""Column rules for reading change payloads.

Every rule is a built-in expression, so parsing stays inside generated code.
A ``*_unfit`` predicate marks text that must reject the row, as opposed to text
that reads as null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted text forms.
WHOLE_NUMBER = r"^[+-]?[0-9]+\z"
PLAIN_DECIMAL = r"^[+-]?[0-9]{1,20}([.][0-9]{0,18})?\z"
DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z"
OFFSET_TIME = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{0,9})?)?"
    r"([Zz]|[+-][0-9]{2}(:[0-9]{2}(:[0-9]{2})?)?)\z"
)
NO_SECONDS = r"^(.{10}T[0-9]{2}:[0-9]{2})([Z+-].*)\z"


def text_or_null(value: Column) -> Column:
    """Empty text is null."""
    return F.nullif(value, F.lit(""))


def long_or_null(value: Column, kind: T.DataType = T.StringType()) -> Column:
    """Whole number text, or a column of an integer type, to bigint."""
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    return F.when(value.rlike(WHOLE_NUMBER), value.try_cast("bigint"))


def long_unfit(value: Column, kind: T.DataType = T.StringType()) -> Column:
    """Non-empty text that is not a 64-bit whole number."""
    if isinstance(kind, T.IntegralType):
        return F.lit(False)
    return text_or_null(value).isNotNull() & long_or_null(value).isNull()


def decimal_parts(value: Column) -> Column:
    """Decimal text taken apart, as a struct; null for null text.

    ``number`` is the text rounded to decimal(38,18). ``digits``, ``fraction``
    and ``exponent`` are set only for text that may need rounding.
    """
    text = value.cast("string")
    mantissa = F.regexp_extract(text, r"^[+-]?([0-9.]*)", 1)
    exponent = F.when(~text.rlike("[eE]"), F.lit(0)).otherwise(
        F.regexp_extract(text, r"[eE]([+-]?[0-9]+)\z", 1).try_cast("int")
    )
    number = text.try_cast("decimal(38,18)").alias("number")
    nothing = F.lit(None).cast("string")
    plain = F.struct(
        F.lit("plain").alias("form"),
        number,
        nothing.alias("digits"),
        F.lit(None).cast("int").alias("fraction"),
        F.lit(None).cast("int").alias("exponent"),
    )
    unusual = F.struct(
        F.when(text.rlike(DECIMAL), "unusual").otherwise("other").alias("form"),
        number,
        F.regexp_replace(F.regexp_replace(mantissa, "[.]", ""), "^0+", "").alias("digits"),
        F.length(F.regexp_extract(mantissa, r"[.]([0-9]*)", 1)).alias("fraction"),
        exponent.alias("exponent"),
    )
    return F.when(text.rlike(PLAIN_DECIMAL), plain).when(text.isNotNull(), unusual)


def judge_decimal(parts: Column) -> Column:
    """``struct<number decimal(38,18), unfit boolean>`` from ``decimal_parts``.

    Text outside the grammar reads as null. Text inside it that decimal(38,18)
    cannot hold without rounding, or at all, is null and unfit.
    """
    digits, number = parts["digits"], parts["number"]
    trailing = F.length(digits) - F.length(F.regexp_replace(digits, r"0+\z", ""))
    decimals = parts["fraction"].cast("bigint") - parts["exponent"] - trailing
    exact = (decimals <= 18) & number.isNotNull()
    zero, nothing = F.lit(0).cast("decimal(38,18)"), F.lit(None).cast("decimal(38,18)")
    readable = (parts["form"] == "unusual") & parts["exponent"].isNotNull()

    def reading(value: Column, unfit: Column) -> Column:
        return F.struct(value.alias("number"), unfit.alias("unfit"))

    return (
        F.when(parts["form"] == "plain", reading(number, F.lit(False)))
        .when(readable & (digits == ""), reading(zero, F.lit(False)))
        .when(readable, reading(F.when(exact, number), ~exact))
        .otherwise(reading(nothing, F.lit(False)))
    )


def decimal_reading(value: Column) -> Column:
    """Both steps at once. Over many columns, do them in two projections."""
    return judge_decimal(decimal_parts(value))


def decimal_or_null(value: Column) -> Column:
    """Decimal text to decimal(38,18), never rounded; null where it cannot be."""
    text = value.cast("string")
    plain = text.rlike(PLAIN_DECIMAL)
    return F.when(plain, text.try_cast("decimal(38,18)")).when(text.isNotNull(), decimal_reading(value)["number"])


def decimal_unfit(value: Column) -> Column:
    """True where the text is a number that decimal(38,18) cannot hold exactly."""
    plain = value.cast("string").rlike(PLAIN_DECIMAL)
    return F.coalesce(~plain & decimal_reading(value)["unfit"], F.lit(False))


def iso_to_millis(value: Column) -> Column:
    """ISO-8601 text with an offset to epoch milliseconds, else null."""
    padded = F.regexp_replace(F.upper(value), NO_SECONDS, "$1:00$2")
    moment = F.coalesce(value.try_cast("timestamp"), padded.try_cast("timestamp"))
    return F.when(value.rlike(OFFSET_TIME), F.unix_millis(moment))


def micros_to_millis(value: Column) -> Column:
    """Epoch microseconds to milliseconds, cut toward zero."""
    return F.call_function("div", value, F.lit(1000).cast("bigint"))


def ts_to_millis(value: Column, kind: T.DataType) -> Column:
    """Time field of a payload, by the type it arrives in. In text, a whole number is microseconds."""
    if isinstance(kind, T.StringType):
        number = F.when(value.rlike(WHOLE_NUMBER), value.try_cast("bigint"))
        return F.coalesce(iso_to_millis(value), micros_to_millis(number))
    if isinstance(kind, T.LongType):
        return micros_to_millis(value)
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(value)
    return F.lit(None).cast("bigint")
