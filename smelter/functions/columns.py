"""Typed, null-safe column expressions.

Malformed input becomes NULL whether or not ANSI mode is on, and wall-clock
values are TIMESTAMP_NTZ, so nothing here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
COORDINATE = "decimal(18,12)"


def clean_text(col: Column) -> Column:
    return F.trim(col.cast("string"))


def standard_code(col: Column) -> Column:
    """Trimmed upper case, for cities, states, statuses and types."""
    return F.upper(clean_text(col))


def not_blank(col: Column) -> Column:
    """True or false, never NULL."""
    return col.isNotNull() & (F.trim(col) != "")


def to_int(col: Column) -> Column:
    return col.try_cast("int")


def to_money(col: Column) -> Column:
    return col.try_cast(MONEY)


def to_coordinate(col: Column) -> Column:
    return col.try_cast(COORDINATE)


def to_wall_clock(col: Column) -> Column:
    """Epoch milliseconds or timestamp text -> TIMESTAMP_NTZ, anything else -> NULL.

    Digits are milliseconds, except four unsigned digits, which are a year.
    """
    text = F.trim(col.cast("string"))
    millis = text.try_cast("bigint")
    is_year = (F.length(text) == 4) & (millis >= 1000)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    in_range = millis.between(-62135596800000, 253402300799999)  # years 1 to 9999
    return F.when(millis.isNull() | is_year, text.try_cast("timestamp_ntz")).when(
        in_range, F.timestamp_add("MILLISECOND", millis, epoch)
    )


def days_between(end: Column, start: Column) -> Column:
    """Calendar days; 23:59 to 00:01 the next day is 1."""
    return F.datediff(end, start)


def hours_between(end: Column, start: Column) -> Column:
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return F.round(seconds / F.lit(3600).cast("decimal(4,0)"), 2).cast("double")


def date_key(col: Column) -> Column:
    """yyyyMMdd as an integer."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def month_of(date_key_column: str) -> Column:
    """yyyyMM of a yyyyMMdd key."""
    return F.expr(f"CAST(`{date_key_column}` DIV 100 AS INT)")


def exact_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """Rounded quotient, half up on the exact decimal value; NULL for a zero divisor."""
    quotient = F.try_divide(numerator.cast("decimal(28,2)"), denominator.cast("decimal(20,0)"))
    return F.round(quotient, places).cast("double")


def first_match(value: Column, cases: dict[str, tuple[str, ...]], default: str) -> Column:
    """The label whose members contain ``value``; one literal map lookup per row."""
    pairs = [F.lit(x) for label, members in cases.items() for m in members for x in (m, label)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def banded(value: Column, limits: tuple[tuple[int, str], ...], above: str, missing: str) -> Column:
    """Label of the first band whose exclusive upper limit exceeds ``value``."""
    bands = F.when(value.isNull(), missing)
    for limit, label in limits:
        bands = bands.when(value < limit, label)
    return bands.otherwise(above)
