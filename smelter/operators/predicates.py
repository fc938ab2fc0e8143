"""Request-time filters: ``{"column_suffix": value}`` -> typed column predicates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from decimal import Decimal, InvalidOperation
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The suffixes of the request syntax.
SUFFIXES = {
    "_gte": "gte",
    "_from": "gte",
    "_lte": "lte",
    "_to": "lte",
    "_gt": "gt",
    "_lt": "lt",
    "_like": "like",
    "_in": "in",
}


INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


class FilterError(ValueError):
    """A filter names no known column or its value does not fit the column's type."""


def _boolean(text: str) -> bool:
    try:
        return {"true": True, "1": True, "false": False, "0": False}[text.lower()]
    except KeyError:
        raise ValueError(f"{text!r} is not a boolean") from None


def _typed(value: Any, dtype: T.DataType) -> Any:
    """Read request text as a Python value of the column's type."""
    text = str(value).strip()
    if isinstance(dtype, T.StringType):
        return str(value)
    if isinstance(dtype, T.BooleanType):
        return _boolean(text)
    if isinstance(dtype, T.IntegralType):
        number, bits = int(text), INTEGER_BITS[type(dtype)]
        if not -(1 << (bits - 1)) <= number < 1 << (bits - 1):
            raise ValueError(f"{text} is outside the range of {dtype.simpleString()}")
        return number
    if isinstance(dtype, T.DecimalType):
        return Decimal(text)
    if isinstance(dtype, T.FractionalType):
        return float(text)
    if isinstance(dtype, T.DateType):
        return dt.date.fromisoformat(text)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # As text: a datetime would be moved by the driver's zone.
        return dt.datetime.fromisoformat(text).isoformat(sep=" ")
    raise ValueError(f"columns of type {dtype.simpleString()} cannot be filtered")


def _literal(name: str, value: Any, dtype: T.DataType) -> Column:
    try:
        typed = _typed(value, dtype)
    except (ValueError, InvalidOperation) as error:
        raise FilterError(f"filter {name!r}: {error}") from None
    # A decimal literal keeps its own digits: casting to the column's scale would round a bound.
    return F.lit(typed) if isinstance(dtype, T.DecimalType) else F.lit(typed).cast(dtype)


def resolve(name: str, columns: Mapping[str, T.DataType]) -> tuple[str, str]:
    """Filter name -> (column, comparison). A column of that exact name wins over a suffix."""
    if name in columns:
        return name, "eq"
    for suffix in sorted(SUFFIXES, key=len, reverse=True):
        stem = name.removesuffix(suffix)
        if stem != name and stem in columns:
            return stem, SUFFIXES[suffix]
    raise FilterError(f"filter {name!r} matches no column")


def predicate(
    name: str, value: Any, columns: Mapping[str, T.DataType], wildcards: bool = False
) -> Column:
    column, comparison = resolve(name, columns)
    dtype, col = columns[column], F.col(column)
    if comparison == "like":
        text = col.cast("string")
        return text.like(str(value)) if wildcards else text.contains(str(value))
    if comparison == "in":
        members = value.split(",") if isinstance(value, str) else list(value)
        return col.isin(*[_literal(name, m, dtype) for m in members])
    bound = _literal(name, value, dtype)
    return {
        "eq": col == bound,
        "gte": col >= bound,
        "lte": col <= bound,
        "gt": col > bound,
        "lt": col < bound,
    }[comparison]


def apply_filters(
    df: DataFrame, filters: Mapping[str, Any] | None, wildcards: bool = False
) -> DataFrame:
    """Rows meeting every filter; filters with no value are left out."""
    columns = {f.name: f.dataType for f in df.schema.fields}
    wanted = [
        predicate(name, value, columns, wildcards)
        for name, value in (filters or {}).items()
        if value is not None and value != ""
    ]
    return df.filter(reduce(and_, wanted)) if wanted else df
