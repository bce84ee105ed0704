"""Cleaning expressions for vendor text and payloads."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F


def blank_sentinels(
    value: Column, equal_to: Iterable[str] = (), containing: Iterable[str] = ()
) -> Column:
    """Null where the text is one of the sentinels or contains one of the marks."""
    bad = F.lit(False)
    exact = list(equal_to)
    if exact:
        bad = value.isin(*exact)
    for mark in containing:
        bad = bad | value.contains(mark)
    return F.when(~bad, value)


def blank_numbers(value: Column, sentinels: Iterable[float]) -> Column:
    """Null where a numeric field carries one of the vendor's filler values."""
    return F.when(~value.isin(*[float(s) for s in sentinels]), value)


def to_number(value: Column) -> Column:
    """Text as a double; null where it is not a number, and for ``NaN`` and ``Infinity``."""
    number = value.try_cast("double")
    return F.when(F.abs(number) <= sys.float_info.max, number)


def numeric_text(value: Column) -> Column:
    """The text if it holds a digit, else null."""
    return F.when(value.rlike(r"\d+"), value)


def zero_if_missing(value: Column) -> Column:
    """``"0"`` in place of null and of the text ``"null"``."""
    return F.when(value.isNull() | (value == "null"), F.lit("0")).otherwise(value)


def digits_only(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def prefixed(value: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), value)


def coded(value: Column, codes: Mapping, default=None) -> Column:
    """Look a code up in a short fixed list."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.coalesce(F.try_element_at(table, value), F.lit(default))


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def vendor_time(text: Column) -> Column:
    """``2023/02/25 10:15:00`` or ``2023-02-25T10:15:00`` as a timestamp."""
    return F.try_to_timestamp(
        F.concat(
            F.translate(F.substring(text, 1, 10), "/.", "--"),
            F.lit(" "),
            F.substring(text, 12, 8),
        ),
        F.lit("yyyy-MM-dd HH:mm:ss"),
    )
