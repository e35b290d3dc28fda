"""Tolerant text parsing. Bad text gives NULL, with or without ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(parts: Column, position: int) -> Column:
    """Element of a split line; NULL where the line is too short."""
    return F.get(parts, F.lit(position))


def clean_int(text: Column, kind: str = "int") -> Column:
    """A whole number; decimals are cut off ('64.0' and '64.9' are 64)."""
    plain = F.trim(text)
    whole = F.regexp_extract(plain, r"^([+-]?\d+)\.\d*$", 1)
    return F.coalesce(plain.try_cast(kind), whole.try_cast(kind))


def text_date(text: Column, pattern: str = "yyyyMMdd") -> Column:
    return F.try_to_date(F.trim(text), pattern)


def decade_of(year: Column) -> Column:
    return (F.floor(clean_int(year) / 10) * 10).cast("int")
