"""Text to value conversions for landed source files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_comma(text: Column) -> Column:
    """'0,11' and '0.11' both become 0.11; anything else becomes NULL."""
    return F.translate(F.trim(text), ",", ".").try_cast("double")


def spaced_integer(text: Column) -> Column:
    """'8 032 377' becomes 8032377."""
    return F.regexp_replace(text, r"\s", "").try_cast("bigint")


def number(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def any_date(text: Column) -> Column:
    """ISO or day-first date, decided row by row."""
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "dd.MM.yyyy"))


def iso_date(text: Column) -> Column:
    """Leading ISO date of a date or timestamp text."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def compact_date(value: Column) -> Column:
    """20200605 (number or text) becomes 2020-06-05."""
    return F.try_to_date(value.cast("string"), "yyyyMMdd")


def epoch_ms_date(value: Column) -> Column:
    """UTC day of an epoch-millisecond instant, whatever the session time zone is."""
    days = F.floor(value.try_cast("bigint") / F.lit(86_400_000))
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def shorten(text: Column, width: int = 20) -> Column:
    """Event label cut to whole words so that it fits ``width`` with a trailing '...'."""
    clean = F.trim(F.regexp_replace(text, r"\s+", " "))
    room = width - 3
    # longest run of whole words that leaves room for the dots
    head = F.regexp_extract(clean, rf"^(.{{0,{room}}})(?=\s|$)", 1)
    return F.when(F.length(clean) <= width, clean).otherwise(
        F.concat(F.rtrim(head), F.lit("..."))
    )
