"""Window building blocks for one daily series per key.

A panel has one row per (keys, date), so a window over the keys never holds more rows
than the calendar has days, however large the raw tables are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def forward(keys: Sequence[str], date: str = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(date)


def backward(keys: Sequence[str], date: str = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(F.col(date).desc())


def whole(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys)


def so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def last_known(c: Column, keys: Sequence[str], date: str = "date") -> Column:
    """Latest non-NULL value up to and including this row."""
    return F.last(c, ignorenulls=True).over(so_far(forward(keys, date)))


def next_known(c: Column, keys: Sequence[str], date: str = "date") -> Column:
    """Earliest non-NULL value from this row on.

    Written as a running frame over the reversed series: an unbounded-following frame
    would be re-read for every row.
    """
    return F.last(c, ignorenulls=True).over(so_far(backward(keys, date)))
