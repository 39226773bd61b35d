"""Data "as it was" on a run date: snapshots, file vintages, overlays."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day(value: datetime.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def as_of(
    snapshots: DataFrame,
    run_date: datetime.date | str,
    keys: Sequence[str] = ("region", "date"),
    *,
    snapshot: str = "snapshot_date",
) -> DataFrame:
    """Newest row per key among snapshots published up to the run date.

    An aggregate, not a ranking: each task keeps one row per key before the shuffle, so keys
    with very many revisions are no problem.
    """
    values = [c for c in snapshots.columns if c not in (*keys, snapshot)]
    newest = (
        snapshots.where(F.col(snapshot) <= _day(run_date))
        .groupBy(*keys)
        .agg(
            F.max_by(F.struct(*values), snapshot).alias("_row"),
            F.max(snapshot).alias(snapshot),
        )
    )
    return newest.select(*keys, snapshot, "_row.*")


def snapshot_as_of(
    snapshots: DataFrame, run_date: datetime.date | str, *, snapshot: str = "snapshot_date"
) -> DataFrame:
    """All rows of the one newest snapshot published up to the run date."""
    allowed = snapshots.where(F.col(snapshot) <= _day(run_date))
    return allowed.where(F.col(snapshot) == allowed.agg(F.max(snapshot)).scalar())


def require_run_date(run_date: datetime.date, today: datetime.date) -> None:
    if run_date > today:
        raise ValueError(f"Run date {run_date} lies in the future (today is {today}).")


def file_date(file_name: Column) -> Column:
    """Vintage in the first ten characters of a file name."""
    return F.try_to_date(F.substring(file_name, 1, 10), "yyyy-MM-dd")


def choose_file(
    lines: DataFrame,
    run_date: datetime.date | str | None = None,
    *,
    file_name: str = "file_name",
) -> DataFrame:
    """Rows of the newest file, or of the newest one dated strictly before ``run_date``."""
    dated = lines.withColumn("file_date", file_date(F.col(file_name))).where("file_date is not null")
    if run_date is not None:
        dated = dated.where(F.col("file_date") < _day(run_date))
    return dated.where(F.col("file_date") == dated.agg(F.max("file_date")).scalar())


def overlay_older(
    newer: DataFrame,
    older: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("region", "date"),
) -> DataFrame:
    """Newer panel with ``columns`` taken from the older vintage; NULL where that has no row."""
    return newer.drop(*columns).join(older.select(*keys, *columns), list(keys), "left")
