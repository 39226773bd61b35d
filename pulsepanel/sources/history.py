"""Vintages kept as changes: each day stores the rows that differ from the day before, not a whole copy.

A change is a row with its keys, its new values and ``deleted``; changes are partitioned by ``snapshot_date``. The
table as of a day is the newest change of every key up to that day. ``validity_intervals`` turns changes into
``[valid_from, valid_to)``, for many reads of old days: written by ``write_intervals``, a read only opens the folders
of intervals that end after its day.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsepanel.operators.vintages import as_of

SNAPSHOT = "snapshot_date"
#: Month of intervals that are still open.
OPEN_MONTH = "9999-12"


def _day(value: datetime.date | str):
    return F.lit(str(value)).cast("date")


def changed_rows(before: DataFrame, now: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``now`` that are new or differ from ``before``, and the keys that are gone, as ``deleted``.

    Values are compared whole, NULL equal to NULL. Keys must not be NULL and stand once in each table.
    """
    values = [c for c in now.columns if c not in keys]
    old = before.select(*keys, F.struct(F.lit(True).alias("_there"), *values).alias("_old"))
    new = now.select(*keys, F.struct(F.lit(True).alias("_there"), *values).alias("_new"))
    both = old.join(new, list(keys), "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    return both.select(
        *keys, *[F.col(f"_new.`{c}`").alias(c) for c in values], F.col("_new").isNull().alias("deleted")
    )


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All changes; filters on ``snapshot_date`` prune whole folders."""
    return spark.read.parquet(path).where("not marker").drop("marker")


def record_snapshot(df: DataFrame, path: str, snapshot: datetime.date | str, keys: Sequence[str]) -> None:
    """Store what changed since the snapshot before. The newest day may be recorded again.

    Every day has a marker row, so that a day without changes is known and replaces what it held.
    """
    spark = df.sparkSession
    try:
        stored = spark.read.parquet(path)
        newest = stored.agg(F.max(SNAPSHOT).cast("string")).first()[0]
        if newest > str(snapshot):
            raise ValueError(f"{snapshot} is older than the newest recorded day, {newest}.")
        state = as_of_changes(stored.where("not marker").drop("marker").where(F.col(SNAPSHOT) < _day(snapshot)), snapshot, keys)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        state = df.where("false")
    changes = changed_rows(state.select(df.columns), df, keys)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in changes.schema if f.name != "deleted"]
    marker = spark.range(1).select(*empty, F.lit(False).alias("deleted"), F.lit(True).alias("marker"))
    (
        changes.withColumn("marker", F.lit(False))
        .unionByName(marker)
        .withColumn(SNAPSHOT, _day(snapshot))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAPSHOT)
        .parquet(path)
    )


def as_of_changes(changes: DataFrame, run_date: datetime.date | str, keys: Sequence[str]) -> DataFrame:
    """The table as it was on a day, without the date of its last change: equal to the whole copy of that day."""
    return as_of(changes, run_date, keys, snapshot=SNAPSHOT).where("not deleted").drop("deleted", SNAPSHOT)


def validity_intervals(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every version of every row with ``valid_from`` and ``valid_to`` (NULL: still valid).

    A key has one row per change of its own, however many snapshots there are.
    """
    following = F.lead(SNAPSHOT).over(Window.partitionBy(*keys).orderBy(SNAPSHOT))
    return (
        changes.withColumn("valid_to", following)
        .where("not deleted")
        .withColumnRenamed(SNAPSHOT, "valid_from")
        .drop("deleted")
    )


def write_intervals(intervals: DataFrame, path: str) -> None:
    """Intervals in folders by the month in which they end."""
    month = F.coalesce(F.date_format("valid_to", "yyyy-MM"), F.lit(OPEN_MONTH))
    intervals.withColumn("end_month", month).write.mode("overwrite").partitionBy("end_month").parquet(path)


def intervals_as_of(intervals: DataFrame, run_date: datetime.date | str) -> DataFrame:
    """Rows valid on a day; folders of months that ended before it are not opened."""
    day = _day(run_date)
    valid = (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day))
    found = intervals
    if "end_month" in intervals.columns:
        found = found.where(F.col("end_month") >= F.lit(str(run_date)[:7])).drop("end_month")
    return found.where(valid).drop("valid_from", "valid_to")
