"""Manual corrections as data: one patch table instead of one statement per glitch.

Patch columns: ``region, date_from, date_to, column, action, value`` with ``action`` one of
``offset`` (add to a cumulative column), ``set`` (overwrite) and ``null`` (remove). A NULL
``date_to`` means "until the end of the series".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.operators.calendar import difference
from pulsepanel.operators.clean import negatives_to_null, positives_not_above_tests

PATCH_SCHEMA = (
    "region string, date_from date, date_to date, column string, action string, value double"
)


def patch_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Patch table from (region, 'from', 'to' or None, column, action, value) tuples."""
    text = spark.createDataFrame(
        list(rows),
        "region string, date_from string, date_to string, column string, action string, value double",
    )
    return text.withColumns(
        {"date_from": F.col("date_from").cast("date"), "date_to": F.col("date_to").cast("date")}
    )


def _patched_cells(panel: DataFrame, patches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per patched (region, date) with the merged patch of every column.

    Ranges are cut to the series they touch and spelled out as days, which turns the range
    join into an equi join; merging per cell first means that the join cannot multiply rows.
    """
    bounds = panel.groupBy("region").agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    days = (
        patches.where(F.col("column").isin(list(columns)))
        .join(bounds, "region")
        .withColumn("_from", F.greatest("date_from", "_lo"))
        .withColumn("_to", F.least("date_to", "_hi"))
        .where(F.col("_from") <= F.col("_to"))
        .withColumn("date", F.explode(F.sequence("_from", "_to")))
    )
    merged = []
    for c in columns:
        here = F.col("column") == c
        merged += [
            F.sum(F.when(here & (F.col("action") == "offset"), F.col("value"))).alias(f"_{c}_offset"),
            F.max(F.when(here & (F.col("action") == "set"), F.col("value"))).alias(f"_{c}_set"),
            F.coalesce(F.bool_or(here & (F.col("action") == "null")), F.lit(False)).alias(f"_{c}_null"),
        ]
    return days.groupBy("region", "date").agg(*merged)


def apply_patches(panel: DataFrame, patches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Apply patches to ``columns``: removal beats overwriting, overwriting beats offsets.

    Patches change existing rows only; they never add one.
    """
    cells = _patched_cells(panel, patches, columns)
    joined = panel.join(cells, ["region", "date"], "left")

    def value(c: str):
        shifted = F.col(c) + F.coalesce(F.col(f"_{c}_offset"), F.lit(0.0))
        removed = F.coalesce(F.col(f"_{c}_null"), F.lit(False))
        return F.when(~removed, F.coalesce(F.col(f"_{c}_set"), shifted))

    return joined.withColumns({c: value(c) for c in columns}).select(panel.columns)


def correct_cumulative_panel(
    panel: DataFrame,
    patches: DataFrame,
    *,
    check_from: str,
    exempt: Sequence[str],
) -> DataFrame:
    """Full correction order for a cumulative (positive, total) panel.

    Offsets on the counters, daily differences, negatives removed, patches on the daily counts,
    then the positives-versus-tests check.
    """
    counters = apply_patches(panel, patches, ["positive", "total"])
    daily = difference(
        difference(counters, "positive", "new_cases"), "total", "new_tests"
    )
    daily = negatives_to_null(daily, ["new_cases", "new_tests"])
    daily = apply_patches(daily, patches, ["new_cases", "new_tests"])
    return positives_not_above_tests(daily, check_from, exempt)
