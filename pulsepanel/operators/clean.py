"""Row and value rules that make a raw panel usable."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsepanel.functions import values
from pulsepanel.operators.checks import COUNT_COLUMNS


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the listed columns only, under their canonical names."""
    return df.select([F.col(f"`{old}`").alias(new) for old, new in names.items()])


def negatives_to_null(panel: DataFrame, columns: Sequence[str] = COUNT_COLUMNS) -> DataFrame:
    return panel.withColumns(
        {c: values.null_if_negative(F.col(c)) for c in columns if c in panel.columns}
    )


def map_codes(df: DataFrame, codes: DataFrame, column: str, *, keep_unmapped: bool) -> DataFrame:
    """Replace names by codes from a (name, code) table.

    ``keep_unmapped`` leaves names without a code as they are, otherwise they become NULL.
    """
    lookup = codes.select(F.col("name").alias(column), F.col("code").alias("_code"))
    mapped = F.coalesce("_code", column) if keep_unmapped else F.col("_code")
    return (
        df.join(lookup, column, "left")
        .withColumn(column, mapped)
        .select(df.columns)
    )


def only_total_ageclass(df: DataFrame, column: str = "ageclass") -> DataFrame:
    return df.where(F.col(column) == 0).drop(column)


def before_run_date(df: DataFrame, run_date: datetime.date | str, date: str = "date") -> DataFrame:
    """Rows up to the day before the run date."""
    return df.where(F.col(date) <= F.date_sub(F.lit(str(run_date)).cast("date"), 1))


def exclude_regions(df: DataFrame, regions: Sequence[str]) -> DataFrame:
    return df.where(~F.col("region").isin(list(regions)))


def known_regions(df: DataFrame, region_dim: DataFrame) -> DataFrame:
    return df.join(region_dim.select("region"), "region", "left_semi")


def positives_not_above_tests(
    panel: DataFrame, start: str, exempt: Sequence[str]
) -> DataFrame:
    """NULL counts from ``start`` on where cumulative positives reach cumulative tests."""
    suspicious = (
        (F.col("date") >= F.lit(start).cast("date"))
        & (F.col("positive") >= F.col("total"))
        & ~F.col("region").isin(list(exempt))
    )
    keep = ~F.coalesce(suspicious, F.lit(False))
    return panel.withColumns({c: F.when(keep, F.col(c)) for c in ("new_cases", "new_tests")})

