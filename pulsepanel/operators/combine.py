"""Joins and set operations between panels, dimensions and event tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsepanel.functions import series
from pulsepanel.functions.text import shorten

KEYS = ("region", "date")


def outer_merge(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Full outer equi join of two panels on their keys."""
    return left.join(right, list(keys), "full_outer")


def with_dimension(df: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left lookup; Catalyst broadcasts the dimension when its measured size allows it."""
    return df.join(dimension, list(keys), "left")


def regions_without(left: DataFrame, right: DataFrame) -> DataFrame:
    """Regions of ``left`` that ``right`` does not have."""
    return left.select("region").distinct().join(right.select("region").distinct(), "region", "left_anti")


def common_dates(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys present in both series."""
    return left.select(*keys).join(right.select(*keys), list(keys), "inner")


def next_report_interval(panel: DataFrame, reported: str, keys: Sequence[str] = ("region",)) -> DataFrame:
    """Day -> reporting interval (previous report, this report], NULL after the last report."""
    report_day = F.when(F.col(reported).isNotNull(), F.col("date"))
    return panel.withColumn("report_date", series.next_known(report_day, keys))


def events_in_range(panel: DataFrame, events: DataFrame, label_width: int = 20) -> DataFrame:
    """Events of a region between the first and last day of its series, labels shortened."""
    spans = panel.groupBy("region").agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    inside = (
        events.join(spans, "region")
        .where(F.col("date").between(F.col("_lo"), F.col("_hi")))
        .select(events.columns)
    )
    return inside.withColumn("label", shorten(F.col("label"), label_width))


def holiday_calendar(
    holidays: DataFrame, alpha2: str, regions: Sequence[str] | str | None = None
) -> DataFrame:
    """One row per holiday date of a country: national, plus those of the listed regions.

    ``regions`` is None (national only), a list, or "all". A date is "national" when the national
    calendar has it, otherwise "regional"; of several names on one date the last wins, regional
    entries counting as later than national ones.
    """
    of_country = holidays.where(F.col("alpha2") == alpha2)
    is_national = F.col("region").isNull()
    if regions is None:
        used = of_country.where(is_national)
    elif regions == "all":
        used = of_country
    else:
        used = of_country.where(is_national | F.col("region").isin(list(regions)))
    order = F.struct(F.coalesce(F.col("region"), F.lit("")), F.col("name"))
    return used.groupBy("date").agg(
        F.max_by("name", order).alias("name"),
        F.when(F.bool_or(is_national), F.lit("national")).otherwise(F.lit("regional")).alias("holiday"),
    )


def forecast_holidays(
    holidays: DataFrame,
    alpha2: str,
    regions: Sequence[str] | str | None = None,
    *,
    regional_holidays: bool = False,
) -> DataFrame:
    """Holiday classes for a forecast.

    National holidays only, as one class, unless ``regional_holidays`` asks for a national and a
    regional class, which takes "all" or several regions.
    """
    if not regional_holidays:
        national = holiday_calendar(holidays, alpha2)
        return national.withColumn("holiday", F.lit("holiday"))
    if regions != "all" and (regions is None or isinstance(regions, str) or len(regions) <= 1):
        raise ValueError("Regional holidays need several regions; set regional_holidays to False.")
    return holiday_calendar(holidays, alpha2, regions)


def with_holidays(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Panel with a ``holiday`` class column, NULL on ordinary days."""
    return panel.join(calendar.select("date", "holiday"), "date", "left")


def long_comparison(wide: DataFrame, series_labels: Mapping[str, str]) -> DataFrame:
    """External estimates in wide form -> (label, date, value, lower, upper) rows."""
    entries = [
        F.struct(
            F.lit(label).alias("label"),
            F.col(name).cast("double").alias("value"),
            F.col(f"{name}_lower").cast("double").alias("lower"),
            F.col(f"{name}_upper").cast("double").alias("upper"),
        )
        for name, label in series_labels.items()
        if name in wide.columns
    ]
    return wide.select("date", F.explode(F.array(*entries)).alias("e")).select("e.label", "date", "e.value", "e.lower", "e.upper")


def compare_estimates(own: DataFrame, external: DataFrame) -> DataFrame:
    """Own R(t) per date next to every external estimate of that date."""
    return own.join(external, "date", "left")


def union_regions(*panels: DataFrame) -> DataFrame:
    """Rows of several panels; a column that one lacks is NULL there."""
    out = panels[0]
    for p in panels[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def assign_on_date(panel: DataFrame, factors: DataFrame, column: str) -> DataFrame:
    """Give every region the national value of ``column`` for its date."""
    return panel.drop(column).join(factors.select("date", F.col(column)), "date", "left")
