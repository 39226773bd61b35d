"""The time axis of a panel: gap filling, extension, interpolation, differences.

``densify`` is the core. It explodes each row into the days up to the next row, so filling
gaps costs one shuffle on the series key and no join, and later windows on the same key reuse
that partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsepanel.functions import series
from pulsepanel.functions.values import null_if_zero

REGION = ("region",)
RAMP_START = "2020-01-01"


def densify(
    panel: DataFrame,
    keys: Sequence[str] = REGION,
    *,
    lead_days: int = 0,
    trail_days: int = 0,
    start: str | None = None,
) -> DataFrame:
    """One row per day from the first to the last date of each series; new rows are NULL.

    ``lead_days`` prepends days, ``trail_days`` appends days, ``start`` prepends all days from
    a fixed date on (when the series begins later).
    """
    w = series.forward(keys)
    is_first = F.lag("date").over(w).isNull()
    begin: Column = F.col("date")
    if lead_days:
        begin = F.when(is_first, F.date_sub("date", lead_days)).otherwise(F.col("date"))
    if start:
        begin = F.when(
            is_first, F.least(F.col("date"), F.lit(start).cast("date"))
        ).otherwise(F.col("date"))
    end = F.coalesce(F.date_sub(F.lead("date").over(w), 1), F.date_add("date", trail_days))
    values = [c for c in panel.columns if c not in (*keys, "date")]
    spread = panel.withColumns({"_begin": begin, "_end": end}).select(
        *keys, F.col("date").alias("_own"), *values,
        F.explode(F.sequence("_begin", "_end")).alias("date"),
    )
    own_day = F.col("_own") == F.col("date")
    return spread.select(
        *keys, "date", *[F.when(own_day, F.col(c)).alias(c) for c in values]
    ).select(panel.columns)


def insert_future(panel: DataFrame, future_days: int, keys: Sequence[str] = REGION) -> DataFrame:
    """Append ``future_days`` NULL rows per region; inner gaps are filled with NULL rows too."""
    return densify(panel, keys, trail_days=future_days)


def fixed_calendar(
    panel: DataFrame, regions: DataFrame, first: str, last: str, columns: Sequence[str]
) -> DataFrame:
    """Exactly the days ``first`` to ``last`` for every listed region; absent counts are zero."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    grid = regions.select("region", F.explode(days).alias("date"))
    return grid.join(panel, ["region", "date"], "left").select(
        "region", "date", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in columns]
    )


def model_axis(panel: DataFrame, buffer_days: int = 10, keys: Sequence[str] = REGION) -> DataFrame:
    """Axis of the R(t) model: from the first day with cases, preceded by NULL buffer days.

    A series without any positive day keeps its whole range.
    """
    first_case = F.min(F.when(F.col("new_cases") > 0, F.col("date"))).over(series.whole(keys))
    trimmed = (
        panel.withColumn("_first", first_case)
        .where(F.col("_first").isNull() | (F.col("date") >= F.col("_first")))
        .drop("_first")
    )
    return densify(trimmed, keys, lead_days=buffer_days)


def interpolate(panel: DataFrame, column: str, keys: Sequence[str] = REGION) -> DataFrame:
    """Linear interpolation by row position.

    Inner gaps become linear, leading NULLs stay, trailing NULLs take the last value. On a
    gap-free calendar (see ``densify``) position and date are the same thing.
    """
    position = F.row_number().over(series.forward(keys))
    known = F.when(F.col(column).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(column).cast("double").alias("v")))
    left, right = F.col("_left"), F.col("_right")
    blend = left.v + (right.v - left.v) * (F.col("_pos") - left.p) / (right.p - left.p)
    filled = (
        F.when(F.col(column).isNotNull(), F.col(column).cast("double"))
        .when(right.isNull(), left.v)
        .when(left.isNotNull(), blend)
    )
    return (
        panel.withColumn("_pos", position)
        .withColumn("_left", series.last_known(known, keys))
        .withColumn("_right", series.next_known(known, keys))
        .withColumn(column, filled)
        .select(panel.columns)
    )


def carry_both_ways(panel: DataFrame, column: str, keys: Sequence[str] = REGION) -> DataFrame:
    """Continue the last value to the end and the first value back to the start."""
    return panel.withColumn(
        column,
        F.coalesce(
            series.last_known(F.col(column), keys), series.next_known(F.col(column), keys)
        ),
    )


def upsert_anchor(
    panel: DataFrame,
    column: str,
    keys: Sequence[str] = REGION,
    *,
    on: str = RAMP_START,
    value: float = 0.0,
    only: Column | None = None,
) -> DataFrame:
    """Set ``column`` on one day of every series, adding the row where it is absent.

    ``only`` is a condition on the keys that limits this to some series.
    """
    day = F.lit(on).cast("date")
    w = series.forward(keys)
    wanted = F.lit(True) if only is None else only
    before, after = F.lag("date").over(w), F.lead("date").over(w)
    missing_above = (day < F.col("date")) & (before.isNull() | (before < day))
    missing_below = (day > F.col("date")) & after.isNull()
    days = (
        F.when(wanted & missing_above, F.array(day, F.col("date")))
        .when(wanted & missing_below, F.array(F.col("date"), day))
        .otherwise(F.array("date"))
    )
    values = [c for c in panel.columns if c not in (*keys, "date")]
    spread = panel.withColumn("_days", days).select(
        *keys, F.col("date").alias("_own"), *values, F.explode("_days").alias("date")
    )
    own_day = F.col("_own") == F.col("date")
    kept = {c: F.when(own_day, F.col(c)) for c in values}
    kept[column] = F.when(wanted & (F.col("date") == day), F.lit(value)).otherwise(
        kept[column].cast("double")
    )
    return spread.select(*keys, "date", *[e.alias(c) for c, e in kept.items()]).select(panel.columns)


def ramp_from_anchor(
    panel: DataFrame, column: str, keys: Sequence[str] = REGION, *, only: Column | None = None
) -> DataFrame:
    """Testing ramp-up from one zero on the first day of 2020 to the first prediction."""
    anchored = upsert_anchor(panel, column, keys, only=only)
    if only is None:
        return interpolate(anchored, column, keys)
    ramp = interpolate(anchored.withColumn("_ramp", F.col(column)), "_ramp", keys)
    return ramp.withColumn(column, F.when(only, F.col("_ramp")).otherwise(F.col(column))).select(
        panel.columns
    )


def back_extend(
    panel: DataFrame, column: str, keys: Sequence[str] = REGION, *, start: str = RAMP_START
) -> DataFrame:
    """Prepend a zero for every day since ``start``, then interpolate ``column``.

    Gaps inside the series are filled with rows as well.
    """
    extended = densify(panel.withColumn("_first", F.min("date").over(series.whole(keys))), keys, start=start)
    origin = series.next_known(F.col("_first"), keys)
    filled = extended.withColumn("_origin", origin).withColumn(
        column, F.when(F.col("date") < F.col("_origin"), F.lit(0.0)).otherwise(F.col(column))
    )
    return interpolate(filled.select(panel.columns), column, keys)


def difference(panel: DataFrame, column: str, target: str, keys: Sequence[str] = REGION) -> DataFrame:
    """First difference by row order; the first row of a series is NULL."""
    previous = F.lag(column).over(series.forward(keys))
    return panel.withColumn(target, F.col(column) - previous)


def yesterday(column: str, keys: Sequence[str] = REGION) -> Column:
    """Value of the day before; NULL when that day has no row."""
    w = series.forward(keys)
    return F.when(F.lag("date").over(w) == F.date_sub("date", 1), F.lag(column).over(w))


def increase_since_yesterday(
    panel: DataFrame, column: str, target: str, keys: Sequence[str] = REGION
) -> DataFrame:
    """Difference to yesterday where yesterday exists and the counter grew, else NULL."""
    before = yesterday(column, keys)
    return panel.withColumn(target, F.when(F.col(column) > before, F.col(column) - before))


def running_total(panel: DataFrame, column: str, target: str, keys: Sequence[str] = REGION) -> DataFrame:
    return panel.withColumn(target, F.sum(column).over(series.so_far(series.forward(keys))))


def daily_from_totals(
    panel: DataFrame, totals: str, target: str, keys: Sequence[str] = REGION
) -> DataFrame:
    """Daily counts from sparse cumulative totals: anchor, interpolate, difference, 0 -> NULL."""
    smooth = interpolate(upsert_anchor(panel, totals, keys), totals, keys)
    return difference(smooth, totals, target, keys).withColumn(target, null_if_zero(F.col(target)))


def all_combinations(panel: DataFrame) -> DataFrame:
    """Every region on every date that occurs anywhere; absent combinations are NULL rows.

    The distinct dates are a calendar, so they travel as one array value.
    """
    dates = panel.agg(F.sort_array(F.collect_set("date")).alias("d")).scalar()
    grid = panel.select("region").distinct().select("region", F.explode(dates).alias("date"))
    return grid.join(panel, ["region", "date"], "left")


def last_rows(panel: DataFrame, n: int, keys: Sequence[str] = REGION) -> DataFrame:
    """The last ``n`` rows of the table in (keys, date) order."""
    order = [F.col(c).desc() for c in (*keys, "date")]
    return panel.orderBy(*order).limit(n)


def last_row_per_region(panel: DataFrame, column: str, keys: Sequence[str] = REGION) -> DataFrame:
    """Last reported date and value of each series, as an aggregate."""
    seen = F.col(column).isNotNull()
    return panel.where(seen).groupBy(*keys).agg(
        F.max("date").alias("date"), F.max_by(column, "date").alias(column)
    )


def complete_row_bounds(panel: DataFrame, columns: Sequence[str], keys: Sequence[str] = REGION) -> DataFrame:
    """First and last date on which all ``columns`` are present."""
    complete = panel.na.drop(subset=list(columns))
    return complete.groupBy(*keys).agg(
        F.min("date").alias("first_complete"), F.max("date").alias("last_complete")
    )
