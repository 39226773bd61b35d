"""Sums over regions: national totals, shares, redistribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsepanel.functions.values import sum_if_enough, sum_or_zero

NATIONAL = "all"


def sum_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sum per key; partial sums run before the shuffle, so a hot key costs one row per task."""
    return df.groupBy(*keys).agg(*[sum_or_zero(F.col(c)).alias(c) for c in columns])


def with_national_total(
    panel: DataFrame,
    columns: Sequence[str],
    *,
    label: str = NATIONAL,
    outer_keys: Sequence[str] = (),
) -> DataFrame:
    """Panel plus rows ``label`` that hold the sum over regions, in one pass over the panel."""
    fine = [*outer_keys, "region", "date"]
    coarse = [*outer_keys, "date"]
    summed = panel.groupingSets([fine, coarse], *fine).agg(
        *[
            F.when(F.grouping("region") == 1, sum_or_zero(F.col(c))).otherwise(F.sum(c)).alias(c)
            for c in columns
        ],
        F.grouping("region").alias("_is_total"),
    )
    region = F.when(F.col("_is_total") == 1, F.lit(label)).otherwise(F.col("region"))
    return summed.withColumn("region", region).select(*fine, *columns)


def national_total(panel: DataFrame, columns: Sequence[str], *, min_count: int = 0) -> DataFrame:
    """Only the national rows; NULL where fewer than ``min_count`` regions reported."""
    def total(c: str):
        return sum_if_enough(F.col(c), min_count) if min_count else sum_or_zero(F.col(c))

    return (
        panel.groupBy("date")
        .agg(*[total(c).alias(c) for c in columns])
        .select(F.lit(NATIONAL).alias("region"), "date", *columns)
    )


def recent_shares(panel: DataFrame, column: str = "new_tests", days: int = 7) -> DataFrame:
    """Share of each region in the national total over the last fully covered days.

    The window ends on the earliest of the regions' last reported days.
    """
    ends = panel.where(F.col(column).isNotNull()).groupBy("region").agg(F.max("date").alias("last"))
    last_covered = ends.agg(F.min("last").alias("d")).scalar()
    sums = (
        panel.where(
            F.col("date").between(F.date_sub(last_covered, days - 1), last_covered)
        )
        .groupBy("region")
        .agg(sum_or_zero(F.col(column)).alias("s"))
    )
    national = sums.where(F.col("region") == NATIONAL).agg(F.max("s")).scalar()
    return sums.select("region", F.try_divide("s", national).alias("share"))


def covered_shares(panel: DataFrame, column: str = "new_tests", days: int = 7) -> DataFrame:
    """Share of each region in the national total over the last ``days`` days in a row on which every region reports.

    Gaps before the last common day move the window back; without such a run of days there are no rows.
    """
    known = panel.where(F.col(column).isNotNull())
    regions = panel.agg(F.count_distinct("region").alias("n")).scalar()
    reporting = known.groupBy("date").agg(F.count_distinct("region").alias("_n"))
    # the calendar as one sorted array: a day ends a run if the one so many places before is so many days before
    common = reporting.where(F.col("_n") == regions)
    covered = common.agg(F.array_sort(F.collect_list(F.unix_date("date"))).alias("_days"))
    run_ends = F.filter("_days", lambda day, i: (i >= days - 1) & (day - F.get("_days", i - (days - 1)) == days - 1))
    last = covered.select(F.date_from_unix_date(F.array_max(run_ends)).alias("d")).scalar()
    sums = (
        known.where(F.col("date").between(F.date_sub(last, days - 1), last))
        .groupBy("region")
        .agg(F.sum(F.col(column)).alias("s"))
    )
    national = sums.where(F.col("region") == NATIONAL).agg(F.max("s")).scalar()
    return sums.select("region", F.try_divide("s", national).alias("share"))


def redistributed_days(
    df: DataFrame,
    columns: Sequence[str],
    buckets: Sequence[str],
    *,
    group: str = "region",
    exact: bool = False,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Per day, an array ``entries`` of (region, columns...) with the NULL-region rows spread.

    The published numbers update the buckets one after another, so a later bucket sees the
    enlarged earlier ones; ``exact`` uses the original sizes throughout. ``extra`` aggregates are
    taken in the same pass.
    """
    cells = {(c, b): f"_{c}_{i}" for c in columns for i, b in enumerate(buckets)}
    wide = df.groupBy("date").agg(
        *[
            sum_or_zero(F.when(F.col(group) == b, F.col(c))).alias(name)
            for (c, b), name in cells.items()
        ],
        *[sum_or_zero(F.when(F.col(group).isNull(), F.col(c))).alias(f"_{c}_free") for c in columns],
        *extra,
    )
    for c in columns:
        sizes = {b: F.col(cells[c, b]) for b in buckets}
        for b in buckets:
            name = cells[c, b]
            whole = sum(list(sizes.values())[1:], list(sizes.values())[0])
            share = F.col(f"_{c}_free") * F.try_divide(sizes[b], whole)
            target = f"{name}_out" if exact else name
            wide = wide.withColumn(target, F.col(name) + F.coalesce(share, F.lit(0.0)))
    suffix = "_out" if exact else ""
    entries = [
        F.struct(
            F.lit(b).alias("region"),
            *[F.bround(F.col(cells[c, b] + suffix), 0).cast("bigint").alias(c) for c in columns],
        )
        for b in buckets
    ]
    return wide.withColumn("entries", F.array(*entries)).drop(
        *[n for n in wide.columns if n.startswith("_")]
    )


def redistribute_unassigned(
    df: DataFrame,
    columns: str | Sequence[str],
    buckets: Sequence[str],
    *,
    group: str = "region",
    exact: bool = False,
) -> DataFrame:
    """Rows of ``buckets`` with the unassigned remainder of each day spread by their size."""
    names = [columns] if isinstance(columns, str) else list(columns)
    days = redistributed_days(df, names, buckets, group=group, exact=exact)
    return days.select("date", F.explode("entries").alias("e")).select(
        "e.region", "date", *[f"e.{c}" for c in names]
    )


def trainable_regions(panel: DataFrame, column: str = "new_tests", more_than: int = 10) -> DataFrame:
    """Training points per region, for regions with enough of them to forecast."""
    return (
        panel.groupBy("region")
        .agg(F.count(column).alias("n_train"))
        .where(F.col("n_train") > more_than)
    )


def date_profile(panel: DataFrame, column: str = "new_tests") -> DataFrame:
    """First, last and first reported day, and the largest value of each region."""
    return panel.groupBy("region").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.min(F.when(F.col(column).isNotNull(), F.col("date"))).alias("first_reported"),
        F.max(column).alias("max_value"),
    )
