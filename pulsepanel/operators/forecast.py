"""Test-count forecasting: trend x weekday x holiday, for every region in one job.

Each series is decomposed in closed form with window aggregates over its region, or (``growth``)
fitted jointly, see ``operators.growth``. Either way any number of regions is forecast with a
single shuffle. A region contributes one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsepanel.functions import series
from pulsepanel.operators.growth import HOLIDAY_CLASSES, Growth, fit_growth

# A trend this close to zero says nothing about the ratio of a day to its trend.
SMALLEST_TREND = 1e-9


@dataclass(frozen=True)
class ForecastOptions:
    """Options of the forecast.

    keep_data      keep reported counts and predict only the missing ones; otherwise smooth all
    ignore_before  no fitting or predicting before this day (nor before the first report)
    cap            bound predictions of the closed form by the largest report
    segment_days   length of a trend segment of the closed form; None fits one trend line per series
    more_than      forecast only series with more than this many reports
    growth         fit trend, weekday and holiday effects jointly, the trend saturating or with changing slope
    """

    keep_data: bool = True
    ignore_before: str | None = "2020-03-15"
    cap: bool = False
    segment_days: int | None = None
    more_than: int = 10
    growth: Growth | None = None


def fit_components(
    panel: DataFrame,
    options: ForecastOptions = ForecastOptions(),
    *,
    keys: Sequence[str] = ("region",),
    column: str = "new_tests",
) -> DataFrame:
    """Panel plus ``trend, weekly, holiday_effect, yhat`` and the fit start ``fit_from``.

    A ``holiday`` class column is used when the panel has one (see ``with_holidays``).
    """
    w = series.whole(keys)
    y = F.col(column).cast("double")
    first_report = F.min(F.when(y.isNotNull(), F.col("date"))).over(w)
    fit_from = first_report
    if options.ignore_before:
        fit_from = F.greatest(F.lit(options.ignore_before).cast("date"), first_report)
    df = panel.withColumns({"fit_from": fit_from, "n_train": F.count(y).over(w)})
    df = df.withColumn("_x", F.datediff("date", "fit_from").cast("double")).withColumn(
        "_y", F.when((F.col("date") >= F.col("fit_from")) & (F.col("n_train") > options.more_than), y)
    )
    if options.growth:
        training = df.select(*panel.columns, "fit_from", "n_train", "_y")
        fitted = fit_growth(training, "_y", options.growth, keys)
        yhat = F.greatest(F.col("trend") * F.col("weekly") * F.col("holiday_effect"), F.lit(0.0))
        return fitted.withColumn("yhat", F.when(F.col("trend").isNotNull(), yhat)).drop("_y").select(
            *panel.columns, "fit_from", "n_train", "trend", "weekly", "holiday_effect", "yhat"
        )
    df = df.withColumn(
        "trend", F.regr_intercept("_y", "_x").over(w) + F.regr_slope("_y", "_x").over(w) * F.col("_x")
    )
    if options.segment_days:
        df = _segment_trend(df, keys, options.segment_days)
    ratio = F.when(F.col("trend") > SMALLEST_TREND, F.col("_y") / F.col("trend"))
    df = df.withColumn("_ratio", ratio).withColumn("_dow", F.dayofweek("date"))
    profile = [F.avg(F.when(F.col("_dow") == d, F.col("_ratio"))).over(w) for d in range(1, 8)]
    df = df.withColumn("_profile", F.array(*profile))
    known = F.filter("_profile", lambda v: v.isNotNull())
    mean = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, v: a + v), F.size(known).cast("double"))
    weekly = F.coalesce(F.try_divide(F.element_at("_profile", F.col("_dow")), mean), F.lit(1.0))
    df = df.withColumn("weekly", weekly)
    df = df.withColumn("holiday_effect", _holiday_effect(df, w))
    yhat = F.greatest(F.col("trend") * F.col("weekly") * F.col("holiday_effect"), F.lit(0.0))
    # greatest() skips NULLs, so a series without a trend needs its own guard
    yhat = F.when(F.col("trend").isNotNull(), yhat)
    if options.cap:
        yhat = F.when(yhat.isNotNull(), F.least(yhat, F.max("_y").over(w)))
    return df.withColumn("yhat", yhat).select(
        *panel.columns, "fit_from", "n_train", "trend", "weekly", "holiday_effect", "yhat"
    )


def _segment_trend(df: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """Trend per segment of ``days``; the last trained segment extrapolates.

    A segment with fewer than two reports falls back to the trend of the whole series.
    """
    w = series.whole(keys)
    index = F.floor(F.col("_x") / F.lit(float(days)))
    last = F.max(F.when(F.col("_y").isNotNull(), index)).over(w)
    df = df.withColumn("_segment", F.least(F.greatest(index, F.lit(0)), last))
    ws = series.whole([*keys, "_segment"])
    local = F.regr_intercept("_y", "_x").over(ws) + F.regr_slope("_y", "_x").over(ws) * F.col("_x")
    return df.withColumn("trend", F.coalesce(local, F.col("trend")))


def _holiday_effect(df: DataFrame, w):
    if "holiday" not in df.columns:
        return F.lit(1.0)
    expected = F.col("trend") * F.col("weekly")
    residual = F.when(expected > SMALLEST_TREND, F.col("_y") / expected)
    effect = F.when(F.col("holiday").isNull(), F.lit(1.0))
    for name in HOLIDAY_CLASSES:
        of_class = F.col("holiday") == name
        effect = effect.when(of_class, F.avg(F.when(of_class, residual)).over(w))
    return F.coalesce(effect, F.lit(1.0))


def predict_testcounts(
    panel: DataFrame,
    options: ForecastOptions = ForecastOptions(),
    *,
    keys: Sequence[str] = ("region",),
    column: str = "new_tests",
    target: str = "predicted_new_tests",
) -> DataFrame:
    """Panel with ``target``: predictions where asked for, reports elsewhere.

    Series with too few reports get NULL throughout.
    """
    fitted = fit_components(panel, options, keys=keys, column=column)
    replace = F.col("date") >= F.col("fit_from")
    if options.keep_data:
        replace = replace & F.col(column).isNull()
    value = F.when(replace, F.col("yhat")).otherwise(F.col(column).cast("double"))
    return fitted.withColumn(
        target, F.when(F.col("n_train") > options.more_than, value)
    ).select(*[c for c in panel.columns if c != target], target)


def forecast_components(
    panel: DataFrame,
    options: ForecastOptions = ForecastOptions(),
    *,
    keys: Sequence[str] = ("region",),
    column: str = "new_tests",
) -> DataFrame:
    """Component table for inspection, from the first fitted day on."""
    fitted = fit_components(panel, options, keys=keys, column=column)
    return fitted.where(F.col("date") >= F.col("fit_from")).select(
        *keys, "date", "trend", "weekly", "holiday_effect", "yhat"
    )


def daily_scaling_factors(
    panel: DataFrame,
    predicted: str,
    reported_totals: str,
    keys: Sequence[str] = ("region",),
) -> DataFrame:
    """Reconcile a daily forecast with sparse cumulative reports.

    Per reporting interval (previous report, this report] the factor is the growth of the
    reported total divided by the sum of the forecast. The first factor is carried back to the
    start, the last one forward to the end.
    """
    total = F.col(reported_totals).cast("double")
    report_day = F.when(total.isNotNull(), F.col("date"))
    earlier = F.last(total, ignorenulls=True).over(
        series.forward(keys).rowsBetween(Window.unboundedPreceding, -1)
    )
    df = panel.withColumns(
        {
            "_interval": series.next_known(report_day, keys),
            "_growth": total - earlier,
        }
    )
    interval = series.whole([*keys, "_interval"])
    has_start = F.max("_growth").over(interval)
    df = df.withColumn(
        "diff_reported", F.when(F.col("_interval").isNotNull(), has_start)
    ).withColumn(
        "sum_predicted",
        F.when(F.col("diff_reported").isNotNull(), F.sum(predicted).over(interval)),
    )
    df = df.withColumn("_factor", F.try_divide("diff_reported", "sum_predicted"))
    factor = F.coalesce(
        series.last_known(F.col("_factor"), keys), series.next_known(F.col("_factor"), keys)
    )
    return df.withColumn("scaling_factor", factor).select(
        *keys, "date", "sum_predicted", "diff_reported", "scaling_factor"
    )
