"""Test-count forecasting (F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsepanel.operators.calendar import insert_future
from pulsepanel.operators.combine import holiday_calendar, with_holidays
from pulsepanel.operators.forecast import (
    ForecastOptions,
    fit_components,
    forecast_components,
    predict_testcounts,
)
from pulsepanel.operators.growth import Growth
from pulsepanel.plans.checked import derived as d
from pulsepanel.plans.checked.base import (
    MASKED,
    MASKED_USERS,
    PE,
    PO,
    PU,
    query,
    sql_dense,
    sql_fit,
    sql_growth,
    sql_predict,
    with_sql,
)
from pulsepanel.plans.checked.correcting import HOLIDAYS, holidays

EARLY = "2024-01-04"
OPTIONS = ForecastOptions(ignore_before=EARLY)
FIT = "region date fit_from n_train:i trend:f weekly:f yhat:f"
JOINT = "region date fit_from n_train:i trend:r weekly:r holiday_effect:r yhat:r"
SATURATING = Growth("logistic", knot_days=None, effects=False)
CHANGING = Growth(effects=False)


def sparse_orders(spark, sf, trail: int = 14):
    """Gap-free order panel with missing tests and future days."""
    return insert_future(d.mask_tests(d.panel_orders(spark, sf)), trail)


SPARSE_ORDERS = (
    "mo AS (SELECT region, date, new_cases, CASE WHEN day(date) % 5 = 0 THEN NULL ELSE new_tests END AS new_tests FROM po), "
    + sql_dense("mo", "dense", "new_cases new_tests", trail=14)
)


@query(
    "f01_fit_rows",
    "region n_fit:i first_fit",
    with_sql(
        PU, MASKED_USERS, sql_fit("masked", "fit", ignore_before=EARLY),
        "SELECT region, count(_y) AS n_fit, min(date) FILTER (WHERE _y IS NOT NULL) AS first_fit FROM fit GROUP BY region",
    ),
)
def f01(spark, sf):
    fitted = fit_components(d.masked_users(spark, sf), OPTIONS)
    used = (F.col("date") >= F.col("fit_from")) & F.col("new_tests").isNotNull() & (F.col("n_train") > 10)
    return fitted.groupBy("region").agg(
        F.count_if(used).alias("n_fit"), F.min(F.when(used, F.col("date"))).alias("first_fit")
    )


@query(
    "f02_fit_start",
    "region fit_from",
    with_sql(
        PU, MASKED_USERS,
        f"SELECT region, greatest(DATE '{EARLY}', min(date) FILTER (WHERE new_tests IS NOT NULL)) AS fit_from FROM masked GROUP BY region",
    ),
)
def f02(spark, sf):
    fitted = fit_components(d.masked_users(spark, sf), OPTIONS)
    return fitted.groupBy("region").agg(F.max("fit_from").alias("fit_from"))


@query(
    "f03_keep_reported_counts",
    "region date new_tests:f predicted_new_tests:f",
    with_sql(
        PU, MASKED_USERS, sql_fit("masked", "fit", ignore_before=EARLY), sql_predict("fit", "pred"), "SELECT * FROM pred"
    ),
)
def f03_keep(spark, sf):
    return predict_testcounts(d.masked_users(spark, sf), OPTIONS)


@query(
    "f03_smooth_all_counts",
    "region date new_tests:f predicted_new_tests:f",
    with_sql(
        PE, MASKED, sql_fit("masked", "fit", ignore_before=EARLY), sql_predict("fit", "pred", keep_data=False), "SELECT * FROM pred"
    ),
)
def f03_smooth(spark, sf):
    return predict_testcounts(d.masked_events(spark, sf), ForecastOptions(keep_data=False, ignore_before=EARLY))


@query(
    "f04_linear_trend",
    FIT,
    with_sql(PO, SPARSE_ORDERS, sql_fit("dense", "fit", ignore_before="1996-03-15"), "SELECT * FROM fit"),
)
def f04(spark, sf):
    return fit_components(sparse_orders(spark, sf), ForecastOptions(ignore_before="1996-03-15"))


@query(
    "f04_capped_prediction",
    "region date yhat:f",
    with_sql(
        PE, MASKED, sql_fit("masked", "fit", ignore_before=EARLY),
        "SELECT f.region, f.date, least(yhat, m) AS yhat FROM fit AS f JOIN (SELECT region, max(_y) AS m FROM fit GROUP BY region) AS x USING (region)",
    ),
)
def f04_cap(spark, sf):
    return fit_components(d.masked_events(spark, sf), ForecastOptions(ignore_before=EARLY, cap=True))


@query(
    "f05_segment_trend",
    FIT,
    with_sql(
        PO, SPARSE_ORDERS, sql_fit("dense", "fit", ignore_before="1996-03-15", segment_days=30), "SELECT * FROM fit"
    ),
)
def f05(spark, sf):
    return fit_components(
        sparse_orders(spark, sf), ForecastOptions(ignore_before="1996-03-15", segment_days=30)
    )


@query(
    "f04_saturating_growth",
    JOINT,
    with_sql(
        PE, MASKED, sql_growth("masked", "fit", SATURATING, iterations=25, ignore_before=EARLY), "SELECT * FROM fit"
    ),
)
def f04_saturating(spark, sf):
    return fit_components(d.masked_events(spark, sf), ForecastOptions(ignore_before=EARLY, growth=SATURATING))


@query(
    "f05_changepoint_trend",
    JOINT,
    with_sql(
        PO, SPARSE_ORDERS, sql_growth("dense", "fit", CHANGING, iterations=1, ignore_before="1996-03-15"), "SELECT * FROM fit"
    ),
)
def f05_changes(spark, sf):
    """A continuous trend over some 2,400 days with a possible change of slope a month."""
    return fit_components(
        sparse_orders(spark, sf), ForecastOptions(ignore_before="1996-03-15", growth=CHANGING)
    )


@query(
    "f06_weekday_profile",
    "region weekday:i weekly:f",
    with_sql(
        PO, SPARSE_ORDERS, sql_fit("dense", "fit", ignore_before="1996-03-15"),
        "SELECT region, dayofweek(date) + 1 AS weekday, max(weekly) AS weekly FROM fit GROUP BY 1, 2",
    ),
)
def f06(spark, sf):
    fitted = fit_components(sparse_orders(spark, sf), ForecastOptions(ignore_before="1996-03-15"))
    return fitted.groupBy("region", F.dayofweek("date").alias("weekday")).agg(F.max("weekly").alias("weekly"))


WITH_HOLIDAYS = """held AS (
  SELECT p.region, p.date, p.new_cases, p.new_tests, h.holiday FROM pe AS p LEFT JOIN (
    SELECT date, CASE WHEN bool_or(region IS NULL) THEN 'national' ELSE 'regional' END AS holiday
    FROM hol WHERE alpha2 = 'XX' GROUP BY date) AS h USING (date))"""


@query(
    "f07_holiday_effect",
    "region date holiday holiday_effect:f yhat:f",
    with_sql(PE, HOLIDAYS, WITH_HOLIDAYS, sql_fit("held", "fit", ignore_before="2023-12-15", holiday=True), "SELECT * FROM fit"),
)
def f07(spark, sf):
    panel = with_holidays(d.panel_events(spark, sf), holiday_calendar(holidays(spark), "XX", "all"))
    return fit_components(panel, ForecastOptions(ignore_before="2023-12-15"))


@query(
    "f06_joint_weekdays",
    JOINT,
    with_sql(
        PE, MASKED, sql_growth("masked", "fit", Growth(), iterations=40, ignore_before=EARLY), "SELECT * FROM fit"
    ),
)
def f06_joint(spark, sf):
    return fit_components(d.masked_events(spark, sf), ForecastOptions(ignore_before=EARLY, growth=Growth()))


@query(
    "f07_joint_holidays",
    JOINT + " holiday",
    with_sql(
        PE, HOLIDAYS, WITH_HOLIDAYS,
        sql_growth("held", "fit", Growth("logistic"), iterations=40, ignore_before="2023-12-15", holiday=True),
        "SELECT * FROM fit",
    ),
)
def f07_joint(spark, sf):
    """All parts of the forecast model: saturating trend with changes, weekdays and holidays."""
    panel = with_holidays(d.panel_events(spark, sf), holiday_calendar(holidays(spark), "XX", "all"))
    return fit_components(panel, ForecastOptions(ignore_before="2023-12-15", growth=Growth("logistic")))


@query(
    "f08_no_negative_prediction",
    "region date yhat:f",
    with_sql(
        PU,
        "falling AS (SELECT region, date, greatest(new_tests - day(date) / 4.0, 0.0) AS new_tests FROM pu)",
        sql_dense("falling", "dense", "new_tests", trail=20),
        sql_fit("dense", "fit", ignore_before=None),
        "SELECT * FROM fit",
    ),
)
def f08(spark, sf):
    falling = d.panel_users(spark, sf).select(
        "region",
        "date",
        F.greatest(F.col("new_tests") - F.dayofmonth("date") / 4.0, F.lit(0.0)).alias("new_tests"),
    )
    return fit_components(insert_future(falling, 20), ForecastOptions(ignore_before=None))


@query(
    "f09_component_table",
    "region date trend:f weekly:f holiday_effect:f yhat:f",
    with_sql(
        PE, MASKED, sql_fit("masked", "fit", ignore_before=EARLY), "SELECT * FROM fit WHERE date >= fit_from"
    ),
)
def f09(spark, sf):
    return forecast_components(d.masked_events(spark, sf), OPTIONS)


@query(
    "f11_process_testcounts",
    "region date new_cases:f new_tests:f predicted_new_tests:f",
    with_sql(
        PU, MASKED_USERS, sql_dense("masked", "dense", "new_cases new_tests", trail=7),
        sql_fit("dense", "fit", ignore_before=EARLY), sql_predict("fit", "pred"), "SELECT * FROM pred",
    ),
)
def f11(spark, sf):
    return predict_testcounts(insert_future(d.masked_users(spark, sf), 7), OPTIONS)
