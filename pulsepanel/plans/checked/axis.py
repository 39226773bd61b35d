"""Windows (W*) and time-axis operators (T*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsepanel.operators import calendar, kernels, vintages
from pulsepanel.operators.forecast import daily_scaling_factors
from pulsepanel.operators.renewal import r_t_path, with_exposure
from pulsepanel.operators.totals import national_total
from pulsepanel.plans.checked import derived as d
from pulsepanel.plans.checked.base import (
    MASKED,
    MASKED_USERS,
    PE,
    PN,
    PO,
    PU,
    query,
    sql_dense,
    sql_interpolate,
    sql_kernel,
    sql_reconcile,
    with_sql,
)
from pulsepanel.plans.checked.correcting import AS_OF, SNAPSHOTS, SPARSE, snapshots, sparse_totals
from pulsepanel.plans.checked.loading import OWID, iso_table, owid_text
from pulsepanel.sources import owid

DENSE_COLUMNS = "new_cases new_tests"


@query(
    "w01_difference_by_row",
    "region date step:f",
    with_sql(PO, "SELECT region, date, new_tests - lag(new_tests) OVER (PARTITION BY region ORDER BY date) AS step FROM po"),
)
def w01(spark, sf):
    return calendar.difference(d.panel_orders(spark, sf), "new_tests", "step")


@query(
    "w02_increase_since_yesterday",
    "region date increase:f",
    with_sql(
        PU,
        "SELECT a.region, a.date, CASE WHEN a.new_tests > b.new_tests THEN a.new_tests - b.new_tests END AS increase "
        "FROM pu AS a LEFT JOIN pu AS b ON b.region = a.region AND b.date = a.date - 1",
    ),
)
def w02(spark, sf):
    return calendar.increase_since_yesterday(d.panel_users(spark, sf), "new_tests", "increase")


@query(
    "w03_running_total",
    "region date total:f",
    with_sql(PO, "SELECT region, date, sum(new_cases) OVER (PARTITION BY region ORDER BY date) AS total FROM po"),
)
def w03(spark, sf):
    return calendar.running_total(d.panel_orders(spark, sf), "new_cases", "total")


@query(
    "w04_kernel_survival",
    "lag:i p:f p_active:f",
    with_sql(
        d.LINE_LIST, d.DELAYS,
        "SELECT a.lag, a.p, 1 - sum(b.p) AS p_active FROM delay_kernel AS a JOIN delay_kernel AS b ON b.lag <= a.lag GROUP BY 1, 2",
    ),
)
def w04(spark, sf):
    kernel = kernels.delay_kernel(kernels.drop_censored(kernels.valid_delays(d.patient_texts(spark, sf), "n")))
    return kernels.survival(kernel.withColumn("name", F.lit("delay")))


@query(
    "w05_interpolation_by_position",
    "region date new_tests:f",
    with_sql(PU, MASKED_USERS, sql_interpolate("masked", "filled", "new_tests"), "SELECT * FROM filled"),
)
def w05(spark, sf):
    return calendar.interpolate(d.masked_users(spark, sf), "new_tests")


@query(
    "w06_next_report_and_previous_total",
    "region date report_date report_total:f previous_total:f",
    with_sql(
        PE,
        "cum AS (SELECT region, date, sum(new_tests) OVER (PARTITION BY region ORDER BY date) AS total FROM pe)",
        "rep AS (SELECT region, date, total, lag(total) OVER (PARTITION BY region ORDER BY date) AS prev FROM cum WHERE dayofweek(date) = 0)",
        "SELECT c.region, c.date, min(r.date) AS report_date, arg_min(r.total, r.date) AS report_total, "
        "(SELECT q.prev FROM rep AS q WHERE q.region = c.region AND q.date = min(r.date)) AS previous_total "
        "FROM cum AS c LEFT JOIN rep AS r ON r.region = c.region AND r.date >= c.date GROUP BY 1, 2",
    ),
)
def w06(spark, sf):
    from pulsepanel.functions import series

    p = calendar.running_total(d.panel_events(spark, sf), "new_tests", "total")
    on_sunday = F.dayofweek("date") == 1
    reported = F.when(on_sunday, F.col("total"))
    before = F.last("_reported", ignorenulls=True).over(
        series.forward(["region"]).rowsBetween(Window.unboundedPreceding, -1)
    )
    p = p.withColumn("_reported", reported).withColumn("_before", before)
    entry = F.when(on_sunday, F.struct("date", F.col("_reported").alias("t"), F.col("_before").alias("b")))
    p = p.withColumn("_next", series.next_known(entry, ["region"]))
    return p.select(
        "region",
        "date",
        F.col("_next.date").alias("report_date"),
        F.col("_next.t").alias("report_total"),
        F.col("_next.b").alias("previous_total"),
    )


@query(
    "w07_carry_both_ways",
    "region date new_cases:f",
    with_sql(
        PU,
        "s AS (SELECT region, date, CASE WHEN new_cases > 1 THEN new_cases END AS new_cases FROM pu)",
        """SELECT region, date, coalesce(
             last_value(new_cases IGNORE NULLS) OVER (PARTITION BY region ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             first_value(new_cases IGNORE NULLS) OVER (PARTITION BY region ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS new_cases
           FROM s""",
    ),
)
def w07(spark, sf):
    p = d.panel_users(spark, sf).withColumn("new_cases", F.when(F.col("new_cases") > 1, F.col("new_cases")))
    return calendar.carry_both_ways(p, "new_cases")


@query("w08_latest_vintage_per_key", "region date new_tests:f snapshot_date", with_sql(PU, SNAPSHOTS, AS_OF))
def w08(spark, sf):
    return vintages.as_of(snapshots(spark, sf), "2024-01-20", ["region", "date"])


@query(
    "w09_last_row_per_region",
    "region date new_cases:f",
    with_sql(
        PU,
        "SELECT region, date, new_cases FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY date DESC) AS rn "
        "FROM pu WHERE new_cases > 0) AS x WHERE rn = 1",
    ),
)
def w09(spark, sf):
    p = d.panel_users(spark, sf).withColumn("new_cases", F.when(F.col("new_cases") > 0, F.col("new_cases")))
    return calendar.last_row_per_region(p, "new_cases")


@query(
    "w10_random_walk",
    "region chain draw date log_r_t:f",
    with_sql(PE, d.STEPS, "SELECT region, chain, draw, date, sum(step) OVER (PARTITION BY region, chain, draw ORDER BY date) AS log_r_t FROM steps"),
)
def w10(spark, sf):
    return r_t_path(d.log_steps(spark, sf)).withColumn("log_r_t", F.ln("r_t"))


@query(
    "w11_exposure_floor",
    "region date exposure:f",
    with_sql(
        PU, MASKED_USERS,
        "SELECT m.region, m.date, CASE WHEN new_tests IS NOT NULL THEN greatest(new_tests, 0.1 * t) END AS exposure "
        "FROM masked AS m JOIN (SELECT region, max(new_tests) AS t FROM masked GROUP BY region) AS x USING (region)",
    ),
)
def w11(spark, sf):
    return with_exposure(d.masked_users(spark, sf), "new_tests")


@query(
    "t01_insert_future",
    "region date new_cases:f new_tests:f",
    with_sql(PO, sql_dense("po", "dense", DENSE_COLUMNS, trail=14), "SELECT * FROM dense"),
)
def t01(spark, sf):
    return calendar.insert_future(d.panel_orders(spark, sf), 14)


@query(
    "t01_insert_future_users",
    "region date new_cases:f new_tests:f",
    with_sql(PU, sql_dense("pu", "dense", DENSE_COLUMNS, trail=7), "SELECT * FROM dense"),
)
def t01_users(spark, sf):
    return calendar.insert_future(d.panel_users(spark, sf), 7)


@query(
    "t02_fixed_calendar",
    "region date new_cases:f new_tests:f",
    with_sql(
        PO,
        "SELECT r.r_name AS region, r.date, coalesce(new_cases, 0) AS new_cases, coalesce(new_tests, 0) AS new_tests FROM "
        "(SELECT r_name, CAST(unnest(generate_series(DATE '1996-03-01', DATE '2001-09-30', INTERVAL 1 DAY)) AS DATE) AS date FROM region) AS r "
        "LEFT JOIN po AS p ON p.region = r.r_name AND p.date = r.date",
    ),
)
def t02(spark, sf):
    regions = d.table(spark, sf, "region").select(F.col("r_name").alias("region"))
    return calendar.fixed_calendar(
        d.panel_orders(spark, sf), regions, "1996-03-01", "2001-09-30", ["new_cases", "new_tests"]
    )


@query(
    "t03_model_axis",
    "region date new_cases:f new_tests:f",
    with_sql(
        PU,
        "firsts AS (SELECT region, coalesce(min(date) FILTER (WHERE new_cases > 0), min(date)) AS f FROM pu GROUP BY region)",
        "kept AS (SELECT pu.region, date, new_cases, new_tests FROM pu JOIN firsts ON firsts.region = pu.region WHERE date >= f)",
        sql_dense("kept", "dense", DENSE_COLUMNS, lead=10),
        "SELECT * FROM dense",
    ),
)
def t03(spark, sf):
    return calendar.model_axis(d.panel_users(spark, sf), 10)


BACK = "2023-12-01"
BACK_SQL = f"""back AS (
  SELECT region, date, new_tests FROM dense UNION ALL
  SELECT region, CAST(unnest(generate_series(DATE '{BACK}', min(date) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE), 0.0
  FROM dense GROUP BY region)"""


@query(
    "t04_back_extension",
    "region date new_tests:f",
    with_sql(PE, MASKED, sql_dense("masked", "dense", "new_tests"), BACK_SQL, sql_interpolate("back", "filled", "new_tests"), "SELECT * FROM filled"),
)
def t04(spark, sf):
    return calendar.back_extend(d.masked_events(spark, sf), "new_tests", start=BACK)


@query(
    "t05_ramp_from_anchor",
    "region date new_tests:f",
    with_sql(
        PU, MASKED_USERS,
        "anchored AS (SELECT region, date, new_tests FROM masked UNION ALL SELECT DISTINCT region, DATE '2020-01-01', 0.0 FROM masked)",
        sql_interpolate("anchored", "filled", "new_tests"),
        "SELECT * FROM filled",
    ),
)
def t05(spark, sf):
    return calendar.ramp_from_anchor(d.masked_users(spark, sf), "new_tests")


WEEKLY = """weekly AS (
  SELECT nationkey AS region, date,
         CASE WHEN dayofweek(date) = 0 THEN sum(new_tests) OVER (PARTITION BY nationkey ORDER BY date) END AS total FROM pn)"""
ANCHORED = "anchored AS (SELECT region, date, total FROM weekly UNION ALL SELECT DISTINCT region, DATE '2020-01-01', 0.0 FROM weekly)"


@query(
    "t06_weekly_totals_to_daily",
    "region:i date daily:f",
    with_sql(
        PN,
        WEEKLY,
        ANCHORED,
        sql_interpolate("anchored", "filled", "total"),
        "SELECT region, date, nullif(total - lag(total) OVER (PARTITION BY region ORDER BY date), 0) AS daily FROM filled",
    ),
)
def t06(spark, sf):
    p = calendar.running_total(d.panel_nations(spark, sf), "new_tests", "total", ["nationkey"])
    weekly = p.select(
        F.col("nationkey").alias("region"),
        "date",
        F.when(F.dayofweek("date") == 1, F.col("total")).alias("total"),
    )
    return calendar.daily_from_totals(weekly, "total", "daily")


@query(
    "t07_volume_reconciliation",
    "region date sum_predicted:f diff_reported:f scaling_factor:f",
    with_sql(
        PE, SPARSE,
        "nat AS (SELECT 'all' AS region, date, sum(new_cases) * 5 AS predicted FROM pe GROUP BY date)",
        "j AS (SELECT n.region, n.date, predicted, owid_total_tests FROM nat AS n LEFT JOIN sparse AS s ON s.date = n.date)",
        sql_reconcile("j", "rec", "predicted", "owid_total_tests"),
        "SELECT * FROM rec",
    ),
)
def t07(spark, sf):
    p = d.panel_events(spark, sf)
    nat = national_total(p, ["new_cases"]).select("region", "date", (F.col("new_cases") * 5).alias("predicted"))
    joined = nat.join(sparse_totals(p), ["region", "date"], "left")
    return daily_scaling_factors(joined, "predicted", "owid_total_tests")


@query(
    "t07_reconciliation_users",
    "region date sum_predicted:f diff_reported:f scaling_factor:f",
    with_sql(
        PU,
        "j AS (SELECT region, date, new_cases + 1 AS predicted, CASE WHEN day(date) % 7 = 0 THEN sum(new_tests) OVER "
        "(PARTITION BY region ORDER BY date) END AS reported FROM pu)",
        sql_reconcile("j", "rec", "predicted", "reported"),
        "SELECT * FROM rec",
    ),
)
def t07_users(spark, sf):
    p = calendar.running_total(d.panel_users(spark, sf), "new_tests", "total")
    p = p.select(
        "region",
        "date",
        (F.col("new_cases") + 1).alias("predicted"),
        F.when(F.dayofmonth("date") % 7 == 0, F.col("total")).alias("reported"),
    )
    return daily_scaling_factors(p, "predicted", "reported")


@query(
    "t08_reported_national_totals",
    "region date owid_total_tests:f",
    with_sql(PN, OWID, "SELECT region, date, total_tests AS owid_total_tests FROM owid WHERE country = 'CX'"),
)
def t08(spark, sf):
    return owid.summarized_totals(owid.owid_panel(owid_text(spark, sf), iso_table(spark, sf)), "CX")


KERNEL = [0.0, 0.1, 0.25, 0.3, 0.2, 0.1, 0.05]


@query(
    "j11_lag_convolution",
    "region date convolved:f",
    with_sql(
        PO,
        sql_dense("po", "dense", DENSE_COLUMNS),
        sql_kernel("kernel", KERNEL),
        "SELECT a.region, a.date, coalesce(sum(b.new_cases * k.p), 0.0) AS convolved FROM dense AS a JOIN kernel AS k ON true "
        "LEFT JOIN dense AS b ON b.region = a.region AND b.date = a.date - k.lag GROUP BY 1, 2",
    ),
)
def j11(spark, sf):
    dense = calendar.densify(d.panel_orders(spark, sf))
    return kernels.convolve(dense, "new_cases", KERNEL, "convolved")
