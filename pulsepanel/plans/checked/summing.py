"""Aggregations over regions (A1 to A9, A15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsepanel.operators import totals
from pulsepanel.operators.kernels import delay_kernel, drop_censored, valid_delays
from pulsepanel.operators.summary import countries_by_zone
from pulsepanel.plans.checked import derived as d
from pulsepanel.plans.checked.base import MASKED, PE, PN, PO, PU, query, sql_all, with_sql
from pulsepanel.plans.checked.loading import BELGIUM, CASE_LINES, belgium_text, case_text
from pulsepanel.sources import belgium, germany


@query(
    "a01_sum_by_region_date",
    "region date new_cases:f new_deaths:f",
    with_sql(CASE_LINES, "SELECT region, date, sum(new_cases) AS new_cases, sum(new_deaths) AS new_deaths FROM case_lines GROUP BY 1, 2"),
)
def a01(spark, sf):
    return totals.sum_by(germany.case_lines(case_text(spark, sf)), ["region", "date"], ["new_cases", "new_deaths"])


@query(
    "a02_national_total",
    "region date new_cases:f new_tests:f",
    with_sql(
        PE, MASKED,
        "SELECT region, date, new_cases, new_tests FROM masked UNION ALL "
        "SELECT 'all', date, coalesce(sum(new_cases), 0), coalesce(sum(new_tests), 0) FROM masked GROUP BY date",
    ),
)
def a02(spark, sf):
    return totals.with_national_total(d.masked_events(spark, sf), ["new_cases", "new_tests"])


@query("a02_national_total_orders", "region date new_cases:f new_tests:f", with_sql(PO, sql_all("po", "t"), "SELECT * FROM t"))
def a02_orders(spark, sf):
    return totals.with_national_total(d.panel_orders(spark, sf), ["new_cases", "new_tests"])


@query(
    "a03_total_with_minimum_count",
    "region date new_cases:f new_tests:f",
    with_sql(
        PN,
        "SELECT 'all' AS region, date, CASE WHEN count(new_cases) >= 6 THEN sum(new_cases) END AS new_cases, "
        "CASE WHEN count(new_tests) >= 6 THEN sum(new_tests) END AS new_tests FROM pn GROUP BY date",
    ),
)
def a03(spark, sf):
    return totals.national_total(d.panel_nations(spark, sf), ["new_cases", "new_tests"], min_count=6)


REDISTRIBUTED = """wide AS (
  SELECT date, coalesce(sum(new_tests) FILTER (WHERE region = 'Brussels'), 0) AS b,
         coalesce(sum(new_tests) FILTER (WHERE region = 'Flanders'), 0) AS f,
         coalesce(sum(new_tests) FILTER (WHERE region = 'Wallonia'), 0) AS w,
         coalesce(sum(new_tests) FILTER (WHERE region IS NULL), 0) AS u FROM be GROUP BY date),
w1 AS (SELECT date, u, f, w, b + coalesce(u * (b / nullif(b + f + w, 0)), 0) AS b FROM wide),
w2 AS (SELECT date, u, b, w, f + coalesce(u * (f / nullif(b + f + w, 0)), 0) AS f FROM w1),
w3 AS (SELECT date, b, f, w + coalesce(u * (w / nullif(b + f + w, 0)), 0) AS w FROM w2)"""


@query(
    "a04_redistributed_remainder",
    "region date new_tests:i",
    with_sql(
        PN, BELGIUM, REDISTRIBUTED,
        "SELECT 'Brussels' AS region, date, round_even(b, 0) AS new_tests FROM w3 UNION ALL SELECT 'Flanders', date, round_even(f, 0) FROM w3 "
        "UNION ALL SELECT 'Wallonia', date, round_even(w, 0) FROM w3",
    ),
)
def a04(spark, sf):
    rows = belgium.test_rows(belgium_text(spark, sf))
    return totals.redistribute_unassigned(rows, "new_tests", ["Brussels", "Flanders", "Wallonia"])


@query(
    "a04_exact_redistribution",
    "region date new_tests:i",
    with_sql(
        PN, BELGIUM, REDISTRIBUTED.split(",\nw1")[0],
        "SELECT region, date, round_even(v + coalesce(u * (v / nullif(s, 0)), 0), 0) AS new_tests FROM ("
        "SELECT 'Brussels' AS region, date, b AS v, b + f + w AS s, u FROM wide UNION ALL SELECT 'Flanders', date, f, b + f + w, u FROM wide "
        "UNION ALL SELECT 'Wallonia', date, w, b + f + w, u FROM wide) AS x",
    ),
)
def a04_exact(spark, sf):
    rows = belgium.test_rows(belgium_text(spark, sf))
    return totals.redistribute_unassigned(rows, "new_tests", ["Brussels", "Flanders", "Wallonia"], exact=True)


@query(
    "a05_province_sums",
    "region date new_cases:f new_tests:f",
    with_sql(
        PN, BELGIUM,
        "SELECT province AS region, date, sum(new_cases) AS new_cases, sum(new_tests) AS new_tests FROM be "
        "WHERE (region IS NULL OR region <> 'Brussels') AND province IS NOT NULL GROUP BY 1, 2",
    ),
)
def a05(spark, sf):
    return belgium.province_sums(belgium.test_rows(belgium_text(spark, sf)))


@query(
    "a06_recent_region_shares",
    "region share:f",
    with_sql(
        PE, sql_all("pe", "t"),
        "h AS (SELECT region, date, CASE WHEN day(date) <= 28 - length(region) - ascii(right(region, 1)) % 5 THEN new_tests END AS new_tests FROM t)",
        "lasts AS (SELECT region, max(date) AS d FROM h WHERE new_tests IS NOT NULL GROUP BY region)",
        "s AS (SELECT region, sum(new_tests) AS s FROM h WHERE date BETWEEN (SELECT min(d) FROM lasts) - 6 AND (SELECT min(d) FROM lasts) GROUP BY region)",
        "SELECT region, s / (SELECT s FROM s WHERE region = 'all') AS share FROM s",
    ),
)
def a06(spark, sf):
    p = totals.with_national_total(d.panel_events(spark, sf), ["new_tests"])
    last = 28 - F.length("region") - F.ascii(F.right("region", F.lit(1))) % 5
    held = p.withColumn("new_tests", F.when(F.dayofmonth("date") <= last, F.col("new_tests")))
    return totals.recent_shares(held)


GAPPED = (
    "h AS (SELECT region, date, CASE WHEN NOT (region = 'R2' AND day(date) IN (9, 26) OR region = 'R4' AND day(date) = 21) "
    "THEN new_tests END AS new_tests FROM t)"
)


@query(
    "a06_covered_region_shares",
    "region share:f",
    with_sql(
        PE, sql_all("pe", "t"), GAPPED,
        "c AS (SELECT date FROM h WHERE new_tests IS NOT NULL GROUP BY date HAVING count(DISTINCT region) = (SELECT count(DISTINCT region) FROM h))",
        "i AS (SELECT date, date - CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS island FROM c)",
        "r AS (SELECT max(date) AS d FROM i GROUP BY island HAVING count(*) >= 7)",
        "s AS (SELECT region, sum(new_tests) AS s FROM h WHERE date BETWEEN (SELECT max(d) FROM r) - 6 AND (SELECT max(d) FROM r) GROUP BY region)",
        "SELECT region, s / (SELECT s FROM s WHERE region = 'all') AS share FROM s",
    ),
)
def a06_covered(spark, sf):
    """Two regions miss days shortly before the end."""
    p = totals.with_national_total(d.panel_events(spark, sf), ["new_tests"])
    day = F.dayofmonth("date")
    gap = ((F.col("region") == "R2") & day.isin(9, 26)) | ((F.col("region") == "R4") & (day == 21))
    return totals.covered_shares(p.withColumn("new_tests", F.when(~gap, F.col("new_tests"))))


@query("a07_delay_distribution", "lag:i p:f", with_sql(d.LINE_LIST, d.DELAYS, "SELECT * FROM delay_kernel"))
def a07(spark, sf):
    return delay_kernel(drop_censored(valid_delays(d.patient_texts(spark, sf), "n")))


@query(
    "a08_date_profile",
    "region first_date last_date first_reported max_value:f",
    with_sql(
        PU,
        "m AS (SELECT region, date, CASE WHEN day(date) % 5 <> 0 THEN new_tests END AS t FROM pu)",
        "SELECT region, min(date) AS first_date, max(date) AS last_date, min(date) FILTER (WHERE t IS NOT NULL) AS first_reported, "
        "max(t) AS max_value FROM m GROUP BY region",
    ),
)
def a08(spark, sf):
    return totals.date_profile(d.masked_users(spark, sf))


@query(
    "a09_trainable_regions",
    "region n_train:i",
    with_sql(PU, "SELECT region, count(*) FILTER (WHERE day(date) % 5 <> 0) AS n_train FROM pu GROUP BY region HAVING n_train > 10"),
)
def a09(spark, sf):
    return totals.trainable_regions(d.masked_users(spark, sf))


@query(
    "a15_countries_by_zone",
    "zone countries",
    "SELECT r_name AS zone, array_to_string(list_sort(list(n_name) FILTER (WHERE n_nationkey % 2 = 0 AND r_regionkey <> 3)), ',') AS countries "
    "FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name",
)
def a15(spark, sf):
    zone = d.table(spark, sf, "region").select("r_regionkey", F.col("r_name").alias("zone"))
    nations = d.table(spark, sf, "nation").where("n_nationkey % 2 = 0 and n_regionkey <> 3")
    countries = nations.join(zone, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("alpha2"), "zone"
    )
    grouped = countries_by_zone(countries, zone.select("zone"))
    # an empty zone has no list in SQL; as text both sides are comparable
    text = F.when(F.size("countries") > 0, F.array_join("countries", ","))
    return grouped.withColumn("countries", text)
