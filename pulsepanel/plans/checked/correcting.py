"""Value rules, filters, patches (P*, C*), joins (J*), sorts (O*) and set operations (U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsepanel.functions import values
from pulsepanel.operators import calendar, checks, clean, combine, patches, totals, vintages
from pulsepanel.operators.kernels import drop_censored, valid_delays
from pulsepanel.operators.renewal import display_range
from pulsepanel.plans.checked import derived as d
from pulsepanel.plans.checked.base import (
    MASKED,
    PE,
    PN,
    PO,
    PU,
    query,
    sql_all,
    with_sql,
)
from pulsepanel.plans.checked.loading import (
    AGECLASS,
    CASE_LINES,
    NOWCAST,
    ageclass_text,
    case_text,
    nowcast_text,
)
from pulsepanel.sources import france, germany, united_states
from pulsepanel.sources.fixed_values import NOWCAST_LABELS

REGION_CODES = (("AFRICA", "AF"), ("AMERICA", "AM"), ("ASIA", "AS"))
CODES = "codes AS (SELECT * FROM (VALUES ('AFRICA', 'AF'), ('AMERICA', 'AM'), ('ASIA', 'AS')) AS c(name, code))"


def codes(spark):
    return spark.createDataFrame(list(REGION_CODES), "name string, code string")


@query(
    "p01_canonical_columns",
    "region date new_cases:f",
    with_sql(CASE_LINES, "SELECT region, date, sum(new_cases) AS new_cases FROM case_lines GROUP BY 1, 2"),
)
def p01(spark, sf):
    typed = germany.case_lines(case_text(spark, sf))
    renamed = clean.rename(typed, {"region": "region", "date": "date", "new_cases": "new_cases"})
    return totals.sum_by(renamed, ["region", "date"], ["new_cases"])


@query(
    "p02_codes_keep_unmapped",
    "region date new_tests:f",
    with_sql(PO, CODES, "SELECT coalesce(code, region) AS region, date, new_tests FROM po LEFT JOIN codes ON name = region"),
)
def p02(spark, sf):
    return clean.map_codes(d.panel_orders(spark, sf), codes(spark), "region", keep_unmapped=True)


@query(
    "p03_codes_null_unmapped",
    "region date new_tests:f",
    with_sql(PO, CODES, "SELECT code AS region, date, new_tests FROM po LEFT JOIN codes ON name = region"),
)
def p03(spark, sf):
    return clean.map_codes(d.panel_orders(spark, sf), codes(spark), "region", keep_unmapped=False)


def shifted(spark, sf):
    """Counts shifted so that some become negative or zero."""
    return d.panel_users(spark, sf).withColumns(
        {"new_cases": F.col("new_cases") - 1, "new_deaths": F.col("new_deaths") - 2}
    )


SHIFTED = "s AS (SELECT region, date, new_cases - 1 AS new_cases, new_tests, new_deaths - 2 AS new_deaths FROM pu)"


@query(
    "p04_negative_to_null",
    "region date new_cases:f new_tests:f new_deaths:f",
    with_sql(
        PU, SHIFTED,
        "SELECT region, date, CASE WHEN new_cases >= 0 THEN new_cases END AS new_cases, new_tests, "
        "CASE WHEN new_deaths >= 0 THEN new_deaths END AS new_deaths FROM s",
    ),
)
def p04(spark, sf):
    return clean.negatives_to_null(shifted(spark, sf))


@query(
    "p04_negative_counts",
    "new_cases:i new_tests:i new_deaths:i",
    with_sql(
        PU, SHIFTED,
        "SELECT count(*) FILTER (WHERE new_cases < 0) AS new_cases, count(*) FILTER (WHERE new_tests < 0) AS new_tests, "
        "count(*) FILTER (WHERE new_deaths < 0) AS new_deaths FROM s",
    ),
)
def p04_counts(spark, sf):
    return checks.negative_counts(shifted(spark, sf))


@query(
    "p05_zero_to_null",
    "region date new_cases:f",
    with_sql(PU, SHIFTED, "SELECT region, date, nullif(new_cases, 0) AS new_cases FROM s"),
)
def p05(spark, sf):
    return shifted(spark, sf).withColumn("new_cases", values.null_if_zero(F.col("new_cases")))


@query(
    "p06_not_positive_to_null",
    "region date new_cases:f",
    with_sql(PU, SHIFTED, "SELECT region, date, CASE WHEN new_cases > 0 THEN new_cases END AS new_cases FROM s"),
)
def p06(spark, sf):
    return shifted(spark, sf).withColumn("new_cases", values.null_if_not_positive(F.col("new_cases")))


@query(
    "p07_total_ageclass",
    "region date new_cases:f new_tests:f",
    with_sql(PN, AGECLASS, "SELECT * FROM ageclass WHERE ageclass = 0"),
)
def p07(spark, sf):
    return clean.only_total_ageclass(france.region_days(ageclass_text(spark, sf)))


@query(
    "p08_before_run_date",
    "region date new_tests:f",
    with_sql(PO, "SELECT region, date, new_tests FROM po WHERE date <= DATE '2000-05-31'"),
)
def p08(spark, sf):
    return clean.before_run_date(d.panel_orders(spark, sf), "2000-06-01")


@query(
    "p09_excluded_territories",
    "region date new_tests:f",
    with_sql(PO, "SELECT region, date, new_tests FROM po WHERE region NOT IN ('ASIA', 'EUROPE')"),
)
def p09(spark, sf):
    return clean.exclude_regions(d.panel_orders(spark, sf), ["ASIA", "EUROPE"])


@query(
    "p10_known_regions",
    "region date new_tests:f",
    with_sql(PO, CODES, "SELECT region, date, new_tests FROM po WHERE region IN (SELECT name FROM codes)"),
)
def p10(spark, sf):
    dim = codes(spark).select(F.col("name").alias("region"))
    return clean.known_regions(d.panel_orders(spark, sf), dim)


@query(
    "p11_drop_unassigned_after_total",
    "region date new_tests:f",
    with_sql(PO, sql_all("po", "t"), "SELECT region, date, new_tests FROM t WHERE region <> 'MIDDLE EAST'"),
)
def p11(spark, sf):
    total = totals.with_national_total(d.panel_orders(spark, sf), ["new_tests"])
    return clean.exclude_regions(total, ["MIDDLE EAST"])


def counter_panel(spark, sf):
    """Counters in which positives overtake tests late in the month."""
    p = d.panel_events(spark, sf).withColumn("new_tests", F.col("new_tests") / 4)
    p = calendar.running_total(p, "new_cases", "positive")
    return calendar.running_total(p, "new_tests", "total")


COUNTER_PANEL = """cp AS (
  SELECT region, date, new_cases, new_tests / 4 AS new_tests,
         sum(new_cases) OVER w AS positive, sum(new_tests / 4) OVER w AS total
  FROM pe WINDOW w AS (PARTITION BY region ORDER BY date))"""


@query(
    "p12_positives_not_above_tests",
    "region date new_cases:f new_tests:f",
    with_sql(
        PE, COUNTER_PANEL,
        "SELECT region, date, CASE WHEN bad THEN NULL ELSE new_cases END AS new_cases, "
        "CASE WHEN bad THEN NULL ELSE new_tests END AS new_tests FROM (SELECT *, "
        "date >= DATE '2024-01-10' AND positive >= total AND region NOT IN ('R1', 'R2') AS bad FROM cp) AS x",
    ),
)
def p12(spark, sf):
    return clean.positives_not_above_tests(counter_panel(spark, sf), "2024-01-10", ["R1", "R2"])


@query(
    "p14_plausible_delays",
    "onset delay:i n:i",
    with_sql(d.LINE_LIST, d.DELAYS, "SELECT * FROM delays"),
)
def p14(spark, sf):
    return valid_delays(d.patient_texts(spark, sf), "n")


@query(
    "p13_line_list_repairs",
    "onset delay:i n:i",
    with_sql(
        d.LINE_LIST,
        """fixed AS (SELECT DATE '2020-01-31' + CAST(datediff('day', DATE '1995-01-01', onset) % 7 AS INTEGER) AS onset,
             DATE '2020-05-01' AS confirmed FROM ll WHERE country <> 'Mexico')""",
        "SELECT CASE WHEN onset = DATE '2020-02-01' THEN DATE '2020-01-31' ELSE onset END AS onset, "
        "date_diff('day', CASE WHEN onset = DATE '2020-02-01' THEN DATE '2020-01-31' ELSE onset END, confirmed) AS delay, "
        "count(*) AS n FROM fixed GROUP BY 1, 2",
    ),
)
def p13(spark, sf):
    texts = d.patient_texts(spark, sf)
    original = F.to_date("onset", "dd.MM.yyyy")
    day = F.date_add(F.lit("2020-01-31").cast("date"), F.datediff(original, F.lit("1995-01-01").cast("date")) % 7)
    onset = F.date_format(day, "dd.MM.yyyy")
    broken = texts.select(
        "country",
        F.when(onset == "01.02.2020", F.lit("01.31.2020")).otherwise(onset).alias("onset"),
        F.lit("31.04.2020").alias("confirmed"),
        "n",
    )
    return valid_delays(broken, "n")


@query(
    "p15_without_censored_onsets",
    "onset delay:i n:i",
    with_sql(d.LINE_LIST, d.DELAYS, "SELECT * FROM uncensored"),
)
def p15(spark, sf):
    return drop_censored(valid_delays(d.patient_texts(spark, sf), "n"))


def snapshots(spark, sf):
    """Every user-day three times: two revisions and, for late days, one more."""
    p = d.panel_users(spark, sf).select("region", "date", "new_tests")
    lags = F.explode(F.array(F.lit(1), F.lit(3), F.lit(9))).alias("_lag")
    return p.select("*", lags).select(
        "region",
        "date",
        (F.col("new_tests") + F.col("_lag")).alias("new_tests"),
        F.date_add("date", F.col("_lag")).alias("snapshot_date"),
    )


SNAPSHOTS = """snap AS (
  SELECT region, date, new_tests + l AS new_tests, date + CAST(l AS INTEGER) AS snapshot_date
  FROM pu, (VALUES (1), (3), (9)) AS x(l))"""

AS_OF = """SELECT region, date, new_tests, snapshot_date FROM (
  SELECT *, row_number() OVER (PARTITION BY region, date ORDER BY snapshot_date DESC) AS rn
  FROM snap WHERE snapshot_date <= DATE '2024-01-20') AS x WHERE rn = 1"""


@query("p16_as_of_run_date", "region date new_tests:f snapshot_date", with_sql(PU, SNAPSHOTS, AS_OF))
def p16(spark, sf):
    return vintages.as_of(snapshots(spark, sf), "2024-01-20")


@query(
    "p16_newest_snapshot",
    "region date new_tests:f snapshot_date",
    with_sql(PU, SNAPSHOTS, "SELECT * FROM snap WHERE snapshot_date = DATE '2024-01-20'"),
)
def p16_newest(spark, sf):
    return vintages.snapshot_as_of(snapshots(spark, sf), "2024-01-20")


@query(
    "p17_single_publication_mark",
    "n_marks:i mark is_valid",
    "SELECT count(DISTINCT '03.08.2001, 00:00 Uhr') AS n_marks, min('03.08.2001, 00:00 Uhr') AS mark, true AS is_valid FROM orders",
)
def p17(spark, sf):
    return checks.snapshot_mark(germany.case_lines(case_text(spark, sf)), "mark", "03.08.2001")


@query(
    "p21_display_range",
    "region date new_tests:f",
    with_sql(
        PE,
        "ob AS (SELECT region, date, CASE WHEN day(date) <= 25 THEN new_cases END AS new_cases, new_tests FROM pe)",
        "SELECT ob.region, ob.date, ob.new_tests FROM ob JOIN (SELECT region, min(date) + 3 AS lo, "
        "max(date) FILTER (WHERE new_cases IS NOT NULL) AS hi FROM ob GROUP BY region) AS b "
        "ON ob.region = b.region WHERE ob.date BETWEEN lo AND hi",
    ),
)
def p21(spark, sf):
    observed = d.panel_events(spark, sf).withColumn(
        "new_cases", F.when(F.dayofmonth("date") <= 25, F.col("new_cases"))
    )
    return display_range(observed, observed)


@query(
    "p23_data_masks",
    "region n_dates:i n_with_cases:i n_with_testcounts:i n_with_data:i",
    with_sql(
        PU,
        "m AS (SELECT region, CASE WHEN new_cases > 0 THEN new_cases END AS c, CASE WHEN day(date) % 5 <> 0 THEN new_tests END AS t FROM pu)",
        "SELECT region, count(*) AS n_dates, count(c) AS n_with_cases, count(t) AS n_with_testcounts, "
        "count(*) FILTER (WHERE c IS NOT NULL AND t IS NOT NULL) AS n_with_data FROM m GROUP BY region",
    ),
)
def p23(spark, sf):
    p = d.masked_users(spark, sf).withColumn("new_cases", values.null_if_not_positive(F.col("new_cases")))
    return checks.mask_counts(p)


# --- joins ---------------------------------------------------------------------------------


def cases_and_tests(spark, sf):
    """Cases of odd days and tests of early days: neither side has every key."""
    p = d.panel_users(spark, sf)
    cases = p.where(F.dayofmonth("date") % 2 == 1).select("region", "date", "new_cases")
    tests = p.where(F.dayofmonth("date") <= 20).select("region", "date", "new_tests")
    return cases, tests


@query(
    "j01_cases_tests_outer",
    "region date new_cases:f new_tests:f",
    with_sql(
        PU,
        "SELECT region, date, CASE WHEN day(date) % 2 = 1 THEN new_cases END AS new_cases, "
        "CASE WHEN day(date) <= 20 THEN new_tests END AS new_tests FROM pu WHERE day(date) % 2 = 1 OR day(date) <= 20",
    ),
)
def j01(spark, sf):
    return combine.outer_merge(*cases_and_tests(spark, sf))


def sparse_totals(panel):
    """Cumulative national totals, reported on Sundays only."""
    nat = totals.national_total(panel, ["new_tests"])
    total = calendar.running_total(nat, "new_tests", "owid_total_tests")
    return total.where(F.dayofweek("date") == 1).select("region", "date", "owid_total_tests")


SPARSE = """sparse AS (
  SELECT 'all' AS region, date, owid_total_tests FROM (
    SELECT date, sum(sum(new_tests)) OVER (ORDER BY date) AS owid_total_tests FROM pe GROUP BY date) AS x
  WHERE dayofweek(date) = 0)"""


@query(
    "j02_sparse_totals_outer",
    "region date new_tests:f owid_total_tests:f",
    with_sql(
        PE, sql_all("pe", "t"), SPARSE,
        "SELECT region, date, new_tests, owid_total_tests FROM t FULL JOIN sparse USING (region, date)",
    ),
)
def j02(spark, sf):
    p = d.panel_events(spark, sf)
    return combine.outer_merge(totals.with_national_total(p, ["new_tests"]), sparse_totals(p))


@query(
    "j03_yesterday",
    "region date new_tests:f yesterday:f",
    with_sql(
        PO,
        "SELECT a.region, a.date, a.new_tests, b.new_tests AS yesterday FROM po AS a LEFT JOIN po AS b "
        "ON b.region = a.region AND b.date = a.date - 1",
    ),
)
def j03(spark, sf):
    return d.panel_orders(spark, sf).withColumn("yesterday", calendar.yesterday("new_tests"))


@query(
    "j04_dimension_lookup",
    "region date new_tests:f code",
    with_sql(PO, CODES, "SELECT region, date, new_tests, code FROM po LEFT JOIN codes ON name = region"),
)
def j04(spark, sf):
    dim = codes(spark).withColumnRenamed("name", "region")
    return combine.with_dimension(d.panel_orders(spark, sf), dim, ["region"])


@query(
    "j05_case_regions_without_tests",
    "region",
    with_sql(
        PU,
        "SELECT DISTINCT region FROM pu WHERE new_cases > 1 EXCEPT SELECT region FROM pu WHERE new_tests >= 4",
    ),
)
def j05(spark, sf):
    p = d.panel_users(spark, sf)
    return combine.regions_without(p.where("new_cases > 1"), p.where("new_tests >= 4"))


@query(
    "j06_factor_by_date",
    "region date new_tests:f factor:f",
    with_sql(
        PE,
        "SELECT region, date, new_tests, t / 100 AS factor FROM pe JOIN (SELECT date, sum(new_tests) AS t FROM pe GROUP BY date) AS n USING (date)",
    ),
)
def j06(spark, sf):
    p = d.panel_events(spark, sf)
    factors = totals.national_total(p, ["new_tests"]).select("date", (F.col("new_tests") / 100).alias("factor"))
    return combine.assign_on_date(p, factors, "factor")


@query(
    "j07_overlay_older_vintage",
    "region date new_cases:f new_tests:f",
    with_sql(
        PU, SNAPSHOTS,
        "SELECT p.region, p.date, p.new_cases, s.new_tests FROM pu AS p LEFT JOIN snap AS s "
        "ON s.region = p.region AND s.date = p.date AND s.snapshot_date = DATE '2024-01-20'",
    ),
)
def j07(spark, sf):
    older = vintages.snapshot_as_of(snapshots(spark, sf), "2024-01-20")
    newer = d.panel_users(spark, sf).select("region", "date", "new_cases", "new_tests")
    return vintages.overlay_older(newer, older, ["new_tests"])


@query(
    "j08_reporting_interval",
    "region date report_date",
    with_sql(
        PE,
        "SELECT a.region, a.date, min(b.date) AS report_date FROM pe AS a LEFT JOIN pe AS b ON b.region = a.region "
        "AND b.date >= a.date AND dayofweek(b.date) = 0 GROUP BY 1, 2",
    ),
)
def j08(spark, sf):
    reported = d.panel_events(spark, sf).withColumn(
        "reported", F.when(F.dayofweek("date") == 1, F.col("new_tests"))
    )
    return combine.next_report_interval(reported, "reported")


@query(
    "j09_events_in_series_range",
    "region date label n:i",
    with_sql(
        PO,
        """SELECT r_name AS region, CAST(l_shipdate AS DATE) AS date, CASE WHEN r_name = 'MIDDLE EAST' THEN 'shipments of...' ELSE 'shipments of ' || r_name END AS label, count(*) AS n
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
           JOIN (SELECT region, min(date) AS lo, max(date) AS hi FROM po GROUP BY region) AS b ON b.region = r_name
           WHERE CAST(l_shipdate AS DATE) BETWEEN lo AND hi GROUP BY 1, 2, 3""",
    ),
)
def j09(spark, sf):
    shipped = (
        d.table(spark, sf, "lineitem")
        .groupBy("l_orderkey", F.col("l_shipdate").cast("date").alias("date"))
        .agg(F.count("*").alias("n"))
    )
    orders = d.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    by_customer = shipped.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", "date").agg(
        F.sum("n").alias("n")
    )
    customer = d.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = d.table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    region = d.table(spark, sf, "region").select("r_regionkey", F.col("r_name").alias("region"))
    events = (
        by_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("region", "date")
        .agg(F.sum("n").alias("n"))
        .withColumn("label", F.concat(F.lit("shipments of "), "region"))
    )
    return combine.events_in_range(d.panel_orders(spark, sf), events)


HOLIDAY_ROWS = (
    ("XX", None, "2024-01-01", "New Year"),
    ("XX", None, "2024-01-06", "Epiphany"),
    ("XX", "R1", "2024-01-06", "Epiphany of R1"),
    ("XX", "R1", "2024-01-15", "Founders of R1"),
    ("XX", "R2", "2024-01-22", "Founders of R2"),
    ("YY", None, "2024-01-10", "Elsewhere"),
)
HOLIDAYS = """hol AS (
  SELECT alpha2, region, CAST(d AS DATE) AS date, name FROM (VALUES
    ('XX', NULL, '2024-01-01', 'New Year'), ('XX', NULL, '2024-01-06', 'Epiphany'),
    ('XX', 'R1', '2024-01-06', 'Epiphany of R1'), ('XX', 'R1', '2024-01-15', 'Founders of R1'),
    ('XX', 'R2', '2024-01-22', 'Founders of R2'), ('YY', NULL, '2024-01-10', 'Elsewhere')
  ) AS h(alpha2, region, d, name))"""


def holidays(spark):
    text = spark.createDataFrame(list(HOLIDAY_ROWS), "alpha2 string, region string, date string, name string")
    return text.withColumn("date", F.col("date").cast("date"))


@query(
    "j10_holiday_class",
    "region date new_tests:f holiday",
    with_sql(
        PE, HOLIDAYS,
        "SELECT p.region, p.date, p.new_tests, h.holiday FROM pe AS p LEFT JOIN (SELECT date, "
        "CASE WHEN bool_or(region IS NULL) THEN 'national' ELSE 'regional' END AS holiday FROM hol "
        "WHERE alpha2 = 'XX' GROUP BY date) AS h USING (date)",
    ),
)
def j10(spark, sf):
    days = combine.forecast_holidays(holidays(spark), "XX", "all", regional_holidays=True)
    return combine.with_holidays(d.panel_events(spark, sf), days)


def own_estimate(spark, sf):
    nat = totals.national_total(d.panel_events(spark, sf), ["new_cases", "new_tests"])
    return nat.select("date", (F.col("new_cases") / F.col("new_tests") * 5).alias("r_t"))


LONG = """long AS (
  SELECT date, '(RKI) $R_t$' AS label, r4 AS value, r4_lower AS lower, r4_upper AS upper FROM nowcast
  UNION ALL SELECT date, '(RKI) $R_t$ 7 days', r7, r7_lower, r7_upper FROM nowcast)"""


@query(
    "j12_estimate_comparison",
    "date r_t:f label value:f lower:f upper:f",
    with_sql(
        PE, NOWCAST, LONG,
        "SELECT o.date, r_t, label, value, lower, upper FROM (SELECT date, sum(new_cases) / sum(new_tests) * 5 AS r_t "
        "FROM pe GROUP BY date) AS o LEFT JOIN long AS l ON l.date = o.date",
    ),
)
def j12(spark, sf):
    external = combine.long_comparison(germany.nowcast_table(nowcast_text(spark, sf)), NOWCAST_LABELS)
    return combine.compare_estimates(own_estimate(spark, sf), external)


@query(
    "j13_region_date_grid",
    "region date new_cases:f new_tests:f",
    with_sql(
        PO,
        "SELECT r.region, t.date, p.new_cases, p.new_tests FROM (SELECT DISTINCT region FROM po) AS r "
        "CROSS JOIN (SELECT DISTINCT date FROM po) AS t LEFT JOIN po AS p ON p.region = r.region AND p.date = t.date",
    ),
)
def j13(spark, sf):
    return calendar.all_combinations(d.panel_orders(spark, sf))


# --- patches -------------------------------------------------------------------------------

PATCH_ROWS = (
    ("R0", "2024-01-05", None, "positive", "offset", 7.0),
    ("R0", "2024-01-05", None, "total", "offset", -11.0),
    ("R0", "2024-01-12", None, "total", "offset", 4.0),
    ("R1", "2024-01-08", "2024-01-10", "new_tests", "set", 33.0),
    ("R1", "2024-01-09", "2024-01-09", "new_cases", "set", 5.0),
    ("R2", "2024-01-11", "2024-01-11", "new_tests", "null", None),
    ("R2", "2024-01-03", "2024-01-06", "new_cases", "null", None),
    ("R2", "2024-01-20", "2024-01-22", "new_tests", "null", None),
    ("R2", "2024-01-21", "2024-01-21", "new_tests", "set", 1.0),
    ("R9", "2024-01-01", None, "new_tests", "null", None),
)


def _patch_sql() -> str:
    def lit(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else repr(v)

    rows = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in PATCH_ROWS)
    return (
        "patch AS (SELECT region, CAST(f AS DATE) AS date_from, coalesce(CAST(t AS DATE), DATE '9999-12-31') AS date_to, "
        f"col, action, CAST(value AS DOUBLE) AS value FROM (VALUES {rows}) AS v(region, f, t, col, action, value))"
    )


PATCH = _patch_sql()


def sql_patch(src: str, out: str, columns: str, others: str) -> str:
    """Patched columns by scalar subqueries over the patch table."""
    def pick(c: str) -> str:
        hit = f"FROM patch AS q WHERE q.region = s.region AND q.col = '{c}' AND s.date BETWEEN q.date_from AND q.date_to"
        return (
            f"CASE WHEN EXISTS (SELECT 1 {hit} AND q.action = 'null') THEN NULL "
            f"ELSE coalesce((SELECT max(value) {hit} AND q.action = 'set'), "
            f"s.{c} + coalesce((SELECT sum(value) {hit} AND q.action = 'offset'), 0)) END AS {c}"
        )

    cols = ", ".join([f"s.{c}" for c in others.split()] + [pick(c) for c in columns.split()])
    return f"{out} AS (SELECT {cols} FROM {src} AS s)"


def counters(spark, sf):
    p = calendar.running_total(d.panel_events(spark, sf), "new_cases", "positive")
    return calendar.running_total(p, "new_tests", "total")


CUM = """cum AS (
  SELECT region, date, new_cases, new_tests, sum(new_cases) OVER w AS positive, sum(new_tests) OVER w AS total
  FROM pe WINDOW w AS (PARTITION BY region ORDER BY date))"""


@query(
    "c01_offset_patches",
    "region date positive:f total:f",
    with_sql(PE, CUM, PATCH, sql_patch("cum", "fixed", "positive total", "region date"), "SELECT * FROM fixed"),
)
def c01(spark, sf):
    return patches.apply_patches(
        counters(spark, sf), patches.patch_table(spark, PATCH_ROWS), ["positive", "total"]
    )


DAILY_FIXED = with_sql(
    PE, PATCH, sql_patch("pe", "fixed", "new_cases new_tests", "region date"), "SELECT * FROM fixed"
)


@query("c02_set_patches", "region date new_cases:f new_tests:f", DAILY_FIXED + " WHERE region <> 'R2'")
def c02(spark, sf):
    panel = d.panel_events(spark, sf).where("region <> 'R2'")
    return patches.apply_patches(panel, patches.patch_table(spark, PATCH_ROWS), ["new_cases", "new_tests"])


@query("c03_null_patches", "region date new_tests:f", DAILY_FIXED)
def c03(spark, sf):
    return patches.apply_patches(
        d.panel_events(spark, sf), patches.patch_table(spark, PATCH_ROWS), ["new_tests"]
    )


@query("c04_null_range_patches", "region date new_cases:f", DAILY_FIXED)
def c04(spark, sf):
    return patches.apply_patches(
        d.panel_events(spark, sf), patches.patch_table(spark, PATCH_ROWS), ["new_cases"]
    )


CORRECTED = (
    sql_patch("cum", "c1", "positive total", "region date")
    + """, c2 AS (
  SELECT region, date, positive, total, CASE WHEN dc >= 0 THEN dc END AS new_cases, CASE WHEN dt >= 0 THEN dt END AS new_tests
  FROM (SELECT *, positive - lag(positive) OVER w AS dc, total - lag(total) OVER w AS dt
        FROM c1 WINDOW w AS (PARTITION BY region ORDER BY date)) AS x), """
    + sql_patch("c2", "c3", "new_cases new_tests", "region date positive total")
    + """, corrected AS (
  SELECT region, date, positive, total, CASE WHEN bad THEN NULL ELSE new_cases END AS new_cases,
         CASE WHEN bad THEN NULL ELSE new_tests END AS new_tests
  FROM (SELECT *, coalesce(positive >= total AND date >= DATE '2020-07-27' AND region NOT IN ('WY', 'HI'), false) AS bad FROM c3) AS y)"""
)


@query(
    "c05_correction_order",
    "region date positive:f total:f new_cases:f new_tests:f",
    with_sql(PE, CUM, PATCH, CORRECTED, "SELECT * FROM corrected"),
)
def c05(spark, sf):
    return patches.correct_cumulative_panel(
        counters(spark, sf),
        patches.patch_table(spark, PATCH_ROWS),
        check_from="2020-07-27",
        exempt=["WY", "HI"],
    )


@query(
    "c06_corrected_tests_and_total",
    "region date new_cases:f new_tests:f predicted_new_tests:f",
    with_sql(
        PE, CUM, PATCH, CORRECTED,
        "joined AS (SELECT c.region, c.date, c.new_cases, r.new_tests, c.new_tests AS predicted_new_tests FROM corrected AS c "
        "JOIN cum AS r ON r.region = c.region AND r.date = c.date)",
        "SELECT * FROM joined UNION ALL SELECT 'all', date, CASE WHEN count(new_cases) >= 5 THEN sum(new_cases) END, "
        "CASE WHEN count(new_tests) >= 5 THEN sum(new_tests) END, CASE WHEN count(predicted_new_tests) >= 5 THEN sum(predicted_new_tests) END "
        "FROM joined GROUP BY date",
    ),
)
def c06(spark, sf):
    return united_states.process_states(
        counters(spark, sf), patches.patch_table(spark, PATCH_ROWS), min_states=5
    )


# --- sorts and set operations ----------------------------------------------------------------


@query("o01_sorted_panel", "region date new_tests:f", with_sql(PO, "SELECT * FROM po ORDER BY region, date"))
def o01(spark, sf):
    return d.panel_orders(spark, sf).orderBy("region", "date")


@query(
    "o02_last_rows",
    "region date new_tests:f",
    with_sql(PO, "SELECT * FROM po ORDER BY region DESC, date DESC LIMIT 30"),
)
def o02(spark, sf):
    return calendar.last_rows(d.panel_orders(spark, sf), 30)


@query(
    "o03_complete_row_bounds",
    "region first_complete last_complete",
    with_sql(
        PE, MASKED,
        "SELECT region, min(date) AS first_complete, max(date) AS last_complete FROM masked "
        "WHERE new_cases IS NOT NULL AND new_tests IS NOT NULL GROUP BY region",
    ),
)
def o03(spark, sf):
    return calendar.complete_row_bounds(d.masked_events(spark, sf), ["new_cases", "new_tests"])


@query(
    "u01_regional_and_national_rows",
    "region date new_tests:f",
    with_sql(PO, sql_all("po", "t"), "SELECT * FROM t"),
)
def u01(spark, sf):
    p = d.panel_orders(spark, sf).select("region", "date", "new_tests")
    return combine.union_regions(p, totals.national_total(p, ["new_tests"]))


@query(
    "u02_union_of_panels",
    "region date new_tests:f new_deaths:f",
    with_sql(
        PE, PO,
        "SELECT region, date, new_tests, new_deaths FROM pe UNION ALL SELECT region, date, new_tests, NULL FROM po",
    ),
)
def u02(spark, sf):
    events = d.panel_events(spark, sf).select("region", "date", "new_tests", "new_deaths")
    return combine.union_regions(events, d.panel_orders(spark, sf).select("region", "date", "new_tests"))


@query(
    "u03_region_difference",
    "region",
    with_sql(PO, CODES, "SELECT DISTINCT region FROM po EXCEPT SELECT name FROM codes"),
)
def u03(spark, sf):
    return combine.regions_without(
        d.panel_orders(spark, sf), codes(spark).select(F.col("name").alias("region"))
    )


@query(
    "u04_dates_with_both",
    "region date",
    with_sql(PU, "SELECT region, date FROM pu WHERE day(date) % 2 = 1 AND day(date) <= 20"),
)
def u04(spark, sf):
    return combine.common_dates(*cases_and_tests(spark, sf))


@query(
    "u05_holiday_calendar_union",
    "date name holiday n_tests:f",
    with_sql(
        PE, HOLIDAYS,
        "SELECT h.date, name, holiday, n_tests FROM (SELECT date, arg_max(name, coalesce(region, '') || '/' || name) AS name, "
        "CASE WHEN bool_or(region IS NULL) THEN 'national' ELSE 'regional' END AS holiday FROM hol "
        "WHERE alpha2 = 'XX' AND (region IS NULL OR region = 'R1') GROUP BY date) AS h "
        "JOIN (SELECT date, sum(new_tests) AS n_tests FROM pe GROUP BY date) AS t ON t.date = h.date",
    ),
)
def u05(spark, sf):
    days = combine.holiday_calendar(holidays(spark), "XX", ["R1"])
    tests = totals.national_total(d.panel_events(spark, sf), ["new_tests"])
    return days.join(tests.select("date", F.col("new_tests").alias("n_tests")), "date")


@query(
    "u06_columns_joined_by_key",
    "region date new_cases:f new_tests:f",
    with_sql(PE, "SELECT * FROM pe"),
)
def u06(spark, sf):
    p = d.panel_events(spark, sf)
    return combine.outer_merge(p.select("region", "date", "new_cases"), p.select("region", "date", "new_tests"))
