"""Source conversions (S*) on text that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsepanel.dimensions import with_short_names
from pulsepanel.functions.text import any_date
from pulsepanel.operators.calendar import running_total
from pulsepanel.operators.checks import missing_regions, unknown_countries
from pulsepanel.operators.kernels import delay_kernel, drop_censored, valid_delays
from pulsepanel.operators.renewal import r_t_path
from pulsepanel.operators.summary import threshold_probability
from pulsepanel.operators.vintages import choose_file, overlay_older
from pulsepanel.plans.checked import derived as d
from pulsepanel.plans.checked.base import PE, PN, PO, query, sql_all, with_sql
from pulsepanel.session import shared_table_path
from pulsepanel.sources import belgium, files, france, germany, history, italy, owid, united_states


def iso_table(spark, sf):
    """ISO-like dimension of the nations; the last five have no two-letter code."""
    nation = d.table(spark, sf, "nation").where("n_nationkey < 20")
    return nation.select(
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("alpha3"),
        F.concat(F.char(F.col("n_nationkey") + 65), F.lit("X")).alias("alpha2"),
    )


def owid_text(spark, sf):
    """Country-day table as text, with running totals per nation."""
    panel = running_total(d.panel_nations(spark, sf), "new_tests", "total_tests", ["nationkey"])
    panel = running_total(panel, "new_cases", "total_cases", ["nationkey"])
    return panel.select(
        F.concat(F.lit("N"), F.lpad(F.col("nationkey").cast("string"), 2, "0")).alias("iso_code"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        d.text(F.col("total_cases")).alias("total_cases"),
        d.text(F.col("new_cases")).alias("new_cases"),
        F.lit("").alias("total_deaths"),
        F.lit(None).cast("string").alias("new_deaths"),
        d.text(F.col("total_tests")).alias("total_tests"),
        d.text(F.col("new_tests")).alias("new_tests"),
        F.lit("tests performed").alias("tests_units"),
    )


OWID = """owid AS (
  SELECT chr(65 + nationkey) || 'X' AS country, 'all' AS region, date, new_cases, new_tests,
         sum(new_tests) OVER (PARTITION BY nationkey ORDER BY date) AS total_tests,
         sum(new_cases) OVER (PARTITION BY nationkey ORDER BY date) AS total_cases
  FROM pn WHERE nationkey < 20)"""


@query(
    "s01_global_country_table",
    "country region date new_cases:f new_tests:f total_cases:f total_tests:f new_deaths:f tests_units",
    with_sql(PN, OWID, "SELECT *, CAST(NULL AS DOUBLE) AS new_deaths, 'tests performed' AS tests_units FROM owid"),
)
def s01(spark, sf):
    return owid.owid_panel(owid_text(spark, sf), iso_table(spark, sf))


def case_text(spark, sf):
    """Case lines by region, day and priority as text."""
    orders = d.table(spark, sf, "orders")
    customer = d.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = d.table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    region = d.table(spark, sf, "region")
    counted = orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("date"), "o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("cases"),
        F.count_if(F.col("o_orderstatus") == "P").alias("deaths"),
    )
    lines = (
        counted.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "date", "o_orderpriority")
        .agg(F.sum("cases").alias("cases"), F.sum("deaths").alias("deaths"))
    )
    epoch_ms = F.unix_date("date").cast("bigint") * 86_400_000
    return lines.select(
        F.col("r_name").alias("Bundesland"),
        epoch_ms.cast("string").alias("Meldedatum"),
        F.lit("03.08.2001, 00:00 Uhr").alias("Datenstand"),
        F.col("cases").cast("string").alias("AnzahlFall"),
        F.col("deaths").cast("string").alias("AnzahlTodesfall"),
    )


CASE_LINES = """case_lines AS (
  SELECT r_name AS region, CAST(o_orderdate AS DATE) AS date, o_orderpriority,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS new_cases,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS new_deaths
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2, 3)"""


@query(
    "s02_case_lines",
    "region date new_cases:f new_deaths:f mark",
    with_sql(CASE_LINES, "SELECT *, '03.08.2001, 00:00 Uhr' AS mark FROM case_lines"),
)
def s02(spark, sf):
    return germany.case_lines(case_text(spark, sf))


def test_text(spark, sf):
    """Test-count lines with decimal commas, two date styles and one file per snapshot month."""
    p = d.panel_orders(spark, sf)
    share = F.round(F.col("new_cases") / F.col("new_tests"), 2)
    style = F.when(F.col("region") == "ASIA", F.lit("dd.MM.yyyy")).otherwise(F.lit("yyyy-MM-dd"))
    return p.select(
        "region",
        F.when(style == "dd.MM.yyyy", F.date_format("date", "dd.MM.yyyy"))
        .otherwise(F.date_format("date", "yyyy-MM-dd"))
        .alias("date"),
        d.text(F.col("new_tests")).alias("new_tests"),
        F.translate(share.cast("string"), ".", ",").alias("positive_fraction"),
        F.concat(
            F.date_format(F.last_day("date"), "yyyy-MM-dd"), F.lit("_tests_daily_BL.csv")
        ).alias("file_name"),
    )


TESTS = """tests AS (
  SELECT region, date, new_tests, round(new_cases / new_tests, 2) AS positive_fraction,
         last_day(date) AS file_date FROM po)"""


@query(
    "s03_decimal_comma_tests",
    "region date new_tests:f positive_fraction:f",
    with_sql(PO, TESTS, "SELECT * FROM tests"),
)
def s03(spark, sf):
    return germany.test_counts(test_text(spark, sf))


@query(
    "s04_latest_file_before_run_date",
    "file_date region n_rows:i",
    with_sql(
        PO, TESTS,
        "SELECT file_date, region, count(*) AS n_rows FROM tests WHERE file_date = "
        "(SELECT max(file_date) FROM tests WHERE file_date < DATE '1999-06-30') GROUP BY 1, 2",
    ),
)
def s04(spark, sf):
    chosen = choose_file(test_text(spark, sf), "1999-06-30")
    return chosen.groupBy("file_date", "region").agg(F.count("*").alias("n_rows"))


@query(
    "s05_two_date_styles",
    "region first_date last_date n_dates:i",
    with_sql(
        PO,
        "SELECT region, min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS n_dates "
        "FROM po GROUP BY region",
    ),
)
def s05(spark, sf):
    dated = test_text(spark, sf).withColumn("date", any_date(F.col("date")))
    return dated.groupBy("region").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.countDistinct("date").alias("n_dates"),
    )


def nowcast_text(spark, sf):
    """Nowcast-like table: old and new headers side by side, '.' for missing, decimal commas."""
    p = d.panel_events(spark, sf).groupBy("date").agg(
        F.sum("new_cases").alias("c"), F.sum("new_tests").alias("t")
    )
    def comma(c):
        return F.translate(F.round(c, 3).cast("string"), ".", ",")

    r = F.col("c") / F.col("t") * 5
    early = F.dayofmonth("date") <= 4
    return p.select(
        F.date_format("date", "dd.MM.yyyy").alias("Datum"),
        F.when(early, F.lit(".")).otherwise(comma(r)).alias("PS_7_Tage_R_Wert"),
        comma(r - 0.1).alias("UG_PI_7_Tage_R_Wert"),
        comma(r + 0.1).alias("OG_PI_7_Tage_R_Wert"),
        F.when(F.dayofmonth("date") % 2 == 0, comma(r)).alias("PS_4_Tage_R_Wert"),
        F.when(F.dayofmonth("date") % 2 == 1, comma(r)).alias("Punktschätzer des 4-Tage-R-Wertes"),
        comma(r - 0.2).alias("UG_PI_4_Tage_R_Wert"),
        comma(r + 0.2).alias("OG_PI_4_Tage_R_Wert"),
    )


NOWCAST = """nowcast AS (
  SELECT date, CASE WHEN day(date) > 4 THEN round(r, 3) END AS r7, round(r - 0.1, 3) AS r7_lower,
         round(r + 0.1, 3) AS r7_upper, round(r, 3) AS r4, round(r - 0.2, 3) AS r4_lower,
         round(r + 0.2, 3) AS r4_upper
  FROM (SELECT date, sum(new_cases) / sum(new_tests) * 5 AS r FROM pe GROUP BY date) AS x)"""


@query(
    "s06_nowcast_headers",
    "date r4:f r4_lower:f r4_upper:f r7:f r7_lower:f r7_upper:f",
    with_sql(PE, NOWCAST, "SELECT * FROM nowcast"),
)
def s06(spark, sf):
    return germany.nowcast_table(nowcast_text(spark, sf))


def counters_text(spark, sf):
    """State-day text with cumulative counters and compact dates."""
    p = running_total(d.panel_events(spark, sf), "new_cases", "positive")
    p = running_total(p, "new_tests", "total")
    return p.select(
        F.col("region").alias("state"),
        F.date_format("date", "yyyyMMdd").alias("date"),
        d.text(F.col("positive")).alias("positive"),
        d.text(F.col("total")).alias("total"),
    )


COUNTERS = """counters AS (
  SELECT region, date, sum(new_cases) OVER w AS positive, sum(new_tests) OVER w AS total
  FROM pe WINDOW w AS (PARTITION BY region ORDER BY date))"""


@query(
    "s07_compact_date_counters",
    "region date positive:f total:f",
    with_sql(PE, COUNTERS, "SELECT * FROM counters"),
)
def s07(spark, sf):
    return united_states.state_counters(counters_text(spark, sf))


def ageclass_text(spark, sf):
    """Region-day text by age class; class 0 is the sum of the others."""
    nation_days = d.panel_nations(spark, sf)
    classes = F.explode(F.array(F.lit(0), F.lit(9), F.lit(19))).alias("cl")
    return nation_days.select("*", classes).select(
        F.lpad(F.col("nationkey").cast("string"), 2, "0").alias("reg"),
        F.date_format("date", "yyyy-MM-dd").alias("jour"),
        d.text(F.when(F.col("cl") == 0, F.col("new_cases")).otherwise(F.col("cl") % 10)).alias("P"),
        d.text(F.when(F.col("cl") == 0, F.col("new_tests")).otherwise(F.col("cl"))).alias("T"),
        F.col("cl").cast("string").alias("cl_age90"),
    )


AGECLASS = """ageclass AS (
  SELECT lpad(CAST(nationkey AS VARCHAR), 2, '0') AS region, date,
         CASE WHEN cl = 0 THEN new_cases ELSE cl % 10 END AS new_cases,
         CASE WHEN cl = 0 THEN new_tests ELSE cl END AS new_tests, cl AS ageclass
  FROM pn, (VALUES (0), (9), (19)) AS c(cl))"""


@query(
    "s08_text_region_codes",
    "region date new_cases:f new_tests:f ageclass:i",
    with_sql(PN, AGECLASS, "SELECT * FROM ageclass"),
)
def s08(spark, sf):
    return france.region_days(ageclass_text(spark, sf))


def italy_text(spark, sf):
    """Regional counters of the nations and the national counters, as text."""
    p = running_total(d.panel_nations(spark, sf), "new_tests", "tests", ["nationkey"])
    regions = p.select(
        F.lpad(F.col("nationkey").cast("string"), 2, "0").alias("codice_regione"),
        F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T18:00:00")).alias("data"),
        d.text(F.col("new_cases")).alias("nuovi_positivi"),
        d.text(F.col("tests")).alias("tamponi"),
    )
    daily = d.panel_nations(spark, sf).groupBy("date").agg(
        F.sum("new_cases").alias("new_cases"), F.sum("new_tests").alias("new_tests")
    )
    daily = running_total(daily.withColumn("k", F.lit("all")), "new_tests", "tests", ["k"])
    nation = daily.select(
        F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T18:00:00")).alias("data"),
        d.text(F.col("new_cases")).alias("nuovi_positivi"),
        d.text(F.col("tests")).alias("tamponi"),
    )
    return regions, nation


ITALY = """it AS (
  SELECT lpad(CAST(nationkey AS VARCHAR), 2, '0') AS region, date, new_cases,
         sum(new_tests) OVER (PARTITION BY nationkey ORDER BY date) AS tests FROM pn
  UNION ALL
  SELECT 'all', date, new_cases, sum(new_tests) OVER (ORDER BY date)
  FROM (SELECT date, sum(new_cases) AS new_cases, sum(new_tests) AS new_tests FROM pn GROUP BY date) AS n)"""


@query("s09_two_counter_files", "region date new_cases:f tests:f", with_sql(PN, ITALY, "SELECT * FROM it"))
def s09(spark, sf):
    regions, nation = italy_text(spark, sf)
    return italy.counters(regions).unionByName(italy.counters(nation))


def belgium_text(spark, sf):
    """Rows by region and province; both can be missing."""
    nations = d.panel_nations(spark, sf)
    k = F.col("nationkey")
    return nations.select(
        F.date_format("date", "yyyy-MM-dd").alias("DATE"),
        F.when(k % 4 == 0, F.lit("Brussels"))
        .when(k % 4 == 1, F.lit("Flanders"))
        .when(k % 4 == 2, F.lit("Wallonia"))
        .alias("REGION"),
        F.when(k % 5 < 4, F.concat(F.lit("P"), (k % 5).cast("string"))).alias("PROVINCE"),
        d.text(F.col("new_cases")).alias("TESTS_ALL_POS"),
        d.text(F.col("new_tests")).alias("TESTS_ALL"),
    )


BELGIUM = """be AS (
  SELECT date, CASE nationkey % 4 WHEN 0 THEN 'Brussels' WHEN 1 THEN 'Flanders' WHEN 2 THEN 'Wallonia' END AS region,
         CASE WHEN nationkey % 5 < 4 THEN 'P' || CAST(nationkey % 5 AS VARCHAR) END AS province,
         new_cases, new_tests FROM pn)"""


@query(
    "s10_nullable_region_rows",
    "date region province new_cases:f new_tests:f",
    with_sql(PN, BELGIUM, "SELECT * FROM be"),
)
def s10(spark, sf):
    return belgium.test_rows(belgium_text(spark, sf))


@query(
    "s11_line_list",
    "country onset confirmed n:i",
    with_sql(
        d.LINE_LIST,
        "SELECT country, strftime(onset, '%d.%m.%Y') AS onset, strftime(confirmed, '%d.%m.%Y') AS confirmed, "
        "count(*) AS n FROM ll GROUP BY ALL",
    ),
)
def s11(spark, sf):
    texts = d.patient_texts(spark, sf)
    return texts.groupBy("country", "onset", "confirmed").agg(F.sum("n").alias("n"))


def region_metadata(spark, sf):
    """Regions with text populations, as a publisher would print them."""
    customers = d.table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    nation = d.table(spark, sf, "nation")
    people = F.col("n") * 1234
    return nation.join(customers, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("region"),
        F.col("n_name").alias("name"),
        F.when(F.col("n_nationkey") % 2 == 0, F.substring("n_name", 1, 3)).alias("short_name"),
        F.translate(F.format_number(people, 0), ",", " ").alias("population"),
    )


METADATA = """meta AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS region, n_name AS name,
         CASE WHEN n_nationkey % 2 = 0 THEN substr(n_name, 1, 3) END AS short_name,
         count(*) * 1234 AS population
  FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY 1, 2, 3)"""


@query(
    "s12_region_dimension",
    "region name short_name population:i",
    with_sql(METADATA, "SELECT region, name, coalesce(short_name, region) AS short_name, population FROM meta"),
)
def s12(spark, sf):
    meta = france.region_metadata(region_metadata(spark, sf), name="World", short_name="W")
    return with_short_names(meta.where("region <> 'all'"))


@query(
    "s12_unknown_country_codes",
    "alpha2",
    "SELECT chr(65 + n_nationkey) || 'X' AS alpha2 FROM nation WHERE n_nationkey >= 20",
)
def s12_unknown(spark, sf):
    every = d.table(spark, sf, "nation").select(
        F.concat(F.char(F.col("n_nationkey") + 65), F.lit("X")).alias("alpha2")
    )
    return unknown_countries(every, iso_table(spark, sf))


@query(
    "s13_population_text",
    "region name short_name population:i",
    with_sql(
        METADATA,
        "SELECT * FROM meta UNION ALL SELECT 'all', 'World', 'W', CAST(sum(population) AS BIGINT) FROM meta",
    ),
)
def s13(spark, sf):
    return france.region_metadata(region_metadata(spark, sf), name="World", short_name="W")


@query(
    "s14_archived_snapshot",
    "region date new_tests:f snapshot_date",
    with_sql(PE, "SELECT region, date, new_tests + 2 AS new_tests, DATE '2024-02-02' AS snapshot_date FROM pe"),
)
def s14(spark, sf):
    path = shared_table_path(spark, "snapshots")
    panel = d.panel_events(spark, sf).select("region", "date", "new_tests")
    for i, day in enumerate(("2024-02-01", "2024-02-02"), start=1):
        files.archive_snapshot(panel.withColumn("new_tests", F.col("new_tests") + i), path, day)
    return files.read_snapshots(spark, path).where("snapshot_date = date '2024-02-02'")


def daily_versions(spark, sf):
    """The order panel as published on three days: rows are revised, withdrawn, and come back."""
    panel = d.panel_orders(spark, sf).select("region", "date", "new_tests")
    day = F.dayofmonth("date")
    return {
        "2024-02-01": panel,
        "2024-02-02": panel.where(day != 3).withColumn("new_tests", F.col("new_tests") + F.when(day == 10, 1).otherwise(0)),
        "2024-03-05": panel.where(day != 7).withColumn("new_tests", F.when(day != 20, F.col("new_tests"))),
    }


def recorded_versions(spark, sf):
    path = shared_table_path(spark, "changes")
    for published, table in daily_versions(spark, sf).items():
        history.record_snapshot(table, path, published, ["region", "date"])
    return history.read_changes(spark, path)


SECOND = "SELECT region, date, new_tests + CASE WHEN day(date) = 10 THEN 1 ELSE 0 END AS new_tests FROM po WHERE day(date) <> 3"


@query("s14_changes_as_of", "region date new_tests:f", with_sql(PO, SECOND))
def s14_changes(spark, sf):
    """The table between the second and the third day, from changes alone."""
    return history.as_of_changes(recorded_versions(spark, sf), "2024-02-20", ["region", "date"])


@query(
    "s14_stored_changes",
    "snapshot_date deleted n:i",
    with_sql(
        PO,
        "v AS (SELECT DATE '2024-02-01' AS s, region, date, new_tests FROM po UNION ALL SELECT DATE '2024-02-02', * FROM (" + SECOND + ") AS b "
        "UNION ALL SELECT DATE '2024-03-05', region, date, CASE WHEN day(date) <> 20 THEN new_tests END FROM po WHERE day(date) <> 7)",
        "days(s, before) AS (VALUES (DATE '2024-02-01', DATE '1900-01-01'), (DATE '2024-02-02', DATE '2024-02-01'), (DATE '2024-03-05', DATE '2024-02-02'))",
        "w AS (SELECT days.s, v.region, v.date, v.new_tests, b.region IS NOT NULL AS was, b.new_tests AS old FROM days JOIN v ON v.s = days.s "
        "LEFT JOIN v AS b ON b.s = before AND b.region = v.region AND b.date = v.date)",
        "gone AS (SELECT days.s FROM days JOIN v AS b ON b.s = before WHERE NOT EXISTS "
        "(SELECT 1 FROM v WHERE v.s = days.s AND v.region = b.region AND v.date = b.date))",
        "SELECT s AS snapshot_date, FALSE AS deleted, count(*) AS n FROM w WHERE NOT was OR old IS DISTINCT FROM new_tests GROUP BY s "
        "UNION ALL SELECT s, TRUE, count(*) FROM gone GROUP BY s",
    ),
)
def s14_stored(spark, sf):
    """What is stored of each day: its changes, not its rows."""
    changes = recorded_versions(spark, sf)
    return changes.groupBy("snapshot_date", "deleted").agg(F.count("*").alias("n"))


@query("w08_as_of_by_intervals", "region date new_tests:f", with_sql(PO, SECOND))
def w08_intervals(spark, sf):
    """The same day from validity intervals, whose folders are pruned by the month in which they end."""
    path = shared_table_path(spark, "intervals")
    intervals = history.validity_intervals(recorded_versions(spark, sf), ["region", "date"])
    history.write_intervals(intervals, path)
    return history.intervals_as_of(spark.read.parquet(path), "2024-02-20")


@query(
    "s15_stored_delay_kernel",
    "lag:i p:f",
    with_sql(d.LINE_LIST, d.DELAYS, "SELECT * FROM delay_kernel"),
)
def s15(spark, sf):
    path = shared_table_path(spark, "kernel")
    files.write_kernel(delay_kernel(drop_censored(valid_delays(d.patient_texts(spark, sf), "n"))), path)
    return files.read_kernel(spark, path)


@query(
    "s16_stored_draws",
    "region r_t_threshold_probability:f",
    with_sql(
        PE, d.STEPS,
        "SELECT region, avg(CASE WHEN r_t > 1 THEN 1.0 ELSE 0.0 END) AS r_t_threshold_probability FROM "
        "(SELECT region, exp(sum(step) OVER (PARTITION BY region, chain, draw ORDER BY date)) AS r_t FROM steps) AS x "
        "GROUP BY region",
    ),
)
def s16(spark, sf):
    path = shared_table_path(spark, "draws")
    files.write_draws(r_t_path(d.log_steps(spark, sf)), path)
    return threshold_probability(files.read_draws(spark, path), keys=["region"])


@query(
    "s17_snapshot_overlay",
    "region date new_cases:f new_tests:f",
    with_sql(
        PE,
        "SELECT region, date, new_cases, CASE WHEN day(date) <= 20 THEN new_tests - 1 END AS new_tests FROM pe",
    ),
)
def s17(spark, sf):
    newer = d.panel_events(spark, sf).select("region", "date", "new_cases", "new_tests")
    older = newer.where(F.dayofmonth("date") <= 20).withColumn("new_tests", F.col("new_tests") - 1)
    return overlay_older(newer, older, ["new_tests"])


@query(
    "p18_regions_without_metadata",
    "region",
    with_sql(PE, sql_all("pe", "t"), "SELECT DISTINCT region FROM t WHERE region IN ('all', 'R3', 'R4')"),
)
def p18(spark, sf):
    from pulsepanel.operators.totals import with_national_total

    panel = with_national_total(d.panel_events(spark, sf), ["new_tests"])
    meta = d.table(spark, sf, "region").where("r_regionkey < 4").select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("region"),
        F.col("r_name").alias("name"),
        F.when(F.col("r_regionkey") < 3, F.lit(1000)).alias("population"),
    )
    return missing_regions(panel, meta)
