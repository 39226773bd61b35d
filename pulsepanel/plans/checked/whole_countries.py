"""Country plans from raw text to the processed panel (Q-*), and the R(t) plan."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from pulsepanel import dimensions
from pulsepanel.api import CountrySupport, Registry, get_data, process_testcounts
from pulsepanel.operators.forecast import ForecastOptions
from pulsepanel.operators.kernels import generation_time
from pulsepanel.operators.patches import patch_table
from pulsepanel.operators.vintages import choose_file
from pulsepanel.plans import countries, rt
from pulsepanel.plans.checked import derived as d
from pulsepanel.plans.checked.base import (
    MASKED,
    PE,
    PN,
    PO,
    query,
    sql_all,
    sql_dense,
    sql_fit,
    sql_hdi,
    sql_interpolate,
    sql_predict,
    sql_reconcile,
    with_sql,
)
from pulsepanel.plans.checked.correcting import CODES, CORRECTED, PATCH, PATCH_ROWS, codes
from pulsepanel.plans.checked.estimating import sql_draws, sql_estimate, sql_renewal
from pulsepanel.plans.checked.loading import (
    AGECLASS,
    BELGIUM,
    CASE_LINES,
    COUNTERS,
    ITALY,
    OWID,
    TESTS,
    ageclass_text,
    belgium_text,
    case_text,
    counters_text,
    iso_table,
    italy_text,
    owid_text,
    test_text,
)
from pulsepanel.plans.checked.summing import REDISTRIBUTED
from pulsepanel.sources import belgium, france, germany, italy, owid, united_states

RUN = datetime.date(2001, 7, 20)
OPTIONS = ForecastOptions(ignore_before="1996-03-15")
FIT = dict(ignore_before="1996-03-15")

# --- Germany: coded regions, zero-filled cases, chosen test file, reported totals -------------

DE_LISTED = ("AF", "AM", "AS", "EUROPE", "all")


def world(spark, sf):
    return owid.owid_panel(owid_text(spark, sf), iso_table(spark, sf))


DE_TESTS = (
    PO, PN, CODES, TESTS, OWID,
    "chosen AS (SELECT coalesce(code, region) AS region, date, new_tests, positive_fraction FROM tests LEFT JOIN codes ON name = region "
    "WHERE file_date = (SELECT max(file_date) FROM tests WHERE file_date < DATE '2001-07-20'))",
    "ct AS (SELECT region, date, new_tests, positive_fraction FROM chosen WHERE region <> 'MIDDLE EAST' UNION ALL SELECT 'all', date, sum(new_tests), NULL FROM chosen GROUP BY date)",
    "sparse_de AS (SELECT region, date, total_tests AS owid_total_tests FROM owid WHERE country = 'CX' AND date >= DATE '2001-06-01')",
    "mt AS (SELECT region, date, new_tests, positive_fraction, owid_total_tests FROM ct FULL JOIN sparse_de USING (region, date))",
)


@query(
    "q_de_test_counts",
    "region date new_tests:f positive_fraction:f owid_total_tests:f",
    with_sql(
        *DE_TESTS,
        "SELECT r.region, t.date, m.new_tests, m.positive_fraction, m.owid_total_tests FROM (SELECT DISTINCT region FROM mt) AS r "
        "CROSS JOIN (SELECT DISTINCT date FROM mt) AS t LEFT JOIN mt AS m ON m.region = r.region AND m.date = t.date",
    ),
)
def q_de_tests(spark, sf):
    totals = owid.summarized_totals(world(spark, sf), "CX").where("date >= date '2001-06-01'")
    raw = test_text(spark, sf).withColumn(
        "region", F.when(F.col("region") == "MIDDLE EAST", F.lit("nicht zugeordnet")).otherwise(F.col("region"))
    )
    return germany.test_counts_panel(choose_file(raw, "2001-07-20"), codes(spark), totals)


@query(
    "q_de_positives",
    "region date new_cases:f new_deaths:f",
    with_sql(
        CASE_LINES.replace("CAST(o_orderdate AS DATE) AS date", "CAST(o_orderdate AS DATE) + 8000 AS date"),
        CODES,
        "dc AS (SELECT coalesce(code, region) AS region, date, sum(new_cases) AS new_cases, sum(new_deaths) AS new_deaths FROM case_lines LEFT JOIN codes ON name = region GROUP BY 1, 2)",
        sql_all("dc", "dca", "new_cases new_deaths"),
        "dgrid AS (SELECT region, CAST(unnest(generate_series(DATE '2020-03-01', DATE '2023-05-30', INTERVAL 1 DAY)) AS DATE) AS date "
        "FROM (VALUES ('AF'), ('AM'), ('AS'), ('EUROPE'), ('all')) AS v(region))",
        "SELECT g.region, g.date, coalesce(new_cases, 0) AS new_cases, coalesce(new_deaths, 0) AS new_deaths FROM dgrid AS g "
        "LEFT JOIN dca AS c ON c.region = g.region AND c.date = g.date",
    ),
)
def q_de_positives(spark, sf):
    # the German calendar starts in March 2020, so the order dates move there
    lines = germany.case_lines(case_text(spark, sf)).withColumn("date", F.date_add("date", 8000))
    return germany.positives_panel(lines, codes(spark), "2023-05-30", DE_LISTED)


DE_PANEL = (
    PE, MASKED,
    sql_all("masked", "t"),
    "sp AS (SELECT date, sum(sum(new_tests)) OVER (ORDER BY date) * 1.25 AS owid_total_tests FROM pe GROUP BY date)",
    "de AS (SELECT t.region, t.date, new_cases, CASE WHEN t.region = 'all' AND day(t.date) % 5 = 0 THEN NULL ELSE new_tests END AS new_tests, "
    "CASE WHEN t.region = 'all' AND dayofweek(t.date) = 0 THEN owid_total_tests END AS owid_total_tests FROM t JOIN sp USING (date))",
)


@query(
    "q_de_process",
    "region date predicted_new_tests_raw:f scaling_factor:f predicted_new_tests:f",
    with_sql(
        *DE_PANEL,
        sql_fit("de", "fit", ignore_before="2023-12-15"),
        sql_predict("fit", "pred", target="raw"),
        "nat AS (SELECT region, date, raw, owid_total_tests FROM pred WHERE region = 'all')",
        sql_reconcile("nat", "rec", "raw", "owid_total_tests"),
        "SELECT p.region, p.date, raw AS predicted_new_tests_raw, scaling_factor, raw * scaling_factor AS predicted_new_tests FROM pred AS p JOIN rec ON rec.date = p.date",
    ),
)
def q_de_process(spark, sf):
    from pulsepanel.operators.calendar import running_total
    from pulsepanel.operators.totals import national_total, with_national_total

    panel = with_national_total(d.masked_events(spark, sf), ["new_cases", "new_tests"])
    unreported = (F.col("region") == "all") & (F.dayofmonth("date") % 5 == 0)
    panel = panel.withColumn("new_tests", F.when(~unreported, F.col("new_tests")))
    nat = running_total(national_total(d.panel_events(spark, sf), ["new_tests"]), "new_tests", "total")
    reports = nat.where(F.dayofweek("date") == 1).select(
        "region", "date", (F.col("total") * 1.25).alias("owid_total_tests")
    )
    joined = panel.join(reports, ["region", "date"], "left")
    return countries.predict_and_reconcile(joined, ForecastOptions(ignore_before="2023-12-15"))


# --- United States ------------------------------------------------------------------------------


@query(
    "q_us_load",
    "region date positive:f total:f new_cases:f new_tests:f",
    with_sql(
        PE, COUNTERS,
        "dl AS (SELECT *, positive - lag(positive) OVER w AS new_cases, total - lag(total) OVER w AS new_tests FROM counters WINDOW w AS (PARTITION BY region ORDER BY date))",
        "SELECT * FROM dl UNION ALL SELECT 'all', date, sum(positive), sum(total), coalesce(sum(new_cases), 0), coalesce(sum(new_tests), 0) FROM dl GROUP BY date",
    ),
)
def q_us_load(spark, sf):
    return united_states.states_panel(counters_text(spark, sf))


@query(
    "q_us_process",
    "region date new_cases:f new_tests:f predicted_new_tests:f",
    with_sql(
        PE, COUNTERS,
        "cum AS (SELECT *, positive - lag(positive) OVER w AS new_cases, total - lag(total) OVER w AS new_tests FROM counters WINDOW w AS (PARTITION BY region ORDER BY date))",
        PATCH, CORRECTED,
        "joined AS (SELECT c.region, c.date, c.new_cases, r.new_tests, c.new_tests AS predicted_new_tests FROM corrected AS c "
        "JOIN cum AS r ON r.region = c.region AND r.date = c.date)",
        "SELECT * FROM joined UNION ALL SELECT 'all', date, CASE WHEN count(new_cases) >= 4 THEN sum(new_cases) END, "
        "CASE WHEN count(new_tests) >= 4 THEN sum(new_tests) END, CASE WHEN count(predicted_new_tests) >= 4 THEN sum(predicted_new_tests) END "
        "FROM joined GROUP BY date",
    ),
)
def q_us_process(spark, sf):
    panel = united_states.states_panel(counters_text(spark, sf))
    return united_states.process_states(panel, patch_table(spark, PATCH_ROWS), min_states=4)


# --- France ---------------------------------------------------------------------------------------

FR_LOAD = (
    PN, AGECLASS,
    "fd AS (SELECT region, date, new_cases, new_tests FROM ageclass WHERE ageclass = 0 AND date <= DATE '2001-07-19')",
    sql_all("fd", "fa"),
    "fr AS (SELECT * FROM fa WHERE region = 'all' OR CAST(region AS INTEGER) < 20)",
)


def region_dim(spark, sf):
    nations = d.table(spark, sf, "nation").where("n_nationkey < 20")
    codes_ = nations.select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("region"))
    return codes_.unionByName(spark.createDataFrame([("all",)], "region string"))


@query("q_fr_load", "region date new_cases:f new_tests:f", with_sql(*FR_LOAD, "SELECT * FROM fr"))
def q_fr_load(spark, sf):
    return france.france_panel(ageclass_text(spark, sf), region_dim(spark, sf), RUN)


def sql_back(src: str, out: str, start: str, columns: str, c: str = "predicted_new_tests") -> str:
    """Dense calendar plus zeros of ``c`` since ``start``, interpolated."""
    nulls = ", ".join(f"NULL AS {x}" for x in columns.split())
    return ", ".join(
        [
            sql_dense(src, f"{out}_d", f"{columns} {c}"),
            f"{out}_b AS (SELECT region, date, {', '.join(columns.split())}, {c} FROM {out}_d UNION ALL "
            f"SELECT region, CAST(unnest(generate_series(DATE '{start}', min(date) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE), {nulls}, 0.0 FROM {out}_d GROUP BY region)",
            sql_interpolate(f"{out}_b", out, c),
        ]
    )


@query(
    "q_fr_process",
    "region date new_cases:f new_tests:f predicted_new_tests:f",
    with_sql(
        *FR_LOAD, sql_fit("fr", "fit", **FIT), sql_predict("fit", "pred"),
        sql_back("pred", "ext", "1994-10-01", "new_cases new_tests"), "SELECT * FROM ext",
    ),
)
def q_fr_process(spark, sf):
    return countries.predict_and_back_extend(q_fr_load(spark, sf), OPTIONS, start="1994-10-01")


# --- Belgium --------------------------------------------------------------------------------------


def _spread(c: str, out: str) -> str:
    text = REDISTRIBUTED.replace("new_tests", c)
    for name in ("wide", "w1", "w2", "w3"):
        text = text.replace(f"{name} AS", f"{out}_{name} AS").replace(f"FROM {name})", f"FROM {out}_{name})")
    return text + (
        f", {out} AS (SELECT 'Brussels' AS region, date, round_even(b, 0) AS {c} FROM {out}_w3 UNION ALL "
        f"SELECT 'Flanders', date, round_even(f, 0) FROM {out}_w3 UNION ALL SELECT 'Wallonia', date, round_even(w, 0) FROM {out}_w3)"
    )


BE_CODES = "bcodes AS (SELECT * FROM (VALUES ('all', 'all'), ('Flanders', 'FLA'), ('Wallonia', 'WAL'), ('Brussels', 'BRU'), ('P0', 'ANT'), ('P1', 'LIM'), ('P2', 'EFL'), ('P3', 'FBR')) AS c(name, code))"
BE_PAIRS = [
    ("all", "all"), ("Flanders", "FLA"), ("Wallonia", "WAL"), ("Brussels", "BRU"),
    ("P0", "ANT"), ("P1", "LIM"), ("P2", "EFL"), ("P3", "FBR"),
]
BE_LOAD = (
    PN, BELGIUM, BE_CODES, _spread("new_cases", "bc"), _spread("new_tests", "bt"),
    "bm AS (SELECT 'all' AS region, date, sum(new_cases) AS new_cases, sum(new_tests) AS new_tests FROM be GROUP BY date UNION ALL "
    "SELECT region, date, new_cases, new_tests FROM bc JOIN bt USING (region, date) UNION ALL "
    "SELECT province, date, sum(new_cases), sum(new_tests) FROM be WHERE (region IS NULL OR region <> 'Brussels') AND province IS NOT NULL GROUP BY 1, 2)",
    "bel AS (SELECT code AS region, date, new_cases, new_tests FROM bm LEFT JOIN bcodes ON name = region)",
)


@query("q_be_load", "region date new_cases:f new_tests:f", with_sql(*BE_LOAD, "SELECT * FROM bel"))
def q_be_load(spark, sf):
    return belgium.belgium_panel(belgium_text(spark, sf), dimensions.code_table(spark, BE_PAIRS))


@query(
    "q_be_process",
    "region date new_cases:f new_tests:f predicted_new_tests:f",
    with_sql(
        *BE_LOAD, sql_fit("bel", "fit", **FIT), sql_predict("fit", "pred"),
        sql_back("pred", "ext", "1994-10-01", "new_cases new_tests"), "SELECT * FROM ext",
    ),
)
def q_be_process(spark, sf):
    return countries.predict_and_back_extend(q_be_load(spark, sf), OPTIONS, start="1994-10-01")


# --- Italy ----------------------------------------------------------------------------------------

IT_LOAD = (
    PN, ITALY,
    "ita AS (SELECT a.region, a.date, CASE WHEN a.new_cases > 0 THEN a.new_cases END AS new_cases, "
    "CASE WHEN a.tests > b.tests THEN a.tests - b.tests END AS new_tests FROM it AS a LEFT JOIN it AS b ON b.region = a.region AND b.date = a.date - 1)",
)


@query("q_it_load", "region date new_cases:f new_tests:f", with_sql(*IT_LOAD, "SELECT * FROM ita"))
def q_it_load(spark, sf):
    return italy.italy_panel(*italy_text(spark, sf))


@query(
    "q_it_process",
    "region date new_cases:f new_tests:f predicted_new_tests:f",
    with_sql(*IT_LOAD, sql_fit("ita", "fit", **FIT), sql_predict("fit", "pred"), "SELECT * FROM pred"),
)
def q_it_process(spark, sf):
    return countries.predict(q_it_load(spark, sf), OPTIONS)


# --- countries with one series: AT, CH, CZ, DK, LU, NL, PT ------------------------------------------

# every country of the table: one with glitches, one with weekly totals, one without a ramp
SPECIAL = {
    "AX": dict(glitches=("1999-04-02", "1999-07-20")),
    "DX": dict(weekly_totals=True, ramp=False),
    "EX": dict(ramp=False),
}
SERIES = tuple(
    countries.SeriesPlan(alpha2, **SPECIAL.get(alpha2, {}))
    for alpha2 in (f"{chr(65 + k)}X" for k in range(20))
)


@query(
    "q_series_countries",
    "country region date new_tests:f predicted_new_tests:f",
    with_sql(
        PN, OWID,
        "s0 AS (SELECT country AS region, date, new_cases, CASE WHEN country = 'AX' AND date IN (DATE '1999-04-02', DATE '1999-07-20') THEN NULL ELSE new_tests END AS new_tests, total_tests "
        "FROM owid)",
        "wk AS (SELECT region, date, total_tests FROM s0 WHERE region = 'DX' UNION ALL SELECT 'DX', DATE '2020-01-01', 0.0)",
        sql_interpolate("wk", "wki", "total_tests"),
        "s1 AS (SELECT region, date, new_tests FROM s0 WHERE region <> 'DX' UNION ALL "
        "SELECT region, date, nullif(total_tests - lag(total_tests) OVER (ORDER BY date), 0) FROM wki)",
        sql_fit("s1", "fit", **FIT), sql_predict("fit", "pred"),
        "anc AS (SELECT region, date, predicted_new_tests FROM pred WHERE region NOT IN ('DX', 'EX') UNION ALL "
        "SELECT DISTINCT region, DATE '2020-01-01', 0.0 FROM pred WHERE region NOT IN ('DX', 'EX'))",
        sql_interpolate("anc", "ramp", "predicted_new_tests"),
        "SELECT r.region AS country, 'all' AS region, r.date, p.new_tests, r.predicted_new_tests FROM ramp AS r LEFT JOIN pred AS p ON p.region = r.region AND p.date = r.date "
        "UNION ALL SELECT region, 'all', date, new_tests, predicted_new_tests FROM pred WHERE region IN ('DX', 'EX')",
    ),
)
def q_series(spark, sf):
    return countries.process_series_countries(world(spark, sf), SERIES, OPTIONS)


# --- registered country and R(t) plans --------------------------------------------------------------


def registry(sf) -> Registry:
    reg = Registry(iso_codes=["AQ"])
    names = {f"R{i}": f"Region {i}" for i in range(5)}
    reg.add(
        CountrySupport(
            alpha2="AQ",
            zone="Europe",
            region_name=names,
            region_population={r: 300_000 for r in names},
            load=lambda spark, run_date: d.masked_events(spark, sf).withColumn(
                "new_cases", F.col("new_cases") - 10
            ),
            process=lambda panel: countries.predict(panel, ForecastOptions(ignore_before="2023-12-15")),
        )
    )
    return reg


@query(
    "q_get_and_process",
    "region date new_cases:f new_tests:f predicted_new_tests:f",
    with_sql(
        PE, MASKED,
        "neg AS (SELECT region, date, CASE WHEN new_cases >= 10 THEN new_cases - 10 END AS new_cases, new_tests FROM masked)",
        sql_dense("neg", "dense", "new_cases new_tests", trail=7),
        sql_fit("dense", "fit", ignore_before="2023-12-15"), sql_predict("fit", "pred"), "SELECT * FROM pred",
    ),
)
def q_get(spark, sf):
    reg = registry(sf)
    panel = get_data(reg, spark, "aq", datetime.date(2024, 2, 1))
    return process_testcounts(reg, "AQ", panel, future_days=7)


@query("q_est_delay_kernel", "lag:i p:f", with_sql(d.LINE_LIST, d.DELAYS, "SELECT * FROM delay_kernel"))
def q_est(spark, sf):
    return rt.delay_kernel_from_line_list(d.patient_texts(spark, sf), weight="n")


P_DELAY = [0.0, 0.05, 0.2, 0.3, 0.2, 0.15, 0.1]


@query(
    "q_rt_case_curves",
    "region date infections_absolute:f infections_absolute_lower:f infections_absolute_upper:f",
    with_sql(
        PE, MASKED,
        sql_estimate("masked", "est"), sql_draws("est", "post", 2, 4),
        "ax AS (SELECT region, date FROM est_d)",
        "grid AS (SELECT p.region, p.chain, p.draw, ax.date FROM (SELECT DISTINCT region, chain, draw FROM post) AS p JOIN ax ON ax.region = p.region)",
        "gp AS (SELECT g.*, r_t AS r0 FROM grid AS g LEFT JOIN post AS p ON p.region = g.region AND p.chain = g.chain AND p.draw = g.draw AND p.date = g.date)",
        """gr AS (SELECT region, chain, draw, date, coalesce(
             last_value(r0 IGNORE NULLS) OVER (PARTITION BY region, chain, draw ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             first_value(r0 IGNORE NULLS) OVER (PARTITION BY region, chain, draw ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS r_t FROM gp)""",
        sql_renewal("gr", "inf"),
        "pdk AS (SELECT * FROM (VALUES (0, 0.0), (1, 0.05), (2, 0.2), (3, 0.3), (4, 0.2), (5, 0.15), (6, 0.1)) AS k(lag, p))",
        "tap AS (SELECT a.region, a.chain, a.draw, a.date, sum(b.infections * CAST(k.p AS DOUBLE)) AS tap FROM inf AS a JOIN inf AS b ON b.region = a.region AND b.chain = a.chain AND b.draw = a.draw AND b.date <= a.date "
        "JOIN pdk AS k ON k.lag = date_diff('day', b.date, a.date) GROUP BY 1, 2, 3, 4)",
        "sf AS (SELECT t.region, chain, draw, sum(new_cases) / sum(tap * exposure / mx) AS f FROM tap AS t JOIN est_a AS o ON o.region = t.region AND o.date = t.date "
        "JOIN (SELECT region, max(exposure) AS mx FROM est_a GROUP BY region) AS m ON m.region = t.region WHERE new_cases IS NOT NULL AND exposure IS NOT NULL GROUP BY 1, 2, 3)",
        "nc AS (SELECT region, chain, draw, date, infections * f AS v FROM inf JOIN sf USING (region, chain, draw))",
        sql_hdi("nc", "v", "region date", 0.75, "h"),
        "SELECT m.region, m.date, med AS infections_absolute, h.lower AS infections_absolute_lower, h.upper AS infections_absolute_upper "
        "FROM (SELECT region, date, median(v) AS med FROM nc GROUP BY 1, 2) AS m JOIN h USING (region, date)",
    ),
)
def q_rt_curves(spark, sf):
    panel = d.masked_events(spark, sf).withColumn("predicted_new_tests", F.col("new_tests"))
    result = rt.estimate(panel, P_DELAY, p_generation_time=generation_time(), chains=2, draws=4)
    people = spark.createDataFrame([(f"R{i}", 300_000) for i in range(5)], "region string, population bigint")
    return result.infections_summary(people, 0.75)
