"""Panels, texts and draws that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.operators.calendar import densify
from pulsepanel.plans.checked.base import sql_dense


# Declared schemas spare a footer-reading job per table; unused columns are left out.
SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int",
    "events": "ts timestamp_ntz, user_id bigint, event_type string",
    "lineitem": "l_orderkey bigint, l_quantity double, l_extendedprice double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _counted(events: DataFrame, region) -> DataFrame:
    """Daily counts; partial counts run before the shuffle, so hot users or days do not matter."""
    return events.groupBy(region.alias("region"), F.col("ts").cast("date").alias("date")).agg(
        F.count_if(F.col("event_type") == "error").cast("double").alias("new_cases"),
        F.count("*").cast("double").alias("new_tests"),
        F.count_if(F.col("event_type") == "signup").cast("double").alias("new_deaths"),
    )


def panel_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five regions by user, 30 gap-free days."""
    region = F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string"))
    return _counted(table(spark, sf_dir, "events"), region)


def panel_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user is a region: the number of series grows with the data."""
    return _counted(table(spark, sf_dir, "events"), F.concat(F.lit("U"), F.col("user_id").cast("string")))


def customer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer and day, counted before any join so that a hot customer stays small."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("date"))
        .agg(
            F.count_if(F.col("o_orderstatus") == "F").alias("cases"),
            F.count("*").alias("tests"),
        )
    )


def panel_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse panel by nation key."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    days = customer_days(spark, sf_dir).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return days.groupBy(F.col("c_nationkey").alias("nationkey"), "date").agg(
        F.sum("cases").cast("double").alias("new_cases"),
        F.sum("tests").cast("double").alias("new_tests"),
    )


def panel_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse panel by world region, about 2,400 days."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    return (
        panel_nations(spark, sf_dir)
        .join(nation, F.col("nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("region", "date")
        .agg(F.sum("new_cases").alias("new_cases"), F.sum("new_tests").alias("new_tests"))
    )


def mask_tests(panel: DataFrame) -> DataFrame:
    """Test counts missing on every fifth day of the month."""
    return panel.select(
        "region",
        "date",
        "new_cases",
        F.when(F.dayofmonth("date") % 5 != 0, F.col("new_tests")).alias("new_tests"),
    )


def masked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_tests(panel_events(spark, sf_dir))


def masked_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_tests(panel_users(spark, sf_dir))


def text(c) -> F.Column:
    """Count as the text a source file would hold."""
    return c.cast("bigint").cast("string")


def patient_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line list as text with a multiplicity: order date is onset, ship date confirmation.

    Lines are counted per order and day before the join, so an order with very many lines is
    one row per day.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("onset"), "o_orderpriority"
    )
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", F.col("l_shipdate").cast("date").alias("confirmed"))
        .agg(F.count("*").alias("n"))
    )
    german = "dd.MM.yyyy"
    return orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Mexico")).otherwise(F.lit("Other")).alias("country"),
        F.date_format("onset", german).alias("onset"),
        F.date_format("confirmed", german).alias("confirmed"),
        "n",
    )


LINE_LIST = """ll AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'Mexico' ELSE 'Other' END AS country,
         CAST(o_orderdate AS DATE) AS onset, CAST(l_shipdate AS DATE) AS confirmed
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""

DELAYS = """delays AS (
  SELECT onset, date_diff('day', onset, confirmed) AS delay, count(*) AS n
  FROM ll WHERE confirmed > onset AND country <> 'Mexico' GROUP BY 1, 2),
uncensored AS (
  SELECT * FROM delays WHERE onset < (SELECT max(onset) FROM delays) - INTERVAL 14 DAY),
hist AS (SELECT delay, sum(n) AS n FROM uncensored WHERE delay <= 60 GROUP BY 1),
delay_kernel AS (
  SELECT g.lag, coalesce(h.n, 0) / (SELECT sum(n) FROM hist) AS p
  FROM (SELECT CAST(unnest(generate_series(0, (SELECT max(delay) FROM hist) + 5)) AS INTEGER) AS lag) AS g
  LEFT JOIN hist AS h ON h.delay = g.lag - 5)"""


def log_steps(spark: SparkSession, sf_dir: str, chains: int = 2, draws: int = 4) -> DataFrame:
    """Deterministic log steps of R(t): (region, chain, draw, date, step), one path per draw.

    Steps follow the day's share of cases, shifted per draw; a day without events steps by zero.
    """
    k = F.explode(F.sequence(F.lit(0), F.lit(chains * draws - 1))).alias("_k")
    panel = densify(panel_events(spark, sf_dir))
    return panel.select("region", "date", "new_cases", "new_tests", k).select(
        "region",
        F.floor(F.col("_k") / draws).cast("int").alias("chain"),
        (F.col("_k") % draws).cast("int").alias("draw"),
        "date",
        F.coalesce(
            (F.col("new_cases") / F.col("new_tests") - 0.2) + (F.col("_k") - 3) / 100.0, F.lit(0.0)
        ).alias("step"),
    )


STEPS = (
    sql_dense("pe", "days", "new_cases new_tests")
    + """, steps AS (
  SELECT region, CAST(k // 4 AS INTEGER) AS chain, CAST(k % 4 AS INTEGER) AS draw, date,
         coalesce((new_cases / new_tests - 0.2) + (k - 3) / 100.0, 0.0) AS step
  FROM days, (SELECT unnest(generate_series(0, 7)) AS k) AS ks)"""
)
