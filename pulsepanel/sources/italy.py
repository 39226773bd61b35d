"""Italian national and regional tables with a cumulative test counter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.functions.text import iso_date, number
from pulsepanel.functions.values import null_if_not_positive
from pulsepanel.operators.calendar import increase_since_yesterday
from pulsepanel.sources.files import read_text_csv

COLUMNS = ("data", "nuovi_positivi", "tamponi")


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path, ["codice_regione", *COLUMNS])


def read_nation(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path, COLUMNS)


def counters(raw: DataFrame) -> DataFrame:
    """Typed rows; the national file has no region code and becomes region 'all'."""
    region = F.col("codice_regione") if "codice_regione" in raw.columns else F.lit("all")
    return raw.select(
        region.alias("region"),
        iso_date(F.col("data")).alias("date"),
        number(F.col("nuovi_positivi")).alias("new_cases"),
        number(F.col("tamponi")).alias("tests"),
    )


def italy_panel(raw_regions: DataFrame, raw_nation: DataFrame) -> DataFrame:
    """Daily tests where yesterday's counter exists and grew; positive cases only."""
    both = counters(raw_regions).unionByName(counters(raw_nation))
    daily = increase_since_yesterday(both, "tests", "new_tests")
    return daily.select(
        "region", "date", null_if_not_positive(F.col("new_cases")).alias("new_cases"), "new_tests"
    )
