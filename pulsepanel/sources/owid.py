"""Global country-day table: one scan serves every country."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.functions.text import iso_date, number
from pulsepanel.sources.files import read_text_csv

COUNTS = ("total_cases", "new_cases", "total_deaths", "new_deaths", "total_tests", "new_tests")


def read_owid(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path, ["iso_code", "date", *COUNTS, "tests_units"])


def owid_panel(raw: DataFrame, iso_dim: DataFrame) -> DataFrame:
    """(country, region='all', date) panel; rows whose code is no ISO country are dropped."""
    named = raw.join(
        iso_dim.select(F.col("alpha3").alias("iso_code"), F.col("alpha2").alias("country")), "iso_code"
    )
    return named.select(
        "country",
        F.lit("all").alias("region"),
        iso_date(F.col("date")).alias("date"),
        *[number(F.col(c)).alias(c) for c in COUNTS],
        "tests_units",
    )


def one_country(panel: DataFrame, alpha2: str) -> DataFrame:
    return panel.where(F.col("country") == alpha2).drop("country")


def summarized_totals(panel: DataFrame, alpha2: str) -> DataFrame:
    """Sparse national test totals of one country, as ``owid_total_tests``."""
    return one_country(panel, alpha2).select(
        "region", "date", F.col("total_tests").alias("owid_total_tests")
    )
