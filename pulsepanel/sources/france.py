"""French region-day table by age class."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.functions.text import iso_date, number, spaced_integer
from pulsepanel.operators.clean import (
    before_run_date,
    known_regions,
    negatives_to_null,
    only_total_ageclass,
)
from pulsepanel.operators.totals import with_national_total
from pulsepanel.sources.files import read_text_csv

COLUMNS = ("reg", "jour", "P", "T", "cl_age90")


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path, COLUMNS, sep=";")


def region_days(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("reg").alias("region"),
        iso_date(F.col("jour")).alias("date"),
        number(F.col("P")).alias("new_cases"),
        number(F.col("T")).alias("new_tests"),
        F.col("cl_age90").try_cast("int").alias("ageclass"),
    )


def france_panel(raw: DataFrame, region_dim: DataFrame, run_date: datetime.date | str) -> DataFrame:
    """Known regions plus the total; rows with unknown region codes count in the total only."""
    days = before_run_date(only_total_ageclass(region_days(raw)), run_date)
    total = with_national_total(days, ["new_cases", "new_tests"])
    return negatives_to_null(known_regions(total, region_dim))


def region_metadata(published: DataFrame, *, name: str, short_name: str) -> DataFrame:
    """Population text -> number, plus the national row that sums them."""
    regions = published.withColumn("population", spaced_integer(F.col("population")))
    national = regions.agg(F.sum("population").alias("population")).select(
        F.lit("all").alias("region"),
        F.lit(name).alias("name"),
        F.lit(short_name).alias("short_name"),
        "population",
    )
    return regions.select("region", "name", "short_name", "population").unionByName(national)
