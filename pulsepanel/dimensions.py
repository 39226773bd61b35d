"""Dimension tables: countries, regions, compute zones, region codes, holidays."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.functions.text import iso_date
from pulsepanel.sources import fixed_values as fv
from pulsepanel.sources.files import read_text_csv

REGION_SCHEMA = "alpha2 string, region string, name string, short_name string, population bigint"


def zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(z,) for z in fv.ZONES], "zone string")


def iso_dimension(spark: SparkSession) -> DataFrame:
    """ISO codes of the supported countries; pass a fuller table to the loaders if needed."""
    return spark.createDataFrame([(a2, a3) for a2, a3, _ in fv.COUNTRIES], "alpha2 string, alpha3 string")


def country_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a2, z) for a2, _, z in fv.COUNTRIES], "alpha2 string, zone string")


def region_rows() -> list[tuple]:
    """(alpha2, region, name, short_name, population) of every supported region.

    The short name is the region code where none is published.
    """
    rows = [(a2, "all", name, "all", pop) for a2, name, pop in fv.SINGLE_REGION_COUNTRIES]
    rows += [("DE", code, name, code, pop) for code, name, pop in fv.DE_REGIONS]
    us_total = sum(pop for _, _, pop in fv.US_REGIONS)
    rows += [("US", code, name, code, pop) for code, name, pop in fv.US_REGIONS]
    rows += [("US", "all", "United States of America", "all", us_total)]
    fr = [(code, name, short, int(text.replace(" ", ""))) for code, name, short, text in fv.FR_REGIONS]
    rows += [("FR", *r) for r in fr]
    rows += [("FR", "all", "France", "FR", sum(r[3] for r in fr))]
    rows += [("BE", code, name, code, pop) for code, name, _, pop in fv.BE_REGIONS]
    rows += [("IT", *r) for r in fv.IT_REGIONS]
    return rows


def region_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(region_rows(), REGION_SCHEMA)


def with_short_names(regions: DataFrame) -> DataFrame:
    """Short names default to the region code."""
    return regions.withColumn("short_name", F.coalesce("short_name", "region"))


def code_table(spark: SparkSession, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """(name, code) lookup for ``map_codes``."""
    return spark.createDataFrame(list(pairs), "name string, code string")


def german_codes(spark: SparkSession) -> DataFrame:
    return code_table(spark, [(name, code) for code, name, _ in fv.DE_REGIONS])


def belgian_codes(spark: SparkSession) -> DataFrame:
    return code_table(spark, [(source, code) for code, _, source, _ in fv.BE_REGIONS])


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """Holiday table (alpha2, region, date, name); national holidays have no region."""
    raw = read_text_csv(spark, path, ["alpha2", "region", "date", "name"])
    return raw.withColumn("date", iso_date(F.col("date")))
