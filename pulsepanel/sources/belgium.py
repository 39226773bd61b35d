"""Belgian test table by region and province, with an unassigned remainder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.functions.text import iso_date, number
from pulsepanel.operators.clean import map_codes, negatives_to_null
from pulsepanel.operators.totals import redistributed_days, sum_by
from pulsepanel.sources import fixed_values
from pulsepanel.sources.files import read_text_csv

COLUMNS = ("DATE", "REGION", "PROVINCE", "TESTS_ALL_POS", "TESTS_ALL")
COUNTS = ["new_cases", "new_tests"]


def read_tests(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path, COLUMNS)


def test_rows(raw: DataFrame) -> DataFrame:
    return raw.select(
        iso_date(F.col("DATE")).alias("date"),
        F.col("REGION").alias("region"),
        F.col("PROVINCE").alias("province"),
        number(F.col("TESTS_ALL_POS")).alias("new_cases"),
        number(F.col("TESTS_ALL")).alias("new_tests"),
    )


def province_sums(rows: DataFrame, *, outside: str = "Brussels") -> DataFrame:
    """Sums per province; rows of Brussels or without a province are left out."""
    inside = rows.where(
        (F.col("region").isNull() | (F.col("region") != outside)) & F.col("province").isNotNull()
    )
    sums = sum_by(inside, ["province", "date"], COUNTS)
    return sums.withColumnRenamed("province", "region")


def belgium_panel(
    raw: DataFrame,
    codes: DataFrame,
    *,
    buckets=fixed_values.BE_REDISTRIBUTION,
    outside: str = "Brussels",
    exact: bool = False,
) -> DataFrame:
    """National, regional (with the unassigned tests spread) and provincial rows."""
    # the raw rows are read once; everything below works on their daily sums
    daily = sum_by(test_rows(raw), ["date", "region", "province"], COUNTS)
    in_province = (
        (F.col("region").isNull() | (F.col("region") != outside)) & F.col("province").isNotNull()
    )
    national = F.struct(F.lit("all").alias("region"), *[F.sum(c).alias(c) for c in COUNTS])
    # a day has one entry per region and province
    provinces = F.collect_list(
        F.when(in_province, F.struct(F.col("province").alias("region"), *COUNTS))
    )
    days = redistributed_days(
        daily, COUNTS, buckets, exact=exact,
        extra=[national.alias("national"), provinces.alias("provinces")],
    )
    regional = F.transform(
        "entries", lambda e: F.struct(e.region.alias("region"), *[e[c].cast("double").alias(c) for c in COUNTS])
    )
    rows = days.select(
        "date", F.explode(F.concat(F.array("national"), regional, "provinces")).alias("e")
    ).select("e.region", "date", *[f"e.{c}" for c in COUNTS])
    merged = sum_by(rows, ["region", "date"], COUNTS)
    return negatives_to_null(map_codes(merged, codes, "region", keep_unmapped=False))
