"""German case lines, test counts and nowcast."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.functions.text import any_date, decimal_comma, epoch_ms_date, number
from pulsepanel.operators.calendar import all_combinations, fixed_calendar
from pulsepanel.operators.clean import map_codes
from pulsepanel.operators.combine import long_comparison, outer_merge
from pulsepanel.operators.totals import sum_by, with_national_total
from pulsepanel.sources import fixed_values
from pulsepanel.sources.files import read_text_csv, vintage_file

CASE_COLUMNS = ("Bundesland", "Meldedatum", "Datenstand", "AnzahlFall", "AnzahlTodesfall")
FIRST_DAY = "2020-03-01"


def read_case_lines(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path, CASE_COLUMNS)


def case_lines(raw: DataFrame) -> DataFrame:
    """Typed case lines: region name, report day, counts, publication mark."""
    return raw.select(
        F.col("Bundesland").alias("region"),
        epoch_ms_date(F.col("Meldedatum")).alias("date"),
        number(F.col("AnzahlFall")).alias("new_cases"),
        number(F.col("AnzahlTodesfall")).alias("new_deaths"),
        F.col("Datenstand").alias("mark"),
    )


def positives_panel(
    lines: DataFrame,
    codes: DataFrame,
    last_day: str,
    regions: Sequence[str],
    *,
    national_from_listed: bool = False,
) -> DataFrame:
    """New cases and deaths of every listed region on every day, and their national total.

    The total covers every state in the lines; ``national_from_listed`` restricts it to the
    listed regions, as the published series does.
    """
    counts = ["new_cases", "new_deaths"]
    # summed per region and day first: case lines are the big table
    coded = map_codes(sum_by(lines, ["region", "date"], counts), codes, "region", keep_unmapped=True)
    wanted = [r for r in regions if r != "all"]
    spark = lines.sparkSession
    if national_from_listed:
        coded = coded.where(F.col("region").isin(wanted))
    merged = with_national_total(coded, counts)
    grid = spark.createDataFrame([(r,) for r in [*wanted, "all"]], "region string")
    return fixed_calendar(merged, grid, FIRST_DAY, last_day, counts)


def read_test_counts(
    spark: SparkSession, folder: str, before: datetime.date | str | None = None
) -> DataFrame:
    """The newest test-count file of a folder, or the newest dated before a run date."""
    path = vintage_file(spark, folder, "*tests_daily_BL.[cC][sS][vV]", before)
    raw = read_text_csv(spark, path, sep=";", encoding="ISO-8859-1")
    return raw.toDF("region", "date", "new_tests", "positive_fraction")


def test_counts(raw: DataFrame) -> DataFrame:
    """Typed test counts; ISO and day-first dates are recognised row by row."""
    return raw.select(
        "region",
        any_date(F.col("date")).alias("date"),
        decimal_comma(F.col("new_tests")).alias("new_tests"),
        decimal_comma(F.col("positive_fraction")).alias("positive_fraction"),
    )


def test_counts_panel(raw: DataFrame, codes: DataFrame, owid_totals: DataFrame) -> DataFrame:
    """Test counts of one file vintage, their total, and the reported totals.

    Unassigned tests count in the total and then disappear. The positive fraction has no total.
    """
    counts = map_codes(test_counts(raw), codes, "region", keep_unmapped=True)
    merged = with_national_total(counts, ["new_tests", "positive_fraction"])
    merged = merged.withColumn(
        "positive_fraction", F.when(F.col("region") != "all", F.col("positive_fraction"))
    ).where(F.col("region") != fixed_values.DE_UNASSIGNED)
    return all_combinations(outer_merge(merged, owid_totals))


def germany_panel(
    lines: DataFrame,
    raw_tests: DataFrame,
    owid_totals: DataFrame,
    codes: DataFrame,
    *,
    run_date: datetime.date,
    regions: Sequence[str],
) -> DataFrame:
    """Cases, deaths and tests of all regions, as known on the run date."""
    last_day = str(run_date - datetime.timedelta(days=2))
    positives = positives_panel(lines, codes, last_day, regions)
    return outer_merge(positives, test_counts_panel(raw_tests, codes, owid_totals))


def nowcast_table(raw: DataFrame, headers: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Nowcast columns under canonical names, whatever header vintage the file has.

    '.' and unreadable numbers are NULL; decimal commas and both date styles are understood.
    """
    synonyms = headers or fixed_values.NOWCAST_HEADERS
    out = []
    for canonical, names in synonyms.items():
        present = [F.col(f"`{n}`") for n in (canonical, *names) if n in raw.columns]
        if not present:
            continue
        text = F.coalesce(*[F.nullif(F.trim(c), F.lit(".")) for c in present])
        value = any_date(text) if canonical == "date" else decimal_comma(text)
        out.append(value.alias(canonical))
    return raw.select(out)


def read_nowcast(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return nowcast_table(read_text_csv(spark, path, sep=sep, null_value="."))


def nowcast_comparison(nowcast: DataFrame, *, german: bool = False) -> DataFrame:
    """External R(t) estimates as (label, date, value, lower, upper)."""
    labels = fixed_values.NOWCAST_LABELS_GERMAN if german else fixed_values.NOWCAST_LABELS
    return long_comparison(nowcast, labels)
