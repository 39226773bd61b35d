"""Load and process plans of the supported countries.

Landed files are expected below one folder per country; any path Spark can read will do.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel import dimensions
from pulsepanel.api import CountrySupport, Registry
from pulsepanel.operators.calendar import back_extend, daily_from_totals, ramp_from_anchor
from pulsepanel.operators.combine import assign_on_date, forecast_holidays, with_holidays
from pulsepanel.operators.forecast import (
    ForecastOptions,
    daily_scaling_factors,
    predict_testcounts,
)
from pulsepanel.operators.patches import apply_patches, patch_table
from pulsepanel.sources import belgium, france, germany, italy, owid, united_states
from pulsepanel.sources import fixed_values as fv

DEFAULT = ForecastOptions()


def predict(panel: DataFrame, options: ForecastOptions = DEFAULT) -> DataFrame:
    """Forecast only."""
    return predict_testcounts(panel, options)


def predict_and_back_extend(panel: DataFrame, options: ForecastOptions = DEFAULT, *, start: str = "2020-01-01") -> DataFrame:
    """Forecast, then zeros back to the start of 2020."""
    return back_extend(predict_testcounts(panel, options), "predicted_new_tests", start=start)


def predict_and_reconcile(panel: DataFrame, options: ForecastOptions = DEFAULT) -> DataFrame:
    """Forecast every region, then scale all of them so that the national sum meets the reports."""
    raw = predict_testcounts(panel, options, target="predicted_new_tests_raw")
    national = raw.where(F.col("region") == "all")
    factors = daily_scaling_factors(national, "predicted_new_tests_raw", "owid_total_tests")
    scaled = assign_on_date(raw, factors, "scaling_factor")
    return scaled.withColumn(
        "predicted_new_tests", F.col("predicted_new_tests_raw") * F.col("scaling_factor")
    )


@dataclass(frozen=True)
class SeriesPlan:
    """What a one-series country needs beyond the forecast."""

    alpha2: str
    weekly_totals: bool = False
    ramp: bool = True
    glitches: Sequence[str] = ()


SERIES_PLANS = (
    SeriesPlan("AT", glitches=fv.AT_GLITCHES),
    SeriesPlan("CH"),
    SeriesPlan("CZ"),
    SeriesPlan("DK"),
    SeriesPlan("LU"),
    SeriesPlan("NL", weekly_totals=True, ramp=False),
    SeriesPlan("PT", ramp=False),
)


def process_series_countries(
    panel: DataFrame,
    plans: Sequence[SeriesPlan] = SERIES_PLANS,
    options: ForecastOptions = DEFAULT,
) -> DataFrame:
    """All one-series countries in one job; input and output are (country, region='all', date).

    The country is the series key, so adding countries adds partitions, not jobs.
    """
    spark = panel.sparkSession
    df = panel.where(F.col("country").isin([p.alpha2 for p in plans])).drop("region")
    df = df.withColumnRenamed("country", "region")
    rows = [
        (p.alpha2, day, day, "new_tests", "null", None) for p in plans for day in p.glitches
    ]
    if rows:
        df = apply_patches(df, patch_table(spark, rows), ["new_tests"])
    weekly = [p.alpha2 for p in plans if p.weekly_totals]
    if weekly:
        is_weekly = F.col("region").isin(weekly)
        converted = daily_from_totals(df.where(is_weekly), "total_tests", "new_tests")
        df = df.where(~is_weekly).unionByName(converted)
    df = predict_testcounts(df, options)
    ramped = [p.alpha2 for p in plans if p.ramp]
    df = ramp_from_anchor(df, "predicted_new_tests", only=F.col("region").isin(ramped))
    others = [c for c in df.columns if c != "region"]
    return df.select(F.col("region").alias("country"), F.lit("all").alias("region"), *others)


def _process_one_series(plan: SeriesPlan):
    def process(panel: DataFrame) -> DataFrame:
        keyed = panel.withColumn("country", F.lit(plan.alpha2))
        return process_series_countries(keyed, [plan]).drop("country")

    return process


def default_registry(
    landing: str, *, take_latest_tests: bool = True, holidays: str | None = None
) -> Registry:
    """All supported countries, reading files landed below ``landing``.

    ``take_latest_tests=False`` uses the last German test-count file before the run date, to see
    what was known then. ``holidays`` is the path of a holiday table for the forecasts.
    """
    registry = Registry()
    zone = {a2: z for a2, _, z in fv.COUNTRIES}
    named: dict[str, list[tuple]] = {}
    for alpha2, region, name, short, population in dimensions.region_rows():
        named.setdefault(alpha2, []).append((region, name, short, population))

    def add(alpha2: str, load, process) -> None:
        rows = named[alpha2]
        registry.add(
            CountrySupport(
                alpha2=alpha2,
                zone=zone[alpha2],
                region_name={r: n for r, n, _, _ in rows},
                region_short_name={r: s for r, _, s, _ in rows},
                region_population={r: p for r, _, _, p in rows},
                load=load,
                process=process if holidays is None else with_national_holidays(alpha2, process),
            )
        )

    def with_national_holidays(alpha2: str, process):
        def run(panel: DataFrame) -> DataFrame:
            table = dimensions.read_holidays(panel.sparkSession, holidays)
            return process(with_holidays(panel, forecast_holidays(table, alpha2))).drop("holiday")

        return run

    def world(spark: SparkSession) -> DataFrame:
        return owid.owid_panel(
            owid.read_owid(spark, f"{landing}/owid"), dimensions.iso_dimension(spark)
        )

    def load_de(spark: SparkSession, run_date: datetime.date) -> DataFrame:
        return germany.germany_panel(
            germany.case_lines(germany.read_case_lines(spark, f"{landing}/de/cases")),
            germany.read_test_counts(
                spark, f"{landing}/de/tests", None if take_latest_tests else run_date
            ),
            owid.summarized_totals(world(spark), "DE"),
            dimensions.german_codes(spark),
            run_date=run_date,
            regions=[code for code, _, _ in fv.DE_REGIONS],
        )

    def load_us(spark: SparkSession, run_date: datetime.date) -> DataFrame:
        return united_states.states_panel(united_states.read_states(spark, f"{landing}/us"))

    def process_us(panel: DataFrame) -> DataFrame:
        patches = patch_table(panel.sparkSession, united_states.correction_rows())
        return united_states.process_states(panel, patches)

    def load_fr(spark: SparkSession, run_date: datetime.date) -> DataFrame:
        regions = dimensions.region_dimension(spark).where("alpha2 = 'FR'")
        return france.france_panel(france.read_regions(spark, f"{landing}/fr"), regions, run_date)

    def load_be(spark: SparkSession, run_date: datetime.date) -> DataFrame:
        return belgium.belgium_panel(
            belgium.read_tests(spark, f"{landing}/be"), dimensions.belgian_codes(spark)
        )

    def load_it(spark: SparkSession, run_date: datetime.date) -> DataFrame:
        return italy.italy_panel(
            italy.read_regions(spark, f"{landing}/it/regions"),
            italy.read_nation(spark, f"{landing}/it/nation"),
        )

    add("DE", load_de, predict_and_reconcile)
    add("US", load_us, process_us)
    add("FR", load_fr, predict_and_back_extend)
    add("BE", load_be, predict_and_back_extend)
    add("IT", load_it, predict)
    for plan in SERIES_PLANS:
        def load(spark: SparkSession, run_date: datetime.date, alpha2: str = plan.alpha2) -> DataFrame:
            return owid.one_country(world(spark), alpha2)

        add(plan.alpha2, load, _process_one_series(plan))
    return registry
