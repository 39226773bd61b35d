"""The two calls of a daily run: load a country's panel, then fill and forecast its tests."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from pulsepanel.dimensions import REGION_SCHEMA, zones
from pulsepanel.operators.calendar import insert_future
from pulsepanel.operators.checks import require_columns, require_known_regions
from pulsepanel.operators.clean import negatives_to_null
from pulsepanel.operators.summary import countries_by_zone as group_by_zone
from pulsepanel.operators.vintages import require_run_date
from pulsepanel.sources.fixed_values import COUNTRIES, ZONES

LoadFunction = Callable[[SparkSession, datetime.date], DataFrame]
ProcessFunction = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class CountrySupport:
    """How one country is loaded and processed, and what its regions are.

    ``load`` returns a (region, date, new_cases, new_tests, ...) panel as known on the run date;
    ``process`` adds ``predicted_new_tests``.
    """

    alpha2: str
    zone: str
    region_name: Mapping[str, str]
    region_population: Mapping[str, int]
    load: LoadFunction
    process: ProcessFunction
    region_short_name: Mapping[str, str] = field(default_factory=dict)

    def region_rows(self) -> list[tuple]:
        return [
            (
                self.alpha2,
                region,
                name,
                self.region_short_name.get(region, region),
                self.region_population.get(region),
            )
            for region, name in self.region_name.items()
        ]


class Registry:
    """Supported countries of a session."""

    def __init__(self, iso_codes: Iterable[str] = tuple(a2 for a2, _, _ in COUNTRIES)):
        self._iso_codes = frozenset(iso_codes)
        self._countries: dict[str, CountrySupport] = {}

    def add(self, support: CountrySupport) -> None:
        if support.alpha2 not in self._iso_codes:
            raise KeyError(f"Unknown ISO-3166 alpha 2 country code '{support.alpha2}'.")
        if support.zone not in ZONES:
            raise KeyError(f"Unknown compute zone '{support.zone}'.")
        self._countries[support.alpha2] = support

    def __contains__(self, alpha2: str) -> bool:
        return alpha2.upper() in self._countries

    def get(self, country: str) -> CountrySupport:
        alpha2 = country.upper()
        if alpha2 not in self._countries:
            raise KeyError(f"The country '{alpha2}' is not in the collection of supported countries.")
        return self._countries[alpha2]

    def countries(self, spark: SparkSession) -> DataFrame:
        rows = [(c.alpha2, c.zone) for c in self._countries.values()]
        return spark.createDataFrame(rows, "alpha2 string, zone string")

    def regions(self, spark: SparkSession, country: str | None = None) -> DataFrame:
        chosen = self._countries.values() if country is None else [self.get(country)]
        rows = [row for c in chosen for row in c.region_rows()]
        return spark.createDataFrame(rows, REGION_SCHEMA)


def get_data(
    registry: Registry, spark: SparkSession, country: str, run_date: datetime.date
) -> DataFrame:
    """Validated panel of a country as known on ``run_date``; negative counts are NULL."""
    support = registry.get(country)
    require_run_date(run_date, datetime.date.today())
    panel = support.load(spark, run_date)
    require_columns(panel, ["region", "date", "new_cases", "new_tests"])
    require_known_regions(panel, registry.regions(spark, country))
    return negatives_to_null(panel)


def process_testcounts(
    registry: Registry, country: str, panel: DataFrame, future_days: int = 0
) -> DataFrame:
    """Panel with ``predicted_new_tests``, optionally extended into the future."""
    support = registry.get(country)
    if future_days > 0:
        panel = insert_future(panel, future_days)
    return require_columns(
        panel.transform(support.process), ["region", "date", "predicted_new_tests"]
    )


def countries_by_zone(registry: Registry, spark: SparkSession) -> DataFrame:
    return group_by_zone(registry.countries(spark), zones(spark))
