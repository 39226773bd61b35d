"""Daily surveillance panels on Spark: clean, fill, forecast, estimate R(t), summarise."""

from pulsepanel.api import (
    CountrySupport,
    Registry,
    countries_by_zone,
    get_data,
    process_testcounts,
)

__all__ = [
    "CountrySupport",
    "Registry",
    "countries_by_zone",
    "get_data",
    "process_testcounts",
]
