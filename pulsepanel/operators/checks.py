"""Contract checks of a panel."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNT_COLUMNS = ("new_cases", "new_tests", "new_deaths")


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Columns {missing} are missing. Columns were: {df.columns}")
    return df


def missing_regions(panel: DataFrame, region_dim: DataFrame) -> DataFrame:
    """Regions of the panel that lack a name or a population in the dimension."""
    named = region_dim.where("name is not null and population is not null").select("region")
    return panel.select("region").distinct().join(named, "region", "left_anti")


def require_known_regions(panel: DataFrame, region_dim: DataFrame) -> DataFrame:
    unknown = [r.region for r in missing_regions(panel, region_dim).limit(20).collect()]
    if unknown:
        raise ValueError(f"Data contains regions {unknown} without a registered name or population.")
    return panel


def unknown_countries(countries: DataFrame, iso_dim: DataFrame) -> DataFrame:
    """Country codes that the ISO dimension does not list."""
    return countries.join(iso_dim.select("alpha2"), "alpha2", "left_anti")


def duplicate_keys(panel: DataFrame, keys: Sequence[str] = ("region", "date")) -> DataFrame:
    """Key combinations that occur more than once; empty for a valid panel."""
    return panel.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def negative_counts(panel: DataFrame) -> DataFrame:
    """How many negative entries each count column has."""
    present = [c for c in COUNT_COLUMNS if c in panel.columns]
    return panel.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in present])


def snapshot_mark(lines: DataFrame, column: str, run_date_text: str) -> DataFrame:
    """Distinct publication marks of a case file and whether they name the run date."""
    return lines.agg(
        F.countDistinct(column).cast("bigint").alias("n_marks"),
        F.min(column).alias("mark"),
    ).withColumn(
        "is_valid", (F.col("n_marks") == 1) & F.col("mark").contains(run_date_text)
    )


def require_single_snapshot(lines: DataFrame, column: str, run_date_text: str) -> DataFrame:
    found = snapshot_mark(lines, column, run_date_text).first()
    if not found.is_valid:
        raise ValueError(
            f"Expected one publication mark containing {run_date_text}; "
            f"found {found.n_marks}, first '{found.mark}'."
        )
    return lines


def data_masks(panel: DataFrame, tests: str = "new_tests") -> DataFrame:
    """Flags for days with case counts, test counts and both."""
    return panel.withColumns(
        {
            "has_cases": F.col("new_cases").isNotNull(),
            "has_testcounts": F.col(tests).isNotNull(),
            "has_data": F.col("new_cases").isNotNull() & F.col(tests).isNotNull(),
        }
    )


def mask_counts(panel: DataFrame, keys: Sequence[str] = ("region",), tests: str = "new_tests") -> DataFrame:
    """Number of days in all, with cases, with test counts and with both."""
    return data_masks(panel, tests).groupBy(*keys).agg(
        F.count("*").alias("n_dates"),
        F.count_if("has_cases").alias("n_with_cases"),
        F.count_if("has_testcounts").alias("n_with_testcounts"),
        F.count_if("has_data").alias("n_with_data"),
    )
