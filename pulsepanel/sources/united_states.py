"""US state-day table with cumulative counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.functions.text import compact_date, number
from pulsepanel.operators.calendar import difference
from pulsepanel.operators.clean import exclude_regions
from pulsepanel.operators.patches import correct_cumulative_panel
from pulsepanel.operators.totals import national_total, with_national_total
from pulsepanel.sources import fixed_values
from pulsepanel.sources.files import read_text_csv

COLUMNS = ("state", "date", "positive", "total")
COUNTERS = ("positive", "total", "new_cases", "new_tests")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path, COLUMNS)


def state_counters(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("state").alias("region"),
        compact_date(F.col("date")).alias("date"),
        number(F.col("positive")).alias("positive"),
        number(F.col("total")).alias("total"),
    )


def states_panel(raw: DataFrame) -> DataFrame:
    """Uncorrected daily counts of every state plus the national total."""
    states = exclude_regions(state_counters(raw), fixed_values.US_EXCLUDED)
    daily = difference(difference(states, "positive", "new_cases"), "total", "new_tests")
    return with_national_total(daily, COUNTERS)


def correction_rows(corrections=fixed_values.US_CORRECTIONS) -> list[tuple]:
    """One patch row per column of each listed correction."""
    return [
        (region, first, last, column, action, value)
        for region, first, last, columns, action, value in corrections
        for column in columns
    ]


def process_states(
    panel: DataFrame, patches: DataFrame, *, min_states: int = fixed_values.US_MIN_STATES
) -> DataFrame:
    """Corrected test counts as ``predicted_new_tests`` next to the raw ``new_tests``.

    The national rows are summed again from the states alone and stay NULL on days on which
    fewer than ``min_states`` states have a value.
    """
    states = panel.where(F.col("region") != "all")
    kept = states.withColumn("_raw_tests", F.col("new_tests"))
    corrected = correct_cumulative_panel(
        kept, patches, check_from=fixed_values.US_CHECK_FROM, exempt=fixed_values.US_CHECK_EXEMPT
    ).select(
        "region",
        "date",
        "positive",
        "total",
        "new_cases",
        F.col("_raw_tests").alias("new_tests"),
        F.col("new_tests").alias("predicted_new_tests"),
    )
    columns = [c for c in corrected.columns if c not in ("region", "date")]
    return corrected.unionByName(national_total(corrected, columns, min_count=min_states))
