"""Patient line list: country, symptom onset and confirmation as published text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.sources.files import read_text_csv

COLUMNS = {
    "country": "country",
    "date_onset_symptoms": "onset",
    "date_confirmation": "confirmed",
}


def read_line_list(spark: SparkSession, path: str) -> DataFrame:
    raw = read_text_csv(spark, path, list(COLUMNS))
    return raw.select([F.col(old).alias(new) for old, new in COLUMNS.items()])
