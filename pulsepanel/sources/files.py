"""CSV and Parquet access. Every CSV field stays text; columns are chosen by header name."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.operators.vintages import file_date


def read_text_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    sep: str = ",",
    encoding: str = "UTF-8",
    null_value: str | None = None,
    with_file_name: bool = False,
) -> DataFrame:
    """Header CSV as strings, restricted to ``columns`` so that only those are parsed."""
    reader = spark.read.options(header=True, sep=sep, encoding=encoding, inferSchema=False)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    df = reader.csv(path if isinstance(path, str) else list(path))
    chosen = list(columns) if columns is not None else df.columns
    missing = [c for c in chosen if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}.")
    picked = [F.col(f"`{c}`") for c in chosen]
    if with_file_name:
        picked.append(F.col("_metadata.file_name").alias("file_name"))
    return df.select(picked)


def vintage_file(
    spark: SparkSession,
    folder: str,
    pattern: str,
    before: datetime.date | str | None = None,
) -> str:
    """Path of the newest file whose name starts with a date, or the newest before ``before``.

    Lists the folder without reading any file.
    """
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    )
    dated = listing.withColumn("day", file_date(F.substring_index("path", "/", -1)))
    allowed = dated.where("day is not null")
    if before is not None:
        allowed = allowed.where(F.col("day") < F.lit(str(before)).cast("date"))
    newest = allowed.agg(F.max_by("path", F.struct("day", "path")).alias("path")).first().path
    if newest is None:
        raise FileNotFoundError(f"No file like {pattern} in {folder} for {before or 'any day'}.")
    return newest


def archive_snapshot(df: DataFrame, path: str, snapshot: datetime.date | str) -> None:
    """Keep the raw table of one day: Parquet, partitioned by ``snapshot_date``.

    Writing the same day again replaces that day only.
    """
    (
        df.withColumn("snapshot_date", F.lit(str(snapshot)).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Archived snapshots; filters on ``snapshot_date`` prune whole folders."""
    return spark.read.parquet(path)


def write_kernel(kernel: DataFrame, path: str) -> None:
    kernel.write.mode("overwrite").parquet(path)


def read_kernel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("lag int, p double").parquet(path)


def write_draws(draws: DataFrame, path: str) -> None:
    """Posterior draws, partitioned by region so that one region's summary reads one folder."""
    draws.write.mode("overwrite").partitionBy("region").parquet(path)


def read_draws(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
