"""Plan shapes that must hold at any size."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from pulsepanel.operators.calendar import insert_future, interpolate
from pulsepanel.operators.forecast import ForecastOptions, predict_testcounts
from pulsepanel.operators.vintages import as_of
from pulsepanel.plans.checked import REGISTRY, derived

QUERIES = {name: build for name, build in queries().items() if name in REGISTRY}
WRITES = {"s14_archived_snapshot", "s15_stored_delay_kernel", "s16_stored_draws", "a10_weighted_r_t_summary",
          "s14_changes_as_of", "s14_stored_changes", "w08_as_of_by_intervals"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_cross_joins_and_no_row_udfs(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_forecast_needs_one_shuffle_on_the_region(spark, sf_dir):
    panel = derived.masked_users(spark, sf_dir)
    plan = plan_of(predict_testcounts(insert_future(panel, 7), ForecastOptions(ignore_before="2024-01-04")))
    # one for the daily counts, one for everything on the series
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert "Join" not in plan


def test_interpolation_reuses_the_series_partitioning(spark, sf_dir):
    plan = plan_of(interpolate(insert_future(derived.masked_users(spark, sf_dir), 7), "new_tests"))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_as_of_is_a_partial_aggregate(spark, sf_dir):
    p = derived.panel_users(spark, sf_dir).withColumn("snapshot_date", F.col("date"))
    plan = plan_of(as_of(p, "2024-01-20"))
    assert "Window" not in plan
    assert "partial_max_by" in plan


def test_counts_read_only_their_columns(spark, sf_dir):
    plan = plan_of(derived.panel_events(spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    assert "partial_count" in plan


def test_as_of_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(
        F.lit("a").alias("region"), F.lit("2024-01-01").cast("date").alias("date"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("snapshot_date"),
        F.col("id").alias("v"),
    ).write.parquet(path)
    df = as_of(spark.read.parquet(path), "2024-01-05")
    assert df.first().v == 4
    assert "LessThanOrEqual(snapshot_date" in plan_of(df)
