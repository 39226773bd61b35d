"""The R(t) plan end to end."""

import datetime

import pytest
from pyspark.sql import functions as F

from pulsepanel.operators import renewal
from pulsepanel.operators.kernels import generation_time
from pulsepanel.plans import rt

P_DELAY = [0.0, 0.2, 0.5, 0.3]


@pytest.fixture(scope="module")
def processed(spark):
    start = datetime.date(2020, 3, 1)
    rows = []
    for t in range(45):
        day = (start + datetime.timedelta(days=t)).isoformat()
        rows.append(("up", day, 100.0 * 1.04**t, None if t == 44 else 5000.0 + 10 * t))
        rows.append(("none", day, 0.0, 100.0))
        rows.append(("untested", day, 0.0, 0.0))
        if t != 20:
            rows.append(("gap", day, 50.0 if t < 40 else None, 900.0))
    df = spark.createDataFrame(rows, "region string, date string, new_cases double, predicted_new_tests double")
    return df.withColumn("date", F.col("date").cast("date"))


@pytest.fixture(scope="module")
def result(processed):
    return rt.estimate(processed, P_DELAY, chains=2, draws=5)


def test_summary(result):
    rows = result.r_t_summary().collect()
    up = [r for r in rows if r.region == "up"]
    assert up and all(r.r_t_lower <= r.r_t <= r.r_t_upper for r in rows)
    last = max(up, key=lambda r: r.date)
    assert last.r_t > 1.05 and last.r_t_threshold_probability == 1.0
    assert not [r for r in rows if r.region in ("none", "untested")]
    assert len({r.date for r in rows if r.region == "gap" and r.date >= datetime.date(2020, 4, 9)}) > 0


def test_curves_add_up_to_the_observed_cases(result, processed):
    """By the scale factor, inferred positives equal the observed ones over the observed days."""
    paths = result.paths.where("new_cases is not null and exposure is not null")
    sums = paths.groupBy("region", "chain", "draw").agg(
        F.sum(F.col("test_adjusted_positive") * F.col("exposure_profile") * F.col("scale_factor")).alias("inferred"),
        F.sum("new_cases").alias("observed"),
    )
    rows = sums.collect()
    assert len(rows) == 20
    assert all(r.inferred == pytest.approx(r.observed) for r in rows)


def test_column_and_table_forms_agree(result):
    table = renewal.scale_factor(result.paths, result.axis, P_DELAY).withColumnRenamed("scale_factor", "other")
    both = result.paths.select("region", "chain", "draw", "scale_factor").distinct().join(table, ["region", "chain", "draw"])
    rows = both.collect()
    assert len(rows) == 20 and all(r.scale_factor == pytest.approx(r.other) for r in rows)
    own = rt.expected_positives(result)
    joined = renewal.expected_positives(result.paths.drop("exposure"), result.axis)
    assert own.agg(F.sum("positive")).first()[0] == pytest.approx(joined.agg(F.sum("positive")).first()[0])


def test_total_and_active_cases(result):
    rows = result.curves.where("region = 'up' and chain = 0 and draw = 0").orderBy("date").collect()
    running, survivors = 0.0, [1 - sum(generation_time()[: i + 1]) for i in range(20)]
    for i, r in enumerate(rows):
        running += r.new_cases
        assert r.total_cases == pytest.approx(running)
        active = sum(rows[i - s].new_cases * survivors[s] for s in range(min(i + 1, 20)))
        assert r.active_cases == pytest.approx(active, rel=1e-9, abs=1e-9)


def test_draws_are_not_joined(result):
    plan = result.curves._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_infections_per_100k(result, spark):
    people = spark.createDataFrame([("up", 200_000), ("gap", 100_000)], "region string, population bigint")
    rows = result.infections_summary(people).where("region = 'up'").collect()
    assert rows
    for r in rows:
        assert r.infections_by_100k == pytest.approx(r.infections_absolute / 2)
