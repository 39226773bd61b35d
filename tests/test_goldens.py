"""Cases with known answers."""

import datetime

import pytest
from pyspark.sql import functions as F

from pulsepanel.operators.calendar import interpolate, ramp_from_anchor
from pulsepanel.operators.forecast import daily_scaling_factors
from pulsepanel.operators.kernels import generation_time
from pulsepanel.operators.summary import summarize_infections, summarize_median_and_hdi, summarize_r_t
from pulsepanel.operators.totals import recent_shares


def days(start, n):
    first = datetime.date.fromisoformat(start)
    return [(first + datetime.timedelta(days=i)).isoformat() for i in range(n)]


def test_recent_shares(panel):
    n = None
    counts = {
        "RegionA": [10, 10, 10, 10, 10, 20, 20, 20, n, n, n, n, n, n],
        "RegionB": [10, 10, 10, 10, 30, 20, 20, 30, 30, 30, n, 12, n, n],
        "RegionC": [40, 40, 40, 10, 30, 20, 0, 17, 40, n, 20, n, n, n],
        "all": [60, 60, 60, 30, 70, 60, 40, 67, 70, 30, 20, 12, n, n],
    }
    rows = [
        (r, d, None if v is None else v * (1.3 if r == "all" else 1.0))
        for r, values in counts.items()
        for d, v in zip(days("2020-11-01", 14), values)
    ]
    shares = {r.region: r.share for r in recent_shares(panel(rows, ["new_tests"])).collect()}
    total = 387 * 1.3
    assert shares["RegionA"] == pytest.approx(100 / total)
    assert shares["RegionB"] == pytest.approx(130 / total)
    assert shares["RegionC"] == pytest.approx(157 / total)


def test_scaling_factors(panel):
    reports = {"2021-04-03": 45.0, "2021-04-06": 135.0, "2021-04-09": 180.0, "2021-04-12": 315.0}
    rows = [
        ("all", d, float([15, 20, 10][i % 3]), reports.get(d)) for i, d in enumerate(days("2021-04-01", 15))
    ]
    out = daily_scaling_factors(panel(rows, ["forecast", "reported"]), "forecast", "reported")
    got = out.orderBy("date").collect()
    assert [r.scaling_factor for r in got] == [2] * 6 + [1] * 3 + [3] * 6
    assert [r.sum_predicted for r in got] == [None] * 3 + [45] * 9 + [None] * 3
    assert [r.diff_reported for r in got] == [None] * 3 + [90] * 3 + [45] * 3 + [135] * 3 + [None] * 3


def test_interpolation_by_position(panel):
    values = [None, None, 1, None, None, 4, None, 2, None, None]
    rows = [("x", d, None if v is None else float(v)) for d, v in zip(days("2020-01-01", 10), values)]
    got = [r.v for r in interpolate(panel(rows, ["v"]), "v").orderBy("date").collect()]
    assert got == [None, None, 1, 2, 3, 4, 3, 2, 2, 2]


def test_anchor_is_sorted_before_interpolating(panel):
    rows = [("x", d, v) for d, v in zip(days("2020-02-01", 4), [None, None, 5.0, 6.0])]
    got = [r.v for r in ramp_from_anchor(panel(rows, ["v"]), "v").orderBy("date").collect()]
    assert got == pytest.approx([0, 5 / 3, 10 / 3, 5, 6])


def test_generation_time():
    expected = [
        0, 0.00735205, 0.10415990, 0.19569517, 0.19434086, 0.15325727, 0.10988444, 0.07563461,
        0.05123553, 0.03458166, 0.02340621, 0.01594049, 0.01094272, 0.00757832, 0.00529647,
        0.00373575, 0.00265875, 0.00190887, 0.00138209, 0.00100882,
    ]
    assert generation_time() == pytest.approx(expected, abs=5e-9)
    assert sum(generation_time()) == pytest.approx(1)
    assert len(generation_time(12)) == 12


@pytest.mark.parametrize("per_group", [None, 1000])
def test_uniform_summary(spark, per_group):
    samples = spark.range(1000).select(
        F.lit("x").alias("region"), F.lit("2020-01-01").cast("date").alias("date"),
        (F.lit(0.8) + F.col("id") / 999.0).alias("r_t"),
    )
    got = summarize_r_t(samples, 0.9, per_group=per_group).first()
    assert got.r_t == pytest.approx(1.3)
    assert got.r_t_threshold_probability == pytest.approx(0.8, abs=0.02)
    assert got.r_t_upper - got.r_t_lower == pytest.approx(0.9, abs=0.002)


def test_normal_summary_per_100k(spark):
    import statistics

    # 300,000 evenly spaced normal quantiles through a table of 3,000, each slightly shifted
    normal = statistics.NormalDist(200, 30)
    points = spark.createDataFrame([(normal.inv_cdf((k + 0.5) / 3000),) for k in range(3000)], "v double")
    samples = points.select(
        F.lit("x").alias("region"), F.lit("2020-01-01").cast("date").alias("date"),
        F.explode(F.sequence(F.lit(0), F.lit(99))).alias("k"), "v",
    ).withColumn("infections", F.col("v") + F.col("k") * 1e-7)
    people = spark.createDataFrame([("x", 200_000)], "region string, population bigint")
    got = summarize_infections(samples, people, 0.9545).first()
    assert got.infections_by_100k == pytest.approx(100, rel=0.01)
    assert got.infections_by_100k_lower == pytest.approx(70, rel=0.01)
    assert got.infections_by_100k_upper == pytest.approx(130, rel=0.01)
    assert got.infections_absolute == pytest.approx(200, rel=0.01)
    assert got.infections_absolute_lower == pytest.approx(140, rel=0.01)


def test_several_probabilities_get_their_own_columns(spark):
    samples = spark.range(100).select(F.lit("x").alias("region"), F.lit(None).cast("date").alias("d"), F.col("id").alias("v"))
    got = summarize_median_and_hdi(samples, "v", "q", [0.5, 0.9], keys=["region"], per_group=100)
    assert got.columns == ["region", "q", "q_lower_0.5", "q_upper_0.5", "q_lower_0.9", "q_upper_0.9"]
