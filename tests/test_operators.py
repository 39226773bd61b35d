"""Operators against pandas, numpy and plain Python."""

import datetime
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsepanel.functions import text
from pulsepanel.functions.values import log_gamma
from pulsepanel.operators import calendar, checks, clean, combine, kernels, patches, renewal, summary, totals
from pulsepanel.operators.forecast import ForecastOptions, fit_components, predict_testcounts


def frame(rows, column):
    return [(r, d.isoformat(), v) for (r, d), v in rows.items()]


def random_panel(seed, regions=3, n=60, gap=0.3, missing=0.3):
    rng = np.random.default_rng(seed)
    start = datetime.date(2020, 3, 1)
    rows = []
    for r in range(regions):
        for i in range(n):
            if rng.random() < gap and 0 < i < n - 1:
                continue
            v = None if rng.random() < missing else float(rng.integers(1, 500))
            rows.append((f"r{r}", (start + datetime.timedelta(days=i)).isoformat(), v))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_interpolate_equals_pandas(panel, seed):
    rows = random_panel(seed)
    got = calendar.interpolate(panel(rows, ["v"]), "v").toPandas().sort_values(["region", "date"])
    want = pd.DataFrame(rows, columns=["region", "date", "v"]).sort_values(["region", "date"])
    want["v"] = want.groupby("region")["v"].transform(lambda s: s.astype(float).interpolate("linear"))
    np.testing.assert_allclose(got["v"].to_numpy(float), want["v"].to_numpy(float))


@pytest.mark.parametrize("seed", [4, 5])
def test_densify_equals_reindex(panel, seed):
    rows = random_panel(seed)
    got = calendar.insert_future(panel(rows, ["v"]), 5).toPandas()
    want = []
    for r, g in pd.DataFrame(rows, columns=["region", "date", "v"]).groupby("region"):
        s = g.assign(date=pd.to_datetime(g.date)).set_index("date")["v"].astype(float)
        s = s.reindex(pd.date_range(s.index[0], s.index[-1] + pd.Timedelta(days=5)))
        want += [(r, d.date(), v) for d, v in s.items()]
    got = sorted(got.itertuples(index=False, name=None), key=lambda x: x[:2])
    assert [x[:2] for x in got] == [x[:2] for x in want]
    np.testing.assert_allclose([x[2] for x in got], [x[2] for x in want])


def test_model_axis(panel):
    rows = [("a", f"2020-03-{d:02d}", c) for d, c in [(1, 0.0), (2, None), (4, 3.0), (6, 0.0)]]
    rows += [("b", "2020-03-05", 0.0), ("b", "2020-03-06", None)]
    got = calendar.model_axis(panel(rows, ["new_cases"]), 3).orderBy("region", "date").collect()
    assert [(r.region, r.date.day, r.new_cases) for r in got] == [
        ("a", 1, None), ("a", 2, None), ("a", 3, None), ("a", 4, 3.0), ("a", 5, None), ("a", 6, 0.0),
        ("b", 2, None), ("b", 3, None), ("b", 4, None), ("b", 5, 0.0), ("b", 6, None),
    ]


@pytest.mark.parametrize(
    "dates,want",
    [
        (["2020-02-01"], ["2020-01-01", "2020-02-01"]),
        (["2020-01-01", "2020-02-01"], ["2020-01-01", "2020-02-01"]),
        (["2019-12-01", "2020-02-01"], ["2019-12-01", "2020-01-01", "2020-02-01"]),
        (["2019-12-01"], ["2019-12-01", "2020-01-01"]),
    ],
)
def test_anchor_positions(panel, dates, want):
    df = panel([("x", d, 7.0, 8.0) for d in dates], ["v", "w"])
    got = calendar.upsert_anchor(df, "v").orderBy("date").collect()
    assert [r.date.isoformat() for r in got] == want
    assert [r.v for r in got] == [0.0 if d == "2020-01-01" else 7.0 for d in want]
    assert [r.w for r in got] == [8.0 if d in dates else None for d in want]


def test_anchor_only_where_wanted(panel):
    df = panel([("x", "2020-02-01", 1.0), ("y", "2020-02-01", 1.0)], ["v"])
    got = calendar.ramp_from_anchor(df, "v", only=F.col("region") == "x")
    assert got.groupBy("region").count().orderBy("region").collect() == [("x", 2), ("y", 1)]


def test_yesterday_needs_the_day_before(panel):
    df = panel([("x", "2020-03-01", 1.0), ("x", "2020-03-02", 4.0), ("x", "2020-03-04", 9.0)], ["v"])
    got = calendar.increase_since_yesterday(df, "v", "d").orderBy("date").collect()
    assert [r.d for r in got] == [None, 3.0, None]
    got = calendar.difference(df, "v", "d").orderBy("date").collect()
    assert [r.d for r in got] == [None, 3.0, 5.0]


def test_weekly_totals_to_daily(panel):
    df = panel([("x", "2020-01-03", 6.0), ("x", "2020-01-04", None), ("x", "2020-01-05", 6.0)], ["total"])
    got = calendar.daily_from_totals(df, "total", "daily").orderBy("date").collect()
    assert [r.daily for r in got] == [None, 6.0, None, None]


@pytest.mark.parametrize("x", [0.5, 1.0, 2.0, 3.7, 10.0, 250.0, 1e6])
def test_log_gamma(spark, x):
    got = spark.range(1).select(log_gamma(F.lit(x)).alias("v")).first().v
    assert got == pytest.approx(math.lgamma(x), rel=1e-11, abs=1e-10)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("per_group", [None, 5000])
def test_hdi_and_median_equal_numpy(spark, seed, per_group):
    rng = np.random.default_rng(seed)
    sizes = {"tiny": 1, "small": 7, "ties": 900, "large": 5000}
    samples = {
        "tiny": np.array([3.0]),
        "small": rng.normal(size=7),
        "ties": rng.integers(-3, 4, size=900).astype(float),
        "large": np.exp(rng.normal(size=5000)) * rng.choice([-1, 1], size=5000),
    }
    rows = [(k, float(v)) for k in sizes for v in samples[k]]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {
        r.k: r
        for r in summary.summarize_median_and_hdi(
            df, "v", "q", [0.5, 0.9], keys=["k"], per_group=per_group
        ).collect()
    }
    for k, v in samples.items():
        v = np.sort(v)
        assert got[k]["q"] == pytest.approx(np.median(v))
        for p in (0.5, 0.9):
            m = math.floor(p * len(v))
            widths = v[m:] - v[: len(v) - m]
            i = int(np.argmin(widths))
            assert got[k][f"q_lower_{p}"] == v[i]
            assert got[k][f"q_upper_{p}"] == v[i + m]


def test_hdi_crosses_rank_blocks(spark, monkeypatch):
    """Small blocks: lookups must find values that started in an earlier block."""
    monkeypatch.setattr(summary, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(9)
    v = np.sort(np.concatenate([np.full(333, 2.0), rng.normal(size=667)]))
    df = spark.createDataFrame([("x", float(a)) for a in v], "k string, v double")
    got = summary.ranked_hdi(summary.value_ranks(df, "v", ["k"]), 0.8, ["k"]).first()
    widths = v[800:] - v[:200]
    i = int(np.argmin(widths))
    assert (got.lower, got.upper) == (v[i], v[i + 800])


@pytest.mark.parametrize("per_group", [None, 2000])
def test_quantile_bands_equal_numpy(spark, per_group):
    v = np.random.default_rng(1).normal(size=1501)
    df = spark.createDataFrame([("x", float(a)) for a in v], "k string, v double")
    qs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = summary.quantile_bands(df, "v", qs, keys=["k"], per_group=per_group).orderBy("q").collect()
    np.testing.assert_allclose([r.value for r in got], np.quantile(v, qs))


def test_array_path_refuses_large_groups(spark):
    with pytest.raises(ValueError, match="per_group"):
        summary.summarize_median_and_hdi(spark.range(1), "id", "q", per_group=10**7)


def test_renewal_equals_loop(spark):
    g = kernels.generation_time(20)
    rng = np.random.default_rng(3)
    start = datetime.date(2020, 3, 1)
    paths = {(f"r{i}", 0, i): np.exp(np.cumsum(rng.normal(0, 0.1, size=n))) for i, n in enumerate((1, 5, 60))}
    rows = [
        (*k, (start + datetime.timedelta(days=t)).isoformat(), float(r), k[0])
        for k, rs in paths.items()
        for t, r in enumerate(rs)
    ]
    df = spark.createDataFrame(rows, "region string, chain int, draw int, date string, r_t double, note string")
    df = df.withColumn("date", F.col("date").cast("date"))
    got = renewal.renewal_infections(df, g, seed=0.5).orderBy("region", "date").collect()
    for (region, _, _), rs in paths.items():
        y = [0.5]
        for t in range(1, len(rs)):
            y.append(sum(rs[s] * y[s] * g[t - s] for s in range(t) if t - s < len(g)))
        mine = [r for r in got if r.region == region]
        np.testing.assert_allclose([r.infections for r in mine], y, rtol=1e-12)
        assert all(r.note == region for r in mine)


def test_convolution_equals_numpy(panel):
    x = [1.0, None, 3.0, 2.0, 0.0, 5.0]
    kernel = [0.0, 0.5, 0.3, 0.2]
    df = panel([("a", f"2020-03-{i + 1:02d}", v) for i, v in enumerate(x)], ["x"])
    got = [r.c for r in kernels.convolve(df, "x", kernel, "c").orderBy("date").collect()]
    np.testing.assert_allclose(got, np.convolve([v or 0 for v in x], kernel)[: len(x)])


def test_delay_kernel_repairs_and_filters(spark):
    rows = [
        ("A", "01.01.2020", "05.01.2020"),
        ("A", "02.01.2020", "06.01.2020"),
        ("A", "01.31.2020", "02.02.2020"),  # repaired, but its onset is censored below
        ("A", "03.01.2020", "03.01.2020"),  # not after onset
        ("Mexico", "01.01.2020", "09.01.2020"),
        ("A", "01.01.2020 - 03.01.2020", "09.01.2020"),
        ("A", None, "09.01.2020"),
        (None, "01.01.2020", "09.01.2020"),
        ("A", "04.01.2020", "06.01.2020"),
        ("A", "99.99.2020", "06.01.2020"),
        ("A", "01.03.2020", "05.03.2020"),  # newest onset
        ("A", "20.01.2020", "31.04.2020"),  # repaired, longer than the maximum
    ]
    df = spark.createDataFrame(rows, "country string, onset string, confirmed string")
    delays = kernels.valid_delays(df)
    assert {(r.onset.isoformat(), r.delay) for r in delays.collect()} == {
        ("2020-01-01", 4), ("2020-01-02", 4), ("2020-01-31", 2), ("2020-01-04", 2),
        ("2020-03-01", 4), ("2020-01-20", 102),
    }
    kept = kernels.drop_censored(delays)
    assert kept.count() == 5
    p = kernels.kernel_values(kernels.delay_kernel(kept))
    assert p == pytest.approx([0] * 7 + [0.5, 0, 0.5])


def test_patch_precedence(spark, panel):
    df = panel([("a", f"2020-03-{d:02d}", 10.0) for d in range(1, 5)], ["v"])
    rows = [
        ("a", "2020-03-02", None, "v", "offset", 1.0),
        ("a", "2020-03-03", None, "v", "offset", 5.0),
        ("a", "2020-03-03", "2020-03-03", "v", "set", 99.0),
        ("a", "2020-03-04", "2020-03-04", "v", "set", 98.0),
        ("a", "2020-03-04", "2020-03-04", "v", "null", None),
        ("b", "2020-03-01", None, "v", "null", None),
        ("a", "2021-01-01", None, "v", "null", None),
    ]
    out = patches.apply_patches(df, patches.patch_table(spark, rows), ["v"]).orderBy("date")
    assert [r.v for r in out.collect()] == [10.0, 11.0, 99.0, None]


def test_holiday_calendar(spark):
    rows = [
        ("DE", None, "2020-01-01", "New Year"),
        ("DE", "BY", "2020-01-06", "Epiphany"),
        ("DE", "BW", "2020-06-01", "Regional"),
        ("FR", None, "2020-07-14", "Other country"),
    ]
    hol = spark.createDataFrame(rows, "alpha2 string, region string, date string, name string")
    hol = hol.withColumn("date", F.col("date").cast("date"))
    def names(regions):
        return {(r.date.isoformat(), r.holiday) for r in combine.holiday_calendar(hol, "DE", regions).collect()}

    assert names(None) == {("2020-01-01", "national")}
    assert names(["BY"]) == {("2020-01-01", "national"), ("2020-01-06", "regional")}
    assert len(names("all")) == 3
    one = combine.forecast_holidays(hol, "DE", "BY").collect()
    assert [(r.date.isoformat(), r.holiday) for r in one] == [("2020-01-01", "holiday")]
    assert combine.forecast_holidays(hol, "DE", ["BY", "BW"], regional_holidays=True).count() == 3
    for regions in (None, "BY", ["BY"]):
        with pytest.raises(ValueError, match="several regions"):
            combine.forecast_holidays(hol, "DE", regions, regional_holidays=True)


def test_forecast_keeps_reports_and_skips_short_series(panel):
    start = datetime.date(2020, 4, 1)
    rows = []
    for i in range(40):
        d = (start + datetime.timedelta(days=i)).isoformat()
        rows.append(("long", d, None if i % 6 == 3 else 100.0 + 2 * i))
        rows.append(("short", d, 5.0 if i < 10 else None))
    out = predict_testcounts(panel(rows, ["new_tests"])).toPandas()
    long = out[out.region == "long"].sort_values("date")
    np.testing.assert_allclose(long.predicted_new_tests, [100 + 2 * i for i in range(40)], rtol=1e-9)
    assert out[out.region == "short"].predicted_new_tests.isna().all()


def test_segment_trend_extrapolates_last_segment(panel):
    start = datetime.date(2020, 4, 1)
    rows = []
    for i in range(70):
        d = (start + datetime.timedelta(days=i)).isoformat()
        v = 100.0 + i if i < 30 else 130.0 + 3 * (i - 30)
        rows.append(("x", d, v if i < 60 else None))
    fit = fit_components(panel(rows, ["new_tests"]), ForecastOptions(segment_days=30)).orderBy("date").collect()
    assert fit[10].trend == pytest.approx(110)
    assert fit[65].trend == pytest.approx(130 + 3 * 35)


def test_weekday_without_training_rows_keeps_its_days(panel):
    start = datetime.date(2020, 4, 1)
    rows = []
    for i in range(42):
        day = start + datetime.timedelta(days=i)
        rows.append(("x", day.isoformat(), None if day.weekday() == 6 else 100.0))
    out = predict_testcounts(panel(rows, ["new_tests"])).collect()
    assert all(r.predicted_new_tests == pytest.approx(100) for r in out)


def test_national_total_counts_missing_as_zero(panel):
    df = panel([("a", "2020-03-01", None), ("b", "2020-03-01", None), ("a", "2020-03-02", 2.0)], ["v"])
    got = {(r.region, r.date.day): r.v for r in totals.with_national_total(df, ["v"]).collect()}
    assert got == {("a", 1): None, ("b", 1): None, ("all", 1): 0.0, ("a", 2): 2.0, ("all", 2): 2.0}
    few = totals.national_total(df, ["v"], min_count=1).orderBy("date").collect()
    assert [r.v for r in few] == [None, 2.0]


def test_redistribution_is_sequential_unless_exact(panel):
    df = panel([("B", "2020-03-01", 100.0), ("F", "2020-03-01", 600.0), ("W", "2020-03-01", 300.0), (None, "2020-03-01", 500.0)], ["v"])
    got = {r.region: r.v for r in totals.redistribute_unassigned(df, "v", ["B", "F", "W"]).collect()}
    b = 100 + 500 * (100 / 1000)
    f = 600 + 500 * (600 / (b + 600 + 300))
    w = 300 + 500 * (300 / (b + f + 300))
    assert got == {"B": round(b), "F": round(f), "W": round(w)}
    exact = {r.region: r.v for r in totals.redistribute_unassigned(df, "v", ["B", "F", "W"], exact=True).collect()}
    assert exact == {"B": 150, "F": 900, "W": 450}


def test_redistribution_without_unassigned_or_without_buckets(panel):
    df = panel([("B", "2020-03-01", 5.0), (None, "2020-03-02", 7.0)], ["v"])
    got = {(r.region, r.date.day): r.v for r in totals.redistribute_unassigned(df, "v", ["B", "F"]).collect()}
    assert got == {("B", 1): 5, ("F", 1): 0, ("B", 2): 0, ("F", 2): 0}


def test_estimate_recovers_constant_growth(panel):
    """Cases that follow the renewal equation with R = 1.3 give that R back."""
    g = kernels.generation_time(20)
    y = [50.0]
    for t in range(1, 60):
        y.append(sum(1.3 * y[s] * g[t - s] for s in range(t) if t - s < len(g)))
    start = datetime.date(2020, 3, 1)
    rows = [("x", (start + datetime.timedelta(days=t)).isoformat(), v * 1e3, 1000.0) for t, v in enumerate(y)]
    est = renewal.estimate_r_t(panel(rows, ["new_cases", "daily_tests"]), g).orderBy("date").collect()
    assert est[-1].r_t_mean == pytest.approx(1.3, rel=1e-3)
    assert len(est) == 54


def test_more_testing_is_not_more_infection(panel):
    g = kernels.generation_time(20)
    start = datetime.date(2020, 3, 1)
    rows = [
        ("x", (start + datetime.timedelta(days=t)).isoformat(), 100.0 + 10 * t, 1000.0 + 100 * t) for t in range(60)
    ]
    est = renewal.estimate_r_t(panel(rows, ["new_cases", "daily_tests"]), g).orderBy("date").collect()
    assert est[-1].r_t_mean == pytest.approx(1.0, abs=0.02)


def test_gamma_quantiles(spark):
    """Against exact gamma quantiles (shape 5, rate 1): 0.05 -> 1.9701, 0.95 -> 9.1535."""
    z = 1.6448536269514722
    one = spark.range(1).select(
        renewal.gamma_quantile(F.lit(5.0), F.lit(1.0), F.lit(-z)).alias("lo"),
        renewal.gamma_quantile(F.lit(5.0), F.lit(1.0), F.lit(z)).alias("hi"),
    ).first()
    assert one.lo == pytest.approx(1.9701, rel=0.004)
    assert one.hi == pytest.approx(9.1535, rel=0.004)


def test_text_functions(spark):
    one = spark.range(1).select(
        text.decimal_comma(F.lit("0,11")).alias("a"),
        text.decimal_comma(F.lit("x")).alias("b"),
        text.spaced_integer(F.lit("8 032 377")).alias("c"),
        text.any_date(F.lit("23.09.2020")).alias("d"),
        text.any_date(F.lit("2021-09-23")).alias("e"),
        text.any_date(F.lit("nothing")).alias("f"),
        text.compact_date(F.lit(20200605)).alias("g"),
        text.epoch_ms_date(F.lit("1584230400000")).alias("h"),
        text.shorten(F.lit("a rather long  name of an event")).alias("i"),
        text.shorten(F.lit("short")).alias("j"),
    ).first()
    assert (one.a, one.b, one.c) == (0.11, None, 8032377)
    assert (one.d, one.e, one.f) == (datetime.date(2020, 9, 23), datetime.date(2021, 9, 23), None)
    assert (one.g, one.h) == (datetime.date(2020, 6, 5), datetime.date(2020, 3, 15))
    import textwrap

    assert one.i == textwrap.shorten("a rather long  name of an event", width=20, placeholder="...")
    assert one.j == "short"


def test_checks(spark, panel):
    df = panel([("a", "2020-03-01", -1.0), ("a", "2020-03-01", 2.0)], ["new_cases"])
    assert checks.duplicate_keys(df).count() == 1
    assert checks.negative_counts(df).first().new_cases == 1
    with pytest.raises(ValueError, match="new_tests"):
        checks.require_columns(df, ["new_tests"])
    dim = spark.createDataFrame([("b", "B", 1)], "region string, name string, population int")
    with pytest.raises(ValueError, match="'a'"):
        checks.require_known_regions(df, dim)
    lines = spark.createDataFrame([("03.08.2020, 00:00 Uhr",), ("02.08.2020, 00:00 Uhr",)], "mark string")
    with pytest.raises(ValueError, match="publication mark"):
        checks.require_single_snapshot(lines, "mark", "03.08.2020")
    assert clean.negatives_to_null(df).where("new_cases is null").count() == 1


def test_kernel_length_is_checked(spark):
    long = spark.range(2000).select(F.col("id").cast("int").alias("lag"), F.lit(0.1).alias("p"))
    with pytest.raises(ValueError, match="at most"):
        kernels.kernel_values(long)


def test_survival_table_equals_list(spark):
    g = kernels.generation_time(20)
    table = kernels.survival(kernels.kernel_table(spark, "generation", g)).orderBy("lag").collect()
    np.testing.assert_allclose([r.p_active for r in table], kernels.still_active(g), atol=1e-12)
