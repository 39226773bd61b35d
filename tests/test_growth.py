"""The joint forecast against dense solves, planted series, and the order in which effects are found."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsepanel.operators import growth
from pulsepanel.operators.forecast import ForecastOptions, fit_components, predict_testcounts
from pulsepanel.operators.growth import Growth

START = 18_500  # days since the epoch, a Monday is (day + 3) % 7 == 0
N = 300
DAY = np.arange(N) + float(START)
T = np.arange(N) / (N - 1)
WEEKDAY = (DAY.astype(int) + 3) % 7
NONE = np.full(N, -1.0)


def fit(y, options, holiday=NONE, day=DAY):
    return growth.fit_arrays([day], [y], [holiday], options)[0]


def test_changing_slope_equals_a_dense_solve():
    r = np.random.default_rng(1)
    y = 50 + 30 * T + r.normal(size=N)
    y[r.random(N) < 0.3] = np.nan
    options = Growth(effects=False, knot_days=20)
    at = np.flatnonzero(~np.isnan(y))
    t = (DAY - DAY[at[0]]) / (at[-1] - at[0])
    places = growth.knots(int(at[-1] - at[0]), options)
    h = np.column_stack([np.ones(N), t, *(np.maximum(t - c, 0) for c in places)])
    weights = options.noise**2 / np.array([25, 25] + [options.change_scale**2] * len(places))
    scale = np.nanmax(y)
    theta = np.linalg.solve(h[at].T @ h[at] + np.diag(weights), h[at].T @ y[at] / scale)
    trend, weekly, special = fit(y, options)
    assert len(places) == 15
    assert trend == pytest.approx(h @ theta * scale, abs=1e-8)
    assert (weekly == 1).all() and (special == 1).all()


def test_trend_has_no_jumps_and_follows_a_change():
    y = 100 + 200 * T - np.maximum(T - 0.4, 0) * 700
    for shrink in ("normal", "laplace"):
        trend, *_ = fit(y, Growth(effects=False, knot_days=15, noise=0.01, change_scale=0.5, shrink=shrink))
        assert np.abs(trend - y).max() < 2
        assert np.abs(np.diff(trend)).max() < 3


def test_laplace_prior_leaves_fewer_changes():
    y = 100 + 200 * T - np.maximum(T - 0.4, 0) * 700 + np.random.default_rng(2).normal(size=N)
    bends = []
    for shrink in ("normal", "laplace"):
        trend, *_ = fit(y, Growth(effects=False, knot_days=15, noise=0.02, shrink=shrink))
        bends.append(int((np.abs(np.diff(trend, 2)) > 0.05).sum()))
    assert bends[1] < bends[0]


@pytest.mark.parametrize("kind", ["linear", "logistic"])
@pytest.mark.parametrize("shrink", ["normal", "laplace"])
def test_no_small_move_lowers_the_objective(kind, shrink):
    r = np.random.default_rng(3)
    holiday = np.where(r.random(N) < 0.1, r.integers(0, 3, N), -1.0)
    y = (20 + 60 * T**2) * (1 + 0.3 * (WEEKDAY < 5) - 0.4 * (holiday == 1)) + r.normal(size=N)
    options = Growth(kind, knot_days=60, shrink=shrink, iterations=400)
    h = growth._design((DAY - DAY[0])[None], np.array([N - 1]), growth.knots(N - 1, options))
    z = growth.effect_columns(WEEKDAY, holiday, options)[None]
    theta = growth.solve(h, z, y[None] / y.max(), np.ones((1, N)), options)[0]

    def objective(v):
        g = growth._trend(h[0] @ v[: h.shape[2]], options)[0]
        errors = y / y.max() - g * (1 + z[0] @ v[h.shape[2] :])
        change = v[2 : h.shape[2]]
        prior = (v[:2] ** 2).sum() / 25 + (v[h.shape[2] :] ** 2).sum() / 100
        if shrink == "normal":
            prior += (change**2).sum() / options.change_scale**2
        else:
            prior += 2 * np.sqrt(change**2 + growth.LAPLACE_EDGE**2).sum() / options.change_scale
        return (errors**2).sum() + options.noise**2 * prior

    best = objective(theta)
    for i in range(len(theta)):
        for move in (1e-4, -1e-4):
            assert objective(theta + move * np.eye(len(theta))[i]) >= best - 1e-12


def test_saturating_series_is_found_and_stays_below_its_cap():
    y = 1000 / (1 + np.exp(3 - 8 * T))
    trend, *_ = fit(y, Growth("logistic", knot_days=None, effects=False, cap_factor=1000 / y.max(), noise=0.001))
    assert np.abs(trend - y).max() < 0.1
    # far ahead, and with reports that stop early
    ahead = np.arange(2000) + float(START)
    early = np.append(y[:200], np.full(1800, np.nan))
    trend, *_ = fit(early, Growth("logistic", effects=False), np.full(2000, -1.0), ahead)
    assert (trend > 0).all() and trend.max() <= np.nanmax(early)
    assert (np.diff(trend) >= 0).all()


def unbalanced():
    """A calendar whose holidays fall on Mondays, in a falling series."""
    r = np.random.default_rng(4)
    effect = np.array([1.3, 1.1, 1.0, 1.0, 0.9, 0.9, 0.8])
    holiday = np.where((WEEKDAY == 0) & (r.random(N) < 0.6), 0.0, -1.0)
    base = 400 - 250 * T
    return base, effect, holiday, base * (effect[WEEKDAY] - 0.7 * (holiday == 0))


def test_effects_of_an_unbalanced_calendar():
    base, effect, holiday, y = unbalanced()
    trend, weekly, special = fit(y, Growth(noise=0.005, knot_days=None), holiday)
    assert trend == pytest.approx(base, rel=1e-3)
    assert weekly == pytest.approx(effect[WEEKDAY], abs=2e-3)
    both = (weekly * special)[holiday == 0]
    assert both == pytest.approx([effect[0] - 0.7] * len(both), abs=3e-3)


def test_effects_one_after_the_other_are_biased(spark):
    base, effect, holiday, y = unbalanced()
    day0 = datetime.date(1970, 1, 1)
    rows = [
        ("A", day0 + datetime.timedelta(int(d)), float(v), "holiday" if h == 0 else None)
        for d, v, h in zip(DAY, y, holiday)
    ]
    panel = spark.createDataFrame(rows, "region string, date date, new_tests double, holiday string")
    errors = []
    for model in (None, Growth(noise=0.005, knot_days=None)):
        fitted = fit_components(panel, ForecastOptions(ignore_before=None, growth=model))
        found = fitted.where("dayofweek(date) = 2 and holiday is null").agg(F.avg("weekly")).first()[0]
        errors.append(abs(found - effect[0]))
    assert errors[1] < 0.005 < 0.1 < errors[0]


def test_series_do_not_depend_on_their_company(monkeypatch):
    r = np.random.default_rng(5)
    series = []
    for n in (40, 41, 300, 3, 1, 90, 40):
        y = 10 + r.random(n) * 5
        y[r.random(n) < 0.2] = np.nan
        series.append((DAY[:n], y, np.full(n, -1.0)))
    series.append((DAY[:5], np.full(5, np.nan), NONE[:5]))
    series.append((DAY[:30], np.zeros(30), NONE[:30]))
    options = Growth()
    alone = [growth.fit_arrays(*([v] for v in s), options)[0] for s in series]
    for values in (1 << 22, 500, 1):
        monkeypatch.setattr(growth, "CHUNK_VALUES", values)
        together = growth.fit_arrays(*(list(v) for v in zip(*series)), options)
        for one, other, (day, *_) in zip(alone, together, series):
            assert (one is None) == (other is None)
            for a, b in zip(one or (), other or ()):
                assert len(a) == len(day) and a == pytest.approx(b, abs=1e-9) and np.isfinite(a).all()
    assert alone[-2] is None and (alone[-1][0] == 0).all()


def test_forecast_of_a_panel(spark, panel):
    rows = [("A", f"2021-01-{d:02}", 10.0 + d if d % 4 else None, 1.0) for d in range(1, 31)]
    rows += [("B", f"2021-01-{d:02}", 5.0, None) for d in range(1, 6)]
    table = panel(rows, ["new_tests", "new_cases"]).withColumn("tags", F.create_map(F.lit("k"), F.col("region")))
    options = ForecastOptions(ignore_before="2021-01-03", growth=Growth("logistic"))
    got = predict_testcounts(table, options)
    assert got.columns == ["region", "date", "new_tests", "new_cases", "tags", "predicted_new_tests"]
    found = {(r.region, r.date.day): r.predicted_new_tests for r in got.collect()}
    assert len(found) == 35 and all(found["B", d] is None for d in range(1, 6))
    assert found["A", 5] == 15.0 and 18 < found["A", 12] < 26
    # one exchange brings a region together; packing its days needs no second one
    plan = fit_components(table, options)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_unknown_options_are_refused():
    for wrong in ({"kind": "flat"}, {"shrink": "none"}):
        with pytest.raises(ValueError):
            Growth(**wrong)
