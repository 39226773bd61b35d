"""Weighted draws, smoothed R(t) and joint draws against numpy; cells of large groups."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsepanel.operators import renewal, smoother, summary
from pulsepanel.operators.calendar import model_axis
from pulsepanel.operators.kernels import generation_time
from pulsepanel.plans import rt

G = generation_time(20)


def dense(cases, expected, alpha=6.0, step=0.035, first=1.0):
    """Mode and covariance of log R by dense Newton steps."""
    n = len(cases)
    diff = np.eye(n)[1:] - np.eye(n)[:-1]
    prior = diff.T @ diff / step**2
    prior[0, 0] += 1 / first**2
    known = ~np.isnan(cases) & (expected > 0)
    x = np.zeros(n)
    for _ in range(400):
        mu = np.where(known, expected, 1) * np.exp(x)
        weight = np.where(known, alpha * mu / (mu + alpha), 0)
        slope = np.where(known, alpha * (np.nan_to_num(cases) - mu) / (mu + alpha), 0) - prior @ x
        x = x + np.clip(np.linalg.solve(prior + np.diag(weight), slope), -1, 1)
    return x, np.linalg.inv(prior + np.diag(weight))


def test_smoother_equals_a_dense_solve():
    r = np.random.default_rng(1)
    lengths = np.array([50, 1, 2, 37])
    cases, expected = np.full((4, 50), np.nan), np.full((4, 50), np.nan)
    for i, n in enumerate(lengths):
        expected[i, :n] = r.uniform(0, 90, n) * (r.random(n) > 0.1)
        cases[i, :n] = np.where(r.random(n) < 0.2, np.nan, r.poisson(np.nan_to_num(expected[i, :n]) * 1.3))
    mode, sd, gain, draw_sd = smoother.smooth(cases, expected, lengths, 6.0, 0.035, 1.0)
    for i, n in enumerate(lengths):
        x, cov = dense(cases[i, :n], expected[i, :n])
        assert mode[i, :n] == pytest.approx(x, abs=1e-9)
        assert sd[i, :n] == pytest.approx(np.sqrt(np.diag(cov)), abs=1e-9)
        conditional = [cov[t, t + 1] / cov[t + 1, t + 1] for t in range(n - 1)] + [0.0]
        assert gain[i, :n] == pytest.approx(conditional, abs=1e-8)
        left = [cov[t, t] - conditional[t] * (cov[t, t + 1] if t + 1 < n else 0) for t in range(n)]
        assert draw_sd[i, :n] == pytest.approx(np.sqrt(left), abs=1e-8)


@pytest.fixture(scope="module")
def observed(spark):
    start = datetime.date(2020, 3, 1)
    rows = []
    for t in range(50):
        day = start + datetime.timedelta(days=t)
        rows.append(("up", day, 40.0 * 1.04**t, 900.0 + 5 * t))
        rows.append(("gap", day, None if 20 <= t < 30 else 60.0, 500.0))
        rows.append(("none", day, 0.0, 100.0))
        rows.append(("untested", day, 5.0, None))
    return spark.createDataFrame(rows, "region string, date date, new_cases double, daily_tests double")


def test_r_t_from_the_first_day_on(observed):
    rows = smoother.smoothed_r_t(model_axis(observed), G).orderBy("region", "date").collect()
    by = {k: [r for r in rows if r.region == k] for k in ("up", "gap", "none", "untested")}
    # ten buffer days come before the first case; a series without cases has none of them cut
    assert [len(v) for v in by.values()] == [60, 60, 60, 60]
    sd = [r.log_r_sd for r in by["up"]]
    assert sd[0] > sd[20] and 1.1 < by["up"][-1].r_t_median < 1.5
    assert all(r.r_t_lower < r.r_t_median < r.r_t_upper for r in rows)
    held = [r.log_r_sd for r in by["gap"]]
    assert held[35] > held[25] and held[35] > held[50]
    assert all(r.log_r == 0 for r in by["untested"])


def test_joint_draws_follow_the_smoother(spark, observed):
    smoothed = smoother.smoothed_r_t(model_axis(observed), G).where("region = 'up'").cache()
    drawn = smoother.joint_draws(smoothed, chains=4, draws=1500).toPandas()
    table = np.log(drawn.pivot(index=["chain", "draw"], columns="date", values="r_t").to_numpy())
    known = smoothed.orderBy("date").toPandas()
    sd, gain = known.log_r_sd.to_numpy(), known.gain.to_numpy()
    assert np.abs(table.mean(axis=0) - known.log_r).max() < 5 * (sd / np.sqrt(len(table))).max()
    assert table.std(axis=0) == pytest.approx(sd, rel=0.06)
    # days next to each other are correlated as in the smoother
    got = [np.corrcoef(table[:, t], table[:, t + 1])[0, 1] for t in range(table.shape[1] - 1)]
    assert got == pytest.approx((gain * np.append(sd[1:], 0) / sd)[:-1], abs=0.03)


def test_draws_are_the_same_at_any_partitioning(spark, observed):
    smoothed = smoother.smoothed_r_t(model_axis(observed), G).cache()
    first = smoother.joint_draws(smoothed, chains=2, draws=3).orderBy("region", "chain", "draw", "date").collect()
    dealt = smoothed.repartition(7, "date")
    again = smoother.joint_draws(dealt, chains=2, draws=3).orderBy("region", "chain", "draw", "date").collect()
    assert first == again
    other = smoother.joint_draws(smoothed, chains=2, draws=3, seed=1).orderBy("region", "chain", "draw", "date").collect()
    assert [r.r_t for r in other] != [r.r_t for r in first]


def test_chunks_of_paths_change_nothing(monkeypatch):
    r = np.random.default_rng(2)
    lengths = r.integers(1, 30, 40)
    for values in (1 << 20, 64, 1):
        parts = list(smoother._chunks(lengths, values))
        assert np.concatenate([np.arange(40)[p] for p in parts]).tolist() == list(range(40))
        assert all(p.stop - p.start == 1 or (p.stop - p.start) * lengths[p].max() <= values for p in parts)
    assert list(smoother._chunks([], 5)) == []


def test_plan_with_the_smoother(observed, spark):
    panel = observed.withColumnRenamed("daily_tests", "predicted_new_tests")
    result = rt.estimate(panel, [0.0, 0.3, 0.7], chains=2, draws=10, smoothed=True)
    rows = result.r_t_summary().collect()
    assert len([r for r in rows if r.region == "up"]) == 60
    last = max((r for r in rows if r.region == "up"), key=lambda r: r.date)
    assert last.r_t > 1.1 and last.r_t_threshold_probability == 1.0
    assert result.estimate.columns == ["region", "date", "log_r", "log_r_sd", "r_t_median"]
    plan = result.curves._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    sums = result.paths.where("region = 'up' and new_cases is not null and exposure is not null").groupBy("chain", "draw").agg(
        F.sum(F.col("test_adjusted_positive") * F.col("exposure_profile") * F.col("scale_factor")).alias("a"), F.sum("new_cases").alias("b")
    )
    assert all(r.a == pytest.approx(r.b) for r in sums.collect())


def test_alpha_draws_follow_the_prior(spark):
    paths = spark.range(8000).select(
        F.lit("A").alias("region"), (F.col("id") % 4).cast("int").alias("chain"), (F.col("id") / 4).cast("int").alias("draw")
    )
    alpha = renewal.with_drawn_alpha(paths).toPandas().alpha
    assert alpha.mean() == pytest.approx(6, abs=0.05) and alpha.std() == pytest.approx(1, abs=0.05)
    # skew of the gamma: 2 / sqrt(36)
    assert ((alpha - alpha.mean()) ** 3).mean() / alpha.std() ** 3 == pytest.approx(1 / 3, abs=0.1)


def test_weights_do_not_underflow(spark):
    rows = [("A", 0, i, -5000.0 - i) for i in range(4)] + [("B", 0, 0, 3.0), ("B", 0, 1, 3.0)]
    table = spark.createDataFrame(rows, "region string, chain int, draw int, log_likelihood double")
    got = {(r.region, r.draw): r.weight for r in renewal.importance_weights(table).collect()}
    raw = np.exp(-np.arange(4.0))
    assert [got["A", i] for i in range(4)] == pytest.approx(raw / raw.sum()) and got["B", 0] == 0.5
    ess = {r.region: r.effective_paths for r in renewal.effective_sample_size(renewal.importance_weights(table)).collect()}
    assert ess["A"] == pytest.approx(raw.sum() ** 2 / (raw**2).sum()) and ess["B"] == pytest.approx(2)


def weighted(values, weights, quantiles, prob):
    """Quantiles and narrowest interval of weighted values, by brute force."""
    v = np.unique(values)
    w = np.array([weights[values == x].sum() for x in v])
    upto, total = w.cumsum(), w.sum()
    at = [v[np.flatnonzero(upto > total * (q - 1e-9))[0]] for q in quantiles]
    best = min(
        (v[j] - v[i], v[i], v[j])
        for i in range(len(v)) if w[i] > 0
        for j in range(i, len(v)) if upto[j] - upto[i] + w[i] > total * (prob - 1e-9)
    )
    return at, best[1:]


@pytest.mark.parametrize("cell_values", [65_536, 20])
@pytest.mark.parametrize("block_rows", [4096, 8])
def test_weighted_summaries_equal_brute_force(spark, monkeypatch, cell_values, block_rows):
    monkeypatch.setattr(summary, "CELL_VALUES", cell_values)
    monkeypatch.setattr(summary, "CELLS", 16)
    monkeypatch.setattr(summary, "BLOCK_ROWS", block_rows)
    r = np.random.default_rng(3)
    groups = {"a": r.normal(size=150).round(1), "b": r.normal(size=90), "c": np.array([2.0]), "d": np.zeros(9)}
    weight = {k: r.choice([0.0, 0.5, 3.0, 10.0], len(v)) + (k in "cd") for k, v in groups.items()}
    rows = [(k, float(x), float(w)) for k, v in groups.items() for x, w in zip(v, weight[k])]
    samples = spark.createDataFrame(rows, "k string, v double, w double")
    got = summary.summarize_median_and_hdi(samples, "v", "m", 0.7, keys=["k"], weight="w").collect()
    bands = summary.quantile_bands(samples, "v", [0.1, 0.9], keys=["k"], weight="w").collect()
    assert len(got) == 4
    for row in got:
        (middle, low, high), ends = weighted(groups[row.k], weight[row.k], [0.5, 0.1, 0.9], 0.7)
        assert (row.m, row.m_lower, row.m_upper) == (middle, *ends)
        assert {b.q: b.value for b in bands if b.k == row.k} == {0.1: low, 0.9: high}


def test_values_close_together_are_split_evenly(spark, monkeypatch):
    """All within a thousandth of a percent of each other, in one group."""
    monkeypatch.setattr(summary, "CELL_VALUES", 1000)
    samples = spark.range(40_000).select(F.lit("a").alias("k"), (1000 + F.col("id") * 1e-7).alias("v"))
    counts = samples.groupBy("k", F.col("v").alias("value")).agg(F.count("*").alias("_n"))
    sizes = [r["count"] for r in summary._with_cells(counts, ["k"]).groupBy("_cell").count().collect()]
    assert len(sizes) == summary.CELLS and max(sizes) < 2 * 40_000 / summary.CELLS
    got = summary.summarize_median_and_hdi(samples, "v", "m", 0.5, keys=["k"]).first()
    v = 1000 + np.arange(40_000) * 1e-7
    assert got.m == pytest.approx(np.median(v), abs=1e-12)
    assert got.m_upper - got.m_lower == pytest.approx(v[20_000] - v[0], abs=1e-12)


@pytest.mark.parametrize("weight", [None, "w"])
def test_bands_of_large_groups_rank_only_the_cells_of_the_quantiles(spark, monkeypatch, weight):
    monkeypatch.setattr(summary, "CELL_VALUES", 500)
    r = np.random.default_rng(8)
    groups = {"even": r.normal(size=20_000), "ties": r.integers(0, 7, 3000) * 1.5, "small": r.normal(size=40)}
    rows = [(k, float(x), float(w)) for k, v in groups.items() for x, w in zip(v, r.choice([0.0, 1.0, 90.0], len(v)))]
    rows += [("no weight", float(x), 0.0) for x in range(900)] + [("null weight", float(x), None) for x in range(900)]
    samples = spark.createDataFrame(rows, "k string, v double, w double")
    qs = [0.0, 0.05, 0.5, 0.95, 1.0]
    bands = {(b.k, b.q): b.value for b in summary.quantile_bands(samples, "v", qs, keys=["k"], weight=weight).collect()}
    assert len(bands) == 5 * len(qs)
    for k, v in groups.items():
        order = np.argsort(v)
        upto = np.array([w for g, _, w in rows if g == k])[order].cumsum()
        expected = np.quantile(v, qs)
        if weight:
            expected = [v[order][np.flatnonzero(upto > upto[-1] * (q - 1e-9))[0]] for q in qs]
        np.testing.assert_allclose([bands[k, q] for q in qs], expected)
    if weight:
        assert all(bands[k, q] is None for k in ("no weight", "null weight") for q in qs)
    ranked = summary.value_ranks(samples.where("k = 'even'"), "v", ["k"], weight, qs)
    assert ranked.count() < 2 * 2 * len(qs) * 20_000 / summary.CELLS
