"""Renewal model on tables: infections, delayed positives, likelihood, R(t), case curves.

Draws are rows ``(region, chain, draw, date, ...)``; one path has one row per day, so windows
over a path are bounded by the calendar and paths spread over the cluster.
"""

from __future__ import annotations

import math
import statistics
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsepanel.functions import series
from pulsepanel.functions.values import log_gamma
from pulsepanel.operators.calendar import carry_both_ways, interpolate
from pulsepanel.operators.kernels import convolve, still_active

PATH = ("region", "chain", "draw")

# How quickly R may react, the exposure floor and ceiling, the prior of alpha.
STEP_SCALE = 0.035
EXPOSURE_FLOOR = 0.1
EXPOSURE_CEILING = 1e9
ALPHA = 6.0
ALPHA_SD = 1.0


def r_t_path(steps: DataFrame, column: str = "step", keys: Sequence[str] = PATH) -> DataFrame:
    """R(t) as the exponential of a running sum of log steps."""
    w = series.so_far(series.forward(keys))
    return steps.withColumn("r_t", F.exp(F.sum(column).over(w)))


def _renewal_paths(kernel: Sequence[float]):
    g = np.asarray(kernel, dtype="float64")

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for paths, seeds in batches:
            lengths = np.array([len(p) for p in paths], dtype="int64")
            days = int(lengths.max()) if len(lengths) else 0
            r = np.zeros((len(paths), days))
            for i, p in enumerate(paths):
                r[i, : len(p)] = p
            y = np.zeros_like(r)
            infectious = np.zeros_like(r)  # r_s * y_s
            for t in range(days):
                if t == 0:
                    y[:, 0] = seeds.to_numpy()
                else:
                    lags = min(t, len(g) - 1)
                    past = infectious[:, t - lags : t]
                    y[:, t] = past @ g[lags:0:-1]
                infectious[:, t] = r[:, t] * y[:, t]
            yield pd.Series([y[i, :n].tolist() for i, n in enumerate(lengths)])

    return F.pandas_udf(run, "array<double>")


def renewal_infections(
    paths: DataFrame,
    kernel: Sequence[float],
    *,
    seed: float | str = 0.02,
    keys: Sequence[str] = PATH,
) -> DataFrame:
    """Infections of each R(t) path: y_0 = seed, y_t = sum_s r_s * y_s * g_(t-s).

    A true recurrence, so a path becomes one array row (as long as its calendar). Arrow batches
    of paths are stepped through the days together.
    """
    seed_column = F.col(seed) if isinstance(seed, str) else F.lit(float(seed))
    others = [c for c in paths.columns if c not in (*keys, "date")]
    packed = (
        paths.withColumn("_seed", seed_column.cast("double"))
        .groupBy(*keys)
        .agg(
            F.array_sort(F.collect_list(F.struct("date", "_seed", *others))).alias("_days"),
        )
        .withColumn(
            "_y",
            _renewal_paths(kernel)(F.col("_days.r_t"), F.element_at("_days._seed", 1)),
        )
    )
    unpacked = packed.select(*keys, F.explode(F.arrays_zip("_days", "_y")).alias("_z"))
    return unpacked.select(
        *keys,
        "_z._days.date",
        *[F.col(f"_z._days.{c}").alias(c) for c in others],
        F.col("_z._y").alias("infections"),
    )


def delayed_positives(
    paths: DataFrame, p_delay: Sequence[float], keys: Sequence[str] = PATH
) -> DataFrame:
    """Infections convolved with the testing delay, cut to the days of the path."""
    return convolve(paths, "infections", p_delay, "test_adjusted_positive", keys)


def exposure(tests: Column, window) -> Column:
    """Tests, but never below a tenth of the series' maximum; NULL where tests are unknown."""
    floor = F.max(tests).over(window) * EXPOSURE_FLOOR
    clipped = F.least(F.greatest(tests, floor), F.lit(EXPOSURE_CEILING))
    return F.when(tests.isNotNull(), clipped)


def with_exposure(
    panel: DataFrame, tests: str = "daily_tests", keys: Sequence[str] = ("region",)
) -> DataFrame:
    """Panel with ``exposure`` and its share of the series' maximum, ``exposure_profile``."""
    w = series.whole(keys)
    exposed = panel.withColumn("exposure", exposure(F.col(tests).cast("double"), w))
    # a series that never tests has no profile
    return exposed.withColumn(
        "exposure_profile", F.try_divide("exposure", F.max("exposure").over(w))
    )


def expected_positives(paths: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected positive tests of every path, on days with test counts."""
    exposed = observed.where("exposure is not null").select("region", "date", "exposure")
    return paths.join(exposed, ["region", "date"]).withColumn(
        "positive", F.col("exposure") * F.col("test_adjusted_positive")
    )


def log_likelihood(
    predicted: DataFrame, observed: DataFrame, *, alpha: float | str = ALPHA, keys: Sequence[str] = PATH
) -> DataFrame:
    """Negative-binomial log-likelihood of the observed cases for every path.

    ``alpha`` is a number or a column (see ``with_drawn_alpha``). Only days with case and test counts enter, and only where the expectation is positive.
    """
    a = F.col(alpha) if isinstance(alpha, str) else F.lit(float(alpha))
    cases = observed.where("new_cases is not null").select("region", "date", F.col("new_cases").alias("_y"))
    y, mu = F.col("_y"), F.col("positive")
    term = (
        log_gamma(y + a)
        - log_gamma(a)
        - log_gamma(y + 1)
        + a * F.ln(a / (a + mu))
        + y * F.ln(mu / (a + mu))
    )
    return (
        predicted.join(cases, ["region", "date"])
        .where(mu > 0)
        .groupBy(*keys)
        .agg(F.sum(term).alias("log_likelihood"), F.count("*").alias("n_days"))
    )


def keyed_normal(*parts: Column) -> Column:
    """A normal number that depends on the parts alone: the same on any machine, in any order, at any retry."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"))

    def uniform(begin: int) -> Column:
        return (F.conv(F.substring(digest, begin, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)

    return F.sqrt(-2 * F.ln(uniform(1))) * F.cos(F.lit(2 * math.pi) * uniform(14))


def with_drawn_alpha(paths: DataFrame, seed: int = 0, keys: Sequence[str] = PATH) -> DataFrame:
    """Paths with ``alpha`` drawn from its gamma prior, one for each path, keyed by (seed, "alpha", path)."""
    z = keyed_normal(F.lit(seed), F.lit("alpha"), *[F.col(c) for c in keys])
    shape, rate = (ALPHA / ALPHA_SD) ** 2, ALPHA / ALPHA_SD**2
    return paths.withColumn("alpha", gamma_quantile(F.lit(shape), F.lit(rate), z))


def importance_weights(likelihood: DataFrame, group: Sequence[str] = ("region",)) -> DataFrame:
    """``likelihood`` (see ``log_likelihood``) plus ``weight`` of each path within its group, their sum 1.

    Scaled by the largest likelihood, so that no weight is lost to underflow before the others are known.
    Both sums are grouped in tasks first; a group of any number of paths is never in one task.
    """
    keys = list(group)
    top = likelihood.groupBy(*keys).agg(F.max("log_likelihood").alias("_top"))
    scaled = likelihood.join(top, keys).withColumn("_w", F.exp(F.col("log_likelihood") - F.col("_top"))).drop("_top")
    total = scaled.groupBy(*keys).agg(F.sum("_w").alias("_total"))
    return scaled.join(total, keys).withColumn("weight", F.col("_w") / F.col("_total")).drop("_w", "_total")


def effective_sample_size(weights: DataFrame, group: Sequence[str] = ("region",)) -> DataFrame:
    """Number of equally weighted paths that would say as much: (group, n_paths, effective_paths)."""
    squares = F.sum(F.col("weight") * F.col("weight"))
    return weights.groupBy(*group).agg(
        F.count("*").alias("n_paths"), F.try_divide(F.pow(F.sum("weight"), 2.0), squares).alias("effective_paths")
    )


def infection_pressure(
    axis: DataFrame, kernel: Sequence[float], keys: Sequence[str] = ("region",)
) -> DataFrame:
    """Axis plus ``_adjusted``, cases over the exposure profile, and ``_pressure``, what they infect on a day at R = 1."""
    cases = F.col("new_cases").cast("double")
    df = axis.withColumn("_adjusted", F.try_divide(cases, F.col("exposure_profile")))
    # history for the infection pressure needs every day; unobserved ones are interpolated
    history = interpolate(df.withColumn("_history", F.col("_adjusted")), "_history", keys)
    return convolve(history, "_history", kernel, "_pressure", keys).drop("_history")


def gamma_posterior(
    axis: DataFrame,
    kernel: Sequence[float],
    *,
    window_days: int = 7,
    prior_shape: float = 1.0,
    prior_scale: float = 5.0,
    min_cases: float = 1.0,
    keys: Sequence[str] = ("region",),
) -> DataFrame:
    """Axis (see ``with_exposure``) plus ``shape`` and ``rate`` of R(t), NULL without an estimate.

    All windows are on the series key, so the axis is shuffled once at most.
    """
    history = infection_pressure(axis, kernel, keys)
    trailing = series.forward(keys).rowsBetween(-(window_days - 1), 0)
    usable = F.col("_adjusted").isNotNull() & (F.col("_pressure") > 0)
    summed = history.withColumns(
        {
            "_cases": F.sum(F.when(usable, F.col("_adjusted"))).over(trailing),
            "_force": F.sum(F.when(usable, F.col("_pressure"))).over(trailing),
            "_rows": F.count("*").over(trailing),
        }
    )
    known = (
        (F.col("_rows") == window_days) & (F.col("_cases") >= min_cases) & (F.col("_force") > 0)
    )
    return summed.select(
        *axis.columns,
        F.when(known, F.lit(prior_shape) + F.col("_cases")).alias("shape"),
        F.when(known, F.lit(1.0 / prior_scale) + F.col("_force")).alias("rate"),
    )


def estimate_r_t(
    panel: DataFrame,
    kernel: Sequence[float],
    *,
    tests: str = "daily_tests",
    keys: Sequence[str] = ("region",),
    **options,
) -> DataFrame:
    """Conjugate window estimate of R(t) (Cori et al., Am J Epidemiol 2013).

    Cases are divided by the exposure profile, so that more testing does not look like more
    infections. Over a trailing window, R has the gamma posterior with shape a + sum(I) and rate
    1/b + sum(Lambda); only days with cases and tests count, and only full windows are emitted.
    The panel must be gap-free (see ``model_axis``). Replaces the sampler: the intervals are not
    those of a hierarchical fit. Lambda is too small while the kernel still lacks history.
    ``options`` are those of ``gamma_posterior``.
    """
    axis = with_exposure(panel, tests, keys)
    posterior = gamma_posterior(axis, kernel, keys=keys, **options).where("shape is not null")
    return posterior.select(
        *keys,
        "date",
        "shape",
        "rate",
        (F.col("shape") / F.col("rate")).alias("r_t_mean"),
        (F.sqrt("shape") / F.col("rate")).alias("r_t_sd"),
    )


def gamma_quantile(shape: Column, rate: Column, z: Column) -> Column:
    """Gamma quantile at normal score ``z`` (Wilson and Hilferty), not below zero."""
    nine = 9 * shape
    root = 1 - 1 / nine + z / (3 * F.sqrt(shape))
    return F.greatest(shape * root * root * root / rate, F.lit(0.0))


def normal_scores(n: int) -> list[float]:
    """Normal quantiles at the mid-points of n equal probability slices."""
    normal = statistics.NormalDist()
    return [normal.inv_cdf((k + 0.5) / n) for k in range(n)]


def posterior_draws(
    estimate: DataFrame,
    *,
    chains: int = 4,
    draws: int = 200,
    keys: Sequence[str] = ("region",),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Deterministic draws of R(t): every gamma posterior at evenly spaced probabilities.

    ``carry`` columns of the day go along with each draw, which spares a join later.
    """
    scores = F.array(*[F.lit(z) for z in normal_scores(chains * draws)])
    spread = estimate.select("*", F.posexplode(scores).alias("_k", "_z"))
    return spread.select(
        *keys,
        F.floor(F.col("_k") / draws).cast("int").alias("chain"),
        (F.col("_k") % draws).cast("int").alias("draw"),
        "date",
        gamma_quantile(F.col("shape"), F.col("rate"), F.col("_z")).alias("r_t"),
        *carry,
    )


def posterior_on_axis(posterior: DataFrame, keys: Sequence[str] = ("region",)) -> DataFrame:
    """Posterior for every day of the axis: constant before the first and after the last estimate.

    Series without any estimate are left out.
    """
    carried = carry_both_ways(carry_both_ways(posterior, "shape", keys), "rate", keys)
    return carried.where("shape is not null")


def scale_factor(
    paths: DataFrame,
    observed: DataFrame,
    p_delay: Sequence[float],
    keys: Sequence[str] = PATH,
) -> DataFrame:
    """Factor per path that lifts normalised infections to case numbers.

    Observed positives over inferred test-adjusted positives weighted with the exposure profile,
    on days that have case and test counts, divided by the probability of being observed. It is a
    lower bound: nobody who is never tested is counted.
    """
    days = observed.where("new_cases is not null and exposure is not null").select(
        "region", "date", F.col("new_cases").alias("_cases"), F.col("exposure_profile").alias("_profile")
    )
    sums = paths.join(days, ["region", "date"]).groupBy(*keys).agg(
        F.sum("_cases").alias("_observed"),
        F.sum(F.col("test_adjusted_positive") * F.col("_profile")).alias("_inferred"),
    )
    observe = float(sum(p_delay))
    return sums.select(
        *keys,
        F.try_divide(F.try_divide("_observed", "_inferred"), F.lit(observe)).alias("scale_factor"),
    )


def with_scale_factor(
    paths: DataFrame, p_delay: Sequence[float], keys: Sequence[str] = PATH
) -> DataFrame:
    """``scale_factor`` as a column, for paths that carry ``new_cases`` and ``exposure_profile``.

    Windows on the path instead of a join with the paths themselves.
    """
    w = series.whole(keys)
    both = F.col("new_cases").isNotNull() & F.col("exposure_profile").isNotNull()
    seen = F.sum(F.when(both, F.col("new_cases"))).over(w)
    inferred = F.sum(F.when(both, F.col("test_adjusted_positive") * F.col("exposure_profile"))).over(w)
    observe = float(sum(p_delay))
    return paths.withColumn(
        "scale_factor", F.try_divide(F.try_divide(seen, inferred), F.lit(observe))
    )


def case_curves(
    paths: DataFrame,
    factors: DataFrame | None,
    generation_kernel: Sequence[float],
    keys: Sequence[str] = PATH,
) -> DataFrame:
    """Daily new, cumulative and active cases of every path.

    ``factors`` is a table of scale factors, or None for paths that have the column already.
    """
    joined = paths if factors is None else paths.join(factors, list(keys))
    scaled = joined.withColumn("new_cases", F.col("infections") * F.col("scale_factor"))
    w = series.so_far(series.forward(keys))
    totals = scaled.withColumn("total_cases", F.sum("new_cases").over(w))
    active = convolve(totals, "new_cases", still_active(generation_kernel), "active_cases", keys)
    return active.select(*keys, "date", "new_cases", "total_cases", "active_cases")


def display_range(df: DataFrame, observed: DataFrame, *, first_day: int = 3, until_cases: bool = True) -> DataFrame:
    """Rows from the fourth model day to the last day with cases (or to the end)."""
    bounds = observed.groupBy("region").agg(
        F.date_add(F.min("date"), first_day).alias("_from"),
        F.max(F.when(F.col("new_cases").isNotNull(), F.col("date"))).alias("_last_cases"),
        F.max("date").alias("_last"),
    )
    end = F.col("_last_cases") if until_cases else F.col("_last")
    return (
        df.join(bounds, "region")
        .where((F.col("date") >= F.col("_from")) & (F.col("date") <= end))
        .select(df.columns)
    )


def display_curves(
    paths: DataFrame,
    factors: DataFrame,
    observed: DataFrame,
    *,
    positive: str | None = None,
    keys: Sequence[str] = PATH,
) -> DataFrame:
    """Labelled curves for a detail view: (keys, date, label, value).

    Infections up to the last case day and test-adjusted positives to the end, both scaled;
    ``positive`` adds the expected positives on all days ("all") or from the last case day on
    ("unobserved").
    """
    bounds = observed.groupBy("region").agg(
        F.date_add(F.min("date"), 3).alias("_from"),
        F.max(F.when(F.col("new_cases").isNotNull(), F.col("date"))).alias("_last_cases"),
    )
    factor, date = F.col("scale_factor"), F.col("date")
    shown = [
        F.struct(
            F.lit("infections").alias("label"),
            F.when(date <= F.col("_last_cases"), F.col("infections") * factor).alias("value"),
        ),
        F.struct(
            F.lit("test_adjusted_positive").alias("label"),
            (F.col("test_adjusted_positive") * factor).alias("value"),
        ),
    ]
    if positive is not None:
        wanted = F.lit(True) if positive == "all" else date >= F.col("_last_cases")
        shown.append(
            F.struct(F.lit("positive").alias("label"), F.when(wanted, F.col("positive")).alias("value"))
        )
    return (
        paths.join(factors, list(keys))
        .join(bounds, "region")
        .where(date >= F.col("_from"))
        .select(*keys, "date", F.explode(F.array(*shown)).alias("_s"))
        .select(*keys, "date", "_s.label", "_s.value")
        .where("value is not null")
    )
