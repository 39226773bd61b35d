"""Joint forecast: piecewise linear or saturating trend times weekday and holiday effects, fitted together.

With ``t`` the days since ``fit_from`` over the days up to the last report, and counts as shares of the largest
report, a series is ``g(t) * (1 + weekday + holiday)``:

* the slope of the exponent ``m + k t + sum d_j max(t - c_j, 0)`` may change at knots, one for each
  ``knot_days`` spread over the first ``knot_range`` of the history; so the trend has no jumps
* linear growth is the exponent itself, logistic growth ``cap / (1 + exp(-exponent))`` between 0 and the cap
* weekday effects sum to zero over a week; each holiday class has an effect of its own

All parameters are the maximum of one penalised likelihood: squared errors over ``noise`` squared and normal priors.
``shrink="laplace"`` pulls changes of slope to zero instead, by a prior that is linear beyond ``LAPLACE_EDGE``.

One shuffle brings a series together as one row, as long as its calendar; nothing is joined. Series with the same
number of knots are solved together: Gauss-Newton steps on stacked normal equations in numpy, each step cut back to
what lowers the objective most. Chunks of series bound the memory; a single series has a row for each of its days.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WEEKDAYS = 7
HOLIDAY_CLASSES = ("holiday", "national", "regional")

# Prior standard deviations of offset and slope, and of weekday and holiday effects.
TREND_SCALE = 5.0
EFFECT_SCALE = 10.0

LAPLACE_EDGE = 1e-3
#: Parts of a step that are tried.
STEPS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.0)
#: Objectives this close together are equal.
FLAT = 1e-12
#: Values of a chunk's design matrices at most.
CHUNK_VALUES = 1 << 22


@dataclass(frozen=True)
class Growth:
    """Options of the joint fit.

    kind         "linear" or "logistic"; logistic growth needs a cap: the largest report, times ``cap_factor``
    knot_days    days for each possible change of slope; None: none
    knot_range   knots lie in this first part of the history
    change_scale prior scale of changes of slope
    shrink       "normal" or "laplace" prior of the changes
    noise        standard deviation of a report as a share of the largest one
    effects      fit weekday and holiday effects
    iterations   most Gauss-Newton steps
    """

    kind: str = "linear"
    knot_days: int | None = 30
    knot_range: float = 0.8
    change_scale: float = 0.05
    shrink: str = "normal"
    noise: float = 0.1
    effects: bool = True
    cap_factor: float = 1.0
    iterations: int = 40

    def __post_init__(self):
        if self.kind not in ("linear", "logistic") or self.shrink not in ("normal", "laplace"):
            raise ValueError(f"Unknown growth or prior: {self.kind}, {self.shrink}.")


def knots(span: int, options: Growth) -> np.ndarray:
    """Places of the knots in a history of ``span`` days, as shares of it."""
    if not options.knot_days or span < 1:
        return np.empty(0)
    n = -(-span // options.knot_days)
    return options.knot_range * np.arange(1, n + 1) / n


def effect_columns(weekday: np.ndarray, holiday: np.ndarray, options: Growth) -> np.ndarray:
    """Weekday contrasts (0..6, the last day carries minus the others' sum) and holiday classes."""
    if not options.effects:
        return np.empty((*weekday.shape, 0))
    day = (weekday[..., None] == np.arange(WEEKDAYS - 1)).astype(float) - (weekday == WEEKDAYS - 1)[..., None]
    named = (holiday[..., None] == np.arange(len(HOLIDAY_CLASSES))).astype(float)
    return np.concatenate([day, named], axis=-1)


def _trend(eta: np.ndarray, options: Growth) -> tuple[np.ndarray, np.ndarray]:
    """Trend and its derivative; counts are shares of the largest report."""
    if options.kind == "linear":
        return eta, np.ones_like(eta)
    share = 1 / (1 + np.exp(-np.clip(eta, -500, 500)))
    return options.cap_factor * share, options.cap_factor * share * (1 - share)


def _penalty(theta: np.ndarray, changes: slice, base: np.ndarray, options: Growth) -> tuple[np.ndarray, np.ndarray]:
    """Objective of the prior, and the weights of the squares that touch it at theta."""
    weights = np.broadcast_to(base, theta.shape).copy()
    value = (base * theta**2).sum(axis=1)
    if options.shrink == "laplace":
        change = theta[:, changes]
        root = np.sqrt(change**2 + LAPLACE_EDGE**2)
        lean = options.noise**2 / options.change_scale
        value += (2 * lean * root).sum(axis=1) - (base[changes] * change**2).sum(axis=1)
        weights[:, changes] = lean / root
    return value, weights


def solve(
    hinges: np.ndarray, effects: np.ndarray, y: np.ndarray, known: np.ndarray, options: Growth
) -> np.ndarray:
    """Parameters (series, columns) of the best fit.

    ``hinges`` and ``effects`` are (series, days, columns), ``y`` and ``known`` (series, days): the shares
    of the largest report, and 1 where they count.
    """
    series, _, q = hinges.shape
    p = q + effects.shape[2]
    changes = slice(2, q)
    base = np.full(p, options.noise**2 / EFFECT_SCALE**2)
    base[:2] = options.noise**2 / TREND_SCALE**2
    base[changes] = options.noise**2 / options.change_scale**2
    theta = np.zeros((series, p))

    def errors(theta: np.ndarray) -> tuple[np.ndarray, ...]:
        g, slope = _trend(np.einsum("snq,sq->sn", hinges, theta[:, :q]), options)
        factor = 1 + np.einsum("snp,sp->sn", effects, theta[:, q:])
        return known * (y - g * factor), g, slope, factor

    def objective(theta: np.ndarray) -> np.ndarray:
        return (errors(theta)[0] ** 2).sum(axis=1) + _penalty(theta, changes, base, options)[0]

    for _ in range(options.iterations):
        r, g, slope, factor = errors(theta)
        j = np.concatenate(
            [hinges * (known * slope * factor)[:, :, None], effects * (known * g)[:, :, None]], axis=2
        )
        weights = _penalty(theta, changes, base, options)[1]
        across = j.transpose(0, 2, 1)
        gram = across @ j
        gram[:, np.arange(p), np.arange(p)] += weights
        move = np.linalg.solve(gram, across @ r[..., None] - (weights * theta)[..., None])[..., 0]
        tried = np.stack([objective(theta + step * move) for step in STEPS])
        # the longest of the best, so that rounding doesn't hold up the last steps
        best = (tried <= tried.min(axis=0) * (1 + FLAT)).argmax(axis=0)
        theta = theta + np.array(STEPS)[best][:, None] * move
        if not move.size or np.abs(move).max() < 1e-12:
            break
    return theta


def _design(x: np.ndarray, span: np.ndarray, places: np.ndarray) -> np.ndarray:
    t = x / np.maximum(span, 1)[:, None]
    hinges = np.maximum(t[..., None] - places, 0)
    return np.concatenate([np.ones((*t.shape, 1)), t[..., None], hinges], axis=2)


def fit_arrays(
    days: list[np.ndarray], counts: list[np.ndarray], holidays: list[np.ndarray], options: Growth
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray] | None]:
    """(trend, weekday factor, holiday factor) of each series, None without counts to fit.

    ``days`` are days since the epoch, ``counts`` NaN where they don't count, ``holidays`` the class or -1.
    """
    out: list = [None] * len(days)
    alike: dict[int, list[int]] = {}
    for i, y in enumerate(counts):
        at = np.flatnonzero(~np.isnan(y))
        if len(at):
            span = int(days[i][at[-1]] - days[i][at[0]])
            alike.setdefault(len(knots(span, options)), []).append(i)
    for n_knots, members in alike.items():
        members.sort(key=lambda i: len(days[i]))
        columns = 2 + n_knots + WEEKDAYS - 1 + len(HOLIDAY_CLASSES)
        begin = 0
        while begin < len(members):
            end = begin + 1
            while end < len(members) and (end - begin) * len(days[members[end]]) * columns < CHUNK_VALUES:
                end += 1
            chunk = members[begin:end]
            for i, found in zip(chunk, _fit_alike(*([v[i] for i in chunk] for v in (days, counts, holidays)), options)):
                out[i] = found
            begin = end
    return out


def _fit_alike(days, counts, holidays, options: Growth) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Fits of series with the same number of knots, padded to the longest."""
    longest = max(len(d) for d in days)

    def padded(arrays, fill) -> np.ndarray:
        out = np.full((len(arrays), longest), fill, float)
        for i, a in enumerate(arrays):
            out[i, : len(a)] = a
        return out

    day, y, holiday = padded(days, 0), padded(counts, np.nan), padded(holidays, -1)
    known = ~np.isnan(y)
    first = np.where(known, day, np.inf).min(axis=1)
    span = np.where(known, day, -np.inf).max(axis=1) - first
    largest = np.where(known, np.abs(np.nan_to_num(y)), 0).max(axis=1)
    # a series of zeros has nothing to scale
    scale = np.where(largest > 0, largest, 1.0)
    places = knots(int(span[0]), options)
    hinges = _design(day - first[:, None], span, places)
    # 1970-01-01 was a Thursday; 0 is Monday
    effects = effect_columns((day.astype(int) + 3) % WEEKDAYS, holiday, options)
    theta = solve(hinges, effects, np.nan_to_num(y) / scale[:, None], known.astype(float), options)
    q = hinges.shape[2]
    trend = _trend(np.einsum("snq,sq->sn", hinges, theta[:, :q]), options)[0] * scale[:, None]
    part = effects * theta[:, None, q:]
    weekly = 1 + part[..., : WEEKDAYS - 1].sum(axis=2)
    # factors multiply: the holiday's is what the sum of both effects adds to the weekday's
    both = 1 + part.sum(axis=2)
    special = np.where(holiday >= 0, np.divide(both, weekly, out=np.ones_like(both), where=weekly != 0), 1.0)
    for i, d in enumerate(days):
        yield trend[i, : len(d)], weekly[i, : len(d)], special[i, : len(d)]


def _fitter(options: Growth):
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for days, counts, holidays in batches:
            found = fit_arrays(
                [np.asarray(d, float) for d in days],
                [np.array([np.nan if v is None else v for v in c], float) for c in counts],
                [np.asarray(h, float) for h in holidays],
                options,
            )
            columns = {
                name: [None if f is None else f[k].tolist() for f in found]
                for k, name in enumerate(("trend", "weekly", "holiday_effect"))
            }
            yield pd.DataFrame(columns)

    return F.pandas_udf(run, "trend array<double>, weekly array<double>, holiday_effect array<double>")


def fit_growth(
    panel: DataFrame, training: str, options: Growth, keys: Sequence[str] = ("region",)
) -> DataFrame:
    """Panel plus ``trend, weekly, holiday_effect``, from the counts in column ``training`` (NULL: not fitted).

    ``panel`` has one row per day and a ``holiday`` class if there are holidays. Series without counts get NULLs.
    """
    others = [c for c in panel.columns if c not in (*keys, "date")]
    number = F.lit(-1)
    if "holiday" in panel.columns:
        number = F.when(F.col("holiday").isNull(), F.lit(-1))
        for i, name in enumerate(HOLIDAY_CLASSES):
            number = number.when(F.col("holiday") == name, F.lit(i))
        number = F.coalesce(number, F.lit(-1))
    day = F.struct(
        "date",
        F.unix_date("date").alias("_day"),
        F.col(training).cast("double").alias("_count"),
        number.alias("_holiday"),
        *[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(others)],
    )
    packed = panel.groupBy(*keys).agg(F.array_sort(F.collect_list(day), _by_date).alias("_days"))
    fitted = packed.withColumn("_f", _fitter(options)("_days._day", "_days._count", "_days._holiday"))
    parts = ("trend", "weekly", "holiday_effect")
    # shorter arrays are filled with NULLs: a series without a fit keeps its days
    none = F.array().cast("array<double>")
    zipped = F.arrays_zip("_days", *[F.coalesce(F.col(f"_f.{c}"), none).alias(c) for c in parts])
    rows = fitted.select(*keys, F.explode(zipped).alias("_z"))
    values = {c: F.col(f"_z._days._o{i}") for i, c in enumerate(others)}
    values |= {c: F.col(f"_z.{c}") for c in parts}
    return rows.select(*keys, F.col("_z._days.date").alias("date"), *[v.alias(c) for c, v in values.items()])


def _by_date(left, right):
    # columns of any type go along, so only dates are compared
    return F.when(left["date"] < right["date"], -1).when(left["date"] > right["date"], 1).otherwise(0)
