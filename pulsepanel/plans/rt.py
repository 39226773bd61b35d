"""From a processed panel to R(t), case curves and their summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsepanel.operators.calendar import model_axis
from pulsepanel.operators.kernels import delay_kernel, drop_censored, generation_time, valid_delays
from pulsepanel.operators.renewal import (
    case_curves,
    delayed_positives,
    gamma_posterior,
    posterior_draws,
    posterior_on_axis,
    renewal_infections,
    with_exposure,
    with_scale_factor,
)
from pulsepanel.operators.smoother import joint_draws, smoothed_on_axis
from pulsepanel.operators.summary import summarize_infections, summarize_r_t


@dataclass(frozen=True)
class RtResult:
    """Tables of one estimation run; all of them are lazy."""

    axis: DataFrame
    estimate: DataFrame
    draws: DataFrame
    paths: DataFrame
    curves: DataFrame
    per_group: int

    def r_t_summary(self, hdi_prob=0.9) -> DataFrame:
        return summarize_r_t(self.draws, hdi_prob, per_group=self.per_group)

    def infections_summary(self, region_dim: DataFrame, hdi_prob=0.9) -> DataFrame:
        daily = self.curves.select("region", "date", F.col("new_cases").alias("infections"))
        return summarize_infections(daily, region_dim, hdi_prob, per_group=self.per_group)


def delay_kernel_from_line_list(line_list: DataFrame, weight: str | None = None) -> DataFrame:
    """Delay kernel (lag, p) from a patient line list; ``weight`` counts identical patients."""
    return delay_kernel(drop_censored(valid_delays(line_list, weight)))


def estimate(
    panel: DataFrame,
    p_delay: Sequence[float],
    *,
    tests: str = "predicted_new_tests",
    p_generation_time: Sequence[float] | None = None,
    buffer_days: int = 10,
    chains: int = 4,
    draws: int = 200,
    window_days: int = 7,
    smoothed: bool = False,
) -> RtResult:
    """Estimate R(t) for every region of a processed panel.

    By windows of ``window_days``, or (``smoothed``) under the random walk of log R: then every day has an
    estimate and the days of a draw belong together.
    """
    kernel = list(p_generation_time or generation_time())
    observed = panel.select("region", "date", "new_cases", F.col(tests).alias("daily_tests"))
    axis = with_exposure(model_axis(observed, buffer_days))
    carry = ["new_cases", "exposure", "exposure_profile"]
    if smoothed:
        found = smoothed_on_axis(axis, kernel)
        estimated = found.select("region", "date", "log_r", "log_r_sd", F.exp("log_r").alias("r_t_median"))
        drawn = joint_draws(found, chains=chains, draws=draws, carry=carry)
        return _result(axis, estimated, drawn, drawn.drop(*carry), kernel, p_delay, chains * draws)
    posterior = gamma_posterior(axis, kernel, window_days=window_days)
    estimated = posterior.where("shape is not null").select(
        "region", "date", "shape", "rate", (F.col("shape") / F.col("rate")).alias("r_t_mean")
    )
    # draws take the day's counts along, so nothing of their size is joined afterwards
    drawn = posterior_draws(
        posterior_on_axis(posterior),
        chains=chains,
        draws=draws,
        carry=carry,
    )
    samples = posterior_draws(estimated, chains=chains, draws=draws)
    return _result(axis, estimated, drawn, samples, kernel, p_delay, chains * draws)


def _result(
    axis: DataFrame,
    estimated: DataFrame,
    drawn: DataFrame,
    samples: DataFrame,
    kernel: Sequence[float],
    p_delay: Sequence[float],
    per_group: int,
) -> RtResult:
    paths = delayed_positives(renewal_infections(drawn, kernel), p_delay)
    scaled = with_scale_factor(paths, p_delay)
    return RtResult(
        axis=axis,
        estimate=estimated,
        draws=samples,
        paths=scaled,
        curves=case_curves(scaled, None, kernel),
        per_group=per_group,
    )


def expected_positives(result: RtResult) -> DataFrame:
    """Expected positive tests of every path, on days with test counts."""
    return result.paths.where("exposure is not null").withColumn(
        "positive", F.col("exposure") * F.col("test_adjusted_positive")
    )
