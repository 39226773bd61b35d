"""Delay and generation-time kernels, and convolution of daily series with them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.functions import series

# Serial interval of the published log-normal (days), and the delay settings.
SERIAL_INTERVAL_MEAN = 4.7
SERIAL_INTERVAL_SD = 2.9
MAX_DELAY = 60
INCUBATION_DAYS = 5
CENSORED_DAYS = 14

# A kernel travels as a literal; more lags than this is a mistake, not a kernel.
MAX_KERNEL_LENGTH = 1000


def generation_time(n_days: int = 20) -> list[float]:
    """Probability of a secondary infection by days since the primary one."""
    variance = math.log(1 + (SERIAL_INTERVAL_SD / SERIAL_INTERVAL_MEAN) ** 2)
    location = math.log(SERIAL_INTERVAL_MEAN) - variance / 2

    def cdf(day: int) -> float:
        if day <= 0:
            return 0.0
        return 0.5 * (1 + math.erf((math.log(day) - location) / math.sqrt(2 * variance)))

    mass = [0.0] + [cdf(d) - cdf(d - 1) for d in range(1, n_days)]
    return [m / math.fsum(mass) for m in mass]


def still_active(kernel: Sequence[float]) -> list[float]:
    """Probability of still being infectious by days since infection: 1 - cumulative sum."""
    return [1 - math.fsum(kernel[: i + 1]) for i in range(len(kernel))]


def kernel_table(spark: SparkSession, name: str, kernel: Sequence[float]) -> DataFrame:
    """Kernel as rows (name, lag, p)."""
    rows = [(name, lag, float(p)) for lag, p in enumerate(kernel)]
    return spark.createDataFrame(rows, "name string, lag int, p double")


def survival(kernel: DataFrame, keys: Sequence[str] = ("name",)) -> DataFrame:
    """Kernel table with ``p_active`` = 1 - running sum of p over the lags."""
    w = series.so_far(series.forward(keys, "lag"))
    return kernel.withColumn("p_active", 1 - F.sum("p").over(w))


def kernel_values(kernel: DataFrame) -> list[float]:
    """Kernel table -> literal list; its length is checked, so the driver sees a few numbers."""
    rows = kernel.select("lag", "p").limit(MAX_KERNEL_LENGTH + 1).collect()
    if len(rows) > MAX_KERNEL_LENGTH:
        raise ValueError(f"A kernel may have at most {MAX_KERNEL_LENGTH} lags.")
    by_lag = {r.lag: r.p for r in rows}
    return [by_lag.get(lag, 0.0) for lag in range(max(by_lag, default=-1) + 1)]


def valid_delays(line_list: DataFrame, weight: str | None = None) -> DataFrame:
    """Onset-to-confirmation delays of plausible patients: (onset, delay, n).

    Input dates are ``dd.MM.yyyy`` text. Patients are counted per pair of dates at once, so
    whatever follows works on at most days x delays rows. The dates come back as aggregates:
    that keeps later filters above the shuffle, and every use of the counts shares it.
    """
    # Two literal date strings of the line list that are known to be wrong.
    repairs = {"01.31.2020": "31.01.2020", "31.04.2020": "01.05.2020"}

    def parsed(c: str):
        text = F.col(c)
        repaired = text
        for wrong, right in repairs.items():
            repaired = F.when(text == wrong, F.lit(right)).otherwise(repaired)
        return F.try_to_date(repaired, "dd.MM.yyyy").alias(c)

    # NULL texts and countries fail these comparisons as well
    usable = (
        (F.col("country") != "Mexico") & (F.length("onset") == 10) & (F.length("confirmed") == 10)
    )
    patients = F.count("*") if weight is None else F.sum(weight)
    carried = [] if weight is None else [weight]
    pairs = (
        line_list.where(usable)
        .select(parsed("onset"), parsed("confirmed"), *carried)
        .groupBy("onset", "confirmed")
        .agg(
            patients.cast("bigint").alias("n"),
            F.max("onset").alias("_onset"),
            F.max("confirmed").alias("_confirmed"),
        )
    )
    return pairs.where(F.col("_confirmed") > F.col("_onset")).select(
        F.col("_onset").alias("onset"),
        F.datediff("_confirmed", "_onset").alias("delay"),
        "n",
    )


def drop_censored(delays: DataFrame, days: int = CENSORED_DAYS) -> DataFrame:
    """Without the onsets of the last ``days``, whose confirmations may be outstanding."""
    # the whole row is compared so that this lookup reads the same shuffle as the rows below
    newest = delays.agg(F.max(F.struct("onset", "delay", "n")).alias("m")).select("m.onset").scalar()
    return delays.where(F.col("onset") < F.date_sub(newest, days))


def delay_kernel(
    delays: DataFrame, *, max_delay: int = MAX_DELAY, incubation_days: int = INCUBATION_DAYS
) -> DataFrame:
    """Normalised, zero-filled delay histogram shifted by the incubation time: (lag, p)."""
    counted = delays.where(F.col("delay") <= max_delay).groupBy("delay").agg(F.sum("n").alias("n"))
    # at most max_delay entries: one map holds the histogram
    packed = counted.agg(
        F.map_from_entries(F.collect_list(F.struct("delay", "n"))).alias("hist"),
        F.max("delay").alias("longest"),
        F.sum("n").cast("double").alias("total"),
    ).where("total > 0")
    lag = F.posexplode(F.sequence(F.lit(0), F.col("longest") + incubation_days)).alias("pos", "lag")
    mass = F.coalesce(F.try_element_at(F.col("hist"), F.col("lag") - incubation_days), F.lit(0))
    return packed.select("hist", "total", lag).select(
        "lag", (mass / F.col("total")).alias("p")
    )


def convolve(
    panel: DataFrame,
    column: str,
    kernel: Sequence[float],
    target: str,
    keys: Sequence[str] = ("region",),
) -> DataFrame:
    """Causal convolution on a gap-free daily series, cut to its length; NULL counts as 0.

    Written as weighted lags over the series window: one shuffle on the keys (none when the
    series is already partitioned by them) instead of one row per day and lag.
    """
    if len(kernel) > MAX_KERNEL_LENGTH:
        raise ValueError(f"A kernel may have at most {MAX_KERNEL_LENGTH} lags.")
    w = series.forward(keys)
    zero = F.lit(0.0)
    source = panel.withColumn("_x", F.coalesce(F.col(column).cast("double"), zero))
    terms = [
        (F.col("_x") if lag == 0 else F.coalesce(F.lag("_x", lag).over(w), zero)) * F.lit(float(p))
        for lag, p in enumerate(kernel)
        if p != 0.0
    ]
    total = zero
    for term in terms:
        total = total + term
    return source.withColumn(target, total).drop("_x")
