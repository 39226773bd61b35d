"""Headline queries at one scale factor; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pulsepanel.plans.checked import REGISTRY  # noqa: E402
from pulsepanel.session import local_session  # noqa: E402

HEADLINE = (
    "a02_national_total_orders",
    "a04_redistributed_remainder",
    "a07_delay_distribution",
    "a12_density_interval_any_group_size",
    "a14_quantile_bands",
    "c05_correction_order",
    "f05_segment_trend",
    "f11_process_testcounts",
    "j11_lag_convolution",
    "m02_renewal_infections",
    "m07_r_t_estimate_users",
    "m10_case_curves",
    "p16_as_of_run_date",
    "q_be_process",
    "q_de_process",
    "q_fr_process",
    "q_it_process",
    "q_rt_case_curves",
    "q_rt_summary",
    "q_series_countries",
    "q_us_process",
    "t01_insert_future_users",
    "t07_reconciliation_users",
    "w05_interpolation_by_position",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=max(1, int(cores)))
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
