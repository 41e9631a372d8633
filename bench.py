"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion (``write.format("noop")``, so the whole
result is computed without collecting it to the driver) once to warm up and
then timed as the median of $BENCH_REPEAT runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitalframe.plans.catalog import QUERIES  # noqa: E402
from vitalframe.session import build_session  # noqa: E402

HEADLINE = [
    "critical_phase_prevalence", "critical_phases_hourly", "label_grid", "resample_5min", "drop_jumps",
    "clip_outliers", "quantile_by", "normalise_z", "normalise_yeojohnson", "feature_grid", "training_table",
    "expand_infusions", "expand_bolus", "locf_chunked", "to_sequences", "auc", "youden_threshold",
    "masked_loss", "number_patients", "impute_by_group", "prepare_training_table",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                          conf={"spark.driver.memory": "16g"})
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    times = {}
    for name in only or HEADLINE:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_median_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
