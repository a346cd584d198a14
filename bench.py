"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed to completion with the ``noop`` sink (full
computation, nothing collected to the driver) and timed from plan
construction to the end of the write.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gapwise.plans import catalog, experiments  # noqa: E402
from gapwise.runtime import get_spark  # noqa: E402

HEADLINE = [
    "session_features",        # flagship: six session features, 15-minute gap
    "session_features_6h",
    "session_table",
    "gap_seconds",
    "avg_prev_session",
    "session_avg_join",        # literal session-table + join formulation
    "label_report",
    "high_session_share",
    "busiest_ip",
    "profile_columns",
    "describe_table",
    "duplicate_count",
    "table_overview",
    "temporal_split",
    "head_by_time",
    "auc_exact",
    "auc_by_group",
    "ordinal_encode",
    "csv_ingest",
]


# Queries that are also timed at the scale factor below, to show how time grows with rows.
GROWTH = ["session_features", "describe_table", "auc_exact", "temporal_split"]


# Experiment 1 with session features, one model per entry (the reference's "Time taken" rows): fit + score train +
# score test + two exact AUCs. These are Spark ML's trees with depths kept from round to round, so that the times can
# be compared; the ``full_`` rows beside them are experiments.reference_specs(1) as registered, without a depth limit.
MODELS = {
    "experiment_dt": experiments.ModelSpec("DecisionTree", "dt", {"maxDepth": 10}),
    "experiment_rf100": experiments.ModelSpec("RandomForest", "rf", {"numTrees": 100, "maxDepth": 8}),
    "experiment_ada50": experiments.ModelSpec("AdaBoost", "ada", {"n_estimators": 50}),
    "experiment_gbt100": experiments.ModelSpec("GradientBoosting", "gbt", {"maxIter": 100, "maxDepth": 3}),
}


def _time_models(spark, sf, timings):
    t0 = time.perf_counter()
    train, test = experiments._split(spark, sf)
    prep = experiments.prepare(train, test, experiments.CAT_COLS, ["ip"], with_sessions=True)
    prep.train.count()
    prep.test.count()
    timings["experiment_prep"] = round(time.perf_counter() - t0, 3)
    print(f"# experiment_prep: {timings['experiment_prep']:.2f}s", file=sys.stderr)
    for name, spec in MODELS.items():
        row = experiments.run([spec], prep)[0]
        timings[name] = round(row["Time taken"], 3)
        print(f"# {name}: {timings[name]:.2f}s (AUC train {row['AUC (Train)']:.4f}, test {row['AUC (Test)']:.4f})",
              file=sys.stderr)
    for row in experiments.staged_rows(prep, [experiments.reference_specs(1)])[0]:
        timings[f"full_{row['Classifier']}"] = round(row["Time taken"], 3)
        print(f"# full {row['Classifier']} {row['Hyperparameters']}: {row['Time taken']:.2f}s (AUC train {row['AUC (Train)']:.4f}, "
              f"test {row['AUC (Test)']:.4f})", file=sys.stderr)
    prep.release()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(master=f"local[{cpus}]", app="gapwise-bench", shuffle_partitions=max(8, 2 * cpus),
                      extra={"spark.driver.memory": "16g"})
    # Warm up the JVM, JIT and code generation on the smallest scale factor (untimed).
    warm = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for name in ("session_features", "describe_table"):
            catalog.QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {timings[name]:.2f}s", file=sys.stderr)
    smaller = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.01")
    if os.path.isdir(smaller) and not sf.rstrip("/").endswith("sf0.01"):
        for name in GROWTH:
            t0 = time.perf_counter()
            catalog.QUERIES[name](spark, smaller).write.format("noop").mode("overwrite").save()
            timings[f"{name}@sf0.01"] = round(time.perf_counter() - t0, 3)
    _time_models(spark, sf, timings)
    m = re.search(r"sf([0-9.]+)", sf)
    out = {"metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
           "queries": timings, "sf": float(m.group(1)) if m else sf, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
