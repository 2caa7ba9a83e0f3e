"""Times the headline queries and prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS] (default 8). Each query runs to
completion into a sink that discards the rows; the time is the better of two runs. Names given as
arguments replace the headline list.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "clean_daily_counts", "transactions_daily_counts", "first_seen_days", "dense_days", "lag_features",
    "rolling_features", "feature_table_current", "feature_table_full", "recent_history", "expanding_mean",
    "merchant_best_row", "merchant_special_accounts", "prediction_row_features", "score_fixed_model", "alerts",
    "alert_chart", "alert_messages", "backtest_errors", "forecast_days", "sampled_training_rows",
    "parquet_roundtrip", "train_tweedie_glm",
]
RUN_ONCE = {"train_tweedie_glm", "train_poisson_pooled", "train_gbt_pooled"}


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder
        .master(f"local[{cpus}]")
        .appName("countcast-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(1 if name in RUN_ONCE else 2):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        times[name] = round(min(runs), 3)
        print(f"{name} {[round(r, 2) for r in runs]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
