"""Time the headline queries; prints one JSON line.

Each query runs to a sink that takes every row and keeps none, so nothing is
collected. A first short query warms the JVM up and is not counted.
"""

from __future__ import annotations

import json
import os
import time

from txnflow.plans.queries import QUERIES
from txnflow.plans.sales import table
from txnflow.session import build_session, drop_staged

HEADLINE = (
    "category_revenue", "clean_lines", "reject_reasons", "json_round_trip", "raw_csv_scan",
    "batch_assign", "batches_cumulative", "fold_thirds", "window_minutes", "union_distinct_lines",
    "high_value_lines", "score_amount_v3", "score_category_v3", "score_high_value_v3",
    "compare_amounts_long", "metrics_regression", "metrics_multiclass", "metrics_auc",
    "train_linear", "train_forest", "train_logistic", "model_score", "stream_clean", "stream_batches",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = build_session(
        "txnflow-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = table(spark, sf_dir, "lineitem").count()
    QUERIES["category_revenue"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    drop_staged(spark)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": {name: round(rows / s) for name, s in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
