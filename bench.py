"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores.
Each query's whole result is computed and discarded; the layers the queries read
are built first and reported under "layers".
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlake.plans import frames, queries  # noqa: E402
from orderlake.session import build_session  # noqa: E402

HEADLINE = [
    "enr_orders",
    "enr_customers",
    "enr_items",
    "enr_products",
    "join_fact",
    "join_fact_raw",
    "agg_overall",
    "agg_cust_metrics",
    "agg_monthly",
    "agg_segment",
    "agg_status",
    "agg_category",
    "agg_rfm",
    "agg_gold",
    "agg_dash_kpi",
    "agg_live",
    "agg_5min",
    "agg_hist",
    "agg_box",
    "agg_item_events_category",
    "agg_alert_kpi",
    "agg_reasons",
    "win_lag_month",
    "win_lag_order",
    "win_dedup_flag",
    "win_dedup_drop",
    "win_orders_1h",
    "topk_customers",
    "topk_fraud",
    "anti_refint",
    "dq_nulls",
    "dq_iqr",
    "dq_iqr_approx",
    "dq_report",
    "dq_summary",
    "dq_quarantine",
    "frd_batch",
    "frd_stream",
    "frd_alert",
    "snk_silver",
    "snk_fact",
    "str_enrich",
    "str_window",
    "str_velocity",
    "log_topic_stats",
    "log_rate",
    "log_lag",
    "log_latest",
    "log_flatten",
    "log_retain",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="orderlake-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    def timed(work) -> float:
        start = time.perf_counter()
        work()
        return round(time.perf_counter() - start, 3)

    def layers() -> None:
        for build in (
            frames.clean_orders,
            frames.clean_customers,
            frames.clean_items,
            frames.clean_products,
            frames.fact,
            frames.customer_months,
            frames.potential_fraud,
        ):
            build(spark, folder)

    timings = {"layers": timed(layers)}
    registered = queries.registered()
    for name in HEADLINE:
        timings[name] = timed(
            lambda: registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": folder,
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
