"""Benchmark: headline queries, one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_RUNS (default 3) set the data, the cores and the warm runs per query.
Each query runs once unmeasured; the median of the measured runs is reported.
Results go to the no-op sink, so all rows and columns are computed but nothing
is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from goldleaf.plans.queries import REGISTRY
from goldleaf.session import local_session, remove_run_dir

HEADLINE = [
    "silver_bookings",
    "gold_revenue_by_destination",
    "gold_monthly_revenue",
    "gold_payment_methods",
    "destination_price_stats",
    "travel_layer_counts",
    "top_destinations",
    "silver_sales",
    "expectation_counts",
    "gold_daily_revenue",
    "gold_revenue_by_state",
    "gold_vendor_performance",
    "rank_vendors_otif_worst",
    "gold_monthly_cashflow",
    "key_overlap",
    "table_profile",
    "resolve_destination",
    "find_properties",
    "plan_trips",
    "request_slots",
    "plan_texts",
    "chat_replies",
    "chunk_documents",
    "retrieve_chunks",
    "guarded_answers",
    "agent_answers_from_replies",
    "eval_scores",
    "customer_features",
    "spend_tier",
    "train_test_split",
    "spend_tier_model",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="goldleaf-bench")
    seconds: dict[str, float] = {}
    for name in os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split():
        run(REGISTRY[name], spark, sf_dir)
        # a model fit is long and steady enough for one measured run
        times = [run(REGISTRY[name], spark, sf_dir) for _ in range(1 if name == "spend_tier_model" else runs)]
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    remove_run_dir(spark)
    spark.stop()


if __name__ == "__main__":
    main()
