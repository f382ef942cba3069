"""Time the headline queries; prints one JSON line.

Each query runs to completion with every output column computed (the noop
sink), on frames of its own and including the time to build its plan, after
one query that warms the JVM up.
"""

from __future__ import annotations

import json
import os
import time

from shelfline.session import local_session
from workload import load_all
from workload.registry import ENTRIES
from workload.star import Star

HEADLINE = (
    "build_fact_sales",
    "q_rollup_revenue",
    "q_period_end_inventory",
    "q_non_additive_ratios",
    "q_hierarchy_grouping_sets",
    "q_net_after_returns",
    "q_mv_atomic",
    "q_mv_composed",
    "q_mv_trailing_by_store",
    "q_mv_day_over_day",
    "q_mv_cumulative",
    "q_mv_ytd",
    "q_mv_join_slice",
    "q_mv_revenue_tier",
    "q_mv_kpi_board",
    "q_sl_counts_by_category",
    "q_sl_ytd_by_month",
    "q_sl_dod_by_day",
    "q_sl_country_quarter",
    "build_fact_web_sessions",
    "dq_foreign_keys",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    load_all()
    spark = local_session("bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")

    def run(name: str) -> float:
        start = time.perf_counter()
        ENTRIES[name].run(Star(spark, folder)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("q_mv_atomic")
    times = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
