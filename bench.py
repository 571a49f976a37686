"""Time the star load, the 54 questions, and some measures, cleaning and checks; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. ``load_star`` is the time
to derive and store the star tables; every query then runs on the stored tables into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwise.plans.catalog import all_queries  # noqa: E402
from shelfwise.plans.questions import QUESTIONS  # noqa: E402
from shelfwise.session import build_session  # noqa: E402
from shelfwise.sources.derived import derived  # noqa: E402


# Measures, cleaning and checks timed beside the questions.
BESIDE = ("m_turnover", "m_stockout_sku_count", "m_dead_stock_value", "m_revenue_yoy_pct", "m_revenue_rank_by_sku_year", "m_est_lost_sales",
          "clean_sales", "dq_report", "dq_ref")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "shelfwise-bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("load_star", derived(spark, sf_dir)[1].load)
    queries = all_queries()
    for name in [*QUESTIONS, *BESIDE]:
        timed(name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "retail inventory star load, 54 business questions, measures, cleaning and checks, total seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
