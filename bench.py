"""Time the headline queries and print one JSON line.

Every query runs to completion into Spark's ``noop`` sink, so all columns are
computed and nothing is collected. A first run warms the JVM and the file
cache; the reported time is the median of the runs after it.
One stream, attribution and roll-up chained, is timed once, unless ``BENCH_STREAM=0``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clicktrail.plans import registry  # noqa: E402
from clicktrail.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "first_click_attribution",
    "first_click_attribution_1d",
    "checkouts",
    "checkouts_1d",
    "final_clicks",
    "final_clicks_second_join",
    "min_click",
    "enrich_purchases",
    "typed_purchases",
    "source_count",
    "fail_count",
    "category_count",
    "gender_count",
    "revenue",
    "revenue_single_pass",
    "report_sources",
    "report_top_categories",
    "report_gender",
    "retention_revenue",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "clicktrail-bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    named = registry.all_queries()

    def finish(name: str) -> None:
        named[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        finish(name)
        seconds[name] = round(statistics.median(timed(lambda: finish(name)) for _ in range(RUNS)), 3)
    if os.environ.get("BENCH_STREAM", "1") == "1":
        seconds["stream_revenue"] = round(timed(lambda: finish("stream_revenue")), 3)
    print(
        json.dumps(
            {
                "metric": "headline query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
