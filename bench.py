"""Time the headline queries and print one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4), BENCH_RUNS
(default 3) and BENCH_QUERIES (comma-separated names, or "all"). All queries run once
unmeasured, then each BENCH_RUNS times; its figure is the median.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from matchlake.plans.queries import QUERIES
from matchlake.session import build_session

HEADLINE = [
    "match_facts",
    "rank_as_of",
    "rank_as_of_broadcast",
    "arrival_replay",
    "hero_win_rate",
    "map_results",
    "player_leaderboard",
    "rank_as_of_mix",
    "rank_vs_result",
    "player_timeline",
    "decode_participant",
    "rank_points_history",
    "metric_increase",
    "metric_deriv",
    "alert_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "matchlake-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in names:
        run(name)
    seconds = {
        name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in names
    }
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
