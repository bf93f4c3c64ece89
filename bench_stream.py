"""Drain a stored change log through the streaming job and print one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.01), BENCH_CPUS (default 4), BENCH_LANES (default
8 for each of these) and BENCH_TRIGGER (default "10 seconds"). The figure is records per second of batch time, as
the query reports it for the batches that read the log.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from matchlake.session import build_session
from matchlake.sources import cdc
from matchlake.sources.testdata import bind
from matchlake.streaming.job import append_files, facts_stream, heartbeat, read_files

FILES = 4


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01")
    cpus = os.environ.get("BENCH_CPUS", "4")
    lanes = int(os.environ.get("BENCH_LANES", 8 * int(cpus)))
    trigger = os.environ.get("BENCH_TRIGGER", "10 seconds")
    spark = build_session(
        "matchlake-stream-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="matchlake-stream-bench-")
    log = bind(spark, folder).arrival_log
    log.repartitionByRange(FILES, "arrival_ts").sortWithinPartitions("arrival_ts").write.json(
        f"{work}/log"
    )
    records = spark.read.schema(cdc.LOG_SCHEMA).json(f"{work}/log").count()
    facts = facts_stream(heartbeat(spark, cdc.replay_log(spark, f"{work}/log")), lanes=lanes)
    start = time.perf_counter()
    query = append_files(facts, f"{work}/out", f"{work}/checkpoint", trigger)
    busy: dict[int, tuple[int, float]] = {}
    quiet = 0
    while quiet < 2:
        time.sleep(1)
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
        for p in query.recentProgress:
            busy[p["batchId"]] = (p["numInputRows"], p["durationMs"]["triggerExecution"] / 1000)
        done = sum(n for n, _ in busy.values()) >= records
        sessions = [p["observedMetrics"].get("join") for p in query.recentProgress]
        idle = bool(sessions) and sessions[-1] and not any(sessions[-1].asDict().values())
        quiet = quiet + 1 if done and idle else 0
        if time.perf_counter() - start > 600:
            break
    query.stop()
    reading = [seconds for n, seconds in busy.values() if n > records / 100]
    print(
        json.dumps(
            {
                "metric": "change records drained per second of batch time",
                "value": round(records / sum(reading), 1),
                "unit": "records/sec",
                "records": records,
                "batches": {str(k): v for k, v in sorted(busy.items())},
                "facts": read_files(spark, f"{work}/out").count(),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
