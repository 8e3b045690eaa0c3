"""Bench: run the headline queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full with a ``noop`` write (every column of every
row is computed; nothing is collected to the driver). The reported value is
the sum of per-query wall times.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "mail_incremental", "high_water_mark", "path_collisions", "folder_closure",
    "event_days", "day_rollup", "day_people", "changed_days",
    "meeting_transcripts", "cue_table", "html_text", "slug_ascii", "utf8_cut", "time_formats",
    "mail_documents", "digest_mail", "stream_incremental", "stream_dedup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from comms_lake.plans import catalog
    from comms_lake.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="comms_lake_bench")
    queries = catalog.queries()
    wanted = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q in queries]
    # warm-up: JIT and file listing on a cheap query
    queries["tie_groups"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in wanted:
        t0 = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
