"""Per-query wall time, shuffle bytes and exchange count, from Spark's event
log written to a fresh scratch folder (no UI, no REST).

    python tools/query_profile.py [sf_dir] [cpus] [repeats]
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    reps = int(sys.argv[3]) if len(sys.argv) > 3 else 3
    logdir = tempfile.mkdtemp(prefix="chainlens-eventlog-", dir="/tmp")
    from bench import HEADLINE, _exchanges
    from chainlens.plans.catalog import queries
    from chainlens.session import get_spark

    spark = get_spark(f"local[{cpus}]", cpus * 2, conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir})
    qs = queries()
    sc = spark.sparkContext
    times, exch = {}, {}
    for n in HEADLINE:
        ts = []
        for r in range(reps + 1):
            sc.setJobDescription(f"{n}#{r}")
            df = qs[n](spark, sf)
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            if r:
                ts.append(time.perf_counter() - t0)
        times[n] = statistics.median(ts)
        exch[n] = _exchanges(df)
    spark.stop()
    stage_desc, shuffle = {}, defaultdict(int)
    def lines(path):
        if path.endswith(".zstd"):
            import io

            import zstandard
            with open(path, "rb") as fh:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh))
        else:
            yield from open(path)

    for f in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(f) or "appstatus" in f:
            continue
        for line in lines(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                d = (e.get("Properties") or {}).get("spark.job.description", "")
                for s in e.get("Stage IDs", []):
                    stage_desc[s] = d
            elif ev == "SparkListenerTaskEnd":
                m = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                shuffle[stage_desc.get(e.get("Stage ID"), "")] += m.get("Shuffle Bytes Written", 0)
    print(f"sf={sf} local[{cpus}] warm median of {reps}\n")
    print("| Query | sec | shuffle bytes (one run) | exchanges |\n|---|---|---|---|")
    for n in HEADLINE:
        print(f"| {n} | {times[n]:.2f} | {shuffle.get(f'{n}#1', 0):,} | {exch[n]} |")
    print(f"| **total** | {sum(times.values()):.2f} | | |")


if __name__ == "__main__":
    main()
