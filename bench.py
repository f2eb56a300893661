"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs through a ``noop`` sink (the full plan executes, nothing is
collected). A short untimed warm-up, then the median of $BENCH_REPEATS runs
per query. Prints ONE JSON line:
{"metric": "sum_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
Exchange counts per query are an extra key; shuffle bytes: tools/query_profile.py.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "extend_txs_blocks",
    "extend_txs_blocks_mempool",
    "label_rollups",
    "summarize_dataset",
    "tx_cost_avg_daily",
    "monthly_chart_series",
    "blob_demand_buckets",
    "agg_sequencer_stats",
    "sequencer_gas_histogram",
    "block_volatility",
    "volatility_moments",
    "kalman_fee_filter",
    "swaps_enriched",
    "decode_swap_logs",
    "sync_batches",
    "tx_cost_deltas",
    "calldata_posted_mb",
    "calldata_cost_per_block",
    "blob_market_non_agg",
    "blob_market_agg",
    "sequencer_gas_share",
    "fee_zscore_kurtosis",
    "swap_net_amounts",
]


def _exchanges(df) -> int:
    """Distinct shuffle exchanges of the plan. A scalar subquery is printed at
    each of its uses, so exchanges are told apart by their text (partitioning
    keys with attribute ids), not counted per printed line."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    found = re.findall(r"(?<!Reused)Exchange ((?:hashpartitioning|rangepartitioning|SinglePartition|"
                       r"RoundRobin)[^\n]*?)(?:, \[plan_id=\d+\]|$)", final, flags=re.M)
    return len(set(found))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from chainlens.plans.catalog import queries
    from chainlens.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus * 2)
    qs = queries()

    def run(name):
        df = qs[name](spark, sf_dir)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0, df

    times, exch = {}, {}
    for n in names[:6] + [m for m in ("kalman_fee_filter",) if m in names]:
        run(n)  # warm-up: JVM JIT of the big plans, file metadata, Python workers
    for n in names:
        ts = []
        for _ in range(repeats):
            t, df = run(n)
            ts.append(t)
        times[n] = round(statistics.median(ts), 3)
        exch[n] = _exchanges(df)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "exchanges": exch,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
