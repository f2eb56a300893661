"""Session helpers.

The library never creates hidden sessions inside transforms. ``get_spark`` is for
scripts, tests and the bench; ``tune_session`` sets the few SQL confs the plans
are designed around (all runtime-settable, so it is safe on a shared cluster
session).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL confs the plans rely on.
#  * requireAllClusterKeysForCoPartition=false: a join on (block_batch, chunk,
#    block_number) may reuse a hash partitioning on (block_batch, chunk), so the
#    join, the per-chunk windows and the final dedupe share one exchange.
#  * AQE + skew join: runtime broadcast of small sides (a size-checked
#    broadcast with sort-merge as the fallback) and splitting of hot partitions.
#  * parallelPartitionDiscovery.parallelism: folders are listed by 64 tasks, not by one
#    task a folder, as every task's result and metrics go to the driver.
TUNED_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def tune_session(spark: SparkSession) -> SparkSession:
    for k, v in TUNED_CONFS.items():
        spark.conf.set(k, v)
    return spark


#: the folder of local sessions that name none (the setting itself cannot be changed at run time)
_private: str | None = None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a private folder; elsewhere executors
    would not share it, so that is an error.
    """
    global _private
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:  # classic sessions; Spark Connect has no SparkContext
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _private = _private or tempfile.mkdtemp(prefix="chainlens-ckpt-")
        d = _private
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "chainlens", conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    master = master or os.environ.get("CHAINLENS_MASTER")
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**TUNED_CONFS, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune_session(spark)
    checkpoint_dir(spark)
    return spark
