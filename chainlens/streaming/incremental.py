"""Structured Streaming forms of the rollup job (T1 / Q29 stream, T2 / Q31).

T1: transaction and block files arrive in two ``block_batch``-partitioned folders, in any
order. Two streams of file listings (one row per new file, contents unread) are keyed by
batch; the state of a batch is which of the two sides has come. A micro-batch emits the
batches that got a file and whose sides are both there, and those alone are read, in
full (rolling windows and block aggregates need whole batches), enriched, labelled and
written with dynamic partition overwrite. The state lives in the checkpoint, so a late
side is matched after a restart too, and replaying a micro-batch after a failure
rewrites the same partitions: the sink is exactly-once. What reaches the driver is the
ids of one micro-batch, whose files the driver lists anyway.

T2: per-day totals per sequencer over an arriving rollup table: in append mode with a
watermark on the event time and tumbling one-day windows, in complete mode over every
row, however late it comes.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from chainlens.operators.extend import rollup_transactions
from chainlens.plans.jobs import write_batches
from chainlens.sources.batches import batch_of_path, read_batches
from chainlens.sources.files import BATCH

TXS, BLOCKS = "txs", "blocks"


def arriving_files(spark: SparkSession, path: str, side: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of (block_batch, side), one row per new file of a batched folder. The
    binary source names a file without opening it, as its content is not selected."""
    r = (spark.readStream.format("binaryFile")
         .schema("path string, modificationTime timestamp, length long, content binary")
         .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    files = r.load(path).select(batch_of_path(F.col("path")).alias(BATCH), F.lit(side).alias("side"))
    return files.filter(F.col(BATCH).isNotNull())


def paired_batches(arriving: DataFrame) -> DataFrame:
    """A stream of the batches that got a file and whose two sides have both come (keyed state: two flags a batch)."""
    def pair(key, frames, state):
        seen = set(state.get[0].split()) if state.exists else set()
        for f in frames:
            seen |= set(f["side"])
        state.update((" ".join(sorted(seen)),))
        if {TXS, BLOCKS} <= seen:
            yield pd.DataFrame({BATCH: [key[0]]})

    return arriving.groupBy(BATCH).applyInPandasWithState(
        pair, f"{BATCH} long", "seen string", "append", GroupStateTimeout.NoTimeout)


def start_rollups_stream(spark: SparkSession, txs_path: str, blocks_path: str,
                         labels: DataFrame, out_path: str, checkpoint: str,
                         available_now: bool = True, max_files_per_trigger: int | None = 1_000_000,
                         per_commit: int = 1000, **extend_kw) -> StreamingQuery:
    """Incremental, exactly-once rollup job over ``block_batch`` folders.

    ``max_files_per_trigger`` bounds a micro-batch, per side, when a large backlog is
    caught up (``availableNow`` still drains it, in several micro-batches). A batch that
    gets more files later is written again, whole, so the bound is wide: a file is one
    short row here, and a batch whose files fall into several micro-batches is computed in
    each. The work is bounded by batches: ``per_commit`` are read and written at a time."""
    files = arriving_files(spark, txs_path, TXS, max_files_per_trigger).unionByName(
        arriving_files(spark, blocks_path, BLOCKS, max_files_per_trigger))

    def process(micro: DataFrame, epoch_id: int) -> None:
        s = micro.sparkSession
        ids = sorted(r[0] for r in micro.collect())
        for i in range(0, len(ids), per_commit):
            some = ids[i:i + per_commit]
            t, b = read_batches(s, txs_path, some), read_batches(s, blocks_path, some)
            write_batches(rollup_transactions(t, b, labels, **extend_kw), out_path)

    w = paired_batches(files).writeStream.outputMode("append").foreachBatch(process).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def daily_totals(stream: DataFrame, watermark: str | None = "1 day") -> DataFrame:
    """T2 transform: rows, gas and calldata per (day, sequencer). Event time is
    ``block_datetime`` (naive UTC), cast to a timestamp for the watermark. Without a
    watermark no row is late, and rows without a time are a day of their own (null)."""
    sums = [F.count(F.lit(1)).alias("n_txs"), F.sum("gas_used").alias("gas_used"),
            F.sum("n_input_bytes").alias("n_input_bytes")]
    if watermark is None:
        return stream.groupBy(F.to_date("block_datetime").alias("day"), "sequencer_names").agg(*sums)
    t = F.col("block_datetime").cast("timestamp")
    by_day = stream.withColumn("_et", t).withWatermark("_et", watermark).groupBy(
        F.window("_et", "1 day").alias("w"), "sequencer_names").agg(*sums)
    return by_day.select(F.to_date(F.col("w.start")).alias("day"), "sequencer_names", "n_txs", "gas_used", "n_input_bytes")


def start_daily_totals_stream(spark: SparkSession, rollups_path: str, out_path: str,
                              checkpoint: str, mode: str = "append",
                              watermark: str = "1 day",
                              available_now: bool = True) -> StreamingQuery:
    """Daily totals to parquet. In ``append`` mode a day is emitted
    once the watermark passes it (late rows are dropped); ``complete`` counts every
    row and rewrites the whole small result (days by sequencers) each micro-batch."""
    schema = spark.read.parquet(rollups_path).schema
    src = spark.readStream.schema(schema).parquet(rollups_path)
    agg = daily_totals(src, None if mode == "complete" else watermark)

    def sink(micro: DataFrame, epoch_id: int) -> None:
        # days are partitions, replaced dynamically: a replayed micro-batch
        # rewrites the same days (exactly-once), in append or complete mode
        (micro.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("day").parquet(out_path))

    w = (agg.writeStream.outputMode(mode).foreachBatch(sink)
            .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
