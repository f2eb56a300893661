"""Named queries: ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Each entry builds the stand-in views from the given scale-factor folder and
runs one library transform over the *whole* tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens.constants import ROLLING_WINDOWS, SEQUENCER_NAMES
from chainlens.operators import extend
from chainlens.operators import kalman as K
from chainlens.operators import rollups as R
from chainlens.operators import swaps as W
from chainlens.operators import volatility as V
from chainlens.session import tune_session
from chainlens.sources import standins as S

Query = Callable[[SparkSession, str], DataFrame]


def _q1(spark: SparkSession, d: str) -> DataFrame:
    return extend.extend_txs_blocks(S.transactions(spark, d), S.blocks(spark, d))


def _q2(spark: SparkSession, d: str) -> DataFrame:
    return extend.extend_txs_blocks_mempool(S.transactions(spark, d), S.blocks(spark, d),
                                            S.mempool(spark, d))


def rollups(spark: SparkSession, d: str) -> DataFrame:
    """Q3 over the stand-ins: the labelled rollup table every dashboard reads."""
    return extend.rollup_transactions(S.transactions(spark, d), S.blocks(spark, d),
                                      S.sequencer_labels(spark, d))


# The driver's orders span 1995-2001, so the dashboard's 2023 floor would keep
# nothing; the stand-in queries use this floor instead (a parameter).
SINCE = "1996-01-01"
TAIL = 500
TOP = 100
NAMES = list(SEQUENCER_NAMES)
BLOCK_RANGE = (500, 1499)
BLOCK_COLS = ["block_number", "timestamp", "base_fee_per_gas", "gas_used", "block_batch"]


def explore(spark: SparkSession, d: str) -> DataFrame:
    """Q4 over the stand-ins: the dashboard's base table."""
    return R.tx_cost_deltas(rollups(spark, d), since=SINCE)


def _store(spark: SparkSession) -> str:
    """A fresh folder for the narrow columns that a histogram reads twice."""
    from chainlens.plans.jobs import scratch_path

    return scratch_path(spark, "histogram")


def _rollup_queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "tx_cost_deltas": explore,
        "summarize_dataset": lambda s, d: R.summarize_dataset(explore(s, d)),
        "summary_text": lambda s, d: R.summary_text(R.summarize_dataset(explore(s, d))),
        "sequencer_list": lambda s, d: R.sequencer_list(explore(s, d)),
    }
    for k in ROLLING_WINDOWS:
        q[f"tx_cost_avg_{k}"] = (lambda kk: lambda s, d: R.tx_cost_avg_transform(
            explore(s, d), f"tx_gas_cost_delta_{kk}", NAMES))(k)
    q["calldata_posted_mb"] = lambda s, d: R.calldata_size_transform(
        explore(s, d), "sequencer_total_mbytes", NAMES)
    q["calldata_gas_ratio"] = lambda s, d: R.calldata_size_transform(
        explore(s, d), "sequencer_mb_gas_ratio", NAMES)
    q["monthly_chart_series"] = lambda s, d: R.monthly_chart_series(
        R.calldata_size_transform(explore(s, d), "sequencer_total_mbytes", NAMES), NAMES)
    q["calldata_cost_per_block"] = lambda s, d: R.calldata_cost_per_block(explore(s, d))
    q["blob_market_per_sequencer"] = lambda s, d: R.blob_market_per_sequencer(explore(s, d), NAMES[0])
    q["blob_market_non_agg"] = lambda s, d: R.blob_market_non_agg(explore(s, d), NAMES)
    q["blob_market_agg"] = lambda s, d: R.blob_market_agg(explore(s, d))
    q["blob_series_non_agg"] = lambda s, d: R.blob_series(
        S.blocks(s, d), R.blob_market_non_agg(explore(s, d), NAMES), SINCE)
    q["blob_series_agg"] = lambda s, d: R.blob_series(
        S.blocks(s, d), R.blob_market_agg(explore(s, d)), SINCE)
    q["blob_demand_buckets"] = lambda s, d: R.blob_demand(explore(s, d), S.blocks(s, d), SINCE)
    q["agg_sequencer_stats"] = lambda s, d: R.agg_sequencer_stats(explore(s, d))
    q["sequencer_gas_histogram"] = lambda s, d: R.sequencer_gas_histogram(explore(s, d), store=_store(s))
    q["sequencer_gas_share_top"] = lambda s, d: R.top_rows(
        R.sequencer_gas_share(explore(s, d)), "sequencer_gas_used_pct", TOP, ["block_number", "sequencer_names"])
    q["sequencer_gas_share"] = lambda s, d: R.sequencer_gas_share(explore(s, d))
    return q


VOL_N = 300  # the surveyed notebook's diff lag
DEC = 6  # decimals of reported moments and Kalman outputs


def volatility(spark: SparkSession, d: str) -> DataFrame:
    return V.block_volatility(S.block_series(spark, d), n=VOL_N)


def kalman(spark: SparkSession, d: str) -> DataFrame:
    return K.kalman_fee_filter(S.block_series(spark, d), by=["series"], decimals=DEC)


def _vol_queries() -> dict[str, Query]:
    return {
        "block_volatility": volatility,
        "volatility_moments": lambda s, d: V.volatility_moments(volatility(s, d), decimals=DEC),
        "fee_zscore_kurtosis": lambda s, d: V.fee_zscore_kurtosis(S.block_series(s, d).select(
            (F.col("base_fee_per_gas") / 1e9).alias("base_fee_per_gas_gwei")), decimals=DEC),
        "fee_zscore": lambda s, d: V.fee_zscore(S.block_series(s, d).withColumn(
            "base_fee_per_gas_gwei", F.col("base_fee_per_gas") / 1e9), decimals=DEC),
        "kalman_fee_filter": kalman,
        "kalman_tail_sample": lambda s, d: K.tail_sample(
            S.block_series(s, d).select("series", "block_number", *K.VARS), ["series"], TAIL)
            .withColumnRenamed("_rn", "rn"),
        "kalman_error_sums": lambda s, d: K.kalman_error_sums(kalman(s, d), ["series"], DEC),
        "kalman_diff_histogram": lambda s, d: V.diff_histogram(
            kalman(s, d), "base_fee_per_gas_diff", 10, by=["series"], store=_store(s)),
        "volatility_diff_histogram": lambda s, d: V.diff_histogram(
            volatility(s, d), "base_fee_per_gas_gwei_diff", 1000, store=_store(s)),
    }


def _ingested(logs: DataFrame) -> DataFrame:
    """Logs of any case, stored in lower case with statistics that selections use."""
    from chainlens.plans.jobs import scratch_path
    from chainlens.sources.logs import ingest_logs

    return ingest_logs(logs, scratch_path(logs.sparkSession, "logs"))


def _swap_queries() -> dict[str, Query]:
    from chainlens.constants import UNIV2_FACTORY

    return {
        "swap_net_amounts": lambda s, d: W.swap_net_amounts(S.univ2_swaps(s, d)),
        "swaps_enriched": lambda s, d: W.swaps_enriched(
            W.swap_net_amounts(S.univ2_swaps(s, d)), S.univ2_pools(s, d), S.univ2_tokens(s, d)),
        "pool_token_list": lambda s, d: W.pool_token_list(S.univ2_pools(s, d)),
        "decode_swap_logs": lambda s, d: W.decode_swap_logs(S.raw_swap_logs(s, d)),
        "decode_pair_logs": lambda s, d: W.decode_pair_logs(
            _ingested(S.raw_pair_logs(s, d, UNIV2_FACTORY)), UNIV2_FACTORY, lower_hex=True),
    }


def _read_back(spark: SparkSession, path: str) -> DataFrame:
    from chainlens.sources.files import read_dataset

    return read_dataset(spark, path)


def _laid_out(spark: SparkSession, df: DataFrame, dataset: str) -> str:
    """Write the keys of a dataset with each batch below its layout name; returns the folder."""
    from chainlens.plans.jobs import scratch_path
    from chainlens.sources.files import batch_file_name

    out = scratch_path(spark, "listing")
    name = batch_file_name(dataset, F.col("block_batch"), S.BLOCKS_PER_BATCH)
    df.select("block_number", name.alias("file")).write.partitionBy("file").parquet(out)
    return out


def _layout_names(spark: SparkSession, path: str) -> DataFrame:
    """The layout names in the listing of a folder that ``_laid_out`` wrote."""
    from chainlens.sources.files import list_files

    return list_files(spark, path).select(F.regexp_extract("path", "/file=([^/]+)/", 1).alias("file_name")).distinct()


def q_sync_batches(spark: SparkSession, d: str) -> DataFrame:
    """Q28 over the listings of two real folders."""
    from chainlens.sources.files import sync_batches

    txs = _laid_out(spark, S.transactions(spark, d), "ethereum__transactions")
    blocks = _laid_out(spark, S.blocks(spark, d), "ethereum__blocks")
    sb = sync_batches(_layout_names(spark, txs), _layout_names(spark, blocks))
    return sb.select("batch_end", F.array_join("files_a", ",").alias("files_a"),
                     F.array_join("files_b", ",").alias("files_b"))


def q_list_batch_files(spark: SparkSession, d: str) -> DataFrame:
    """S8-S10 over a real folder: each batch is written below its layout name, then listed."""
    from chainlens.sources.files import batch_of_filename, batch_range_of_filename

    found = _layout_names(spark, _laid_out(spark, S.blocks(spark, d), "ethereum__blocks"))
    return found.select("file_name", batch_of_filename(F.col("file_name")).alias("batch_end"),
                        batch_range_of_filename(F.col("file_name")).alias("batch_range"))


def q_select_blocks(spark: SparkSession, d: str) -> DataFrame:
    """A closed block range, and the latest block."""
    from chainlens.sources.files import select_blocks

    b = S.blocks(spark, d).select(*BLOCK_COLS)
    return (select_blocks(b, *BLOCK_RANGE).withColumn("selection", F.lit("range"))
            .unionByName(select_blocks(b, latest=True).withColumn("selection", F.lit("latest"))))


def q_copy_batches(spark: SparkSession, d: str) -> DataFrame:
    """Copy the blocks twice into a fresh folder; the second copy finds nothing to do."""
    from chainlens.plans.jobs import copy_batches, scratch_path, write_batches

    src, out = scratch_path(spark, "blocks"), scratch_path(spark, "copy")
    write_batches(S.blocks(spark, d), src)
    for _ in range(2):
        copy_batches(spark, src, out, BLOCK_COLS)
    return _read_back(spark, out).select(*BLOCK_COLS)


def q_write_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Q29 (batch): the job over two folders, run when the blocks of even batches are there,
    when all are, and once more with nothing pending. Returns the written table."""
    from chainlens.plans.jobs import process_new_batches, scratch_path, write_batches

    txs, blocks, out = (scratch_path(spark, k) for k in ("txs", "blocks", "rollups"))
    write_batches(S.transactions(spark, d), txs)
    for rest in (0, 1, None):
        if rest is not None:
            write_batches(S.blocks(spark, d).filter(F.col("block_batch") % 2 == rest), blocks)
        process_new_batches(spark, txs, blocks, S.sequencer_labels(spark, d), out)
    return _read_back(spark, out)


def q_combine_files(spark: SparkSession, d: str) -> DataFrame:
    """Q30: compact a many-file copy of the swaps table; return the result."""
    from chainlens.plans.jobs import combine_files, scratch_path

    src, dst = scratch_path(spark, "swaps-src"), scratch_path(spark, "swaps-dst")
    S.univ2_swaps(spark, d).repartition(16).write.parquet(src)
    combine_files(spark, src, dst, target_file_bytes=1 << 20)
    return spark.read.parquet(dst)


def q_rollups_stream(spark: SparkSession, d: str) -> DataFrame:
    """Q29 (stream): batch-partitioned inputs -> availableNow stream -> table. The blocks
    of odd batches arrive after their transactions were seen, which triggers a second run."""
    from chainlens.plans.jobs import scratch_path, write_batches
    from chainlens.streaming.incremental import start_rollups_stream

    tx, bl = scratch_path(spark, "txs"), scratch_path(spark, "blocks")
    write_batches(S.transactions(spark, d), tx)
    out, ck = scratch_path(spark, "rollups"), scratch_path(spark, "ckpt")
    for late in (0, 1):
        write_batches(S.blocks(spark, d).filter(F.col("block_batch") % 2 == late), bl)
        start_rollups_stream(spark, tx, bl, S.sequencer_labels(spark, d), out, ck).awaitTermination()
    return _read_back(spark, out)


#: the stand-in days are split here; blocks older than LATE_DAY with a number divisible by 7 come late
SPLIT_DAY, LATE_DAY = "1998-06-01", "1998-04-01"


def q_daily_totals_stream(spark: SparkSession, d: str) -> DataFrame:
    """Q31: daily totals per sequencer from a streamed rollup table, every row counted. Two
    arrivals: the days before SPLIT_DAY; then the later days, with some rows of old days,
    whose totals are corrected, and the rows without a day."""
    from chainlens.plans.jobs import scratch_path
    from chainlens.streaming.incremental import start_daily_totals_stream

    all_rows, src = scratch_path(spark, "rollups"), scratch_path(spark, "arriving")
    rollups(spark, d).select("block_number", "block_datetime", "sequencer_names", "gas_used", "n_input_bytes").write.parquet(all_rows)
    df = spark.read.parquet(all_rows)
    day = F.to_date("block_datetime")
    late = (day < F.lit(LATE_DAY).cast("date")) & (F.col("block_number") % 7 == 0)
    first = F.coalesce((day < F.lit(SPLIT_DAY).cast("date")) & ~late, F.lit(False))
    out, ck = scratch_path(spark, "daily"), scratch_path(spark, "ckpt")
    for arrival in (df.filter(first), df.filter(~first)):
        arrival.write.mode("append").parquet(src)
        start_daily_totals_stream(spark, src, out, ck, mode="complete").awaitTermination()
    return spark.read.parquet(out).withColumn("day", F.col("day").cast("date"))


def _job_queries() -> dict[str, Query]:
    return {
        "sync_batches": q_sync_batches,
        "list_batch_files": q_list_batch_files,
        "select_blocks": q_select_blocks,
        "copy_batches": q_copy_batches,
        "write_rollups_incremental": q_write_incremental,
        "combine_files": q_combine_files,
        "write_rollups_stream": q_rollups_stream,
        "daily_totals_stream": q_daily_totals_stream,
    }


def _tuned(fn: Query) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        tune_session(spark)
        return fn(spark, d)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "extend_txs_blocks": _q1,
        "extend_txs_blocks_mempool": _q2,
        "label_rollups": rollups,
    }
    q.update(_rollup_queries())
    q.update(_vol_queries())
    q.update(_swap_queries())
    q.update(_job_queries())
    return {k: _tuned(v) for k, v in q.items()}
