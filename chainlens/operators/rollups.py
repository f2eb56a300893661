"""Rollup economics queries over the labelled rollup table (Q4-Q17).

Input is the output of ``extend.label_rollups`` (one row per sequencer
transaction). Conventions kept from the surveyed dashboard, with the reasons:

* sums over empty / all-null groups are 0 (``sum0``), so later means count them;
* rounding is half away from zero (``round_half_away``);
* float means and sums inside bounded groups (a block, a datetime, a day) add
  the values in sorted order (``ordered_mean`` / ``ordered_mean``), so results
  do not depend on partitioning;
* ``first()`` of a block-constant column is ``max`` (any value is the same);
  ``first()`` of a per-transaction column is the value at the lowest
  ``transaction_index`` (``min_by``), which makes it deterministic;
* pivots run *late*: aggregate per key first, pivot the small result with an
  explicit list of sequencer names (the pivot columns are then fixed, not
  data-dependent). Missing cells are 0, as after the reference's fill_null(0).

Orderings that only served the charts are not applied: results are sets, and
the consumer orders them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlens.constants import (
    BLOB_BYTES,
    ROLLING_WINDOWS,
    SEQUENCER_NAMES,
    WEI_PER_ETH,
)
from chainlens.functions.numeric import (
    blob_count,
    datetime_literal,
    epoch_of,
    epoch_to_datetime,
    ieee_div,
    exact_mean,
    exact_sum,
    ordered_mean,
    round_half_away,
    round_numeric,
    sum0,
)
from chainlens.functions.stats import histogram

SEQ = "sequencer_names"
BLK = "block_number"
DT = "block_datetime"


# --- Q4 / Q5 ---------------------------------------------------------------

def tx_cost_deltas(rollups: DataFrame, since: str | None = None,
                   windows: Sequence[str] = tuple(ROLLING_WINDOWS)) -> DataFrame:
    """Cost at each rolling average fee, and actual minus that (positive:
    the transaction paid more than the average)."""
    df = rollups if since is None else rollups.filter(F.col(DT) >= datetime_literal(since))
    df = df.withColumns({
        f"tx_gas_cost_avg_{k}": F.col(f"avg_base_fee_{k}") * F.col("gas_used") / F.lit(WEI_PER_ETH)
        for k in windows
    })
    return df.withColumns({
        f"tx_gas_cost_delta_{k}": F.col("tx_gas_cost") - F.col(f"tx_gas_cost_avg_{k}")
        for k in windows
    })


def summarize_dataset(explore: DataFrame) -> DataFrame:
    """One row: block range, distinct blocks, transactions, date range."""
    return explore.agg(
        F.min(BLK).alias("first_block"),
        F.max(BLK).alias("last_block"),
        (F.max(BLK) - F.min(BLK)).alias("block_range"),
        F.count_distinct(BLK).alias("n_blocks"),
        F.count(F.lit(1)).alias("n_txs"),
        F.min_by(DT, BLK).alias("first_block_datetime"),
        F.max_by(DT, BLK).alias("last_block_datetime"),
    )


def summary_text(summary: DataFrame) -> DataFrame:
    """The dashboard's three summary lines from ``summarize_dataset``
    (numbers stay raw in the summary; formatting is the last step)."""
    n = lambda c: F.format_number(F.col(c), 0)
    return summary.select(
        F.concat(F.lit("block range: "), n("first_block"), F.lit(" to "), n("last_block"),
                 F.lit(" = "), n("block_range"), F.lit(" range")).alias("block_range_info"),
        F.concat(F.lit("blocks in dataset: "), n("n_blocks"), F.lit(", total txs: "),
                 n("n_txs")).alias("blocks_dataset_info"),
        F.concat(F.lit("block date range: "), F.col("first_block_datetime").cast("string"),
                 F.lit(" to "), F.col("last_block_datetime").cast("string")).alias("block_date_range_info"),
    )


def sequencer_list(explore: DataFrame) -> DataFrame:
    """The sorted distinct sequencer names (the dashboard's selector)."""
    return explore.select(SEQ).distinct().orderBy(SEQ)


# --- pivoted daily tables (Q6, Q7) -------------------------------------------

def _daily_pivot(per_block_seq: DataFrame, value: str, names: Sequence[str]) -> DataFrame:
    """(block, seq) values -> mean per (datetime, seq) -> sum per (date, seq)
    -> pivot to one column per sequencer -> 0 for missing -> round(2).

    Every step is an exact sum that is combined before its shuffle, so a long
    date is not one task's work; the pivot is one aggregate by date."""
    per_ts = per_block_seq.groupBy(DT, SEQ).agg(exact_mean(value).alias("_v"))
    wide = per_ts.groupBy(F.to_date(DT).alias(DT)).agg(
        *[exact_sum(F.when(F.col(SEQ) == n, F.col("_v"))).alias(n) for n in names])
    wide = wide.fillna(0.0, subset=list(names))
    return round_numeric(wide, 2)


def tx_cost_avg_transform(explore: DataFrame, pivot_column: str,
                          names: Sequence[str] = SEQUENCER_NAMES) -> DataFrame:
    """Q6: daily total of the per-block cost delta, one column per sequencer."""
    per_bs = explore.groupBy(BLK, SEQ).agg(
        F.max(DT).alias(DT), F.coalesce(exact_sum(pivot_column), F.lit(0.0)).alias(pivot_column))
    return _daily_pivot(per_bs, pivot_column, names)


def calldata_size_transform(explore: DataFrame, pivot_column: str,
                            names: Sequence[str] = SEQUENCER_NAMES) -> DataFrame:
    """Q7: ``sequencer_total_mbytes`` (calldata posted) or
    ``sequencer_mb_gas_ratio`` (MB per gwei of gas price), daily by sequencer."""
    aggs = {
        "sequencer_total_mbytes": (sum0("n_input_bytes") / F.lit(1e6)),
        "sequencer_mb_gas_ratio": exact_mean(ieee_div("n_input_bytes", "gas_price_gwei") / F.lit(1e6)),
        "calldata_mb_block_gas_ratio": exact_mean(
            ieee_div("block_calldata_kbytes", "gas_price_gwei") / F.lit(1e3)),
    }
    per_bs = explore.groupBy(BLK, SEQ).agg(F.max(DT).alias(DT),
                                            aggs[pivot_column].alias(pivot_column))
    return _daily_pivot(per_bs, pivot_column, names)


def monthly_chart_series(daily: DataFrame, sequencers: Sequence[str]) -> DataFrame:
    """Q8: monthly mean of the daily values of the chosen sequencers, every
    month from the first to the last present (empty months are null).

    Daily values are cent-rounded, so the mean is taken over exact cents
    (sum of integers / count / 100): independent of summation order.
    """
    d = daily.withColumn("block_month", F.trunc(DT, "MM"))
    aggs = [(F.sum(F.round(F.col(s) * 100).cast("bigint")).cast("double")
             / F.count(s) / F.lit(100.0)).alias(s) for s in sequencers]
    monthly = d.groupBy("block_month").agg(*aggs)
    # Empty months: each present month also emits the months up to the next
    # present one, with null values. The lead() runs over the monthly table
    # (one row per month: small), so there is no second pass and no join.
    nxt = F.lead("block_month").over(Window.orderBy("block_month"))
    upto = F.coalesce(F.add_months(F.col("_next"), -1), F.col("block_month"))
    filled = monthly.withColumn("_next", nxt).select(
        "*", F.posexplode(F.sequence("block_month", upto, F.expr("INTERVAL 1 MONTH")))
             .alias("_k", "_m"))
    return filled.select(
        F.col("_m").alias("block_month"),
        F.date_format("_m", "MMM yyyy").alias("month_label"),
        *[F.when(F.col("_k") == 0, F.col(s)).alias(s) for s in sequencers])


def calldata_cost_per_block(explore: DataFrame) -> DataFrame:
    """Q9: per block and sequencer, block calldata and its ratio to gas price."""
    return explore.groupBy(BLK, SEQ).agg(
        F.max(DT).alias(DT),
        F.max("block_calldata_kbytes").alias("block_calldata_kbytes"),
        F.min_by("gas_price_gwei", "transaction_index").alias("gas_price_gwei"),
        ordered_mean(ieee_div("block_calldata_kbytes", "gas_price_gwei")).alias("calldata_block_gas_ratio"),
    ).select(BLK, DT, SEQ, "calldata_block_gas_ratio", "block_calldata_kbytes", "gas_price_gwei")


# --- blob market (Q10-Q14) --------------------------------------------------

def blob_market_per_sequencer(explore: DataFrame, sequencer: str,
                              blob_bytes: int = BLOB_BYTES) -> DataFrame:
    """Q10: blobs one sequencer would fill per block, alone."""
    return (explore.filter(F.col(SEQ) == sequencer)
                   .groupBy(BLK)
                   .agg(F.max(DT).alias(DT), F.max(SEQ).alias(SEQ),
                        sum0("n_input_bytes").alias("sequencer_total_bytes"))
                   .withColumn("blob_size_split", blob_count("sequencer_total_bytes", blob_bytes)))


def blob_market_non_agg(explore: DataFrame, names: Sequence[str] = SEQUENCER_NAMES,
                        blob_bytes: int = BLOB_BYTES) -> DataFrame:
    """Q11: per block, blobs per sequencer when each fills its own (wide),
    and their total ``blob_count``.

    The reference's pivot of per-(block, sequencer) sums is one aggregation
    keyed by block with a conditional byte sum per sequencer: map-side
    combined before its single exchange."""
    by_seq = explore.groupBy(BLK).agg(*[
        F.sum(F.when(F.col(SEQ) == n, F.col("n_input_bytes"))).alias(n) for n in names])
    wide = by_seq.select(BLK, *[F.coalesce(blob_count(F.col(n), blob_bytes), F.lit(0))
                                .cast("bigint").alias(n) for n in names])
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return wide.withColumn("blob_count", total.cast("bigint"))


def blob_market_agg(explore: DataFrame, blob_bytes: int = BLOB_BYTES) -> DataFrame:
    """Q12: blobs per block when all sequencers share blobs (the reference's
    two-level sum collapses into one aggregation)."""
    return (explore.groupBy(BLK)
                   .agg(F.max(DT).alias(DT), sum0("n_input_bytes").alias("sequencer_total_bytes"))
                   .withColumn("blob_count", blob_count("sequencer_total_bytes", blob_bytes)))


def _since(blocks: DataFrame, since: str | None) -> DataFrame:
    """Blocks from the date floor on (None: all); on the raw epoch column, so it is pushed."""
    return blocks if since is None else blocks.filter(F.col("timestamp") >= F.lit(epoch_of(since)))


def blob_series(blocks: DataFrame, counts: DataFrame, since: str | None = None) -> DataFrame:
    """Q13: every block since ``since`` with its blob count (0 if none).

    The date floor is applied to the raw epoch column, so it is pushed into
    the parquet scan of the blocks table."""
    b = _since(blocks, since).select(BLK, "timestamp")
    c = counts.select(BLK, "blob_count")
    return (b.join(c, BLK, "left")
             .fillna(0, subset=["blob_count"])
             .withColumn("datetime", epoch_to_datetime("timestamp"))
             .drop("timestamp"))


def blob_demand_buckets(series: dict[str, DataFrame]) -> DataFrame:
    """Q14: blocks with 0, 1-3, more than 3 and more than 6 blobs, per market,
    in one aggregation over the union (not four filtered scans)."""
    u = None
    for market, s in series.items():
        s = s.select(F.lit(market).alias("market"), "blob_count")
        u = s if u is None else u.unionByName(s)
    c = F.col("blob_count")
    return u.groupBy("market").agg(
        F.count_if(c == 0).alias("zero_blobs"),
        F.count_if((c > 0) & (c <= 3)).alias("one_to_three_blobs"),
        F.count_if(c > 3).alias("more_than_3_blobs"),
        F.count_if(c > 6).alias("more_than_6_blobs"),
    )


def blob_demand(explore: DataFrame, blocks: DataFrame, since: str | None = None,
                blob_bytes: int = BLOB_BYTES, names: Sequence[str] = SEQUENCER_NAMES) -> DataFrame:
    """Q14 in one pass: per block, the non-aggregated count (sum over
    sequencers of their own blobs) and the aggregated count (shared blobs)
    come out of one map-side-combined aggregation; all blocks since ``since``
    are then counted into the buckets of both markets. Same result as
    ``blob_demand_buckets`` over the two ``blob_series``."""
    per_b = explore.groupBy(BLK).agg(
        sum0("n_input_bytes").alias("_all"),
        *[F.sum(F.when(F.col(SEQ) == n, F.col("n_input_bytes"))).alias(f"_s{i}")
          for i, n in enumerate(names)])
    non_agg = sum((F.coalesce(blob_count(F.col(f"_s{i}"), blob_bytes), F.lit(0))
                   for i in range(len(names))), F.lit(0))
    per_b = per_b.select(BLK, non_agg.cast("bigint").alias("non_agg"),
                         blob_count("_all", blob_bytes).alias("agg"))
    b = _since(blocks, since).select(BLK)
    s = b.join(per_b, BLK, "left").fillna(0, subset=["non_agg", "agg"])
    long = s.select(F.explode(F.array(
        F.struct(F.lit("non_agg").alias("market"), F.col("non_agg").alias("blob_count")),
        F.struct(F.lit("agg").alias("market"), F.col("agg").alias("blob_count")))).alias("m"))
    c = F.col("m.blob_count")
    return long.groupBy(F.col("m.market").alias("market")).agg(
        F.count_if(c == 0).alias("zero_blobs"),
        F.count_if((c > 0) & (c <= 3)).alias("one_to_three_blobs"),
        F.count_if(c > 3).alias("more_than_3_blobs"),
        F.count_if(c > 6).alias("more_than_6_blobs"),
    )


# --- sequencer statistics (Q15-Q17) ----------------------------------------

def agg_sequencer_stats(explore: DataFrame,
                        windows: Sequence[str] = tuple(ROLLING_WINDOWS)) -> DataFrame:
    """Q15: one row per sequencer. Single pass: per (block, sequencer), then
    per sequencer (the reference's second aggregation + self-join is folded
    in, since both group the same rows by the same key).

    Kept from the reference: ``tx_cost_*_delta_eth`` hold sums of the
    *average-fee cost*, ``tota_cost_eth`` is spelled so, and ``mb_per_eth``
    divides two already rounded numbers."""
    per_bs = explore.groupBy(BLK, SEQ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.coalesce(exact_sum("tx_gas_cost"), F.lit(0.0)).alias("_cost"),
        sum0("n_input_bytes").alias("_in"),
        sum0("n_rlp_bytes").alias("_rlp"),
        *[F.coalesce(exact_sum(f"tx_gas_cost_avg_{k}"), F.lit(0.0)).alias(f"_avg_{k}") for k in windows],
    )
    per_seq = per_bs.groupBy(SEQ).agg(
        F.count(F.lit(1)).cast("double").alias("n_blocks"),
        F.sum("_n").cast("double").alias("n_txs"),
        round_half_away(exact_sum("_cost"), 2).alias("tota_cost_eth"),
        round_half_away(F.sum("_in") / F.lit(1e6), 2).alias("total_mbytes"),
        round_half_away(F.sum("_rlp") / F.lit(1e6), 2).alias("_rlp_mb"),
        *[round_half_away(exact_sum(f"_avg_{k}"), 2).alias(f"tx_cost_{k}_delta_eth") for k in windows],
    )
    return (per_seq
            .withColumn("mb_per_eth", round_half_away(ieee_div("_rlp_mb", "tota_cost_eth"), 2))
            .withColumnRenamed(SEQ, "sequencer")
            .select("sequencer", "n_blocks", "n_txs", "tota_cost_eth", "mb_per_eth",
                    "total_mbytes", *[f"tx_cost_{k}_delta_eth" for k in windows]))


def sequencer_gas_per_block(explore: DataFrame) -> DataFrame:
    """Gas used per (block, sequencer), rounded, with the transaction count."""
    return explore.groupBy(BLK, SEQ).agg(
        round_half_away(sum0("gas_used").cast("double"), 0).alias("sequencer_gas_used_sum"),
        F.count(F.lit(1)).alias("n_txs"))


def sequencer_gas_histogram(explore: DataFrame, bins: int = 50,
                            upper: float = 1e8, store: str | None = None) -> DataFrame:
    """Q16: histogram of per-block sequencer gas (< ``upper``), by sequencer,
    on bins shared by all sequencers. ``store``: see ``stats.histogram``."""
    g = sequencer_gas_per_block(explore).filter(F.col("sequencer_gas_used_sum") < upper)
    return histogram(g, "sequencer_gas_used_sum", bins, by=[SEQ], store=store)


def sequencer_gas_share(explore: DataFrame) -> DataFrame:
    """Q17: share of the block's gas used by each sequencer."""
    return explore.groupBy(BLK, SEQ).agg(
        ieee_div(sum0("gas_used"), F.max("gas_used_block")).alias("sequencer_gas_used_pct"),
        F.max("gas_used_block").alias("total_gas_in_block"),
    )


def top_rows(df: DataFrame, by: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows by ``by`` descending (nulls first), ``ties``
    ascending, numbered in ``rank``. Each task keeps n rows; the rank sees n rows."""
    order = [F.col(by).desc_nulls_first(), *[F.col(c) for c in ties]]
    head = df.orderBy(*order).limit(n)
    return head.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
