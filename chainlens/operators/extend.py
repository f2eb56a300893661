"""Transaction + block enrichment (Q1-Q3).

Plan shape (``extend_txs_blocks``), designed for hundreds of billions of rows:

* both inputs are hash-partitioned once on ``(block_batch, chunk)`` where
  ``chunk = block_number div chunk_blocks``. The left join on
  ``(block_batch, chunk, block_number)``, the per-block aggregates (a window
  partitioned by block), the per-chunk row numbering and the final dedupe all
  reuse that one exchange (with
  ``spark.sql.requireAllClusterKeysForCoPartition=false``, see ``session``);
* the trailing row-count means run on a narrow projection through
  ``functions.series.rolling_means`` (prefix sums + halo buckets) and are
  joined back on ``(block_batch, chunk, _lrn)``. No task ever holds more than
  one chunk or one halo bucket, so a hot batch is split, not serialised;
* only narrow rows (a handful of longs) take the extra shuffles; the wide
  transaction rows are shuffled once;
* with a mempool, the hashes and places of transactions go to the sightings and the
  sightings come back to the partitioning of the wide rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlens.constants import ROLLING_WINDOWS, WEI_PER_ETH, WEI_PER_GWEI
from chainlens.functions.numeric import (
    epoch_to_datetime,
    fill_nan,
    ieee_div,
    round_half_away,
)
from chainlens.functions.series import LRN, chunk_col, local_window, rolling_means

BATCH = "block_batch"
CHUNK = "_chunk"
DEFAULT_CHUNK_BLOCKS = 1024


def _suffix_clashes(right: DataFrame, left_cols, keys, suffix: str) -> DataFrame:
    ren = {c: c + suffix for c in right.columns if c in left_cols and c not in keys}
    return right.withColumnsRenamed(ren) if ren else right


def mempool_sightings(txs: DataFrame, mempool: DataFrame) -> DataFrame:
    """(block_batch, _chunk, transaction_hash, the mempool's columns): sightings at the place of
    their transactions. Only the hash and place of a transaction travel to the mempool."""
    m = _suffix_clashes(mempool, set(txs.columns), {"hash"}, "_mempool")
    places = txs.select("transaction_hash", BATCH, CHUNK).filter(F.col("transaction_hash").isNotNull())
    # the join below needs no other exchange; keys as aggregates keep not-null filters of later
    # joins above, so that the exchange of the wide rows is reused
    places = places.repartition("transaction_hash").groupBy("transaction_hash", BATCH, CHUNK).agg(
        F.max(BATCH).alias("_batch"), F.max(CHUNK).alias("_place")).select(
        "transaction_hash", F.col("_batch").alias(BATCH), F.col("_place").alias(CHUNK))
    return places.join(m, places["transaction_hash"] == m["hash"], "inner").drop(m["hash"])


def extend_txs_blocks(
    txs: DataFrame,
    blocks: DataFrame,
    mempool: DataFrame | None = None,
    windows: Mapping[str, int] | None = None,
    chunk_blocks: int = DEFAULT_CHUNK_BLOCKS,
    bucket_rows: int | None = None,
    senders: DataFrame | None = None,
) -> DataFrame:
    """Join transactions with their block (and optionally mempool sightings)
    and add cost, premium, block-space and rolling base-fee columns.

    ``windows`` maps a suffix to a trailing row count; defaults to
    daily=7200, hourly=300, minute=5 (rows of the joined frame, restarted per
    ``block_batch``, ordered by block_number, transaction_index). Rows without
    a ``block_batch`` column form one batch. Float NaN becomes 0; null and inf
    stay. Duplicate rows are removed last.

    ``senders`` (one column of addresses) keeps only transactions from those
    addresses. It is applied after the windows, which must see every row, and
    before the per-row columns and the full-row dedupe. Both commute with a
    filter on ``from_address``, so the result equals filtering afterwards, but
    with far fewer rows going through the dedupe.
    """
    windows = dict(ROLLING_WINDOWS if windows is None else windows)
    if (BATCH in txs.columns) != (BATCH in blocks.columns):
        raise ValueError("block_batch must be on both inputs or on neither "
                         "(read both with sources.files.read_dataset)")
    if BATCH not in txs.columns:
        txs = txs.withColumn(BATCH, F.lit(0).cast("bigint"))
        blocks = blocks.withColumn(BATCH, F.lit(0).cast("bigint"))

    keys = [BATCH, CHUNK, "block_number"]
    t = txs.withColumn(CHUNK, chunk_col("block_number", chunk_blocks))
    sightings = None if mempool is None else mempool_sightings(t, mempool)
    t = t.repartition(BATCH, CHUNK)
    if sightings is not None:  # brought to the rows, not the rows to them
        t = t.join(sightings.repartition(BATCH, CHUNK), [BATCH, CHUNK, "transaction_hash"], "left")
    b = _suffix_clashes(blocks, set(t.columns), set(keys), "_block")
    b = b.withColumn(CHUNK, chunk_col("block_number", chunk_blocks))
    b = b.repartition(BATCH, CHUNK)
    j = t.join(b, keys, "left")

    # The rolled value depends on the first three columns alone, so the narrow
    # rows stay all-long. Rows that tie in them (a hash sighted twice, a repeated
    # transaction) are numbered by all other columns: a retried task numbers them alike.
    order = ["block_number", "transaction_index", "base_fee_per_gas"]
    ties = [c for c, t in j.dtypes if c not in {BATCH, CHUNK, *order} and "map<" not in t]
    w_block = Window.partitionBy(BATCH, CHUNK, "block_number")
    j = j.withColumns({
        "transaction_index_max": F.max("transaction_index").over(w_block),
        "block_encoded_bytes": F.sum("n_rlp_bytes").over(w_block),
        "block_calldata_bytes": F.sum("n_input_bytes").over(w_block),
        LRN: F.row_number().over(local_window([BATCH], CHUNK, [*order, *ties])).cast("bigint"),
    })

    means = None
    if windows:  # over every row: the frames count all transactions
        means = rolling_means(j, "base_fee_per_gas", [BATCH], CHUNK, order,
                              {f"avg_base_fee_{k}": n for k, n in windows.items()},
                              bucket_rows)
    if senders is not None:
        keep = senders.select(senders.columns[0]).withColumnRenamed(senders.columns[0], "_addr")
        j = j.join(keep, j["from_address"] == keep["_addr"], "left_semi")
    if means is not None:
        j = j.join(means, [BATCH, CHUNK, LRN], "left")

    gp, bf = F.col("gas_price"), F.col("base_fee_per_gas")
    j = j.withColumns({
        "tx_gas_cost": F.col("gas_used").cast("double") * gp / F.lit(WEI_PER_ETH),
        "block_datetime": epoch_to_datetime("timestamp"),
        "block_gas_premium": ieee_div(gp, bf),
        "blockspace_percentile": ieee_div("transaction_index", "transaction_index_max") * 100,
    })
    gwei = {
        "gas_price_gwei": gp / F.lit(WEI_PER_GWEI),
        "max_priority_fee_per_gas_gwei": F.col("max_priority_fee_per_gas") / F.lit(WEI_PER_GWEI),
        "max_fee_per_gas_gwei": F.col("max_fee_per_gas") / F.lit(WEI_PER_GWEI),
        "base_fee_per_gas_gwei": bf / F.lit(WEI_PER_GWEI),
    }
    for k in windows:
        gwei[f"avg_base_fee_{k}_gwei"] = F.col(f"avg_base_fee_{k}") / F.lit(WEI_PER_GWEI)
    gwei["block_encoded_kbytes"] = F.col("block_encoded_bytes") / F.lit(1e3)
    gwei["block_calldata_kbytes"] = F.col("block_calldata_bytes") / F.lit(1e3)
    j = (j.withColumn("rounded_blockspace_percentile",
                      round_half_away("blockspace_percentile", 0))
          .withColumns(gwei)
          .drop("gas_price", "max_priority_fee_per_gas", "max_fee_per_gas",
                "base_fee_per_gas", "block_encoded_bytes", "block_calldata_bytes", LRN))
    # Full-row dedupe. ``_chunk`` (a function of block_number, so it changes
    # nothing) stays in the key until after it: the grouping then contains the
    # (block_batch, _chunk) partitioning and no extra exchange is planned.
    return fill_nan(j).dropDuplicates().drop(CHUNK)


def extend_txs_blocks_mempool(txs: DataFrame, blocks: DataFrame, mempool: DataFrame,
                              **kw) -> DataFrame:
    """Q2: ``extend_txs_blocks`` with mempool sightings joined on hash."""
    return extend_txs_blocks(txs, blocks, mempool, **kw)


def rollup_transactions(txs: DataFrame, blocks: DataFrame, labels: DataFrame,
                        mempool: DataFrame | None = None, **kw) -> DataFrame:
    """Q3 fused: the same table as ``label_rollups(extend_txs_blocks(...))``,
    with the sequencer filter applied right after the windows, so derived
    columns and the dedupe only see sequencer transactions (about 1% of rows
    on mainnet)."""
    lab = labels.select("sequencer_addresses", "sequencer_names")
    ext = extend_txs_blocks(txs, blocks, mempool, senders=lab.select("sequencer_addresses"), **kw)
    return label_rollups(ext, lab)


def label_rollups(extended: DataFrame, labels: DataFrame) -> DataFrame:
    """Q3: keep transactions sent by a labelled sequencer, add its name.

    The surveyed job does a left join and then keeps labelled rows, which is an
    inner join. The label table is small; AQE broadcasts it after checking its
    runtime size, and falls back to a shuffle join if it is not.
    """
    lab = labels.select("sequencer_addresses", "sequencer_names")
    out = extended.join(lab, extended["from_address"] == lab["sequencer_addresses"], "inner")
    return out.drop("sequencer_addresses", "timestamp", "block_number_right")
