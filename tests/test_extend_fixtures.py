"""Hand fixtures for the enrichment (FIXTURES.md §3)."""

import math

import pytest

from chainlens.operators.extend import extend_txs_blocks, label_rollups

TX = ("block_number long, transaction_index long, transaction_hash string, from_address string, "
      "gas_used long, gas_price long, max_priority_fee_per_gas long, max_fee_per_gas long, "
      "n_input_bytes long, n_input_zero_bytes long, n_input_nonzero_bytes long, n_rlp_bytes long, "
      "block_batch long")
BL = "block_number long, timestamp long, base_fee_per_gas long, gas_used long, block_batch long"


def tx(block, idx, price=100, gas=21000, batch=0, h=None):
    return (block, idx, h or f"0x{block}-{idx}", "a", gas, price, 1, 2 * price, 10, 1, 9, 120, batch)


def run(spark, txs, blocks, mempool=None, windows=None):
    t = spark.createDataFrame(txs, TX)
    b = spark.createDataFrame(blocks, BL)
    m = None
    if mempool is not None:
        m = spark.createDataFrame(mempool, "hash string, seen_at string")
    return extend_txs_blocks(t, b, m, windows=windows or {"m": 2}, chunk_blocks=2, bucket_rows=4)


def test_single_tx_block_percentile_zero(spark):
    r = run(spark, [tx(1, 0)], [(1, 86400, 50, 1000, 0)]).collect()[0]
    assert r["transaction_index_max"] == 0
    assert r["blockspace_percentile"] == 0.0 and r["rounded_blockspace_percentile"] == 0.0


def test_zero_base_fee_inf_and_nan(spark):
    rows = run(spark, [tx(1, 0, price=5), tx(2, 0, price=0)],
               [(1, 0, 0, 1, 0), (2, 0, 0, 1, 0)]).collect()
    by = {r["block_number"]: r for r in rows}
    assert by[1]["block_gas_premium"] == math.inf      # x/0 stays inf
    assert by[2]["block_gas_premium"] == 0.0           # 0/0 = NaN -> 0


def test_null_base_fee_and_missing_block_stay_null(spark):
    rows = run(spark, [tx(1, 0), tx(9, 0)], [(1, 0, None, 1, 0)]).collect()
    by = {r["block_number"]: r for r in rows}
    assert by[1]["block_gas_premium"] is None and by[1]["base_fee_per_gas_gwei"] is None
    assert by[9]["block_datetime"] is None and by[9]["gas_used_block"] is None


def test_duplicate_rows_deduplicated_after_windows(spark):
    rows = run(spark, [tx(1, 0), tx(1, 0), tx(1, 1)], [(1, 0, 50, 1, 0)]).collect()
    # the duplicate pair sits at positions 1 and 2; with a 2-row window their
    # means differ (null vs 50), so both survive; with a 1-row window they merge
    assert len(rows) == 3
    rows1 = run(spark, [tx(1, 0), tx(1, 0), tx(1, 1)], [(1, 0, 50, 1, 0)], windows={"m": 1}).collect()
    assert len(rows1) == 2


def test_mempool_empty_and_absent(spark):
    txs = [tx(1, 0), tx(1, 1)]
    blocks = [(1, 0, 50, 1, 0)]
    with_m = run(spark, txs, blocks, mempool=[])
    without = run(spark, txs, blocks)
    assert with_m.count() == without.count() == 2
    assert "seen_at" in with_m.columns and "seen_at" not in without.columns
    hit = run(spark, txs, blocks, mempool=[("0x1-0", "t")]).collect()
    assert sorted(r["seen_at"] or "" for r in hit) == ["", "t"]


def test_rolling_window_restarts_per_batch(spark):
    txs = [tx(b, 0, batch=0) for b in range(5)] + [tx(b, 0, batch=1) for b in range(5, 10)]
    blocks = [(b, 0, 10 * (b + 1), 1, 0 if b < 5 else 1) for b in range(10)]
    rows = run(spark, txs, blocks, windows={"m": 3}).collect()
    by = {r["block_number"]: r["avg_base_fee_m"] for r in rows}
    assert by[0] is None and by[1] is None and by[2] == 20.0 and by[4] == 40.0
    assert by[5] is None and by[6] is None and by[7] == 70.0


def test_label_join_keeps_labelled_only(spark):
    ext = run(spark, [tx(1, 0), (1, 1, "0xb", "b", 1, 1, 1, 1, 1, 0, 1, 1, 0)], [(1, 0, 5, 1, 0)])
    labels = spark.createDataFrame([("a", "arbitrum")], "sequencer_addresses string, sequencer_names string")
    out = label_rollups(ext, labels).collect()
    assert len(out) == 1 and out[0]["sequencer_names"] == "arbitrum"
    assert "timestamp" not in label_rollups(ext, labels).columns


def test_mempool_clashing_columns_get_suffix(spark):
    t = spark.createDataFrame([tx(1, 0)], TX)
    b = spark.createDataFrame([(1, 0, 50, 1, 0)], BL)
    m = spark.createDataFrame([("0x1-0", 999)], "hash string, gas_used long")
    r = extend_txs_blocks(t, b, m, windows={"m": 1}).collect()[0]
    assert r["gas_used"] == 21000 and r["gas_used_mempool"] == 999 and r["gas_used_block"] == 1


def test_batch_on_one_side_only_is_rejected(spark):
    t = spark.createDataFrame([tx(1, 0)], TX)
    b = spark.createDataFrame([(1, 0, 50, 1, 0)], BL).drop("block_batch")
    with pytest.raises(ValueError):
        extend_txs_blocks(t, b)
    r = extend_txs_blocks(t.drop("block_batch"), b, windows={"m": 1}).collect()[0]
    assert r["block_batch"] == 0 and r["avg_base_fee_m"] == 50.0
