"""Chunked prefix-sum rolling means and halo lags against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chainlens.functions.series import chunk_col, lag_diff, rolling_means


def _brute_rolling(pdf, n):
    out = {}
    for _, g in pdf.sort_values(["batch", "block", "idx"]).groupby("batch"):
        v = g["fee"].to_numpy(dtype=float)
        for i, key in enumerate(zip(g["batch"], g["block"], g["idx"])):
            if i + 1 < n:
                out[key] = None
                continue
            w = v[i + 1 - n:i + 1]
            out[key] = None if np.isnan(w).any() else float(w.sum()) / n
    return out


@pytest.mark.parametrize("chunk,bucket", [(1, 4), (3, 8), (1000, 1 << 16)])
def test_rolling_means_match_brute_force(spark, chunk, bucket):
    rnd = random.Random(7)
    data = []
    for batch in range(3):
        for block in range(batch * 40, batch * 40 + rnd.randint(5, 40)):
            fee = None if rnd.random() < 0.05 else rnd.randint(1, 10**9)
            for idx in range(rnd.randint(0, 6)):
                data.append((batch, block, idx, fee))
    df = spark.createDataFrame(data, "batch long, block long, idx long, fee long")
    df = df.withColumn("_chunk", chunk_col("block", chunk))
    wins = {"w1": 1, "w3": 3, "w5": 5, "w7": 7}
    means = rolling_means(df, "fee", ["batch"], "_chunk", ["block", "idx"], wins, bucket_rows=bucket)
    # join back on (batch, chunk, _lrn) the same way the enrichment does
    from chainlens.functions.series import LRN, local_window
    keyed = df.withColumn(LRN, F.row_number().over(local_window(["batch"], "_chunk", ["block", "idx"])))
    got = keyed.join(means, ["batch", "_chunk", LRN]).toPandas()
    pdf = pd.DataFrame(data, columns=["batch", "block", "idx", "fee"]).astype({"fee": float})
    for name, n in wins.items():
        exp = _brute_rolling(pdf, n)
        for r in got.itertuples():
            e = exp[(r.batch, r.block, r.idx)]
            v = getattr(r, name)
            if e is None:
                assert v is None or pd.isna(v), (name, r)
            else:
                assert v == e, (name, r, e)
    assert len(got) == len(data)


def test_rolling_restarts_per_batch_and_needs_n_non_null(spark):
    # 15 rows: batches of 4, 5 and 6 rows; one null fee in the last batch
    data = [(0, i, 0, 10) for i in range(4)] + [(1, 10 + i, 0, 20) for i in range(5)]
    data += [(2, 20 + i, 0, None if i == 1 else 30) for i in range(6)]
    df = spark.createDataFrame(data, "batch long, block long, idx long, fee long")
    df = df.withColumn("_chunk", chunk_col("block", 2))
    m = rolling_means(df, "fee", ["batch"], "_chunk", ["block", "idx"], {"m": 5}, bucket_rows=4)
    vals = [(r["batch"], r["m"]) for r in m.collect()]
    assert [v for b, v in vals if b == 0] == [None] * 4
    got1 = [v for b, v in vals if b == 1]
    assert got1.count(20.0) == 1 and got1.count(None) == 4
    assert [v for b, v in vals if b == 2] == [None] * 6  # the null fee is in every 5-row frame


def test_lag_diff_matches_shift(spark):
    rnd = random.Random(3)
    data = [(k, i, float(rnd.randint(0, 1000))) for k in ("a", "b") for i in range(0, 300, rnd.choice([1, 2]))]
    df = spark.createDataFrame(data, "key string, block long, v double")
    df = df.withColumn("_chunk", chunk_col("block", 16))
    out = lag_diff(df, {"d": "v"}, 7, ["key"], "_chunk", ["block"], bucket_rows=32).toPandas()
    pdf = pd.DataFrame(data, columns=["key", "block", "v"]).sort_values(["key", "block"])
    pdf["d"] = pdf.groupby("key")["v"].diff(7)
    m = out.merge(pdf, on=["key", "block"], suffixes=("", "_e"))
    assert len(m) == len(pdf)
    assert ((m["d"].isna() & m["d_e"].isna()) | (m["d"] == m["d_e"])).all()


def test_no_single_partition_exchange_in_keyed_series(spark):
    """Keyed series (batch, series key) never funnel rows into one task.
    (A partitionless series ranks groups of 4,096 chunks in one small window;
    rows and chunk totals stay spread.)"""
    from chainlens.plans.catalog import queries

    for name in ("extend_txs_blocks", "kalman_fee_filter"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan, name


def test_wide_rows_shuffle_once_in_enrichment(spark):
    """The full transaction rows are exchanged once, on (block_batch, _chunk);
    the per-block windows, row numbering and the final full-row dedupe reuse
    that partitioning (no exchange keyed on all output columns)."""
    import re

    from chainlens.operators.extend import extend_txs_blocks
    from chainlens.sources import standins as S

    d = "/root/testdata/sf0.001"
    df = extend_txs_blocks(S.transactions(spark, d), S.blocks(spark, d))
    plan = df._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert keys, plan
    assert not any("tx_gas_cost" in k for k in keys), keys


def test_wide_rows_shuffle_once_with_mempool(spark):
    """Of the exchanges, one carries the transactions' fees: that on (block_batch, _chunk)."""
    import re

    from chainlens.operators.extend import extend_txs_blocks
    from chainlens.plans.jobs import scratch_path, write_batches
    from chainlens.sources import standins as S

    d, path = "/root/testdata/sf0.001", scratch_path(spark, "wide")
    write_batches(S.transactions(spark, d), path)
    txs = spark.read.parquet(path)  # a stored table: the stand-in sorts its rows, which would count
    df = extend_txs_blocks(txs, S.blocks(spark, d), S.mempool(spark, d))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "repartition" in plan.lower()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = extend_txs_blocks(txs, S.blocks(spark, d), S.mempool(spark, d))._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    wide = [x for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\n]*)\]\nArguments: ([^\n]*)", text) if "max_fee_per_gas" in x[0]]
    assert {re.sub(r"#\d+L?", "", a).split("),")[0] for _, a in wide} <= {"hashpartitioning(block_batch, _chunk, 4"} and wide, wide


def test_histogram_store_runs_the_input_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from chainlens.functions.stats import histogram

    df = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") * 0.5).alias("v"))
    key = lambda h: sorted(map(tuple, h.collect()))
    stored = histogram(df, "v", 9, ["g"], store=str(tmp_path / "h"))
    assert key(stored) == key(histogram(df, "v", 9, ["g"]))
    assert "Range" not in stored._jdf.queryExecution().executedPlan().toString()
    empty = histogram(df.filter("v < 0"), "v", 9, store=str(tmp_path / "e"))
    assert empty.count() == 0


def test_kalman_chunks_equal_one_pass(spark):
    """A series longer than any sample, in many chunks, against the plain recursion."""
    import numpy as np

    from chainlens.operators import kalman as K

    rng = np.random.default_rng(3)
    n = 9000
    y = np.cumsum(rng.normal(size=n)) + rng.normal(size=n)
    rows = [("a", i, float(v), float(-v)) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "series string, block_number long, gas_used double, base_fee_per_gas double")
    s = K.numbered(df, ["series"])
    prm = K.noise_params(s, ["series"])
    p = prm.first()
    got = K.kalman_filter(s, prm, ["series"], chunk_rows=1000).orderBy("block_number").toPandas()
    x, var, want = y[0], K.P0, []
    for t in range(n):
        var = var + p.q_gas_used if t else var
        k = var / (var + p.r_gas_used)
        x, var = x + k * (y[t] - x), (1 - k) * var
        want.append(x)
    assert len(got) == n
    assert np.allclose(got.gas_used_kalman, want, rtol=1e-9, atol=1e-9)
    assert np.allclose(got.base_fee_per_gas_kalman, -np.array(want), rtol=1e-9, atol=1e-9)
    assert K.kalman_fee_filter(df, ["series"]).count() == n


def test_kalman_gains_and_scan_equal_the_recursion():
    import numpy as np

    from chainlens.operators import kalman as K

    def plain(y, q, r):
        p, x, k, out, all_k = K.P0, y[0], 1.0, [], []
        for t, v in enumerate(y):
            p = p + q if t else p
            k = p / (p + r) if p + r else 1.0
            x, p = x + k * (v - x), (1 - k) * p
            out.append(x)
            all_k.append(k)
        return np.array(out), np.array(all_k)

    rng = np.random.default_rng(8)
    for q, r in ((0.3, 2.0), (0.0, 1.0), (5.0, 0.0), (0.0, 0.0), (1e9, 3e8), (1e-9, 1e6), (1e12, 1e-3), (2.0, 1e-300)):
        y = np.cumsum(rng.normal(size=700)) * 1e3
        want, k = plain(y, q, r)
        assert np.allclose(K.gains(0, 700, q, r), k, rtol=1e-12, atol=0)
        assert np.allclose(K.gains(400, 300, q, r), k[400:], rtol=1e-12, atol=0)
        assert np.allclose(K.local_level_filter(y, q, r), want, rtol=1e-11, atol=1e-9)
        assert np.allclose(K.local_level_filter(y[400:], q, r, start=400, x=want[399]), want[400:], rtol=1e-11, atol=1e-9)
        a, b = K.chunk_map(y[400:], q, r, 400)
        assert abs(a * want[399] + b - want[-1]) <= 1e-9 * max(1, abs(want[-1]))
    assert len(K.gains(5, 0, 1.0, 1.0)) == 0 and K.local_level_filter(np.array([4.0]), 1.0, 1.0).tolist() == [4.0]


def test_positions_without_keys_across_chunk_groups(spark, monkeypatch):
    from pyspark.sql import functions as F

    from chainlens.functions import series

    monkeypatch.setattr(series, "GROUP_CHUNKS", 3)
    df = spark.range(1000).select((F.col("id") * 3).alias("b"), (F.col("id") % 7).alias("v"))
    df = df.withColumn("_chunk", series.chunk_col("b", 100)).repartition(5)
    got = series.add_positions(df, [], "_chunk", ["b"], "v").orderBy("b").collect()
    total = 0
    for k, r in enumerate(got):
        total += k % 7
        assert (r[series.RN], r[series.CS], r[series.CC]) == (k + 1, total, k + 1)


def test_wide_rows_are_exchanged_once(spark):
    """No branch of the plan filters the transactions below their exchange, so that it is reused, and
    rows that lie in their places already are not shuffled again."""
    from chainlens.operators.extend import extend_txs_blocks
    from chainlens.sources import standins as S

    d = "/root/testdata/sf0.001"
    for m in (None, S.mempool(spark, d)):
        df = extend_txs_blocks(S.transactions(spark, d, extra=m is not None), S.blocks(spark, d), m)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        scans = [x for x in plan.split("\n") if "lineitem.parquet" in x]
        assert len(scans) == 1, plan
        assert "isnotnull(FLOOR((cast(l_orderkey" not in plan


def test_rolling_means_of_sparse_values_match_brute_force(spark):
    import random

    from chainlens.functions.series import rolling_means

    rnd = random.Random(3)
    rows = [(p, i // 7, i, None if rnd.random() < 0.02 else rnd.randrange(10**15)) for p in (0, 1) for i in range(90)]
    df = spark.createDataFrame(rows, "p long, c long, i long, v long")
    got = {(r.p, r.c, r._lrn): (r.a, r.b) for r in rolling_means(df, "v", ["p"], "c", ["i"], {"a": 3, "b": 10}, 40).collect()}
    for p in (0, 1):
        v = [r[3] for r in rows if r[0] == p]
        for i in range(90):
            want = tuple(sum(f) / n if len(f := v[max(0, i - n + 1):i + 1]) == n and None not in f else None for n in (3, 10))
            assert got[p, i // 7, i % 7 + 1] == want
