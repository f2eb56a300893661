"""Swap sign, left joins that keep rows, and 256-bit word decoding."""

from pyspark.sql import functions as F

from chainlens.operators.swaps import swap_net_amounts, swaps_enriched
from chainlens.sources.logs import decode_logs, parse_signature, word_to_double

SW = ("block_number long, transaction_hash string, address string, event__to string, "
      "event__sender string, event__amount0In_f64 double, event__amount1In_f64 double, "
      "event__amount0Out_f64 double, event__amount1Out_f64 double")


def test_swap_sign(spark):
    df = spark.createDataFrame([(1, "h1", "p", "t", "s", 5.0, 0.0, 0.0, 3.0),
                                (2, "h2", "p", "t", "s", 0.0, 4.0, 2.0, 0.0)], SW)
    out = {r["swaps_transaction_id"]: r for r in swap_net_amounts(df).collect()}
    assert (out["h1"]["swaps_amount0"], out["h1"]["swaps_amount1"]) == (5.0, -3.0)
    assert (out["h2"]["swaps_amount0"], out["h2"]["swaps_amount1"]) == (-2.0, 4.0)


def test_missing_pool_and_token_keep_rows(spark):
    sw = spark.createDataFrame([(1, "h1", "p1", "t", "s", 1.0, 0.0, 0.0, 1.0),
                                (2, "h2", "p9", "t", "s", 1.0, 0.0, 0.0, 1.0)], SW)
    pools = spark.createDataFrame([("p1", "A", "Z")], "event__pair string, event__token0 string, event__token1 string")
    tokens = spark.createDataFrame([("A", "Alpha", "AL", 18)], "erc20 string, name string, symbol string, decimals long")
    out = {r["swaps_transaction_id"]: r for r in swaps_enriched(swap_net_amounts(sw), pools, tokens).collect()}
    assert len(out) == 2
    assert out["h1"]["name"] == "Alpha" and out["h1"]["name_token1"] is None
    assert out["h2"]["event__token0"] is None


def test_word_to_double(spark):
    words = ["0" * 47 + "1" + "0" * 16,           # 2^64
             "8" + "0" * 63,                      # 2^255
             "0" * 64]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(word_to_double(F.col("w"))).collect()]
    assert got == [2.0 ** 64, 2.0 ** 255, 0.0]


def test_parse_signature_unnamed_param():
    name, ps = parse_signature("PairCreated(address indexed token0, address indexed token1, address pair, uint)")
    assert name == "PairCreated" and [p.name for p in ps] == ["token0", "token1", "pair", "arg3"]
    assert [p.indexed for p in ps] == [True, True, False, False]


def test_decode_topics_and_data(spark):
    addr = "00" * 12 + "ab" * 20
    data = "0x" + "0" * 63 + "7" + addr
    logs = spark.createDataFrame([(1, "h", "0xc", "0xT", "0x" + addr, data)],
                                 "block_number long, transaction_hash string, address string, "
                                 "topic0 string, topic1 string, data string")
    r = decode_logs(logs, "E(address indexed a, uint x, address b)", "0xt").collect()[0]
    assert r["event__a"] == "0x" + "ab" * 20 and r["event__b"] == "0x" + "ab" * 20
    assert r["event__x_f64"] == 7.0


def test_log_filters_reach_the_scan(spark, tmp_path):
    """On any 50 rows: the logs of the event are kept whatever their case, and the filters are pushed."""
    from chainlens.constants import SWAP_TOPIC0
    from chainlens.operators.swaps import decode_swap_logs
    from chainlens.sources import standins as S
    from chainlens.sources.logs import ingest_logs

    all_logs = S.raw_swap_logs(spark, "/root/testdata/sf0.001").cache()
    for seed in (1, 2):
        some = all_logs.orderBy(F.xxhash64("transaction_hash", F.lit(seed))).limit(50).cache()
        want = some.filter(F.lower("topic0") == SWAP_TOPIC0)
        assert 0 < want.count() < 50 and want.filter(F.col("topic0") != SWAP_TOPIC0).count() > 0
        logs = ingest_logs(some, str(tmp_path / f"logs-{seed}"))
        df = decode_swap_logs(logs, [some.first()["address"]], lower_hex=True)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(topic0," in plan and "IsNotNull(address)" in plan.split("PushedFilters")[1]
        assert decode_swap_logs(logs, lower_hex=True).count() == want.count() == decode_swap_logs(some).count()


def test_mixed_case_is_kept_without_ingest(spark):
    from chainlens.constants import PAIR_CREATED_TOPIC0
    from chainlens.operators.swaps import decode_pair_logs

    word = "0x" + "0" * 24 + "AB" * 20
    rows = [(1, "h", "0xAbC", t, word, word, "0x" + "0" * 24 + "cd" * 20 + "0" * 63 + "1") for t in (
        PAIR_CREATED_TOPIC0, "0x" + PAIR_CREATED_TOPIC0[2:].upper())]
    logs = spark.createDataFrame(rows, "block_number long, transaction_hash string, address string, topic0 string, "
                                       "topic1 string, topic2 string, data string")
    got = decode_pair_logs(logs, "0xaBc").collect()
    assert [r["event__token0"] for r in got] == ["0x" + "ab" * 20] * 2
