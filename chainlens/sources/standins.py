"""Stand-in views: the driver's TPC-H-ish tables projected into the block-data
schemas the library works on (see FIXTURES.md §2).

Each Spark builder has a DuckDB twin in ``STANDIN_SQL`` so the oracle queries
read exactly the same derived tables. Measures are integer-valued on purpose:
sums and means are then exact in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainlens.constants import PAIR_CREATED_TOPIC0, SEQUENCER_NAMES, SWAP_TOPIC0
from chainlens.functions.numeric import to_epoch_seconds
from chainlens.functions.series import chunk_col
from chainlens.operators.extend import DEFAULT_CHUNK_BLOCKS

BLOCKS_PER_BATCH = 5000

LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "l_shipdate",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _batch(c: str, per_batch: int) -> F.Column:
    return F.floor(F.col(c) / F.lit(per_batch)).cast("bigint")


def blocks(spark: SparkSession, sf_dir: str, per_batch: int = BLOCKS_PER_BATCH) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("block_number"),
        to_epoch_seconds("o_orderdate").alias("timestamp"),
        (F.round(F.col("o_totalprice") * 100).cast("bigint") * 1000).alias("base_fee_per_gas"),
        ((F.col("o_custkey") + 1) * 1000).alias("gas_used"),
        _batch("o_orderkey", per_batch).alias("block_batch"),
    )


def _lineitem_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items numbered within their order. Orders go by batch and chunk of order numbers, the
    places ``extend`` and batched folders put them, so that rows are not shuffled again there."""
    li = read_table(spark, sf_dir, "lineitem")
    places = [_batch("l_orderkey", BLOCKS_PER_BATCH), chunk_col("l_orderkey", DEFAULT_CHUNK_BLOCKS)]
    w = Window.partitionBy(*places, "l_orderkey").orderBy(*LINEITEM_COLS)
    # the hash reads its order off the window: a filter on it stays above, and the exchange below is reused
    return li.repartition(*places).withColumns({"idx": (F.row_number().over(w) - 1).cast("bigint"),
                                                "_order": F.lag("l_orderkey", 0).over(w)})


def _tx_hash() -> F.Column:
    return F.concat(F.lit("0x"), F.col("_order").cast("string"), F.lit("-"),
                    F.col("idx").cast("string"))


def transactions(spark: SparkSession, sf_dir: str, per_batch: int = BLOCKS_PER_BATCH,
                 extra: bool = False) -> DataFrame:
    li = _lineitem_indexed(spark, sf_dir)
    gas_price = F.round(F.col("l_extendedprice") * 100).cast("bigint") * 1000
    n_in = (F.col("l_partkey") % 2000) * 997
    cols = [
        F.col("l_orderkey").alias("block_number"),
        F.col("idx").alias("transaction_index"),
        _tx_hash().alias("transaction_hash"),
        F.col("l_suppkey").cast("string").alias("from_address"),
        (F.col("l_quantity") * 3000000).cast("bigint").alias("gas_used"),
        gas_price.alias("gas_price"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("max_priority_fee_per_gas"),
        F.when(F.col("l_returnflag") == "A", F.lit(None).cast("bigint"))
         .otherwise(gas_price * 2).alias("max_fee_per_gas"),
        n_in.alias("n_input_bytes"),
        (F.col("l_partkey") % 2000).alias("n_input_zero_bytes"),
        (n_in - F.col("l_partkey") % 2000).alias("n_input_nonzero_bytes"),
        (n_in + 110).alias("n_rlp_bytes"),
        _batch("l_orderkey", per_batch).alias("block_batch"),
    ]
    if extra:
        cols += [F.col("l_returnflag"), F.col("l_shipdate")]
    return li.select(*cols)


def sequencer_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    names = F.array(*[F.lit(n) for n in SEQUENCER_NAMES])
    return (s.filter(F.col("s_suppkey") < len(SEQUENCER_NAMES))
             .select(F.col("s_suppkey").cast("string").alias("sequencer_addresses"),
                     F.element_at(names, (F.col("s_suppkey") + 1).cast("int"))
                      .alias("sequencer_names")))


def mempool(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = transactions(spark, sf_dir, extra=True)
    seen = t.filter(F.col("l_returnflag") == "R").select(
        F.col("transaction_hash").alias("hash"), F.col("l_shipdate").alias("seen_at"), "transaction_index")
    again = seen.filter("transaction_index % 3 = 0").withColumn("seen_at", F.expr("seen_at + INTERVAL 1 DAY"))
    return seen.unionByName(again).drop("transaction_index")


def block_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("block_number"),
        F.col("ts").alias("block_datetime"),
        (F.round(F.col("value") * 100).cast("bigint") * 10000000).alias("base_fee_per_gas"),
        F.col("user_id").alias("gas_used"),
        F.col("event_type").alias("series"),
    )


def univ2_swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lineitem_indexed(spark, sf_dir)
    is_a = F.col("l_returnflag") == "A"
    q = F.col("l_quantity")
    zero = F.lit(0.0)
    return li.select(
        F.col("l_orderkey").alias("block_number"),
        _tx_hash().alias("transaction_hash"),
        F.col("l_partkey").cast("string").alias("address"),
        F.col("l_orderkey").cast("string").alias("event__to"),
        F.col("l_suppkey").cast("string").alias("event__sender"),
        F.when(is_a, q).otherwise(zero).alias("event__amount0In_f64"),
        F.when(~is_a, q).otherwise(zero).alias("event__amount1In_f64"),
        F.when(~is_a, q).otherwise(zero).alias("event__amount0Out_f64"),
        F.when(is_a, q).otherwise(zero).alias("event__amount1Out_f64"),
    )


def univ2_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.cast("string").alias("event__pair"),
        (k % 25).cast("string").alias("event__token0"),
        ((k % 25 + 1 + k % 7) % 25).cast("string").alias("event__token1"),
    )


def univ2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("string").alias("erc20"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("symbol"),
        (F.col("n_regionkey") + 6).cast("bigint").alias("decimals"),
    )


def mixed_case(value: str) -> str:
    """A hex string with its first half in capital letters (some logs come that way)."""
    return "0x" + value[2:len(value) // 2].upper() + value[len(value) // 2:]


def _word(c: F.Column) -> F.Column:
    """A non-negative integer as one 32-byte ABI word: 64 lower-case hex chars."""
    return F.lpad(F.lower(F.hex(c.cast("bigint"))), 64, "0")


def raw_swap_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undecoded Swap logs: topics hold indexed sender / to, data the amounts."""
    s = univ2_swaps(spark, sf_dir)
    return s.select(
        "block_number", "transaction_hash", "address",
        F.when(F.col("block_number") % 10 == 3, F.lit(PAIR_CREATED_TOPIC0))
         .when(F.col("block_number") % 10 == 7, F.lit(mixed_case(SWAP_TOPIC0))).otherwise(F.lit(SWAP_TOPIC0)).alias("topic0"),
        F.concat(F.lit("0x"), _word(F.col("event__sender"))).alias("topic1"),
        F.concat(F.lit("0x"), _word(F.col("event__to"))).alias("topic2"),
        F.concat(F.lit("0x"),
                 _word(F.col("event__amount0In_f64")), _word(F.col("event__amount1In_f64")),
                 _word(F.col("event__amount0Out_f64")), _word(F.col("event__amount1Out_f64")),
                 ).alias("data"),
    )


def raw_pair_logs(spark: SparkSession, sf_dir: str, factory: str) -> DataFrame:
    """Undecoded PairCreated logs: topics hold token0 / token1, data pair + index."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("block_number"),
        F.concat(F.lit("0xpair-"), k.cast("string")).alias("transaction_hash"),
        F.when(k % 10 == 4, F.lit("0x" + "0" * 40)).when(k % 10 == 7, F.lit(mixed_case(factory)))
         .otherwise(F.lit(factory)).alias("address"),
        F.lit(PAIR_CREATED_TOPIC0).alias("topic0"),
        F.concat(F.lit("0x"), _word(k % 25)).alias("topic1"),
        F.concat(F.lit("0x"), _word((k % 25 + 1 + k % 7) % 25)).alias("topic2"),
        F.concat(F.lit("0x"), _word(k), _word(k + 1)).alias("data"),
    )


# ---------------------------------------------------------------------------
# DuckDB twins (CTE bodies). Same expressions; DuckDB spellings differ only in
# casts (VARCHAR) and epoch().
# ---------------------------------------------------------------------------

_LI_ORDER = ", ".join(LINEITEM_COLS)
_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in SEQUENCER_NAMES) + "]"


def _word_sql(e: str) -> str:
    return f"lpad(lower(hex(CAST({e} AS BIGINT))), 64, '0')"


STANDIN_SQL = {
    "blocks": f"""
SELECT o_orderkey AS block_number,
       CAST(epoch(o_orderdate) AS BIGINT) AS timestamp,
       CAST(round(o_totalprice * 100) AS BIGINT) * 1000 AS base_fee_per_gas,
       (o_custkey + 1) * 1000 AS gas_used,
       CAST(floor(o_orderkey / {BLOCKS_PER_BATCH}) AS BIGINT) AS block_batch
FROM orders""",
    "li_idx": f"""
SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LI_ORDER}) - 1 AS idx
FROM lineitem""",
    "transactions": f"""
SELECT l_orderkey AS block_number,
       CAST(idx AS BIGINT) AS transaction_index,
       concat('0x', CAST(l_orderkey AS VARCHAR), '-', CAST(idx AS VARCHAR)) AS transaction_hash,
       CAST(l_suppkey AS VARCHAR) AS from_address,
       CAST(l_quantity * 3000000 AS BIGINT) AS gas_used,
       CAST(round(l_extendedprice * 100) AS BIGINT) * 1000 AS gas_price,
       CAST(round(l_tax * 100) AS BIGINT) AS max_priority_fee_per_gas,
       CASE WHEN l_returnflag = 'A' THEN NULL
            ELSE CAST(round(l_extendedprice * 100) AS BIGINT) * 2000 END AS max_fee_per_gas,
       (l_partkey % 2000) * 997 AS n_input_bytes,
       l_partkey % 2000 AS n_input_zero_bytes,
       (l_partkey % 2000) * 997 - l_partkey % 2000 AS n_input_nonzero_bytes,
       (l_partkey % 2000) * 997 + 110 AS n_rlp_bytes,
       CAST(floor(l_orderkey / {BLOCKS_PER_BATCH}) AS BIGINT) AS block_batch,
       l_returnflag, l_shipdate
FROM li_idx""",
    "sequencer_labels": f"""
SELECT CAST(s_suppkey AS VARCHAR) AS sequencer_addresses,
       {_NAMES_SQL}[s_suppkey + 1] AS sequencer_names
FROM supplier WHERE s_suppkey < {len(SEQUENCER_NAMES)}""",
    "mempool": """
SELECT transaction_hash AS hash, l_shipdate AS seen_at
FROM transactions WHERE l_returnflag = 'R'
UNION ALL
SELECT transaction_hash, l_shipdate + INTERVAL 1 DAY
FROM transactions WHERE l_returnflag = 'R' AND transaction_index % 3 = 0""",
    "block_series": """
SELECT event_id AS block_number, ts AS block_datetime,
       CAST(round(value * 100) AS BIGINT) * 10000000 AS base_fee_per_gas,
       user_id AS gas_used, event_type AS series
FROM events""",
    "univ2_swaps": """
SELECT l_orderkey AS block_number,
       concat('0x', CAST(l_orderkey AS VARCHAR), '-', CAST(idx AS VARCHAR)) AS transaction_hash,
       CAST(l_partkey AS VARCHAR) AS address,
       CAST(l_orderkey AS VARCHAR) AS event__to,
       CAST(l_suppkey AS VARCHAR) AS event__sender,
       CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0.0 END AS event__amount0In_f64,
       CASE WHEN l_returnflag <> 'A' THEN l_quantity ELSE 0.0 END AS event__amount1In_f64,
       CASE WHEN l_returnflag <> 'A' THEN l_quantity ELSE 0.0 END AS event__amount0Out_f64,
       CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0.0 END AS event__amount1Out_f64
FROM li_idx""",
    "univ2_pools": """
SELECT CAST(p_partkey AS VARCHAR) AS event__pair,
       CAST(p_partkey % 25 AS VARCHAR) AS event__token0,
       CAST((p_partkey % 25 + 1 + p_partkey % 7) % 25 AS VARCHAR) AS event__token1
FROM part""",
    "univ2_tokens": """
SELECT CAST(n_nationkey AS VARCHAR) AS erc20, n_name AS name,
       concat('T', CAST(n_nationkey AS VARCHAR)) AS symbol,
       CAST(n_regionkey + 6 AS BIGINT) AS decimals
FROM nation""",
    "raw_swap_logs": f"""
SELECT block_number, transaction_hash, address,
       CASE WHEN block_number % 10 = 3 THEN '{PAIR_CREATED_TOPIC0}'
            WHEN block_number % 10 = 7 THEN '{mixed_case(SWAP_TOPIC0)}' ELSE '{SWAP_TOPIC0}' END AS topic0,
       '0x' || {_word_sql('event__sender')} AS topic1,
       '0x' || {_word_sql('event__to')} AS topic2,
       '0x' || {_word_sql('event__amount0In_f64')} || {_word_sql('event__amount1In_f64')}
            || {_word_sql('event__amount0Out_f64')} || {_word_sql('event__amount1Out_f64')} AS data
FROM univ2_swaps""",
}


def raw_pair_logs_sql(factory: str) -> str:
    return f"""
SELECT p_partkey AS block_number,
       concat('0xpair-', CAST(p_partkey AS VARCHAR)) AS transaction_hash,
       CASE WHEN p_partkey % 10 = 4 THEN '0x{"0" * 40}' WHEN p_partkey % 10 = 7 THEN '{mixed_case(factory)}'
            ELSE '{factory}' END AS address,
       '{PAIR_CREATED_TOPIC0}' AS topic0,
       '0x' || {_word_sql('p_partkey % 25')} AS topic1,
       '0x' || {_word_sql('(p_partkey % 25 + 1 + p_partkey % 7) % 25')} AS topic2,
       '0x' || {_word_sql('p_partkey')} || {_word_sql('p_partkey + 1')} AS data
FROM part"""


# dependency order of the CTEs above
STANDIN_DEPS = {
    "blocks": [], "li_idx": [], "transactions": ["li_idx"], "sequencer_labels": [],
    "mempool": ["transactions"], "block_series": [], "univ2_swaps": ["li_idx"],
    "univ2_pools": [], "univ2_tokens": [], "raw_swap_logs": ["univ2_swaps"],
}
