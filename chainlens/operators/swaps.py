"""DEX swap queries (Q24-Q27).

Dimension joins (pools, tokens) are plain left joins: AQE broadcasts a side
once its runtime size is known to be under the threshold and otherwise keeps
a sort-merge join, whose hot pools (a few pairs carry most swaps) are split by
AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.constants import (
    PAIR_CREATED_SIGNATURE,
    PAIR_CREATED_TOPIC0,
    SWAP_SIGNATURE,
    SWAP_TOPIC0,
)
from chainlens.sources.logs import decode_logs

AMOUNTS = ["event__amount0In_f64", "event__amount1In_f64",
           "event__amount0Out_f64", "event__amount1Out_f64"]


def swap_net_amounts(swaps: DataFrame) -> DataFrame:
    """Q24: signed amount per token: the amount in if positive, else minus
    the amount out; identifiers renamed to the ``swaps_*`` vocabulary."""
    d = swaps.select("block_number", "transaction_hash", "address", "event__to",
                     *AMOUNTS, "event__sender")
    d = d.withColumns({
        "swaps_amount0": F.when(F.col("event__amount0In_f64") > 0, F.col("event__amount0In_f64"))
                          .otherwise(F.col("event__amount0Out_f64") * -1),
        "swaps_amount1": F.when(F.col("event__amount1In_f64") > 0, F.col("event__amount1In_f64"))
                          .otherwise(F.col("event__amount1Out_f64") * -1),
    })
    return (d.withColumnsRenamed({
                "transaction_hash": "swaps_transaction_id",
                "address": "swaps_pool_id",
                "event__to": "swaps_recipient",
                "event__sender": "swaps_sender"})
             .drop(*AMOUNTS))


def swaps_enriched(net: DataFrame, pools: DataFrame, tokens: DataFrame) -> DataFrame:
    """Q25: swap -> pool (token pair) -> token0 metadata -> token1 metadata.

    As in the reference, token0's columns keep their plain names
    (name, symbol, decimals) and token1's get the ``_token1`` suffix."""
    p = pools.select(F.col("event__pair").alias("swaps_pool_id"), "event__token0", "event__token1")
    t = tokens.select("erc20", "name", "symbol", "decimals")
    t0 = t.withColumnRenamed("erc20", "event__token0")
    t1 = t.withColumnsRenamed({"erc20": "event__token1", "name": "name_token1",
                               "symbol": "symbol_token1", "decimals": "decimals_token1"})
    return (net.join(p, "swaps_pool_id", "left")
               .join(t0, "event__token0", "left")
               .join(t1, "event__token1", "left"))


def pool_token_list(pools: DataFrame) -> DataFrame:
    """Q26: distinct tokens appearing on either side of any pool."""
    return (pools.select(F.col("event__token0").alias("token"))
                 .union(pools.select(F.col("event__token1").alias("token")))
                 .distinct())


def decode_swap_logs(raw_logs: DataFrame, contracts: list[str] | None = None, lower_hex: bool = False) -> DataFrame:
    """Uniswap V2 ``Swap`` logs -> decoded swap table. The case of hex does not
    count; ``lower_hex`` says that it is lower in storage (``sources.logs.ingest_logs``)."""
    return decode_logs(raw_logs, SWAP_SIGNATURE, SWAP_TOPIC0, contracts, lower_hex=lower_hex)


def decode_pair_logs(raw_logs: DataFrame, factory: str | None = None, lower_hex: bool = False) -> DataFrame:
    """``PairCreated`` logs of the factory -> pool table."""
    return decode_logs(raw_logs, PAIR_CREATED_SIGNATURE, PAIR_CREATED_TOPIC0,
                       [factory] if factory else None, lower_hex=lower_hex)
