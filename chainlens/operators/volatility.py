"""Base-fee volatility and distribution queries (Q18-Q20, Q23).

Row lags over block order use ``functions.series.lag_diff`` (chunked row
positions + halo buckets), never a global ``Window.orderBy``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.constants import WEI_PER_GWEI
from chainlens.functions.numeric import round_half_away
from chainlens.functions.series import chunk_col, lag_diff
from chainlens.functions.stats import histogram, unbiased_kurt, unbiased_skew

DEFAULT_CHUNK_BLOCKS = 4096


def block_volatility(blocks: DataFrame, n: int = 1, by: Sequence[str] = (),
                     chunk_blocks: int = DEFAULT_CHUNK_BLOCKS,
                     bucket_rows: int | None = None) -> DataFrame:
    """Q18: base fee in gwei and its ``n``-row difference, plus the gas-used
    difference, in block order (per ``by`` key if given)."""
    d = (blocks.withColumn("base_fee_per_gas_gwei",
                           F.col("base_fee_per_gas") / F.lit(WEI_PER_GWEI))
               .withColumn("_chunk", chunk_col("block_number", chunk_blocks)))
    out = lag_diff(d, {"base_fee_per_gas_gwei_diff": "base_fee_per_gas_gwei",
                       "gas_used_diff": "gas_used"},
                   n, list(by), "_chunk", ["block_number"], bucket_rows)
    return out.drop("_chunk")


def _r(c, decimals):
    return c if decimals is None else round_half_away(c, decimals)


def volatility_moments(vol: DataFrame, column: str = "base_fee_per_gas_gwei_diff",
                       decimals: int | None = None) -> DataFrame:
    """Q19: mean, population variance, biased skewness and excess kurtosis of
    ``column`` with nulls (the first n rows) taken as 0."""
    x = F.coalesce(F.col(column), F.lit(0.0))
    return vol.agg(
        _r(F.avg(x), decimals).alias("mean"),
        _r(F.var_pop(x), decimals).alias("variance"),
        _r(F.skewness(x), decimals).alias("skewness"),
        _r(F.kurtosis(x), decimals).alias("kurtosis"),
    )


def fee_zscore_kurtosis(vol: DataFrame, column: str = "base_fee_per_gas_gwei",
                        decimals: int | None = None) -> DataFrame:
    """Q20: excess kurtosis of the z-scored fee (SciPy style), and pandas'
    bias-corrected kurtosis and skewness of the fee.

    Kurtosis is invariant under the z-score's shift and scale, so all three
    come from one aggregation pass (the oracle z-scores first and so checks
    this). A constant series has no kurtosis: null, where SciPy gives NaN."""
    x = F.col(column)
    agg = vol.agg(F.kurtosis(x).alias("_k"), F.skewness(x).alias("_s"), F.count(x).alias("_n"))
    return agg.select(
        _r(F.col("_k"), decimals).alias("zscore_kurtosis"),
        _r(unbiased_kurt(F.col("_k"), F.col("_n")), decimals).alias("kurt"),
        _r(unbiased_skew(F.col("_s"), F.col("_n")), decimals).alias("skew"),
    )


def fee_zscore(vol: DataFrame, column: str = "base_fee_per_gas_gwei",
               decimals: int | None = None) -> DataFrame:
    """The z-score of ``column`` over the whole table as ``zscore`` (null for a
    constant series); mean and deviation are scalar subqueries."""
    b = vol.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s"))
    z = (F.col(column) - b.select("m").scalar()) / F.nullif(b.select("s").scalar(), F.lit(0.0))
    return vol.withColumn("zscore", _r(z, decimals))


def diff_histogram(df: DataFrame, column: str, bins: int,
                   view: tuple[float, float] | None = None, by: Sequence[str] = (), store: str | None = None) -> DataFrame:
    """Q23: equi-width histogram of a difference column. Bins span the data;
    ``view`` (axis limits) only keeps the bins that overlap it. ``store``: see
    ``stats.histogram``."""
    h = histogram(df, column, bins, by=by, store=store)
    if view is not None:
        h = h.filter((F.col("bin_hi") >= view[0]) & (F.col("bin_lo") <= view[1]))
    return h
