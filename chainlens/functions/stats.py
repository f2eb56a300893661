"""Distribution helpers: equi-width histograms and moments, all native.

Global bounds (min / max, mean / stddev) are attached as *scalar subqueries*
(``DataFrame.scalar()``): Spark computes the one-row aggregate once and inlines
the value, so there is no join, no cross product and no single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = (),
              lo: float | None = None, hi: float | None = None, store: str | None = None) -> DataFrame:
    """Equi-width histogram of ``value`` (nulls and NaN skipped).

    Bounds default to the data's min / max; with explicit view limits values
    outside ``[lo, hi]`` are left out. The top edge falls in the last bin.
    Returns ``(*by, bin, bin_lo, bin_hi, n)`` for non-empty bins.

    Two passes over the input: the bounds are a plain min / max, and values are
    binned before the exchange, so both combine map-side and only bins are
    shuffled. Where the input is dear to compute, name a folder as ``store``: the
    groups and values alone are written there first (now, not lazily), so that the
    input runs once and both passes read these columns.
    """
    x = F.col(value).cast("double")
    d = df.filter(x.isNotNull() & ~F.isnan(x))
    if lo is not None:
        d = d.filter(x >= F.lit(float(lo)))
    if hi is not None:
        d = d.filter(x <= F.lit(float(hi)))
    d = d.select(*by, x.alias("_x"))
    if store is not None:
        d.write.mode("overwrite").parquet(store)
        d = df.sparkSession.read.schema(d.schema).parquet(store)
    if lo is None or hi is None:
        span = d.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
    lo_c = F.lit(float(lo)) if lo is not None else span.getField("lo")
    hi_c = F.lit(float(hi)) if hi is not None else span.getField("hi")
    width = (hi_c - lo_c) / F.lit(float(bins))
    b = F.when(width > 0, F.least(F.floor((F.col("_x") - lo_c) / width), F.lit(bins - 1))) \
         .otherwise(F.lit(0)).cast("bigint")
    out = d.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumns({
        "bin_lo": lo_c + F.col("bin") * width,
        "bin_hi": lo_c + (F.col("bin") + 1) * width,
    }).select(*by, "bin", "bin_lo", "bin_hi", "n")


def unbiased_skew(g1: Column, n: Column) -> Column:
    """pandas ``skew``: G1 = g1 * sqrt(n (n-1)) / (n-2)."""
    n = n.cast("double")
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def unbiased_kurt(g2: Column, n: Column) -> Column:
    """pandas ``kurt``: G2 = (n-1) / ((n-2)(n-3)) * ((n+1) g2 + 6)."""
    n = n.cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
