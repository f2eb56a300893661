"""Kalman smoothing of base fee and gas used over keyed block series (K1, K2,
Q21, Q22).

Re-aimed from a single jointly EM-fitted 2-D model to independent univariate
*local-level* filters, one per (series, variable):

    predict  P <- P + Q            (not on the first observation)
    gain     K  = P / (P + R)      (K = 1 when P + R = 0)
    update   x <- x + K (y - x),  P <- (1 - K) P

with the state starting at the first observation and P0 = 1 (the reference's
initial covariance diagonal). Noise variances come from moments of the first
difference d of each series (K2), native aggregates with no UDF:

    R = max(-cov(d_t, d_{t-1}), 0),   Q = max(var(d) - 2 R, 0)

This does not reproduce the EM fit's numbers; it is the standard moment
estimator for the same model family.

Scale: the filter spans whole series of any length. The gains do not depend on the data
and have a closed form in the row number, and a step is an affine map of the state, so a
chunk of a series is filtered by an associative scan over numpy arrays (no loop over
rows), and chunks are composed along the series (one row per chunk). Each
``applyInPandas`` group holds one chunk. ``tail_sample`` is the surveyed 7,600-block
sample, for callers that want it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlens.constants import WEI_PER_GWEI
from chainlens.functions.numeric import round_half_away
from chainlens.functions.series import RN, add_positions, chunk_col, lag_positions

#: rows of a series that one task filters; the filter itself spans all chunks
CHUNK_ROWS = 65_536
P0 = 1.0
VARS = ("gas_used", "base_fee_per_gas")


def numbered(df: DataFrame, by: Sequence[str], order: str = "block_number",
             chunk_blocks: int = 4096) -> DataFrame:
    """All rows of each ``by`` group with ``_rn``, their 1-based position in ``order``."""
    d = df.withColumn("_chunk", chunk_col(order, chunk_blocks))
    return add_positions(d, list(by), "_chunk", [order]).drop("_chunk", "_lrn")


def tail_sample(df: DataFrame, by: Sequence[str], n: int, order: str = "block_number",
                chunk_blocks: int = 4096) -> DataFrame:
    """The last ``n`` rows of each ``by`` group in ``order`` (a sampling
    operator: the limit is the feature). Adds ``_rn`` (1-based in group)."""
    by = list(by)
    pos = numbered(df, by, order, chunk_blocks)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    return (pos.join(sizes, by, "inner")
               .filter(F.col(RN) > F.col("_size") - n)
               .withColumn(RN, F.col(RN) - F.greatest(F.col("_size") - n, F.lit(0)))
               .drop("_size"))


def noise_params(sample: DataFrame, by: Sequence[str], cols: Sequence[str] = VARS) -> DataFrame:
    """K2: per group and variable, ``q_<col>`` and ``r_<col>`` from moments of
    the first difference. ``sample`` must carry ``_rn``."""
    by = list(by)
    lag = lag_positions(sample.select(*by, RN, *cols), by, list(cols), [1, 2])
    aggs = []
    for c in cols:
        d = F.col(c).cast("double") - F.col(f"_lag1_{c}")
        dp = F.col(f"_lag1_{c}").cast("double") - F.col(f"_lag2_{c}")
        aggs += [F.var_pop(d).alias(f"_v_{c}"), F.covar_pop(d, dp).alias(f"_c_{c}")]
    m = lag.groupBy(*by).agg(*aggs)
    out = {}
    for c in cols:
        r = F.greatest(-F.coalesce(F.col(f"_c_{c}"), F.lit(0.0)), F.lit(0.0))
        out[f"r_{c}"] = r
        out[f"q_{c}"] = F.greatest(F.coalesce(F.col(f"_v_{c}"), F.lit(0.0)) - 2 * r, F.lit(0.0))
    return m.withColumns(out).select(*by, *out.keys())


def gains(start: int, n: int, q: float, r: float, p0: float = P0) -> np.ndarray:
    """Kalman gains of rows start .. start+n-1 of a series, in closed form.

    The posterior variance goes from p to r(p+q)/(p+q+r), a Moebius map with fixed points
    a > 0 > b (the roots of p^2 + qp - qr); (p-a)/(p-b) shrinks by the same factor in
    every step. Without process noise (q = 0) 1/p grows by 1/r instead."""
    k = np.ones(n)
    if r <= 0.0 or not n:  # no observation noise: every observation is the state
        return k
    t = np.arange(start, start + n, dtype=np.float64)  # steps before the row; row 0 has no prediction
    first = p0 * r / (p0 + r)  # posterior variance of row 0
    if q <= 0.0:
        prior = 1.0 / (1.0 / first + (t - 1) / r) if first > 0.0 else np.zeros(n)
    else:
        root = math.sqrt(q * q + 4.0 * q * r)
        a, b = 2.0 * q * r / (q + root), -(q + root) / 2.0
        z = (first - a) / (first - b) * (r / (a + q + r)) ** (2.0 * np.maximum(t - 1, 0.0))
        prior = (a - b * z) / (1.0 - z) + q
    k = prior / (prior + r)
    if start == 0:
        k[0] = p0 / (p0 + r)
    return k


def scan(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maps x -> a*x + b composed from the first to each: log2(n) rounds over whole arrays."""
    a, b, step = a.copy(), b.copy(), 1
    while step < len(a):
        b[step:] = a[step:] * b[:-step] + b[step:]
        a[step:] = a[step:] * a[:-step]
        step *= 2
    return a, b


def step_maps(y: np.ndarray, q: float, r: float, start: int, p0: float = P0) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) of rows start .. of a series: each takes the state x before its row to a*x + b."""
    k = gains(start, len(y), q, r, p0)
    a, b = 1.0 - k, k * y
    if start == 0 and len(y):  # the state starts at the first observation
        a[0], b[0] = 0.0, y[0]
    return a, b


def local_level_filter(y: np.ndarray, q: float, r: float, p0: float = P0,
                       start: int = 0, x: float | None = None) -> np.ndarray:
    """Filtered state means (float64) of a series, or of its rows from ``start`` on
    when the state ``x`` of the row before is given."""
    a, b = scan(*step_maps(np.asarray(y, dtype=np.float64), q, r, start, p0))
    return b if x is None else a * x + b


def chunk_map(y: np.ndarray, q: float, r: float, start: int) -> tuple[float, float]:
    """(a, b): the chunk takes a state x before it to a*x + b after it."""
    a, b = scan(*step_maps(y, q, r, start))
    return float(a[-1]), float(b[-1])


def kalman_filter(sample: DataFrame, params: DataFrame, by: Sequence[str],
                  cols: Sequence[str] = VARS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """K1 over whole series of any length, in chunks of ``chunk_rows`` rows.

    The state update is affine and the gains follow from the row number, so every
    chunk is reduced to one affine map; the maps are composed along the series (one
    row per chunk), and each chunk then filters its rows from its own start state.
    A task holds one chunk, never a series. ``sample`` carries ``_rn``.
    """
    by = list(by)
    chunk = F.floor((F.col(RN) - 1) / chunk_rows).cast("bigint").alias("_kc")
    prm = [f"{v}_{c}" for c in cols for v in ("q", "r")]
    d = sample.join(params, by, "inner").select(*by, "block_number", *cols, RN, *prm, chunk)
    keys = T.StructType([T.StructField(c, d.schema[c].dataType, True) for c in [*by, "_kc"]])
    maps = T.StructType(list(keys) + [T.StructField(f"{v}_{c}", T.DoubleType(), True) for c in cols for v in ("a", "b")])
    states = T.StructType(list(keys) + [T.StructField(f"x_{c}", T.DoubleType(), True) for c in cols])

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(RN, kind="stable")
        out = pdf[[*by, "_kc"]].head(1).copy()
        for c in cols:
            out[f"a_{c}"], out[f"b_{c}"] = chunk_map(
                pdf[c].to_numpy(dtype=np.float64), float(pdf[f"q_{c}"].iloc[0]),
                float(pdf[f"r_{c}"].iloc[0]), int(pdf[RN].iloc[0]) - 1)
        return out

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_kc", kind="stable")
        out = pdf[[*by, "_kc"]].copy()
        for c in cols:
            after = scan(pdf[f"a_{c}"].to_numpy(), pdf[f"b_{c}"].to_numpy())[1]
            out[f"x_{c}"] = np.concatenate([[0.0], after[:-1]])  # the first chunk has no state before it
        return out

    start = d.groupBy(*by, "_kc").applyInPandas(reduce, maps).groupBy(*by).applyInPandas(compose, states)
    keep = [*by, "block_number", *cols]
    schema = T.StructType(
        [T.StructField(c, d.schema[c].dataType, True) for c in keep]
        + [T.StructField(f"{c}_kalman", T.DoubleType(), True) for c in cols])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(RN, kind="stable")
        first = int(pdf[RN].iloc[0]) - 1
        res = pdf[keep].copy()
        for c in cols:
            res[f"{c}_kalman"] = local_level_filter(
                pdf[c].to_numpy(dtype=np.float64), float(pdf[f"q_{c}"].iloc[0]), float(pdf[f"r_{c}"].iloc[0]),
                start=first, x=float(pdf[f"x_{c}"].iloc[0]) if first else None)
        return res

    return d.join(start, [*by, "_kc"], "inner").groupBy(*by, "_kc").applyInPandas(run, schema)


def kalman_fee_filter(blocks: DataFrame, by: Sequence[str] = ("series",),
                      sample_size: int | None = None, decimals: int | None = 6,
                      chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Q21: filter each whole series, or with ``sample_size`` its last rows
    (``tail_sample``); report the filtered and actual base fee in gwei and their
    difference."""
    by = list(by)
    rows = blocks.select(*by, "block_number", *VARS)
    s = numbered(rows, by) if sample_size is None else tail_sample(rows, by, sample_size)
    k = kalman_filter(s, noise_params(s, by), by, chunk_rows=chunk_rows)
    g = F.lit(WEI_PER_GWEI)
    rd = (lambda c: round_half_away(c, decimals)) if decimals is not None else (lambda c: c)
    kal = F.col("base_fee_per_gas_kalman") / g
    act = F.col("base_fee_per_gas") / g
    return k.select(
        *by, "block_number",
        rd(F.col("gas_used_kalman")).alias("gas_used_kalman"),
        rd(kal).alias("base_fee_per_gas_kalman"),
        F.col("gas_used"),
        act.alias("base_fee_per_gas"),
        rd(kal - act).alias("base_fee_per_gas_diff"),
    )


def kalman_error_sums(filtered: DataFrame, by: Sequence[str] = ("series",),
                      decimals: int | None = 6) -> DataFrame:
    """Q22: total, positive-only and negative-only sums of the fee difference."""
    d = F.col("base_fee_per_gas_diff")
    if decimals is None:
        total = lambda e: F.coalesce(F.sum(e), F.lit(0.0))
    else:
        # the differences carry ``decimals`` places: sum them as exact integers
        s = float(10 ** decimals)
        total = lambda e: F.coalesce(
            F.sum(F.round(e * s).cast("bigint")).cast("double") / F.lit(s), F.lit(0.0))
    return filtered.groupBy(*by).agg(
        total(d).alias("diff_sum"),
        total(F.when(d > 0, d)).alias("diff_pos_sum"),
        total(F.when(d < 0, d)).alias("diff_neg_sum"),
    )
