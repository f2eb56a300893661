"""Ordered-series operators that never put a whole series into one task.

The surveyed code uses trailing row-count windows (``rolling_mean(n)``) and
row lags (``diff(n)``) over frames ordered by block. In Spark a window with a
large partition (a whole block batch, or ``Window.orderBy`` with no partition,
which plans ``Exchange SinglePartition``) puts the whole series into one task.
Here every series is split into *chunks* (a monotone function of the leading
order column, e.g. ``block_number div C``):

1. local row number / running sums inside each chunk (window partitioned by
   ``part + chunk``: bounded task size);
2. per-chunk totals (partial aggregation) turned into exclusive offsets by a
   window over the chunk table (one row per chunk: small);
3. global position ``_rn`` = chunk offset + local row number, and inclusive
   prefix sums likewise;
4. lags by ``n`` rows are read from *halo buckets*: rows are bucketed by
   ``(_rn - 1) div K`` and the last ``max(n)`` rows of each bucket are copied
   into the next bucket, so ``lag(x, n)`` inside ``part + bucket`` is exact.
   Each bucket holds at most ``K + max(n)`` rows, whatever the skew.

A trailing ``n``-row mean is then ``(cs[rn] - cs[rn-n]) / n`` (prefix sums of a bucket
and its halo, O(rows) instead of O(rows * n)), null unless the frame holds ``n`` non-null
values, which is the ``min_periods = window`` rule of the surveyed library.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKET_ROWS = 1 << 16
GROUP_CHUNKS = 4096

RN, LRN, CS, CC = "_rn", "_lrn", "_cs", "_cc"


def chunk_col(order_col: str, chunk_size: int) -> Column:
    """Monotone chunk id of an integer order column."""
    return F.floor(F.col(order_col) / F.lit(int(chunk_size))).cast("bigint")


def local_window(part_cols: Sequence[str], chunk: str, order_cols: Sequence[str]):
    return Window.partitionBy(*part_cols, chunk).orderBy(*order_cols)


def _exact_sum_type(dt: T.DataType) -> str:
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DecimalType)):
        return "decimal(38,0)" if not isinstance(dt, T.DecimalType) else dt.simpleString()
    return "double"


def _keys_over(part_cols: Sequence[str], w) -> list[Column]:
    """The columns ``part_cols`` read off the window ``w``. A not-null filter that Spark infers from
    the caller's join then stays above the window: what is below it equals the plan of
    the caller's rows, whose exchange is reused."""
    return [F.lag(c, 0).over(w).alias(c) for c in part_cols]


def _exclusive_sums(totals: DataFrame, part_cols: Sequence[str], chunk: str,
                    sums: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(*part_cols, chunk, *sums): for each ``out -> (column, type)`` the sum over the
    earlier chunks. Without ``part_cols`` it works in two levels, so that one task
    ranks groups of ``GROUP_CHUNKS`` chunks and not the chunks themselves."""
    def before(col: str, kind: str, w):
        frame = w.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(col).over(frame), F.lit(0)).cast(kind)

    if part_cols:
        w = Window.partitionBy(*part_cols).orderBy(chunk)
        return totals.select(*_keys_over(part_cols, w), chunk, *[before(c, k, w).alias(o) for o, (c, k) in sums.items()])
    t = totals.withColumn("_grp", chunk_col(chunk, GROUP_CHUNKS))
    groups = t.groupBy("_grp").agg(*[F.sum(c).alias(c) for c, _ in sums.values()])
    groups = groups.select("_grp", *[before(c, k, Window.orderBy("_grp")).alias(f"{o}_grp")
                                     for o, (c, k) in sums.items()])
    w = Window.partitionBy("_grp").orderBy(chunk)
    inner = t.select("_grp", chunk, *[before(c, k, w).alias(o) for o, (c, k) in sums.items()])
    return inner.join(groups, "_grp", "left").select(
        chunk, *[(F.col(o) + F.col(f"{o}_grp")).cast(k).alias(o) for o, (_, k) in sums.items()])


def add_positions(df: DataFrame, part_cols: Sequence[str], chunk: str,
                  order_cols: Sequence[str], value: str | None = None) -> DataFrame:
    """Add ``_lrn`` (row number in chunk), ``_rn`` (1-based row number in
    ``part_cols`` by ``order_cols``) and, with ``value``, inclusive prefix sum
    ``_cs`` and prefix non-null count ``_cc`` over the same order.

    ``chunk`` must be a column of ``df`` that never decreases along the order.
    Integer values are summed as decimal(38,0): exact, and cannot overflow.
    """
    part_cols = list(part_cols)
    w = local_window(part_cols, chunk, order_cols)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = {LRN: F.row_number().over(w).cast("bigint")}
    if value is not None:
        st = _exact_sum_type(df.schema[value].dataType)
        v = F.col(value).cast(st)
        new["_lcs"] = F.coalesce(F.sum(v).over(run), F.lit(0).cast(st))
        new["_lcc"] = F.count(v).over(run)
    local = df.withColumns(new)

    # per-chunk totals -> exclusive offsets (a small table: one row per chunk).
    # Totals are read off the running values of ``local`` itself (the last row
    # of a chunk holds them), so both branches start from the same exchange
    # and Spark reuses it instead of evaluating the input twice.
    aggs, offs = [F.max(LRN).alias("_tn")], {"_on": ("_tn", "bigint")}
    if value is not None:
        aggs += [F.max("_lcs").alias("_ts"), F.max("_lcc").alias("_tc")]
        offs |= {"_os": ("_ts", st), "_oc": ("_tc", "bigint")}
    totals = local.groupBy(*part_cols, chunk).agg(*aggs)
    offsets = _exclusive_sums(totals, part_cols, chunk, offs)

    # every chunk has an offsets row, so "left" equals "inner" here; a left
    # join infers no IsNotNull filter on ``local``, which keeps this branch's
    # plan identical to the totals branch and lets Spark reuse its exchange
    out = local.join(offsets, [*part_cols, chunk], "left")
    res = {RN: (F.col("_on") + F.col(LRN)).cast("bigint")}
    drop = ["_on"]
    if value is not None:
        res[CS] = (F.col("_os") + F.col("_lcs")).cast(st)
        res[CC] = (F.col("_oc") + F.col("_lcc")).cast("bigint")
        drop += ["_os", "_oc", "_lcs", "_lcc"]
    return out.withColumns(res).drop(*drop)


def halo_buckets(df: DataFrame, part_cols: Sequence[str], max_n: int, rn: str = RN, bucket_rows: int | None = None):
    """(rows with ``_bkt`` and ``_halo``, the window over ``part + bucket`` by ``rn``): each row
    in its bucket, the last ``max_n`` rows of a bucket also in the next one, as its halo."""
    k = max(bucket_rows or DEFAULT_BUCKET_ROWS, 4 * max_n)
    base = F.floor((F.col(rn) - 1) / F.lit(k)).cast("bigint")
    copies = F.when(F.pmod(F.col(rn) - 1, F.lit(k)) >= F.lit(k - max_n), F.array(base, base + 1)).otherwise(F.array(base))
    d = df.withColumn("_bkt", F.explode(copies)).withColumn("_halo", F.col("_bkt") != base)
    return d, Window.partitionBy(*part_cols, "_bkt").orderBy(rn)


def lag_positions(df: DataFrame, part_cols: Sequence[str], cols: Sequence[str],
                  ns: Sequence[int], rn: str = RN,
                  bucket_rows: int | None = None) -> DataFrame:
    """Add ``_lag{n}_{col}`` = value of ``col`` at row ``rn - n`` of the same
    ``part_cols`` (null when that row does not exist), for each n in ``ns``.

    Uses halo buckets (module doc): one hash exchange on ``part + bucket``,
    with ``max(ns) / K`` extra rows.
    """
    ns = sorted({int(n) for n in ns})
    d, w = halo_buckets(df, part_cols, max(ns), rn, bucket_rows)
    lags = {f"_lag{n}_{c}": F.lag(c, n).over(w) for n in ns for c in cols}
    return d.withColumns(lags).filter(~F.col("_halo")).drop("_bkt", "_halo")


def rolling_means(df: DataFrame, value: str, part_cols: Sequence[str], chunk: str,
                  order_cols: Sequence[str], windows: Mapping[str, int],
                  bucket_rows: int | None = None) -> DataFrame:
    """Trailing ``n``-row means of ``value`` for each ``name -> n``.

    Returns ``(*part_cols, chunk, _lrn, *names)``; ``_lrn`` is the row number
    under ``local_window(part_cols, chunk, order_cols)`` so callers join the
    means back onto their rows. Null unless ``n`` non-null values are in frame.
    """
    part_cols = list(part_cols)
    narrow = df.select(*dict.fromkeys([*part_cols, chunk, *order_cols, value]))
    pos = add_positions(narrow, part_cols, chunk, order_cols).select(*part_cols, chunk, LRN, RN, value)
    # only the values travel: prefix sums are taken inside a bucket and its halo
    st, ns = _exact_sum_type(df.schema[value].dataType), sorted(set(windows.values()))
    d, w = halo_buckets(pos, part_cols, max(ns), RN, bucket_rows)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keys = [f"_key{i}" for i in range(len(part_cols))]
    d = d.withColumns(dict(zip(keys, _keys_over(part_cols, w)))).withColumns({CS: F.coalesce(F.sum(F.col(value).cast(st)).over(run), F.lit(0).cast(st)),
                       CC: F.count(value).over(run)})
    d = d.withColumns({f"_lag{n}_{c}": F.lag(c, n).over(w) for n in ns for c in (CS, CC)})
    outs = {}
    for name, n in windows.items():
        s = F.col(CS) - F.coalesce(F.col(f"_lag{n}_{CS}"), F.lit(0))
        c = F.col(CC) - F.coalesce(F.col(f"_lag{n}_{CC}"), F.lit(0))
        outs[name] = F.when((F.col(RN) >= n) & (c == n),
                            s.cast("double") / F.lit(float(n)))
    return d.filter(~F.col("_halo")).withColumns(outs).select(
        *[F.col(k).alias(c) for k, c in zip(keys, part_cols)], chunk, LRN, *windows.keys())


def lag_diff(df: DataFrame, cols: Mapping[str, str], n: int, part_cols: Sequence[str],
             chunk: str, order_cols: Sequence[str],
             bucket_rows: int | None = None) -> DataFrame:
    """``out = col - col n rows earlier`` (null for the first n rows of a part),
    for each ``out -> col``; all input columns are kept."""
    part_cols = list(part_cols)
    pos = add_positions(df, part_cols, chunk, order_cols)
    src = sorted(set(cols.values()))
    lagged = lag_positions(pos, part_cols, src, [n], RN, bucket_rows)
    outs = {o: F.col(c) - F.col(f"_lag{n}_{c}") for o, c in cols.items()}
    return (lagged.withColumns(outs)
                  .drop(*[f"_lag{n}_{c}" for c in src], LRN, RN))
