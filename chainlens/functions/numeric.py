"""Column helpers whose semantics are written down once.

All return ``Column`` expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAN = float("nan")
_INF = float("inf")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ieee_div(a, b) -> Column:
    """IEEE float division: x/0 -> +-inf, 0/0 -> NaN, null stays null.

    Plain ``/`` raises DIVIDE_BY_ZERO under ANSI mode, even for doubles.
    """
    a, b = _c(a).cast("double"), _c(b).cast("double")
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(b != 0, a / b)
        .when(F.isnan(a) | (a == 0), F.lit(_NAN))
        .when(a > 0, F.lit(_INF))
        .otherwise(F.lit(-_INF))
    )


def round_half_away(x, decimals: int = 0) -> Column:
    """Round half away from zero; NaN and +-inf pass through.

    Spark's and other engines' ``round`` disagree on binary ties (1.005), so the
    formula is spelled out: sign * floor(|x| * 10^d + 0.5) / 10^d.
    """
    x = _c(x).cast("double")
    s = float(10 ** decimals)
    return (
        F.when(F.isnan(x) | (F.abs(x) == _INF), x)
        .when(x < 0, -F.floor(-x * s + 0.5) / s)
        .otherwise(F.floor(x * s + 0.5) / s)
    )


def sum0(c) -> Column:
    """Sum that is 0 (not null) over an empty or all-null group."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def fill_nan(df: DataFrame, value: float = 0.0) -> DataFrame:
    """Replace NaN by ``value`` in every float column; null and inf untouched."""
    cols = {
        f.name: F.nanvl(F.col(f.name), F.lit(value))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(cols) if cols else df


def fill_null(df: DataFrame, value=0) -> DataFrame:
    """Replace null by ``value`` in every numeric column."""
    return df.fillna(value)


def round_numeric(df: DataFrame, decimals: int, exclude=()) -> DataFrame:
    """Round every float column (type-class selector over the schema)."""
    cols = {
        f.name: round_half_away(F.col(f.name), decimals)
        for f in df.schema.fields
        if f.name not in exclude and isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(cols) if cols else df


def epoch_to_datetime(c) -> Column:
    """Epoch seconds -> naive (UTC wall clock) timestamp."""
    return F.timestamp_seconds(_c(c)).cast("timestamp_ntz")


def to_epoch_seconds(c) -> Column:
    """Naive UTC timestamp -> epoch seconds (session time zone must be UTC)."""
    return F.unix_timestamp(_c(c).cast("timestamp"))


def datetime_literal(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def epoch_of(value: str) -> int:
    """Epoch seconds of an ISO date/time literal taken as UTC (driver side, a constant)."""
    import datetime as _dt

    d = _dt.datetime.fromisoformat(value)
    if d.tzinfo is None:
        d = d.replace(tzinfo=_dt.timezone.utc)
    return int(d.timestamp())


def blob_count(total_bytes, blob_bytes: int) -> Column:
    """Blobs needed for ``total_bytes``: ceil(bytes / blob size)."""
    return F.ceil(_c(total_bytes).cast("double") / float(blob_bytes)).cast("bigint")


def exact_sum(c) -> Column:
    """Sum of the non-null values that does not depend on their order, combined before
    the shuffle: finite values below 1e15 are added as decimals of 12 places, any others
    (inf, NaN, larger) as they are, and the two sums are added; null for no values."""
    x = _c(c).cast("double")
    plain = F.abs(x) < 1e15
    rest = F.sum(F.when(~plain | F.isnan(x), x))
    small = F.sum(F.when(plain, x).cast("decimal(38,12)")).cast("double")
    return F.coalesce(rest + small, rest, small)


def exact_mean(c) -> Column:
    """``exact_sum`` by the number of non-null values; null for no values."""
    n = F.count(_c(c))
    return F.when(n > 0, exact_sum(c) / n)


def ordered_mean(c) -> Column:
    """Mean over the values in ascending order (a fixed float summation order); null for no
    values. Only for groups bounded by a block, as it holds the group's values."""
    vals = F.array_sort(F.collect_list(_c(c).cast("double")))
    return F.when(F.size(vals) > 0,
                  F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + x) / F.size(vals))
