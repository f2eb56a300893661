import math

from pyspark.sql import functions as F

from chainlens.functions.numeric import fill_nan, ieee_div, round_half_away


def test_ieee_div(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (-2.0, 0.0), (None, 1.0), (6.0, 3.0)],
                               "a double, b double")
    out = [r[0] for r in df.select(ieee_div("a", "b")).collect()]
    assert out[0] == math.inf and math.isnan(out[1]) and out[2] == -math.inf
    assert out[3] is None and out[4] == 2.0


def test_round_half_away(spark):
    vals = [1.005, 2.5, -2.5, 0.125, -0.001, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r2 = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    r0 = [r[0] for r in df.select(round_half_away("x", 0)).collect()]
    assert r0[1] == 3.0 and r0[2] == -3.0
    assert r2[3] == 0.13 and r2[4] == 0.0 and math.copysign(1, r2[4]) == 1.0
    assert math.isnan(r2[5]) and r2[6] == math.inf and r2[7] is None


def test_fill_nan_keeps_null_and_inf(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (float("inf"),)], "x double")
    out = [r[0] for r in fill_nan(df).collect()]
    assert out[0] == 0.0 and out[1] is None and out[2] == math.inf


def test_epoch_literal():
    from chainlens.functions.numeric import epoch_of

    assert epoch_of("1970-01-02") == 86400


def test_exact_sum_adds_large_and_small_values(spark):
    from chainlens.functions.numeric import exact_mean, exact_sum

    df = spark.createDataFrame([("a", 2e15), ("a", 4e14), ("a", 6e14), ("b", 1.5), ("b", None), ("c", math.inf), ("c", 1.0), ("d", None)], "k string, x double")
    got = {r.k: (r.s, r.m) for r in df.groupBy("k").agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).collect()}
    assert got == {"a": (3e15, 1e15), "b": (1.5, 1.5), "c": (math.inf, math.inf), "d": (None, None)}
