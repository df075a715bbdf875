import math

from pyspark.sql import functions as F

from loanlens.functions import (clip_lower_keep_null, div_eps, div_ieee, div_null, div_one_plus,
                                fill_zero, flag, inf_to_null, null_skipping_sum, replace_sentinels,
                                row_max, row_mean, row_median, row_min, row_std, zero_filled_mean)


def test_division_policies(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 2.0), (3.0, 2.0), (2.0, -1.0)],
                               "a double, b double")
    r = df.select(div_null("a", "b").alias("n"), div_one_plus("a", "b").alias("o"),
                  div_ieee("a", "b").alias("i"), div_eps("a", "b", 1e-8).alias("e")).collect()
    assert [x.n for x in r] == [None, None, None, None, 1.5, -2.0]
    assert r[0].i == math.inf and r[1].i == -math.inf and r[2].i is None
    assert r[5].o is None  # 1 + (-1) = 0 -> NULL
    assert r[0].e == 1e8


def test_row_stats_and_fills(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (2.0, 4.0, 9.0)],
                               "a double, b double, c double")
    r = df.select(zero_filled_mean(["a", "b", "c"]).alias("zm"), null_skipping_sum(["a", "b", "c"]).alias("s"),
                  row_mean(["a", "b", "c"]).alias("m"), row_median(["a", "b", "c"]).alias("md"),
                  row_std(["a", "b", "c"]).alias("sd"), row_max(["a", "b", "c"]).alias("mx"),
                  row_min(["a", "b", "c"]).alias("mn")).collect()
    assert r[0].zm == 4 / 3 and r[0].s == 4.0 and r[0].m == 2.0 and r[0].md == 2.0
    assert abs(r[0].sd - math.sqrt(2.0)) < 1e-12 and r[0].mx == 3.0 and r[0].mn == 1.0
    assert r[1].s == 0.0 and r[1].m is None and r[1].sd is None and r[1].mx is None
    assert r[2].md == 4.0


def test_flags_clip_sentinels_inf(spark):
    df = spark.createDataFrame([(None, -3, 365243, float("inf")), (5, 2, 10, 1.0)],
                               "x int, d int, days int, v double")
    out = replace_sentinels(df, {"days": 365243, "missing_col": 1})
    r = inf_to_null(out).select(flag(F.col("x") > 0).alias("f"), clip_lower_keep_null("x").alias("c"),
                                clip_lower_keep_null("d").alias("cd"), "days", "v").collect()
    assert [x.f for x in r] == [0, 1]
    assert r[0].c is None and r[0].cd == 0 and r[0].days is None and r[0].v is None
    z = fill_zero(spark.createDataFrame([(None, float("nan"))], "a int, b double"), ["a", "b"]).first()
    assert z.a == 0 and z.b == 0.0
