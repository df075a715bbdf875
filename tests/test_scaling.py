import numpy as np
from pyspark.sql import functions as F

from loanlens.plans import wide_checks
from loanlens.plans.application import application_features


def test_six_digits():
    x = np.array([1234567.0, -1234565.0, 0.5, -1e-10, 2.0, 99999.95, np.nan, np.inf, -np.inf, 1e-8, 123456.5, 1e200])
    got = wide_checks.six_digits(x)
    want = [1234570.0, -1234570.0, 0.5, 0.0, 2.0, 100000.0, np.nan, 1e300, -1e300, 1e-8, 123457.0, 1e200]
    assert np.allclose(got, want, rtol=1e-15, atol=0, equal_nan=True)


def test_rounding_is_no_expression_a_number(spark):
    rows = [(1, 1234567.0, None, "t", 7, 1.5), (None, float("nan"), float("inf"), None, -7, None)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, `a.b` double, c double, s string, n int, f float")
    wide = wide_checks.canonical(df)
    assert wide.columns == df.columns
    got = sorted((tuple(r) for r in wide.collect()), key=str)
    assert got == sorted([(1, 1234570.0, None, "t", 7.0, 1.5), (None, None, 1e300, None, -7.0, None)], key=str)
    assert wide_checks.canonical(df.limit(0)).collect() == []
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "log10" not in plan.lower()


def test_narrow_rows_are_spread_before_they_grow(spark):
    """One split of 2,000 applications is widened by several tasks."""
    app = spark.range(0, 2000, 1, 1).select(
        F.col("id").alias("SK_ID_CURR"), (F.col("id") * 10.0 + 1).alias("AMT_CREDIT"), (F.col("id") % 7 + 1.0).alias("AMT_ANNUITY"),
        F.when(F.col("id") % 2 == 0, "F").otherwise("M").alias("CODE_GENDER"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        x = application_features(app)
        assert x.select(F.spark_partition_id().alias("p")).distinct().count() > 4 and x.count() == 2000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
