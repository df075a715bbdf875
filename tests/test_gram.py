import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanlens.operators.gram import correlation_matrix


def _frame(n=500, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=n)
    pdf = pd.DataFrame({
        "a": base, "far away": 1e9 + base * 3 + rng.normal(size=n), "c": np.where(rng.random(n) < 0.4, np.nan, -base),
        "big": rng.normal(size=n) * 1e60, "flat": 7.1, "whole": rng.integers(0, 3, n).astype(float),
        "empty": np.nan, "once": np.where(np.arange(n) == 5, 2.0, np.nan),
        "pair.dot": np.where(rng.random(n) < 0.5, np.nan, base ** 2)})
    return pdf


def _rows(df):
    return {(r.FEATURE_A, r.FEATURE_B): (r.N, r.CORR) for r in df.collect()}


@pytest.mark.parametrize("block, parts", [(1200, None), (4, 3), (1, 1)])
def test_matches_pandas(spark, block, parts):
    pdf = _frame()
    cols = list(pdf.columns)
    df = spark.createDataFrame(pdf).repartition(5).withColumn("other", F.lit("x"))
    got = _rows(correlation_matrix(df, cols, block, parts))
    want, held = pdf.corr(), pdf.notna().astype(int)
    counts = held.T @ held
    assert len(got) == len(cols) * (len(cols) - 1) // 2
    for (a, b), (n, corr) in got.items():
        assert cols.index(a) < cols.index(b) and n == counts.loc[a, b]
        if "flat" in (a, b) or "once" in (a, b) or "empty" in (a, b):
            assert corr is None
        else:
            assert abs(corr - want.loc[a, b]) < 2e-6


def test_odd_values_types_and_empty_tables(spark):
    rows = [(1, float("inf"), None, True), (2, float("nan"), 2.5, False), (3, 4.0, 3.5, True), (4, 5.0, 1e200, False), (6, 7.0, 1.5, None)]
    df = spark.createDataFrame(rows, "i int, x double, y double, t boolean")
    got = _rows(correlation_matrix(df, ["i", "x", "y", "t"]))
    assert got["i", "x"] == (3, round(float(np.corrcoef([3, 4, 6], [4, 5, 7])[0, 1]), 6))
    assert got["x", "y"][0] == 2 and got["i", "t"][0] == 4
    none = _rows(correlation_matrix(df.where("false"), ["i", "x", "y"]))
    assert none == {("i", "x"): (0, None), ("i", "y"): (0, None), ("x", "y"): (0, None)}
    assert correlation_matrix(df, ["i"]).count() == 0 and correlation_matrix(df, []).count() == 0
    with pytest.raises(ValueError):
        correlation_matrix(df, ["i", "i"])


def test_partitions_do_not_matter(spark):
    df = spark.createDataFrame(_frame(3000, 8))
    cols = df.columns[:6]
    assert _rows(correlation_matrix(df.repartition(1), cols)) == _rows(correlation_matrix(df.repartition(40), cols, parts=7))
