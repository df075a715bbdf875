"""Correlations of all pairs of many columns by Gram matrices.

One ``corr`` for each pair makes 606,000 aggregates of 1,101 columns, each
an expression of its own.  Here a task adds up four matrices over its rows,

    N = M'M    rows that hold both columns
    S = Z'M    sums of one column over the rows that hold the other
    Q = (Z^2)'M   the same for squares
    P = Z'Z    products

with Z the shifted and scaled values (0 where missing) and M their mask, and
gives one row for each pair; Spark sums these.  A task holds four matrices
of at most ``block`` columns however many rows it reads.  More columns are
cut into chunks of half a block, and each pair of chunks reads its own columns.

Pairs are over the rows that hold both (as pandas ``corr``).  Missing are
NULL, NaN, infinite values and those of 1e150 or more.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A column varies over a pair's rows if its variance is above this share of
#: its mean square about the column's mean; below it is rounding.
LEAST_VARIANCE = 1e-11
_SLICE = 2048
_SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def _doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(cols)])


def _few_tasks(df: DataFrame, parts: int | None) -> DataFrame:
    # every task sends its matrices once, so small partitions share a task
    return df.coalesce(parts or 4 * df.sparkSession.sparkContext.defaultParallelism)


def column_shifts(df: DataFrame, cols: Sequence[str], parts: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Mean and largest distance from it of each column: two numbers a column
    on the driver.  They only keep the sums small; any values would be right."""
    n_cols, step = len(cols), _SLICE

    def run(batches):
        n, mean = np.zeros(n_cols), np.zeros(n_cols)
        low, high = np.full(n_cols, np.inf), np.full(n_cols, -np.inf)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.slice(at, step).columns])
                here = np.abs(x) < 1e150  # false for NaN
                low = np.minimum(low, np.where(here, x, np.inf).min(axis=0))
                high = np.maximum(high, np.where(here, x, -np.inf).max(axis=0))
                more = here.sum(axis=0)
                n += more
                mean += (np.where(here, x, 0).sum(axis=0) - more * mean) / np.maximum(n, 1)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"k": held.astype(np.int32), "n": n[held], "mean": mean[held],
                                          "low": low[held], "high": high[held]})

    found = (_few_tasks(_doubles(df, cols), parts).mapInArrow(run, "k int, n double, mean double, low double, high double")
             .groupBy("k").agg(F.expr("sum(mean * n) / sum(n)").alias("mean"), F.min("low").alias("low"), F.max("high").alias("high")))
    shift, scale = np.zeros(n_cols), np.ones(n_cols)
    for r in found.collect():  # a row a column
        shift[r.k] = min(max(r["mean"], r.low), r.high)
        scale[r.k] = max(r.high - shift[r.k], shift[r.k] - r.low) or 1.0
    return shift, scale


def _chunk_moments(df: DataFrame, left: Sequence[int], right: Sequence[int], cols: Sequence[str], shift: np.ndarray,
                   scale: np.ndarray, parts: int | None) -> DataFrame:
    """Sums of the pairs of a column of ``left`` with one of ``right``, or of
    two columns of ``left`` where ``right`` is empty."""
    places = np.array([*left, *right])
    own_shift, own_scale = shift[places], scale[places]
    n_left, n_cols, step, names = len(left), len(places), _SLICE, list(_SUMS)

    def run(batches):
        both, sums, squares, products = (np.zeros((n_cols, n_cols)) for _ in range(4))
        rows = 0
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.slice(at, step).columns])
                here = np.abs(x) < 1e150
                z = np.where(here, (np.where(here, x, 0) - own_shift) / own_scale, 0)
                mask = here.astype(np.float64)
                both += mask.T @ mask
                sums += z.T @ mask
                squares += (z * z).T @ mask
                products += z.T @ z
                rows += len(x)
        if not rows:
            return
        for i in range(n_left):
            j = np.arange(n_left if n_left < n_cols else i + 1, n_cols)
            j = j[both[i, j] > 0]
            columns = [both[i, j], sums[i, j], sums[j, i], squares[i, j], squares[j, i], products[i, j]]
            yield pa.RecordBatch.from_pydict({"a": np.full(len(j), places[i], np.int32), "b": places[j].astype(np.int32),
                                              **dict(zip(names, columns))})

    schema = "a int, b int, " + ", ".join(f"{c} double" for c in names)
    return _few_tasks(_doubles(df, [cols[k] for k in places]), parts).mapInArrow(run, schema)


def correlation_matrix(df: DataFrame, cols: Sequence[str], block: int = 1200, parts: int | None = None,
                       digits: int = 6) -> DataFrame:
    """(FEATURE_A, FEATURE_B, N, CORR) of every pair of ``cols``, in their order.

    N counts the rows that hold both.  CORR is NULL if N is below two or one
    of them does not vary over these rows.  Pairs without a common row have
    N = 0, also on an empty table; fewer than two columns give no rows.
    ``parts`` is the most tasks that read the table (four a core unless
    given).  Other columns are not read.
    """
    cols = list(cols)
    if len(set(cols)) < len(cols):
        raise ValueError("correlation_matrix: a column is named twice")
    spark = df.sparkSession
    names = F.array(*[F.lit(c) for c in cols]) if cols else F.array(F.lit(""))
    every = (spark.range(len(cols)).select(F.col("id").cast("int").alias("a"))
             .withColumn("b", F.explode(F.sequence(F.col("a"), F.lit(max(0, len(cols) - 1))))).where("a < b"))
    size = len(cols) if len(cols) <= block else max(1, block // 2)
    chunks = [range(k, min(k + size, len(cols))) for k in range(0, len(cols), max(1, size))]
    if not chunks:
        return every.select(names[F.col("a")].alias("FEATURE_A"), names[F.col("b")].alias("FEATURE_B"),
                            F.lit(0).cast("long").alias("N"), F.lit(None).cast("double").alias("CORR"))
    shift, scale = column_shifts(df, cols, parts)
    pieces = [_chunk_moments(df, c, [], cols, shift, scale, parts) for c in chunks if len(c) > 1]
    pieces += [_chunk_moments(df, c, d, cols, shift, scale, parts) for c, d in combinations(chunks, 2)]
    if not pieces:
        pieces = [every.select("a", "b", *[F.lit(0.0).alias(c) for c in _SUMS])]
    m = reduce(DataFrame.unionByName, pieces).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in _SUMS])
    n = F.col("n")
    vx, vy = F.col("sxx") - F.col("sx") * F.col("sx") / n, F.col("syy") - F.col("sy") * F.col("sy") / n
    varies = (n >= 2) & (vx > LEAST_VARIANCE * F.col("sxx")) & (vy > LEAST_VARIANCE * F.col("syy"))
    corr = (F.col("sxy") - F.col("sx") * F.col("sy") / n) / F.sqrt(vx) / F.sqrt(vy)
    return every.join(m, ["a", "b"], "left").select(
        names[F.col("a")].alias("FEATURE_A"), names[F.col("b")].alias("FEATURE_B"),
        F.coalesce(n, F.lit(0)).cast("long").alias("N"),
        F.when(varies, F.round(F.greatest(F.least(corr, F.lit(1.0)), F.lit(-1.0)), digits) + F.lit(0.0)).alias("CORR"))
