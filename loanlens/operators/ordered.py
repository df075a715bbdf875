"""Order statistics without one-partition windows.

A plain ``Window.partitionBy(key).orderBy(v)`` puts a whole group in one
task, and ``Window.orderBy(v)`` puts the whole table in one task.  Both break
when one key holds a third of the data.  ``prefix_counts`` computes, for rows
that are unique on (keys, order), the total weight of all earlier rows of the
same key in three bounded steps:

  1. range-partition on (keys, order) — a hot key is split over many tasks;
     the partition id is materialised by a reliable checkpoint so both
     branches below see the same split,
  2. running sums inside each (partition, key) segment (bounded by the
     partition size),
  3. per-key offsets from the segment totals (at most #partitions rows per
     key), joined back.

Everything built on it (average rank, exact quantiles, dense category
codes, stratified folds, ROC points) inherits the same bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.session import cut_lineage

_PID = "_ll_pid"


def _parts(df: DataFrame, parts: int | None) -> int:
    if parts:
        return parts
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def prefix_counts(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str,
                  parts: int | None = None) -> DataFrame:
    """``prefix_sums`` of one weight, as ``before`` and ``key_total``."""
    return prefix_sums(df, keys, order, {weight: ("before", "key_total")}, parts)


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], weights: dict[str, tuple[str, str]],
                parts: int | None = None) -> DataFrame:
    """Add two columns for each weight: its sum over rows of the same key that
    sort strictly earlier on ``order``, and its sum over the key.

    Rows must be unique on keys + order (aggregate duplicates into the
    weights first).  Order is ascending with NULLs first.
    """
    keys, order = list(keys), list(order)
    ranged = (df.repartitionByRange(_parts(df, parts), *[F.col(c) for c in keys + order])
              .withColumn(_PID, F.spark_partition_id()))
    ranged = cut_lineage(ranged)

    seg_w = Window.partitionBy(_PID, *keys).orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({f"_ll_local{i}": F.coalesce(F.sum(w).over(seg_w), F.lit(0)) for i, w in enumerate(weights)})

    segs = ranged.groupBy(_PID, *keys).agg(*[F.sum(w).alias(f"_ll_seg{i}") for i, w in enumerate(weights)])
    key_w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    off_w = key_w.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    all_w = key_w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    segs = segs.select(_PID, *keys, *[c for i, (_, total) in enumerate(weights.values()) for c in (
        F.coalesce(F.sum(f"_ll_seg{i}").over(off_w), F.lit(0)).alias(f"_ll_off{i}"),
        F.sum(f"_ll_seg{i}").over(all_w).alias(total))])
    out = local.join(segs, [_PID, *keys], "inner")
    return out.select(*df.columns, *[c for i, (before, total) in enumerate(weights.values()) for c in (
        (F.col(f"_ll_local{i}") + F.col(f"_ll_off{i}")).alias(before), F.col(total))])


def average_rank(df: DataFrame, value: str, out: str, keys: Sequence[str] = (),
                 parts: int | None = None) -> DataFrame:
    """pandas ``rank(method='average')``: ties share the mean of their
    positions; NULL values get a NULL rank.  Optionally within ``keys``."""
    keys = list(keys)
    counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(F.count(F.lit(1)).alias("_ll_n")))
    ranked = prefix_counts(counts, keys, [value], "_ll_n", parts)
    ranked = ranked.select(*keys, value,
                           (F.col("before") + (F.col("_ll_n") + F.lit(1)) / F.lit(2.0)).alias(out))
    return df.join(ranked, [*keys, value], "left")


def dense_codes(df: DataFrame, col: str, out: str, null_code: int = -1,
                parts: int | None = None) -> DataFrame:
    """Category codes: sorted distinct non-NULL values -> 0..k-1, NULL -> -1
    (pandas ``astype('category').cat.codes``; binary string order)."""
    values = df.where(F.col(col).isNotNull()).select(col).distinct() \
        .withColumn("_ll_one", F.lit(1))
    table = prefix_counts(values, [], [col], "_ll_one", parts) \
        .select(col, F.col("before").cast("int").alias(out))
    joined = df.join(table, col, "left")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(null_code)))


def _missing_as_null(c: str):
    """NaN is missing, as in pandas."""
    v = F.col(c).cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


def quantile_table(df: DataFrame, key: Sequence[str], cols: Sequence[str],
                   qs: Sequence[float], names: Sequence[str],
                   null_poison: bool = False, parts: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (``np.quantile`` / percentile_cont)
    of several columns per key, in one distributed pass.

    With ``null_poison`` a key whose column holds any NULL gets NULL (the
    behaviour of ``np.quantile`` on a NaN-containing group).
    """
    key = list(key)
    ids = list(range(len(cols)))
    long = df.select(*key, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_ll_c"), _missing_as_null(c).alias("_ll_v"))
        for i, c in zip(ids, cols)])).alias("_ll_s")).select(*key, "_ll_s.*")
    counts = (long.where(F.col("_ll_v").isNotNull())
              .groupBy(*key, "_ll_c", "_ll_v").agg(F.count(F.lit(1)).alias("_ll_n")))
    pc = prefix_counts(counts, [*key, "_ll_c"], ["_ll_v"], "_ll_n", parts)
    q_of = F.element_at(F.array(*[F.lit(float(q)) for q in qs]), F.col("_ll_c") + 1)
    pos = q_of * (F.col("key_total") - 1)
    lo, hi = F.floor(pos), F.ceil(pos)
    has_lo = (F.col("before") <= lo) & (lo < F.col("before") + F.col("_ll_n"))
    has_hi = (F.col("before") <= hi) & (hi < F.col("before") + F.col("_ll_n"))
    picked = (pc.where(has_lo | has_hi)
              .groupBy(*key, "_ll_c")
              .agg(F.max(F.when(has_lo, F.col("_ll_v"))).alias("_lo"),
                   F.max(F.when(has_hi, F.col("_ll_v"))).alias("_hi"),
                   F.first(pos - lo).alias("_frac")))
    picked = picked.withColumn("_q", F.col("_lo") + F.col("_frac") * (F.col("_hi") - F.col("_lo")))
    wide = picked.groupBy(*key).agg(*[
        F.max(F.when(F.col("_ll_c") == i, F.col("_q"))).alias(n) for i, n in zip(ids, names)])
    base = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_ll_rows"),
                                *[F.count(_missing_as_null(c)).alias(f"_ll_nn{i}") for i, c in zip(ids, cols)])
    out = base.join(wide, key, "left") if key else base.crossJoin(wide)
    sel = []
    for i, n in zip(ids, names):
        v = F.col(n)
        if null_poison:
            v = F.when(F.col(f"_ll_nn{i}") == F.col("_ll_rows"), v)
        sel.append(v.alias(n))
    return out.select(*key, *sel)


def listed_quantiles(df: DataFrame, key: Sequence[str], cols: Sequence[str], qs: Sequence[float],
                     names: Sequence[str], null_poison: bool = False) -> DataFrame:
    """``quantile_table`` for keys of few rows: a key's values are one sorted list."""
    lists = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_ll_rows"), *[
        F.collect_list(_missing_as_null(c)).alias(f"_ll_v{i}") for i, c in enumerate(cols)])
    lists = lists.select(*key, "_ll_rows", *[F.sort_array(f"_ll_v{i}").alias(f"_ll_v{i}") for i in range(len(cols))])
    sel = []
    for i, (q, n) in enumerate(zip(qs, names)):
        values = F.col(f"_ll_v{i}")
        found = F.size(values)
        pos = F.lit(float(q)) * (found - 1)
        lo = F.get(values, F.floor(pos).cast("int"))
        hi = F.get(values, F.ceil(pos).cast("int"))
        v = F.when(found > 0, lo + (pos - F.floor(pos)) * (hi - lo))
        sel.append((F.when(found == F.col("_ll_rows"), v) if null_poison else v).alias(n))
    return lists.select(*key, *sel)


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int, seed: int,
                     out: str = "fold", parts: int | None = None) -> DataFrame:
    """Deterministic stratified k-fold: inside each label, rows are ordered by
    a seeded hash of the id and dealt round-robin into k folds, so every
    fold gets the same share of each class (+-1 row).  Rows that repeat an id
    share its fold."""
    h = df.groupBy(id_col).agg(F.max(label).alias(label)).withColumn("_ll_h", F.xxhash64(F.col(id_col), F.lit(seed))) \
        .withColumn("_ll_one", F.lit(1))
    ranked = prefix_counts(h, [label], ["_ll_h", id_col], "_ll_one", parts)
    folds = ranked.select(id_col, F.pmod(F.col("before"), F.lit(k)).cast("int").alias(out))
    return df.join(folds, id_col, "inner")


def cumulative_by_score(df: DataFrame, score: str, label: str,
                        parts: int | None = None) -> DataFrame:
    """Per distinct score (descending): positives and negatives at or above
    it.  Rows: score, tp, fp, pos_total, neg_total — the ROC staircase."""
    per = (df.where(F.col(score).isNotNull())
           .groupBy(score)
           .agg(F.sum(F.col(label).cast("long")).alias("_ll_p"),
                F.sum((F.lit(1) - F.col(label)).cast("long")).alias("_ll_q"),
                F.count(F.lit(1)).alias("_ll_n"))
           .withColumn("_ll_neg", -F.col(score)))
    both = prefix_sums(per, [], ["_ll_neg"], {"_ll_p": ("_ll_pb", "pos_total"), "_ll_q": ("_ll_qb", "neg_total")}, parts)
    return both.select(score,
                    (F.col("_ll_pb") + F.col("_ll_p")).alias("tp"),
                    (F.col("_ll_qb") + F.col("_ll_q")).alias("fp"),
                    "pos_total", "neg_total")
