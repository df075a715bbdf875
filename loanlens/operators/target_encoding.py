"""Smoothed target-mean encoding, plain and out-of-fold.

  enc(cat) = (n * mean + s * prior) / (n + s),   unseen category -> prior

A NULL category is its own level (pandas turns it into the string 'nan').
All fits are grouped aggregates joined back on the category; the k-fold
variant builds every held-out table in one pass as *total minus fold*
instead of k separate fits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.session import cut_lineage

NULL_LEVEL = "nan"


def category_key(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(NULL_LEVEL))


def hash_normal(id_col, seed: int) -> Column:
    """Standard-normal noise from a seeded hash of the row id (Box-Muller):
    reproducible, and independent of partitioning and row order."""
    scale = float(2 ** 53)
    u1 = (F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(2 ** 53)).cast("double") + 1.0) / (scale + 1.0)
    u2 = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed + 7919)), F.lit(2 ** 53)).cast("double") / scale
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def fit_target_encoding(train: DataFrame, cat: str, label: str,
                        smoothing: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Returns (table[_cat_key, enc], prior[prior]) — prior is one row."""
    prior = train.agg(F.avg(F.col(label).cast("double")).alias("prior"))
    stats = (train.groupBy(category_key(cat).alias("_cat_key"))
             .agg(F.count(F.col(label)).alias("_n"),
                  F.avg(F.col(label).cast("double")).alias("_m")))
    s = F.lit(float(smoothing))
    table = (stats.crossJoin(F.broadcast(prior))  # one row
             .select("_cat_key",
                     ((F.col("_n") * F.col("_m") + s * F.col("prior")) / (F.col("_n") + s))
                     .alias("enc")))
    return table, prior


def apply_target_encoding(df: DataFrame, cat: str, table: DataFrame, prior: DataFrame,
                          out: str, noise_level: float = 0.0, id_col: str | None = None,
                          seed: int = 0, drop_source: bool = True) -> DataFrame:
    """Left-join the encoding; unseen levels get the prior.  Optional
    multiplicative noise ``enc * (1 + noise * N(0,1))`` (training rows)."""
    j = (df.withColumn("_cat_key", category_key(cat))
         .join(table, "_cat_key", "left")
         .crossJoin(F.broadcast(prior)))
    enc = F.coalesce(F.col("enc"), F.col("prior"))
    if noise_level > 0:
        if id_col is None:
            raise ValueError("noise needs an id column to stay reproducible")
        enc = F.when(F.col("enc").isNotNull(),
                     F.col("enc") * (F.lit(1.0) + F.lit(noise_level) * hash_normal(id_col, seed))
                     ).otherwise(F.col("prior"))
    keep = [c for c in df.columns if not (drop_source and c == cat)]
    return j.select(*keep, enc.alias(out))


def fold_encoding_tables(df: DataFrame, cat: str, label: str, fold: str, k: int,
                         smoothing: float = 1.0) -> DataFrame:
    """For every held-out fold f, the encoding fitted on the other k-1 folds:
    rows (fold, _cat_key, enc, prior).  One aggregate per (fold, level);
    the totals minus the held-out part give each table."""
    y = F.col(label).cast("double")
    per = (df.groupBy(F.col(fold).alias("fold"), category_key(cat).alias("_cat_key"))
           .agg(F.count(y).alias("_n"), F.sum(y).alias("_s")))
    per_fold = per.groupBy("fold").agg(F.sum("_n").alias("_fn"), F.sum("_s").alias("_fs"))
    tot = per.groupBy("_cat_key").agg(F.sum("_n").alias("_tn"), F.sum("_s").alias("_ts"))
    all_n = per_fold.agg(F.sum("_fn").alias("_an"), F.sum("_fs").alias("_as"))
    folds = df.sparkSession.range(k).select(F.col("id").cast("int").alias("fold"))  # k rows
    grid = tot.crossJoin(F.broadcast(folds))
    t = (grid.join(per, ["fold", "_cat_key"], "left")
         .join(F.broadcast(per_fold), "fold", "left")  # at most k rows
         .crossJoin(F.broadcast(all_n)))  # one row
    n_in = F.col("_tn") - F.coalesce(F.col("_n"), F.lit(0))
    s_in = F.col("_ts") - F.coalesce(F.col("_s"), F.lit(0.0))
    prior = (F.col("_as") - F.coalesce(F.col("_fs"), F.lit(0.0))) / \
        (F.col("_an") - F.coalesce(F.col("_fn"), F.lit(0)))
    sm = F.lit(float(smoothing))
    enc = F.when(n_in > 0, (s_in + sm * prior) / (n_in + sm))
    return t.select("fold", "_cat_key", enc.alias("enc"), prior.alias("prior"))


#: Categories of up to so many levels are sent to every task, so the rows don't move; beyond that the joins shuffle.
SENT_LEVELS = 10_000


def _levels(cats) -> Column:
    """A row for each category: its name and the row's level."""
    return F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), category_key(c).alias("_cat_key")) for c in cats]))


def fit_target_encodings(train: DataFrame, cats, label: str, prior: float | None, smoothing: float = 1.0) -> DataFrame:
    """(feature, _cat_key, enc): ``fit_target_encoding`` of all categories from one pass over the rows."""
    y, s, prior = F.col("_y"), F.lit(float(smoothing)), F.lit(prior).cast("double")
    stats = (train.select(F.col(label).cast("double").alias("_y"), _levels(cats).alias("_l")).select("_y", "_l.*")
             .groupBy("feature", "_cat_key").agg(F.count(y).alias("_n"), F.avg(y).alias("_m")))
    return stats.select("feature", "_cat_key", ((F.col("_n") * F.col("_m") + s * prior) / (F.col("_n") + s)).alias("enc"))


def join_levels(df: DataFrame, cats, table: DataFrame, value: str) -> DataFrame:
    """``df`` with ``_enc_0``, ``_enc_1``, ...: the ``value`` of each row's level of
    each category, from a table of (feature, _cat_key, value); NULL where the
    table lacks the level.  The table is written, since it is counted."""
    count = {r["feature"]: r["n"] for r in table.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a category
    out = df
    for i, c in enumerate(cats):
        own = table.where(F.col("feature") == c).select(F.col("_cat_key").alias(f"_key_{i}"), F.col(value).alias(f"_enc_{i}"))
        few = count.get(c, 0) <= SENT_LEVELS
        out = out.withColumn(f"_key_{i}", category_key(c)).join(F.broadcast(own) if few else own, f"_key_{i}", "left").drop(f"_key_{i}")
    return out


def encoding_arrays(df: DataFrame, cats, label: str, fold: str, k: int,
                    smoothing: float = 1.0) -> tuple[DataFrame, list[float]]:
    """``df`` with ``_enc_0``, ``_enc_1``, ...: for each category the encodings
    that are fitted without fold 0, 1, ... (an array of k, NULL where a level is
    unknown to the other folds); and the k priors.  The levels of all categories
    are counted in one pass, and joined once a category."""
    y = F.col(label).cast("double")
    own = {r["fold"]: (r["n"], r["s"]) for r in df.groupBy(F.col(fold).alias("fold")).agg(
        F.count(y).alias("n"), F.coalesce(F.sum(y), F.lit(0.0)).alias("s")).collect()}  # k rows
    n_all, s_all = (sum(v[j] for v in own.values()) for j in (0, 1))
    priors = []
    for f in range(k):
        n, s = own.get(f, (0, 0.0))
        priors.append(float((s_all - s) / (n_all - n)) if n_all > n else 0.0)
    if not cats:
        return df, priors
    per = (df.select(y.alias("_y"), F.col(fold).alias("fold"), _levels(cats).alias("_l")).select("_y", "fold", "_l.*")
           .groupBy("feature", "_cat_key", "fold").agg(F.count("_y").alias("_n"), F.sum("_y").alias("_s")))
    held = [(F.sum(F.when(F.col("fold") == f, F.col(c))).alias(f"{c}{f}")) for f in range(k) for c in ("_n", "_s")]
    tot = per.groupBy("feature", "_cat_key").agg(F.sum("_n").alias("_tn"), F.sum("_s").alias("_ts"), *held)
    sm, encodings = F.lit(float(smoothing)), []
    for f in range(k):
        n_in = F.col("_tn") - F.coalesce(F.col(f"_n{f}"), F.lit(0))
        s_in = F.col("_ts") - F.coalesce(F.col(f"_s{f}"), F.lit(0.0))
        encodings.append(F.when(n_in > 0, (s_in + sm * F.lit(priors[f])) / (n_in + sm)))
    table = cut_lineage(tot.select("feature", "_cat_key", F.array(*encodings).alias("enc")))
    return join_levels(df, cats, table, "enc"), priors


def oof_encode(df: DataFrame, cat: str, label: str, fold: str, k: int, out: str,
               smoothing: float = 1.0, drop_source: bool = True) -> DataFrame:
    """Out-of-fold column: each row gets the encoding fitted without its fold."""
    tables = fold_encoding_tables(df, cat, label, fold, k, smoothing)
    priors = tables.select("fold", "prior").distinct()
    j = (df.withColumn("_cat_key", category_key(cat))
         .join(tables.select(F.col("fold").alias(fold), "_cat_key", "enc"), [fold, "_cat_key"], "left")
         .join(F.broadcast(priors.withColumnRenamed("fold", fold)), fold, "left"))  # k rows
    keep = [c for c in df.columns if not (drop_source and c == cat)]
    return j.select(*keep, F.coalesce(F.col("enc"), F.col("prior")).alias(out))
