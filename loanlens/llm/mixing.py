"""Operator 3: mixing sources to target weights.

Sources share ``share`` times the words of all documents by their weights; a
target stops at ``most`` times its source's words and the excess is shared
again by weight (water filling).  Inside a source each document gets an
Efraimidis-Spirakis key, an exponential variate divided by its quality
weight: key = -ln(u) / weight with u from a hash of ``doc_id``.  A target
above the source's size first takes whole epochs of it; what is left is
filled with documents in ascending order of the key, up to the document that
brings the source nearest to its target.

The running sum is distributed: the rows are range-partitioned on source, key,
``doc_id``, size and row into slots of about ``SLOT_ROWS`` rows, whatever the
weights and ids; each slot is summed by itself, and slots add the sums of the
slots before them.  A source with a third of all rows has many slots.  The
sums over sources are distributed alike.

The quality weight of a text is the share of letters and their marks, of any
script, among its characters other than white space:
(1 + letters) / (1 + characters).

Defined results: a null or empty text has size 0; a null source is a source and
comes last; rows with the same ``doc_id`` are rows of their own with one key;
equal keys go by ``doc_id``, size and row; a source of size 0 has target 0; very
long texts are rows like others; an empty table gives no rows; carried columns
keep their names inside a struct, so none clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanlens.llm.storage import Workspace
from loanlens.operators.ordered import prefix_sums

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SLOT_ROWS = 4_000
#: Range partitions at most; beyond that slots get longer.
MOST_SLOTS = 20_000
#: Sources up to this many are sent to every task; more are joined by a shuffle.
SENT_SOURCES = 100_000


def word_count(text: str | Column) -> Column:
    """Runs of characters other than space and \\t\\n\\v\\f\\r; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: str | Column) -> Column:
    shown = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    others = F.length(F.regexp_replace(text, r"[\p{L}\p{M}\x20\x09-\x0D]+", ""))
    return F.coalesce((F.lit(1.0) + shown - others) / (F.lit(1.0) + shown), F.lit(1.0))


def uniform(key: Column) -> Column:
    """A number in (0, 1) from 48 bits of the key's MD5; a null counts as the empty string."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(1.0)) / F.lit(2.0 ** 48 + 1.0)


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """``sources`` (source, source_size) with their weight and target.

    A source is full while its cap per weight is at most what each weight
    unit still gets; the level of the first that isn't holds for all after it.
    """
    named = sources.select("source", "source_size", F.col("source").isNull().alias("nameless"), F.lit(1).alias("one"))
    named = prefix_sums(named, [], ["nameless", "source"], {"one": ("ahead", "n")})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("ahead") % len(weights) + 1).cast("int"))
    led = (named.drop("n", "one").withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most))
           .withColumn("ratio", F.col("cap") / F.col("weight")))
    led = prefix_sums(led, [], ["ratio", "nameless", "source"], {
        "cap": ("cap_before", "cap_all"), "weight": ("weight_before", "weight_all"),
        "source_size": ("size_before", "size_all")})
    led = led.withColumn("level", (F.col("size_all") * F.lit(share) - F.col("cap_before"))
                         / (F.col("weight_all") - F.col("weight_before")))
    first = led.where("ratio > level").agg(F.min(F.struct("ratio", "nameless", "source", "level")).alias("first"))
    target = F.least("cap", F.coalesce(F.col("first.level") * F.col("weight"), F.col("cap")))
    return led.crossJoin(F.broadcast(first)).select("source", "source_size", target.alias("target"))


def mix_documents(docs: DataFrame, carry: list[str], weights: tuple[int, ...] = WEIGHTS,
                  share: float = SHARE, most: float = MOST) -> DataFrame:
    """``carry`` columns with size, source_size, target and copies (0, 1 or more)."""
    work = Workspace(docs.sparkSession, "mixing")
    kept = F.struct(*[F.col(c) for c in carry]).alias("row")
    slots = min(MOST_SLOTS, max(1, -(-docs.count() // SLOT_ROWS)))
    rows = docs.select(
        kept, F.col("source").cast("string").alias("source"), F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id").alias("tie"), word_count("text").alias("size"),
        (-F.log(uniform(F.col("doc_id"))) / quality_weight("text")).alias("key"))
    # written first: the bounds of the ranges are sampled from the keys alone
    keyed = work.write(rows, "keyed")
    rows = work.write(keyed.repartitionByRange(slots, "source", "key", "tie", "size", "uid")
                      .withColumn("slot", F.spark_partition_id()), "rows")
    work.remove("keyed")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = work.write(source_targets(sources, weights, share, most), "targets")
    if targets.count() <= SENT_SOURCES:
        targets = F.broadcast(targets)
    led = (rows.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
           .drop("of"))
    sums = led.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    ahead = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = work.write(sums.select(F.col("source").alias("of"), F.col("slot").alias("at"),
                                  F.coalesce(F.sum("slot_size").over(ahead), F.lit(0)).alias("base")), "slots")
    inside = Window.partitionBy("source", "slot").orderBy("key", "tie", "size", "uid")
    run = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    led = led.withColumn("run", run).join(
        sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("slot") == F.col("at")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    budget = F.col("target") - epochs * F.col("source_size")
    before = F.col("base") + F.col("run") - F.col("size")
    chosen = (before + F.col("size") / 2 <= budget) & (budget > 0)
    copies = (epochs + chosen.cast("long")).cast("long")
    return led.select("row.*", "size", "source_size", "target", copies.alias("copies"))


def mixing_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The query: what the mix takes of each document."""
    mixed = mix_documents(docs.select("doc_id", "text", "source"), ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE_SQL = r"""
WITH rows AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce((1.0 + length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))
                   - length(regexp_replace(text, '[\p{L}\p{M}\x20\x09-\x0D]+', '', 'g')))::DOUBLE
                  / (1.0 + length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))), 1.0)::DOUBLE AS quality,
         (('0x' || substr(md5(doc_id::VARCHAR), 1, 12))::BIGINT::DOUBLE + 1.0) / (281474976710656.0::DOUBLE + 1.0) AS u
  FROM documents),
keyed AS (SELECT *, -ln(u) / quality AS key FROM rows),
sources AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM rows GROUP BY source),
caps AS (SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / weight AS ratio FROM sources),
levels AS (
  SELECT *, row_number() OVER (ORDER BY ratio, source NULLS LAST) AS place,
         (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0.0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0.0)) AS level
  FROM caps WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
open AS (SELECT level AS open_level FROM levels WHERE ratio > level ORDER BY place LIMIT 1),
targets AS (SELECT source, source_size, least(cap, coalesce(open_level * weight, cap))::DOUBLE AS target
            FROM levels LEFT JOIN open ON true),
runs AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - k.size AS ahead
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0.0 END AS epochs FROM runs)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (epochs + CASE WHEN ahead + size / 2.0 <= target - epochs * source_size
                               AND target - epochs * source_size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM parts
"""
