"""Checked queries over the driver tables.

Each entry runs library operators (the same ones the domain plans use)
over whole driver tables and has an independent DuckDB SQL oracle next to
it.  Names are inventory ids + slug.  Doubles are rounded identically on
both sides (summation order differs); counts are BIGINT on both sides.
Nulls are injected inside the query (the driver tables hold none).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions import (clip_lower_keep_null, div_eps, div_ieee, div_null,
                                div_one_plus, flag, null_skipping_sum, row_max, row_mean,
                                row_median, row_min, row_std, zero_filled_mean)
from loanlens.operators.encoders import (add_group_statistics, add_zscores, bin_label,
                                         fit_categories, median_impute, polynomial_exprs)
from loanlens.operators.latest import By, pick_expr, pick_per_group
from loanlens.operators.ordered import average_rank, cumulative_by_score, dense_codes
from loanlens.operators.rollup import conditional_rollup, pandas_style_name
from loanlens.operators.stats import group_quantiles, safe_cv, safe_kurt, safe_skew
from loanlens.operators.target_encoding import apply_target_encoding, fit_target_encoding, oof_encode
from loanlens.functions import fill_zero
from loanlens.plans import wide_checks
from loanlens.session import checkpoint_dir, cut_lineage, shuffles_removed
from loanlens.sources.io import sanitize_name

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def R(c, n=4):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def _days(c):
    return F.datediff(F.col(c).cast("date"), F.to_date(F.lit("2002-01-01")))


SQL_DAYS = "datediff('day', DATE '2002-01-01', CAST({c} AS DATE))"


def _round_all(df: DataFrame, keep: list[str], n: int = 4) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if f.name in keep or f.dataType.typeName() != "double":
            out.append(F.col(f.name))
        else:
            out.append(F.round(F.col(f.name), n).alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------------------
# Nested roll-up (flagship)
# ---------------------------------------------------------------------------
LOAN_SPEC_ALL = {"o_orderkey": ["count"], "o_totalprice": ["max", "mean", "sum"],
                 "n_lines": ["mean", "sum"], "price_std": ["mean"], "o_shipdays": ["min"],
                 "o_years": ["var"]}
LOAN_SPEC_STATUS = {"o_totalprice": ["mean", "sum"], "n_lines": ["mean", "sum"],
                    "o_orderkey": ["count"]}


def nested_rollup(spark: SparkSession, sf: str) -> DataFrame:
    li, o, c = _t(spark, sf, "lineitem"), _t(spark, sf, "orders"), _t(spark, sf, "customer")
    loan = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty_sum"),
        F.stddev_samp("l_extendedprice").alias("price_std"))
    orders = o.withColumn("o_shipdays", _days("o_orderdate")) \
        .withColumn("o_years", F.col("o_shipdays") / 365.0)
    b = fill_zero(orders.join(loan, "o_orderkey", "left"), ["n_lines", "qty_sum", "price_std"])
    closed, active = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    agg = conditional_rollup(b, "o_custkey", [
        (LOAN_SPEC_ALL, pandas_style_name("ALL_"), None),
        (LOAN_SPEC_STATUS, pandas_style_name("CLOSED_"), closed),
        (LOAN_SPEC_STATUS, pandas_style_name("ACTIVE_"), active),
    ])
    ratios = [div_null(f"ACTIVE_{col}_{s.upper()}", f"CLOSED_{col}_{s.upper()}")
              .alias(f"RATIO_ACTIVE_{col}_{s.upper()}") for col, st in LOAN_SPEC_STATUS.items() for s in st]
    agg = agg.select("*", *ratios)
    out = c.select("c_custkey").join(agg, c.c_custkey == agg.o_custkey, "left").drop("o_custkey")
    return _round_all(out, ["c_custkey"], 4)


def _sql_nested():
    def cond_block(prefix, status):
        f = f"FILTER (WHERE o_orderstatus = '{status}')"
        has = f"count(*) {f} > 0"
        parts = []
        for col, st in LOAN_SPEC_STATUS.items():
            for s in st:
                e = {"mean": f"avg({col}) {f}", "sum": f"coalesce(sum({col}) {f}, 0)",
                     "count": f"count({col}) {f}"}[s]
                parts.append(f"CASE WHEN {has} THEN {e} END AS {prefix}{col}_{s.upper()}")
        return parts
    allp = ["count(o_orderkey) AS ALL_o_orderkey_COUNT", "max(o_totalprice) AS ALL_o_totalprice_MAX",
            "avg(o_totalprice) AS ALL_o_totalprice_MEAN",
            "coalesce(sum(o_totalprice), 0) AS ALL_o_totalprice_SUM",
            "avg(n_lines) AS ALL_n_lines_MEAN", "coalesce(sum(n_lines), 0) AS ALL_n_lines_SUM",
            "avg(price_std) AS ALL_price_std_MEAN", "min(o_shipdays) AS ALL_o_shipdays_MIN",
            "var_samp(o_shipdays / 365.0) AS ALL_o_years_VAR"]
    cols = allp + cond_block("CLOSED_", "F") + cond_block("ACTIVE_", "O")
    ratio = [f"CASE WHEN CLOSED_{c}_{s.upper()} = 0 THEN NULL ELSE ACTIVE_{c}_{s.upper()} / CLOSED_{c}_{s.upper()} END "
             f"AS RATIO_ACTIVE_{c}_{s.upper()}" for c, st in LOAN_SPEC_STATUS.items() for s in st]
    names = ([p.rsplit(" AS ", 1)[1] for p in cols] +
             [f"RATIO_ACTIVE_{c}_{s.upper()}" for c, st in LOAN_SPEC_STATUS.items() for s in st])
    ints = {"ALL_o_orderkey_COUNT", "ALL_n_lines_SUM", "CLOSED_n_lines_SUM", "ACTIVE_n_lines_SUM",
            "CLOSED_o_orderkey_COUNT", "ACTIVE_o_orderkey_COUNT", "ALL_o_shipdays_MIN"}
    sel = ", ".join(f"CAST({n} AS BIGINT) AS {n}" if n in ints and n != "ALL_o_shipdays_MIN"
                    else (f"CAST({n} AS INTEGER) AS {n}" if n == "ALL_o_shipdays_MIN" else f"round({n}, 4) AS {n}")
                    for n in names)
    return f"""
WITH loan AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty_sum,
         stddev_samp(l_extendedprice) AS price_std
  FROM lineitem GROUP BY l_orderkey),
b AS (
  SELECT o.*, {SQL_DAYS.format(c='o.o_orderdate')} AS o_shipdays,
         coalesce(loan.n_lines, 0) AS n_lines, coalesce(loan.price_std, 0) AS price_std
  FROM orders o LEFT JOIN loan ON o.o_orderkey = loan.l_orderkey),
agg AS (SELECT o_custkey, {", ".join(cols)} FROM b GROUP BY o_custkey),
agg2 AS (SELECT *, {", ".join(ratio)} FROM agg)
SELECT c.c_custkey, {sel}
FROM customer c LEFT JOIN agg2 ON c.c_custkey = agg2.o_custkey
"""


register("a1_a5_nested_rollup", _sql_nested())(nested_rollup)


# ---------------------------------------------------------------------------
# Category codes, dummy means, overdue flag
# ---------------------------------------------------------------------------
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("e1_a7_a9_codes_dummies_overdue", f"""
WITH o AS (
  SELECT o_custkey, o_totalprice,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS prio
  FROM orders),
codes AS (SELECT prio, CAST(dense_rank() OVER (ORDER BY prio) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT prio FROM o WHERE prio IS NOT NULL))
SELECT o_custkey,
  round(avg(coalesce(codes.code, -1)), 4) AS PRIO_CODE_MEAN,
  {", ".join(f"round(avg(CASE WHEN o.prio = '{v}' THEN 1.0 ELSE 0.0 END), 4) AS OHE_MEAN_{sanitize_name(v)}" for v in PRIORITIES)},
  CAST(sum(CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END) AS BIGINT) AS OVERDUE_COUNT,
  CAST(CASE WHEN sum(CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS INTEGER) AS HAS_OVERDUE
FROM o LEFT JOIN codes ON o.prio = codes.prio
GROUP BY o_custkey
""")
def codes_dummies(spark, sf):
    o = _t(spark, sf, "orders").select(
        "o_custkey", "o_totalprice",
        F.when(F.col("o_orderkey") % 10 == 0, None).otherwise(F.col("o_orderpriority")).alias("prio"))
    coded = dense_codes(o, "prio", "code")
    values = fit_categories(coded, ["prio"])["prio"]
    over = F.sum(flag(F.col("o_totalprice") > 400000))
    aggs = [R(F.avg("code")).alias("PRIO_CODE_MEAN")]
    aggs += [R(F.avg(flag(F.col("prio") == v).cast("double"))).alias(f"OHE_MEAN_{sanitize_name(v)}")
             for v in values]
    aggs += [over.cast("long").alias("OVERDUE_COUNT"), (over > 0).cast("int").alias("HAS_OVERDUE")]
    return coded.groupBy("o_custkey").agg(*aggs)


# ---------------------------------------------------------------------------
# A10: exact quantiles with NULL poison
# ---------------------------------------------------------------------------
@register("a10_quantile_null_poison", """
SELECT o_custkey,
  round(CASE WHEN count(p) = count(*) THEN quantile_cont(p, 0.25) END, 4) AS Q25_PRICE,
  round(CASE WHEN count(o_totalprice) = count(*) THEN quantile_cont(o_totalprice, 0.75) END, 4) AS Q75_PRICE,
  round(CASE WHEN count(d) = count(*) THEN quantile_cont(d, 0.25) END, 4) AS Q25_DAYS
FROM (SELECT o_custkey, o_totalprice,
             CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_totalprice END AS p,
             CAST(datediff('day', DATE '2002-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS d
      FROM orders)
GROUP BY o_custkey
""")
def quantiles(spark, sf):
    o = _t(spark, sf, "orders").select(
        "o_custkey", "o_totalprice",
        F.when(F.col("o_orderkey") % 23 == 0, None).otherwise(F.col("o_totalprice")).alias("p"),
        _days("o_orderdate").cast("double").alias("d"))
    q = group_quantiles(o, "o_custkey", [("p", 0.25, "Q25_PRICE"), ("o_totalprice", 0.75, "Q75_PRICE"),
                                         ("d", 0.25, "Q25_DAYS")])
    return _round_all(q, ["o_custkey"])


# ---------------------------------------------------------------------------
# Skewness, kurtosis, coefficient of variation
# ---------------------------------------------------------------------------
@register("a21_a23_skew_kurt_cv", """
WITH x AS (
  SELECT o.o_custkey AS k,
         CASE WHEN l.l_partkey % 17 = 0 THEN NULL ELSE l.l_extendedprice / 1000.0 END AS v,
         l.l_quantity AS q
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
m AS (SELECT k, avg(v) AS mu, count(*) AS n_rows FROM x GROUP BY k),
c AS (
  SELECT x.k, m.n_rows,
         avg(power(v - mu, 2)) AS m2, avg(power(v - mu, 3)) AS m3, avg(power(v - mu, 4)) AS m4,
         avg(q) AS q_mean, stddev_samp(q) AS q_std
  FROM x JOIN m ON x.k = m.k GROUP BY x.k, m.n_rows)
SELECT k,
  round(CASE WHEN n_rows >= 3 AND m2 > 0 THEN m3 / power(m2, 1.5) END, 4) AS V_SKEW,
  round(CASE WHEN n_rows >= 4 AND m2 > 0 THEN m4 / (m2 * m2) - 3 END, 4) AS V_KURT,
  round(CASE WHEN abs(q_mean) >= 1e-10 THEN q_std / q_mean END, 4) AS Q_CV
FROM c
""")
def moments(spark, sf):
    li, o = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    x = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("k"),
        F.when(F.col("l_partkey") % 17 == 0, None).otherwise(F.col("l_extendedprice") / 1000.0).alias("v"),
        F.col("l_quantity").alias("q"))
    return x.groupBy("k").agg(R(safe_skew("v")).alias("V_SKEW"), R(safe_kurt("v")).alias("V_KURT"),
                              R(safe_cv("q")).alias("Q_CV"))


# ---------------------------------------------------------------------------
# Distinct loans; approved = status of the pair's first row
# ---------------------------------------------------------------------------
@register("a14_j7_u4_distinct_pairs", """
WITH r AS (
  SELECT l_orderkey, l_linenumber, l_returnflag,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS rn
  FROM lineitem)
SELECT l_orderkey,
  CAST(count(DISTINCT l_linenumber) AS BIGINT) AS PAIRS_TOTAL,
  CAST(count(DISTINCT CASE WHEN rn = 1 AND l_returnflag = 'R' THEN l_linenumber END) AS BIGINT) AS PAIRS_FIRST_R,
  CAST(count(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_linenumber END) AS BIGINT) AS PAIRS_ANY_A,
  CAST(count(DISTINCT CASE WHEN l_returnflag = 'N' THEN l_linenumber END) AS BIGINT) AS PAIRS_ANY_N
FROM r GROUP BY l_orderkey
""")
def distinct_pairs(spark, sf):
    li = _t(spark, sf, "lineitem").withColumns({
        "_d": _days("l_shipdate"), "_r": flag(F.col("l_returnflag") == "R")})
    first = [By("_d", "min"), By("l_partkey", "min"), By("l_suppkey", "min"),
             By("l_extendedprice", "min"), By("l_quantity", "min"), By("l_discount", "min"),
             By("l_tax", "min")]
    pairs = li.groupBy("l_orderkey", "l_linenumber").agg(
        pick_expr(first, ["_r"]).alias("_first"),
        F.max(flag(F.col("l_returnflag") == "A")).alias("_a"),
        F.max(flag(F.col("l_returnflag") == "N")).alias("_n"))
    return pairs.groupBy("l_orderkey").agg(
        F.count("l_linenumber").alias("PAIRS_TOTAL"),
        F.sum(F.col("_first")["_p"]["_r"]).cast("long").alias("PAIRS_FIRST_R"),
        F.sum("_a").cast("long").alias("PAIRS_ANY_A"),
        F.sum("_n").cast("long").alias("PAIRS_ANY_N"))


# ---------------------------------------------------------------------------
# Latest loan's categories (max recency, first on ties)
# ---------------------------------------------------------------------------
@register("w1_latest_per_borrower", """
SELECT o_custkey, o_orderkey AS LATEST_ORDER, o_orderstatus AS LATEST_STATUS,
       o_orderpriority AS LATEST_PRIORITY
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
      FROM orders) WHERE rn = 1
""")
def latest_per_borrower(spark, sf):
    o = _t(spark, sf, "orders").withColumn("_d", _days("o_orderdate"))
    p = pick_per_group(o, "o_custkey", [By("_d", "max"), By("o_orderkey", "min")],
                       ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return p.select("o_custkey", F.col("o_orderkey").alias("LATEST_ORDER"),
                    F.col("o_orderstatus").alias("LATEST_STATUS"),
                    F.col("o_orderpriority").alias("LATEST_PRIORITY"))


# ---------------------------------------------------------------------------
# Status of each loan's most recent month, counted per borrower
# ---------------------------------------------------------------------------
@register("w2_a17_recent_status_counts", """
WITH last AS (
  SELECT l_orderkey, l_returnflag FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn
    FROM lineitem) WHERE rn = 1),
per AS (
  SELECT o.o_custkey, count(*) FILTER (WHERE last.l_returnflag = 'R') AS r,
         count(*) FILTER (WHERE last.l_returnflag = 'A') AS a
  FROM last JOIN orders o ON last.l_orderkey = o.o_orderkey GROUP BY o.o_custkey)
SELECT c.c_custkey, CAST(coalesce(per.r, 0) AS INTEGER) AS COUNT_R_LAST_MONTH,
       CAST(coalesce(per.a, 0) AS INTEGER) AS COUNT_A_LAST_MONTH
FROM customer c LEFT JOIN per ON c.c_custkey = per.o_custkey
""")
def recent_status(spark, sf):
    li, o, c = _t(spark, sf, "lineitem"), _t(spark, sf, "orders"), _t(spark, sf, "customer")
    li = li.withColumn("_d", _days("l_shipdate"))
    last = pick_per_group(li, "l_orderkey",
                          [By("_d", "max"), By("l_linenumber", "min"), By("l_partkey", "min"),
                           By("l_suppkey", "min"), By("l_extendedprice", "min"), By("l_quantity", "min")],
                          ["l_returnflag"])
    per = last.join(o, last.l_orderkey == o.o_orderkey).groupBy("o_custkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("r"),
        F.count_if(F.col("l_returnflag") == "A").alias("a"))
    out = c.select("c_custkey").join(per, c.c_custkey == per.o_custkey, "left")
    return out.select("c_custkey", F.coalesce("r", F.lit(0)).cast("int").alias("COUNT_R_LAST_MONTH"),
                      F.coalesce("a", F.lit(0)).cast("int").alias("COUNT_A_LAST_MONTH"))


# ---------------------------------------------------------------------------
# Last instalment version — NULL due day sorts last and wins
# ---------------------------------------------------------------------------
@register("w3_last_due_null_wins", """
SELECT l_orderkey, l_quantity AS LAST_DUE_QUANTITY FROM (
  SELECT l_orderkey, l_quantity,
         row_number() OVER (PARTITION BY l_orderkey
            ORDER BY (due IS NULL) DESC, due DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                     l_extendedprice DESC) AS rn
  FROM (SELECT *, CASE WHEN l_partkey % 29 = 0 THEN NULL
                       ELSE datediff('day', DATE '2002-01-01', CAST(l_shipdate AS DATE)) END AS due
        FROM lineitem)) WHERE rn = 1
""")
def last_due(spark, sf):
    li = _t(spark, sf, "lineitem").withColumn(
        "due", F.when(F.col("l_partkey") % 29 == 0, None).otherwise(_days("l_shipdate")))
    p = pick_per_group(li, "l_orderkey",
                       [By("due", "max", "win"), By("l_linenumber", "max"), By("l_partkey", "max"),
                        By("l_suppkey", "max"), By("l_extendedprice", "max")], ["l_quantity"])
    return p.select("l_orderkey", F.col("l_quantity").alias("LAST_DUE_QUANTITY"))


# ---------------------------------------------------------------------------
# Group-statistic recipes joined back, with deviations
# ---------------------------------------------------------------------------
@register("a26_j3_x6_group_statistics", """
WITH c AS (
  SELECT c_custkey, c_mktsegment, c_acctbal,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_nationkey END AS nk,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS bal2
  FROM customer),
g1 AS (SELECT c_mktsegment, nk, avg(c_acctbal) AS m, max(c_acctbal) AS mx, coalesce(sum(bal2), 0) AS s
       FROM c WHERE c_mktsegment IS NOT NULL AND nk IS NOT NULL GROUP BY c_mktsegment, nk),
g2 AS (SELECT c_mktsegment, avg(bal2) AS m2 FROM c WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment)
SELECT c.c_custkey,
  round(g1.m, 4) AS c_mktsegment_nk_MEAN_c_acctbal,
  round(g1.mx, 4) AS c_mktsegment_nk_MAX_c_acctbal,
  round(g1.s, 2) AS c_mktsegment_nk_SUM_bal2,
  round(g2.m2, 4) AS c_mktsegment_MEAN_bal2,
  round(c.c_acctbal - g1.m, 4) AS c_mktsegment_nk_MEAN_c_acctbal_DIFF,
  round(abs(c.c_acctbal - g1.m), 4) AS c_mktsegment_nk_MEAN_c_acctbal_ABS_DIFF,
  round(c.c_acctbal - g1.mx, 4) AS c_mktsegment_nk_MAX_c_acctbal_DIFF,
  round(abs(c.c_acctbal - g1.mx), 4) AS c_mktsegment_nk_MAX_c_acctbal_ABS_DIFF,
  round(c.bal2 - g2.m2, 4) AS c_mktsegment_MEAN_bal2_DIFF,
  round(abs(c.bal2 - g2.m2), 4) AS c_mktsegment_MEAN_bal2_ABS_DIFF
FROM c LEFT JOIN g1 ON c.c_mktsegment = g1.c_mktsegment AND c.nk = g1.nk
       LEFT JOIN g2 ON c.c_mktsegment = g2.c_mktsegment
""")
def group_statistics(spark, sf):
    c = _t(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", "c_acctbal",
        F.when(F.col("c_custkey") % 17 == 0, None).otherwise(F.col("c_nationkey")).alias("nk"),
        F.when(F.col("c_custkey") % 3 == 0, None).otherwise(F.col("c_acctbal")).alias("bal2"))
    out = add_group_statistics(c, [
        (["c_mktsegment", "nk"], [("c_acctbal", "mean"), ("c_acctbal", "max"), ("bal2", "sum")]),
        (["c_mktsegment"], [("bal2", "mean")]),
    ])
    out = out.drop("c_mktsegment", "nk", "c_acctbal", "bal2")
    r = _round_all(out, ["c_custkey"])
    return r.withColumn("c_mktsegment_nk_SUM_bal2", R("c_mktsegment_nk_SUM_bal2", 2))


# ---------------------------------------------------------------------------
# Legacy counts, status count and share, dummy mean and sum
# ---------------------------------------------------------------------------
@register("a32_a35_status_counts_shares", f"""
SELECT o_custkey,
  CAST(count(o_orderkey) AS BIGINT) AS LOAN_COUNT,
  CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS LOAN_TYPES,
  round(count(o_orderkey) / (count(DISTINCT o_orderpriority) + 1e-8), 4) AS AVERAGE_LOAN_TYPE,
  {", ".join(f"CAST(count(*) FILTER (WHERE o_orderstatus = '{s}') AS BIGINT) AS STATUS_{s}_count, round(count(*) FILTER (WHERE o_orderstatus = '{s}') / count(*), 4) AS STATUS_{s}_ratio" for s in "FOP")},
  {", ".join(f"round(avg(CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END), 4) AS PRIO_{sanitize_name(v)}_MEAN, CAST(sum(CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS PRIO_{sanitize_name(v)}_SUM" for v in PRIORITIES)},
  round(avg((o_totalprice * (o_orderkey % 5) / 4) / (o_totalprice + 1e-8)), 4) AS DEBT_CREDIT_RATIO_MEAN
FROM orders GROUP BY o_custkey
""")
def status_counts(spark, sf):
    o = _t(spark, sf, "orders")
    n = F.count(F.lit(1))
    aggs = [F.count("o_orderkey").alias("LOAN_COUNT"),
            F.count_distinct("o_orderpriority").alias("LOAN_TYPES"),
            R(div_eps(F.count("o_orderkey"), F.count_distinct("o_orderpriority"), 1e-8)).alias("AVERAGE_LOAN_TYPE")]
    for s in "FOP":
        cnt = F.count_if(F.col("o_orderstatus") == s)
        aggs += [cnt.alias(f"STATUS_{s}_count"), R(cnt / n).alias(f"STATUS_{s}_ratio")]
    for v in PRIORITIES:
        d = flag(F.col("o_orderpriority") == v)
        aggs += [R(F.avg(d)).alias(f"PRIO_{sanitize_name(v)}_MEAN"),
                 F.sum(d).cast("long").alias(f"PRIO_{sanitize_name(v)}_SUM")]
    debt = F.col("o_totalprice") * (F.col("o_orderkey") % 5) / 4
    aggs.append(R(F.avg(div_eps(debt, F.col("o_totalprice"), 1e-8))).alias("DEBT_CREDIT_RATIO_MEAN"))
    return o.groupBy("o_custkey").agg(*aggs)


# ---------------------------------------------------------------------------
# Loan-count bins (right-closed)
# ---------------------------------------------------------------------------
@register("e7_count_bins", """
WITH per AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS nf
             FROM orders GROUP BY o_custkey)
SELECT o_custkey, CAST(n AS BIGINT) AS N_LOANS,
  CASE WHEN n > 0 AND n <= 1 THEN '1' WHEN n > 1 AND n <= 3 THEN '2-3' WHEN n > 3 AND n <= 5 THEN '4-5'
       WHEN n > 5 AND n <= 10 THEN '6-10' WHEN n > 10 AND n <= 1000 THEN '>10' END AS N_LOANS_CAT,
  CASE WHEN nf > 0 AND nf <= 1 THEN '1' WHEN nf > 1 AND nf <= 3 THEN '2-3' WHEN nf > 3 AND nf <= 5 THEN '4-5'
       WHEN nf > 5 AND nf <= 10 THEN '6-10' WHEN nf > 10 AND nf <= 1000 THEN '>10' END AS N_CLOSED_CAT
FROM per
""")
def count_bins(spark, sf):
    per = _t(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("N_LOANS"), F.count_if(F.col("o_orderstatus") == "F").alias("nf"))
    return per.select("o_custkey", "N_LOANS", bin_label("N_LOANS").alias("N_LOANS_CAT"),
                      bin_label("nf").alias("N_CLOSED_CAT"))


# ---------------------------------------------------------------------------
# Z-score, exact median imputation, polynomial
# ---------------------------------------------------------------------------
@register("e8_e9_e10_zscore_impute_poly", """
WITH c AS (SELECT c_custkey, c_acctbal, CAST(c_nationkey AS DOUBLE) AS nat,
                  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal
           FROM customer),
s AS (SELECT avg(c_acctbal) AS mu, stddev_samp(c_acctbal) AS sd, median(bal) AS med_bal,
             median(nat) AS med_nat FROM c),
i AS (SELECT c.*, coalesce(bal, med_bal) AS bal_i, coalesce(nat, med_nat) AS nat_i, mu, sd FROM c, s)
SELECT c_custkey,
  round(CASE WHEN sd > 0 THEN (c_acctbal - mu) / sd END, 4) AS Z_c_acctbal,
  round(bal_i, 4) AS "POLY_bal", round(nat_i, 4) AS "POLY_nat",
  round(bal_i * bal_i, 2) AS "POLY_bal^2", round(bal_i * nat_i, 2) AS "POLY_bal nat",
  round(nat_i * nat_i, 4) AS "POLY_nat^2"
FROM i
""")
def zscore_poly(spark, sf):
    c = _t(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nat"),
        F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_acctbal")).alias("bal"))
    z = add_zscores(c, ["c_acctbal"])
    imp = median_impute(z, ["bal", "nat"], suffix="_i")
    out = imp.select("c_custkey", "Z_c_acctbal",
                     *polynomial_exprs(["bal", "nat"], source={"bal": "bal_i", "nat": "nat_i"}))
    r = _round_all(out, ["c_custkey"])
    return r.withColumns({"POLY_bal^2": R("POLY_bal^2", 2), "POLY_bal nat": R("POLY_bal nat", 2)})


# ---------------------------------------------------------------------------
# Smoothed target encoding, NULL level 'nan', unseen -> prior
# ---------------------------------------------------------------------------
_DOCS_SQL = """SELECT d.doc_id, CASE WHEN d.doc_id % 9 = 0 THEN NULL ELSE d.lang END AS lang, d.source,
                   d.n_chars, l.quality
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def _docs(spark, sf):
    d, lab = _t(spark, sf, "documents"), _t(spark, sf, "labels")
    return d.join(lab, "doc_id", "left").select(
        "doc_id", F.when(F.col("doc_id") % 9 == 0, None).otherwise(F.col("lang")).alias("lang"),
        "source", "n_chars", "quality")


@register("e4_target_encoding", f"""
WITH d AS ({_DOCS_SQL}),
tr AS (SELECT * FROM d WHERE quality IS NOT NULL),
p AS (SELECT avg(quality) AS prior FROM tr),
st AS (SELECT coalesce(lang, 'nan') AS k, count(quality) AS n, avg(quality) AS m FROM tr GROUP BY 1),
enc AS (SELECT k, (n * m + 5 * prior) / (n + 5) AS e FROM st, p)
SELECT d.doc_id, round(coalesce(enc.e, p.prior), 6) AS LANG_TARGET_ENCODED
FROM d LEFT JOIN enc ON coalesce(d.lang, 'nan') = enc.k CROSS JOIN p
""")
def target_encoding(spark, sf):
    d = _docs(spark, sf)
    tr = d.where(F.col("quality").isNotNull())
    table, prior = fit_target_encoding(tr, "lang", "quality", smoothing=5)
    out = apply_target_encoding(d, "lang", table, prior, "LANG_TARGET_ENCODED")
    return out.select("doc_id", R("LANG_TARGET_ENCODED", 6).alias("LANG_TARGET_ENCODED"))


# ---------------------------------------------------------------------------
# Out-of-fold encoding (fold given in the query)
# ---------------------------------------------------------------------------
@register("e6_oof_target_encoding", f"""
WITH d AS (SELECT *, CAST(doc_id % 8 AS INTEGER) AS fold FROM ({_DOCS_SQL}) WHERE quality IS NOT NULL),
per AS (SELECT fold, coalesce(source, 'nan') AS k, count(quality) AS n, sum(quality) AS s FROM d GROUP BY 1, 2),
tot AS (SELECT k, sum(n) AS tn, sum(s) AS ts FROM per GROUP BY k),
pf AS (SELECT fold, sum(n) AS fn, sum(s) AS fs FROM per GROUP BY fold),
al AS (SELECT sum(n) AS an, sum(s) AS as_ FROM per),
j AS (
  SELECT d.doc_id, d.fold, coalesce(d.source, 'nan') AS k,
         tot.tn - coalesce(per.n, 0) AS n_in, tot.ts - coalesce(per.s, 0) AS s_in,
         (al.as_ - pf.fs) / (al.an - pf.fn) AS prior
  FROM d JOIN tot ON coalesce(d.source, 'nan') = tot.k
         LEFT JOIN per ON per.fold = d.fold AND per.k = coalesce(d.source, 'nan')
         JOIN pf ON pf.fold = d.fold CROSS JOIN al)
SELECT doc_id, round(CASE WHEN n_in > 0 THEN (s_in + 5 * prior) / (n_in + 5) ELSE prior END, 6) AS SOURCE_OOF
FROM j
""")
def oof_encoding(spark, sf):
    d = _docs(spark, sf).where(F.col("quality").isNotNull()) \
        .withColumn("fold", (F.col("doc_id") % 8).cast("int"))
    out = oof_encode(d, "source", "quality", "fold", 8, "SOURCE_OOF", smoothing=5)
    return out.select("doc_id", R("SOURCE_OOF", 6).alias("SOURCE_OOF"))


# ---------------------------------------------------------------------------
# Average rank per score, mean across scores, min-max to [0, 1]
# ---------------------------------------------------------------------------
@register("w5_m8_rank_blend", """
WITH s AS (SELECT o_orderkey, o_totalprice AS s1, CAST((o_orderkey * 7919) % 1000 AS DOUBLE) AS s2 FROM orders),
r AS (SELECT o_orderkey,
        rank() OVER (ORDER BY s1) + (count(*) OVER (PARTITION BY s1) - 1) / 2.0 AS r1,
        rank() OVER (ORDER BY s2) + (count(*) OVER (PARTITION BY s2) - 1) / 2.0 AS r2
      FROM s),
m AS (SELECT o_orderkey, r1, r2, (r1 + r2) / 2 AS mr FROM r),
b AS (SELECT min(mr) AS lo, max(mr) AS hi FROM m)
SELECT o_orderkey, round(r1, 4) AS RANK_1, round(r2, 4) AS RANK_2,
       round(CASE WHEN hi > lo THEN (mr - lo) / (hi - lo) ELSE 0 END, 6) AS TARGET
FROM m, b
""")
def rank_blend(spark, sf):
    from loanlens.plans.training import blend_ranks
    o = _t(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("s1"),
        ((F.col("o_orderkey") * 7919) % 1000).cast("double").alias("s2"))
    b = blend_ranks(o, "o_orderkey", ["s1", "s2"], out="TARGET", keep_ranks=True)
    return b.select("o_orderkey", R("RANK_1").alias("RANK_1"), R("RANK_2").alias("RANK_2"),
                    R("TARGET", 6).alias("TARGET"))


# ---------------------------------------------------------------------------
# AUC via average ranks (one row per score)
# ---------------------------------------------------------------------------
@register("m9_d11_auc_by_model", f"""
WITH d AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars, quality FROM ({_DOCS_SQL}) WHERE quality IS NOT NULL),
s AS (SELECT 'n_chars' AS model, n_chars AS score, quality FROM d
      UNION ALL SELECT 'doc_id', CAST(doc_id AS DOUBLE), quality FROM d),
r AS (SELECT model, quality,
        rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS rk
      FROM s),
a AS (SELECT model, sum(rk) FILTER (WHERE quality = 1) AS rp, count(*) FILTER (WHERE quality = 1) AS p,
             count(*) FILTER (WHERE quality = 0) AS n FROM r GROUP BY model)
SELECT model, round((rp - p * (p + 1) / 2.0) / (p * n), 6) AS AUC FROM a
""")
def auc_by_model(spark, sf):
    from loanlens.plans.training import auc
    d = _docs(spark, sf).where(F.col("quality").isNotNull()).select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.col("doc_id").cast("double").alias("doc_score"), "quality")
    a1 = auc(d, "n_chars", "quality").select(F.lit("n_chars").alias("model"), "AUC")
    a2 = auc(d, "doc_score", "quality").select(F.lit("doc_id").alias("model"), "AUC")
    return a1.unionByName(a2).select("model", R("AUC", 6).alias("AUC"))


@register("d11_model_table", f"""
WITH d AS (SELECT CAST(n_chars AS DOUBLE) / 10000 AS a, CAST(doc_id % 100 AS DOUBLE) / 100 AS b, quality
           FROM ({_DOCS_SQL}) WHERE quality IS NOT NULL),
s AS (SELECT 'length' AS model, a AS score, quality FROM d UNION ALL SELECT 'id', b, quality FROM d),
r AS (SELECT *, rank() OVER (PARTITION BY model ORDER BY score)
                + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS rk FROM s),
c AS (SELECT model, sum(rk) FILTER (WHERE quality = 1) AS rp, count(*) FILTER (WHERE quality = 1) AS p,
             count(*) FILTER (WHERE quality = 0) AS n,
             count(*) FILTER (WHERE score >= 0.5 AND quality = 1) AS tp, count(*) FILTER (WHERE score >= 0.5 AND quality = 0) AS fp
      FROM r GROUP BY model)
SELECT model AS MODEL, round((rp - p * (p + 1) / 2.0) / (p * n), 6) AS AUC,
  round(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END, 6) AS "PRECISION",
  round(CASE WHEN p > 0 THEN CAST(tp AS DOUBLE) / p END, 6) AS RECALL,
  round(CASE WHEN p + tp + fp > 0 THEN 2.0 * tp / (p + tp + fp) END, 6) AS F1
FROM c
""")
def model_table_q(spark, sf):
    from loanlens.plans.profile import model_table
    d = _docs(spark, sf).select("quality", (F.col("n_chars").cast("double") / 10000).alias("length"),
                                ((F.col("doc_id") % 100).cast("double") / 100).alias("id"))
    return model_table(d, "quality", {"length": "length", "id": "id"})


# ---------------------------------------------------------------------------
# Union by name with a missing column, then train/test split
# ---------------------------------------------------------------------------
@register("u1_p6_union_split", """
SELECT o_orderkey, o_custkey, TARGET, CAST(TARGET IS NOT NULL AS INTEGER) AS IS_TRAIN FROM (
  SELECT o_orderkey, o_custkey, CAST(o_totalprice > 250000 AS INTEGER) AS TARGET FROM orders WHERE o_orderstatus = 'F'
  UNION ALL BY NAME
  SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'F')
""")
def union_split(spark, sf):
    from loanlens.plans.features import combine_applications, split_train_test
    o = _t(spark, sf, "orders")
    train = o.where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") > 250000).cast("int").alias("TARGET"))
    test = o.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_custkey")
    both = combine_applications(train, test)
    tr, te = split_train_test(both)
    return tr.withColumn("IS_TRAIN", F.lit(1)).unionByName(te.withColumn("IS_TRAIN", F.lit(0)))


# ---------------------------------------------------------------------------
# X1-X4, X10, X13, X17, DIV policies, P1, P3: row expressions
# ---------------------------------------------------------------------------
@register("x_row_expressions", """
WITH x AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
         CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS a,
         CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS b,
         CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity / 50.0 END AS c,
         l_tax, l_discount, l_quantity,
         CASE WHEN l_linenumber = 4 THEN NULL ELSE l_linenumber - 3 END AS dd
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round((coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / 3, 6) AS ZERO_FILLED_MEAN,
  round(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0), 6) AS NULL_SKIP_SUM,
  round(list_aggregate([a, b, c], 'avg'), 6) AS ROW_MEAN,
  round(greatest(a, b, c), 6) AS ROW_MAX, round(least(a, b, c), 6) AS ROW_MIN,
  round(list_aggregate([a, b, c], 'median'), 6) AS ROW_MEDIAN,
  round(list_aggregate([a, b, c], 'stddev_samp'), 6) AS ROW_STD,
  round(5 * c + 3 * a + 1 * b, 6) AS WEIGHTED_SUM,
  CAST(coalesce(a > b, false) AS INTEGER) AS FLAG_A_GT_B,
  CAST(coalesce(l_returnflag IN ('R', 'N') AND l_linestatus = 'O', false) AS INTEGER) AS DPD_FLAG,
  CASE WHEN dd IS NOT NULL THEN greatest(dd, 0) END AS CLIPPED,
  round(CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END, 6) AS DIV_NULL,
  round(l_discount / (1 + l_tax), 6) AS DIV_ONE_PLUS,
  round(l_discount / (l_tax + 1e-8), 2) AS DIV_EPS,
  CASE WHEN l_tax = 0 AND l_discount > 0 THEN 'inf' WHEN l_tax = 0 AND l_discount < 0 THEN '-inf'
       WHEN l_tax = 0 THEN 'null' ELSE 'finite' END AS DIV_IEEE_KIND
FROM x
""")
def row_expressions(spark, sf):
    li = _t(spark, sf, "lineitem")
    x = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        "l_tax", "l_discount",
        F.when(F.col("l_tax") == 0, None).otherwise(F.col("l_tax")).alias("a"),
        F.when(F.col("l_discount") == 0, None).otherwise(F.col("l_discount")).alias("b"),
        F.when(F.col("l_partkey") % 5 == 0, None).otherwise(F.col("l_quantity") / 50.0).alias("c"),
        F.when(F.col("l_linenumber") == 4, None).otherwise(F.col("l_linenumber") - 3).alias("dd"))
    ieee = div_ieee("l_discount", "l_tax")
    kind = (F.when(ieee == float("inf"), "inf").when(ieee == float("-inf"), "-inf")
            .when(ieee.isNull(), "null").otherwise("finite"))
    abc = ["a", "b", "c"]
    return x.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        R(zero_filled_mean(abc), 6).alias("ZERO_FILLED_MEAN"),
        R(null_skipping_sum(abc), 6).alias("NULL_SKIP_SUM"),
        R(row_mean(abc), 6).alias("ROW_MEAN"), R(row_max(abc), 6).alias("ROW_MAX"),
        R(row_min(abc), 6).alias("ROW_MIN"), R(row_median(abc), 6).alias("ROW_MEDIAN"),
        R(row_std(abc), 6).alias("ROW_STD"),
        R(F.col("c") * 5 + F.col("a") * 3 + F.col("b") * 1, 6).alias("WEIGHTED_SUM"),
        flag(F.col("a") > F.col("b")).alias("FLAG_A_GT_B"),
        flag(F.col("l_returnflag").isin("R", "N") & (F.col("l_linestatus") == "O")).alias("DPD_FLAG"),
        clip_lower_keep_null("dd").alias("CLIPPED"),
        R(div_null("l_discount", "l_tax"), 6).alias("DIV_NULL"),
        R(div_one_plus("l_discount", "l_tax"), 6).alias("DIV_ONE_PLUS"),
        R(div_eps("l_discount", "l_tax", 1e-8), 2).alias("DIV_EPS"),
        kind.alias("DIV_IEEE_KIND"))


# ---------------------------------------------------------------------------
# D-rows: profiling queries
# ---------------------------------------------------------------------------
@register("d1_d5_overview", f"""
WITH d AS ({_DOCS_SQL})
SELECT CAST(5 AS BIGINT) AS N_COLUMNS,
       CAST(count(*) AS BIGINT) AS ROWS_TOTAL, CAST(count(quality) AS BIGINT) AS ROWS_LABELLED,
       round(avg(quality), 6) AS TARGET_RATE,
       CAST(count(*) FILTER (WHERE quality = 1) AS BIGINT) AS TARGET_1,
       CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS TARGET_0
FROM d
""")
def overview_q(spark, sf):
    from loanlens.plans.profile import overview
    return overview(_docs(spark, sf), "quality")


@register("d3_histogram", """
SELECT CAST(least(floor(o_totalprice / 50000), 9) AS INTEGER) AS BIN, CAST(count(*) AS BIGINT) AS N
FROM orders GROUP BY 1
""")
def histogram_q(spark, sf):
    from loanlens.plans.profile import histogram
    return histogram(_t(spark, sf, "orders"), "o_totalprice", 0.0, 50000.0, 10)


@register("d4_category_share", """
SELECT c_mktsegment AS VALUE, CAST(count(*) AS BIGINT) AS N, round(count(*) / sum(count(*)) OVER (), 6) AS SHARE
FROM customer GROUP BY c_mktsegment
""")
def category_share_q(spark, sf):
    from loanlens.plans.profile import category_share
    return category_share(_t(spark, sf, "customer"), "c_mktsegment")


@register("d6_correlation", """
SELECT round(corr(l_quantity, l_extendedprice), 6) AS CORR_l_quantity_l_extendedprice,
       round(corr(l_discount, l_tax), 6) AS CORR_l_discount_l_tax,
       round(corr(l_extendedprice, l_tax), 6) AS CORR_l_extendedprice_l_tax,
       round(corr(l_quantity, l_discount), 6) AS CORR_l_quantity_l_discount,
       round(corr(l_quantity, l_tax), 6) AS CORR_l_quantity_l_tax,
       round(corr(l_extendedprice, l_discount), 6) AS CORR_l_extendedprice_l_discount
FROM lineitem
""")
def correlation_q(spark, sf):
    from loanlens.plans.profile import correlations
    return correlations(_t(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])

@register("d6_correlation_matrix", wide_checks.correlation_sql())
def correlation_matrix_q(spark, sf):
    """All pairs of the application frame's numbers, of six significant digits on both sides."""
    from loanlens.operators.gram import correlation_matrix
    from loanlens.plans.application import application_features
    # two passes read the frame: it is built and rounded once
    frame = cut_lineage(wide_checks.canonical(application_features(_domain(spark, sf)["application"])))
    return correlation_matrix(frame, sorted(c for c in frame.columns if c != "SK_ID_CURR"), digits=4)


@register("d7_confusion_metrics", f"""
WITH d AS (SELECT quality AS y, CAST(n_chars > 2000 AS INTEGER) AS p FROM ({_DOCS_SQL}) WHERE quality IS NOT NULL),
c AS (SELECT count(*) FILTER (WHERE p = 1 AND y = 1) AS tp, count(*) FILTER (WHERE p = 1 AND y = 0) AS fp,
             count(*) FILTER (WHERE p = 0 AND y = 0) AS tn, count(*) FILTER (WHERE p = 0 AND y = 1) AS fn FROM d)
SELECT CAST(tp AS BIGINT) AS TP, CAST(fp AS BIGINT) AS FP, CAST(tn AS BIGINT) AS TN, CAST(fn AS BIGINT) AS FN,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 6) AS PRECISION,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 6) AS RECALL,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) END, 6) AS F1
FROM c
""")
def confusion_q(spark, sf):
    from loanlens.plans.profile import confusion_metrics
    d = _docs(spark, sf).where(F.col("quality").isNotNull())
    return confusion_metrics(d.withColumn("_p", (F.col("n_chars") > 2000).cast("int")), "_p", "quality")


@register("d8_roc_points", f"""
WITH d AS (SELECT CAST(n_chars AS DOUBLE) AS s, quality AS y FROM ({_DOCS_SQL}) WHERE quality IS NOT NULL),
per AS (SELECT s, sum(y) AS p, sum(1 - y) AS q FROM d GROUP BY s),
cum AS (SELECT s, sum(p) OVER (ORDER BY s DESC) AS tp, sum(q) OVER (ORDER BY s DESC) AS fp,
               sum(p) OVER () AS pt, sum(q) OVER () AS nt FROM per)
SELECT s AS SCORE, round(tp / pt, 6) AS TPR, round(fp / nt, 6) AS FPR FROM cum
""")
def roc_q(spark, sf):
    from loanlens.plans.profile import roc_points
    d = _docs(spark, sf).where(F.col("quality").isNotNull()).withColumn("s", F.col("n_chars").cast("double"))
    return roc_points(d, "s", "quality").withColumnRenamed("s", "SCORE")


@register("d9_risk_band", """
SELECT o_orderkey,
  CASE WHEN o_totalprice / 500000 < 0.3 THEN 'Low' WHEN o_totalprice / 500000 < 0.7 THEN 'Medium' ELSE 'High' END AS RISK_BAND,
  CASE WHEN o_totalprice / 500000 < 0.3 THEN 'Approve' WHEN o_totalprice / 500000 < 0.7 THEN 'Review' ELSE 'Deny' END AS DECISION
FROM orders
""")
def risk_band_q(spark, sf):
    from loanlens.plans.profile import risk_band
    o = _t(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 500000).alias("p"))
    return risk_band(o, "p").drop("p")


def _missing_sql():
    return """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal,
                  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS seg, c_name FROM customer)
SELECT 'c_custkey' AS COLUMN_NAME, CAST(count(*) - count(c_custkey) AS BIGINT) AS N_MISSING,
       round((count(*) - count(c_custkey)) / count(*), 6) AS SHARE_MISSING FROM c
UNION ALL SELECT 'bal', CAST(count(*) - count(bal) AS BIGINT), round((count(*) - count(bal)) / count(*), 6) FROM c
UNION ALL SELECT 'seg', CAST(count(*) - count(seg) AS BIGINT), round((count(*) - count(seg)) / count(*), 6) FROM c
UNION ALL SELECT 'c_name', CAST(count(*) - count(c_name) AS BIGINT), round((count(*) - count(c_name)) / count(*), 6) FROM c
"""


def _missing_profile(spark, sf):
    from loanlens.plans.profile import missing_profile
    c = _t(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_acctbal")).alias("bal"),
        F.when(F.col("c_custkey") % 11 == 0, None).otherwise(F.col("c_mktsegment")).alias("seg"), "c_name")
    return missing_profile(c)


QUERIES["d12_missing_profile"] = _missing_profile
ORACLE["d12_missing_profile"] = _missing_sql().strip()


@register("d2_feature_types", """
SELECT CAST(4 AS BIGINT) AS N_NUMERIC, CAST(2 AS BIGINT) AS N_CATEGORICAL,
  round(4 / 6.0, 6) AS SHARE_NUMERIC, round(2 / 6.0, 6) AS SHARE_CATEGORICAL,
  round(((CASE WHEN count(DISTINCT c_custkey) = 2 THEN 1 ELSE 0 END)
     + (CASE WHEN count(DISTINCT c_nationkey) = 2 THEN 1 ELSE 0 END)
     + (CASE WHEN count(DISTINCT c_acctbal) = 2 THEN 1 ELSE 0 END)
     + (CASE WHEN count(DISTINCT c_custkey % 2) = 2 THEN 1 ELSE 0 END)) / 6.0, 6) AS SHARE_BINARY,
  CAST((CASE WHEN count(DISTINCT c_custkey) = 2 THEN 1 ELSE 0 END)
     + (CASE WHEN count(DISTINCT c_nationkey) = 2 THEN 1 ELSE 0 END)
     + (CASE WHEN count(DISTINCT c_acctbal) = 2 THEN 1 ELSE 0 END)
     + (CASE WHEN count(DISTINCT c_custkey % 2) = 2 THEN 1 ELSE 0 END) AS BIGINT) AS N_BINARY
FROM customer
""")
def feature_types_q(spark, sf):
    from loanlens.plans.profile import feature_types
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal",
                                         (F.col("c_custkey") % 2).alias("odd"), "c_name", "c_mktsegment")
    return feature_types(c)


@register("d10_similar_applicants", """
SELECT c_custkey, round(c_acctbal, 4) AS c_acctbal FROM customer
WHERE abs(c_acctbal - 5000) <= 500 AND c_nationkey BETWEEN 5 AND 15
ORDER BY abs(c_acctbal - 5000), c_custkey LIMIT 5
""")
def similar_q(spark, sf):
    from loanlens.plans.profile import similar_rows
    c = _t(spark, sf, "customer")
    out = similar_rows(c, {"c_acctbal": (5000.0, 500.0), "c_nationkey": (10, 5)},
                       order_by="c_acctbal", id_col="c_custkey", k=5)
    return out.select("c_custkey", R("c_acctbal").alias("c_acctbal"))


@register("d10_similar_for_probes", """
SELECT p.c_custkey AS probe_id,
  CAST(row_number() OVER (PARTITION BY p.c_custkey ORDER BY abs(c.c_acctbal - p.c_acctbal), c.c_custkey) AS INTEGER) AS rank,
  c.c_custkey
FROM customer p JOIN customer c ON c.c_custkey <> p.c_custkey
 AND abs(c.c_acctbal - p.c_acctbal) <= 500 AND abs(c.c_nationkey - p.c_nationkey) <= 5
WHERE p.c_custkey % 100 = 0
QUALIFY rank <= 5
""")
def similar_probes_q(spark, sf):
    """Every hundredth customer is a probe, all customers are candidates."""
    from loanlens.plans.profile import similar_for_probes
    c = _t(spark, sf, "customer")
    return similar_for_probes(c, c.where("c_custkey % 100 = 0"), {"c_acctbal": 500.0, "c_nationkey": 5.0}, "c_acctbal", "c_custkey")


# ---------------------------------------------------------------------------
# Domain plans over the crosswalked driver tables.  The child plans return
# every column, compared with the SQL of ``wide_checks``.
# ---------------------------------------------------------------------------
def _domain(spark, sf):
    from loanlens.plans.crosswalk import domain_tables
    return domain_tables(spark, sf)


@register("a1_a10_w1_bureau_features")
def bureau_q(spark, sf):
    from loanlens.plans.bureau import bureau_features
    t = _domain(spark, sf)
    return bureau_features(t["bureau"], t["bureau_balance"])


@register("a32_a35_bureau_counts_variant")
def bureau_counts_q(spark, sf):
    from loanlens.plans.bureau import bureau_count_features, finish_bureau_counts
    t = _domain(spark, sf)
    agg, fill = bureau_count_features(t["bureau"], t["bureau_balance"])
    app = t["application"].select("SK_ID_CURR")
    return finish_bureau_counts(app.join(agg, "SK_ID_CURR", "left"), fill)


@register("a11_a14_e7_previous_features")
def previous_q(spark, sf):
    from loanlens.plans.previous import previous_features
    return previous_features(_domain(spark, sf)["previous_application"])


@register("a15_a17_w2_pos_features")
def pos_q(spark, sf):
    from loanlens.plans.pos_cash import pos_features
    t = _domain(spark, sf)
    pos, fill = pos_features(t["pos_cash"])
    return fill_zero(t["application"].select("SK_ID_CURR").join(pos, "SK_ID_CURR", "left"), fill)


@register("a18_a23_w3_installment_features")
def installments_q(spark, sf):
    from loanlens.plans.installments import installment_features
    return installment_features(_domain(spark, sf)["installments"])


@register("a24_a25_card_features")
def card_q(spark, sf):
    from loanlens.plans.credit_card import card_features
    return card_features(_domain(spark, sf)["credit_card"])


@register("x1_x11_e2_application_features")
def application_q(spark, sf):
    from loanlens.plans.application import application_features
    return application_features(_domain(spark, sf)["application"])


@register("j3_a26_e2_fitted_application_state")
def fitted_application_q(spark, sf):
    """The state of the labelled rows, saved and loaded, applied to all rows;
    the value lists are those of all rows, so the columns don't hang on the labels."""
    from loanlens.plans.application import ApplicationState, application_features, fit_application
    app = _domain(spark, sf)["application"]
    path = f"{checkpoint_dir(spark).rstrip('/')}/application-state-{uuid.uuid4().hex}"
    ApplicationState.fit(app.where("TARGET IS NOT NULL"), fit_application(app)).save(path)
    return application_features(app, fitted=ApplicationState.load(spark, path))


@register("s4_p10_full_feature_build")
def build_q(spark, sf):
    from loanlens.plans.crosswalk import domain_tables
    from loanlens.plans.features import build_features
    with shuffles_removed(spark):
        return build_features(domain_tables(spark, sf, joined_once=True))


@register("m2_m8_ensemble_scores")
def ensemble_q(spark, sf):
    """Cross-validate and train on the labelled applicants, score the others
    (rows-only: tree ensembles are not SQL-expressible).  Numbers and ratios of
    the application are binned, its 14 text columns target-encoded."""
    from loanlens.cli import ID, LABEL, category_features
    from loanlens.plans.application import base_features, ratio_exprs, spread
    from loanlens.plans.features import split_train_test
    from loanlens.plans.training import BoostParams, cross_validate, final_round_count, train_and_score
    x = base_features(spread(_domain(spark, sf)["application"]))
    train, test = split_train_test(cut_lineage(x.select("*", *ratio_exprs(x))), LABEL)
    features, cats = [c for c in train.columns if c not in (ID, LABEL)], category_features(train)
    # the labels of the test tables can be told exactly, so the loss falls for ever; gains below 0.02 don't count
    base = BoostParams(step_size=0.3, max_depth=3, max_bins=32, patience=5, least_gain=0.02)
    _scores, best, _imp = cross_validate(train, features, cats, LABEL, ID, params=base, parallelism=8)
    preds, _imp, _ensemble = train_and_score(train, test, features, cats, LABEL, ID, rounds=final_round_count(best),
                                             members=7, base=base, parallelism=7)
    return preds


@register("e2_a9_sparse_dummies", """
WITH x AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS cust,
         o_orderpriority AS prio, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
 c AS (SELECT cust, row_number() OVER (ORDER BY cust) - 1 AS place FROM (SELECT DISTINCT cust FROM x WHERE cust IS NOT NULL)),
 p AS (SELECT prio, row_number() OVER (ORDER BY prio) - 1 AS place FROM (SELECT DISTINCT prio FROM x WHERE prio IS NOT NULL)),
 d AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS place FROM (SELECT DISTINCT day FROM x WHERE day IS NOT NULL)),
 n AS (SELECT (SELECT count(*) FROM c) AS nc, (SELECT count(*) FROM p) AS np, (SELECT count(*) FROM d) AS nd)
SELECT o_orderkey, CAST(nc + np + nd AS BIGINT) AS width,
  CAST((c.place IS NOT NULL)::INT + (p.place IS NOT NULL)::INT + (d.place IS NOT NULL)::INT AS BIGINT) AS n_set,
  CAST(coalesce(c.place, 0) + coalesce(nc + p.place, 0) + coalesce(nc + np + d.place, 0) AS BIGINT) AS place_sum
FROM x CROSS JOIN n LEFT JOIN c ON x.cust = c.cust LEFT JOIN p ON x.prio = p.prio LEFT JOIN d ON x.day = d.day
""")
def sparse_dummies_q(spark, sf):
    """Dummies of order customers, priorities and days as sparse vectors; the entries that are set."""
    from loanlens.operators.sparse import SparseDummies
    o = _t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("cust"),
        F.col("o_orderpriority").alias("prio"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    fitted = SparseDummies.fit(o, ["cust", "prio", "day"])
    v = F.unwrap_udt("dummies")
    return fitted.transform(o).select(
        "o_orderkey", v["size"].cast("long").alias("width"), F.size(v["indices"]).cast("long").alias("n_set"),
        F.aggregate(v["indices"], F.lit(0).cast("long"), lambda a, x: a + x).alias("place_sum"))


@register("m3_patience_best_rounds", """
WITH curve AS (
  SELECT CAST(o_custkey % 8 AS INTEGER) AS fold,
         CAST((year(o_orderdate) - 1992) * 12 + month(o_orderdate) AS INTEGER) AS round, avg(o_totalprice) AS loss
  FROM orders GROUP BY 1, 2
), led AS (
  SELECT *, arg_min(round, (loss, round)) OVER (PARTITION BY fold ORDER BY round) AS led FROM curve
), stops AS (SELECT fold, min(round) FILTER (round - led >= 9) AS stop FROM led GROUP BY fold)
SELECT c.fold, arg_min(c.round, (c.loss, c.round)) AS best
FROM curve c JOIN stops s ON c.fold = s.fold WHERE s.stop IS NULL OR c.round <= s.stop
GROUP BY c.fold
""")
def patience_q(spark, sf):
    """The curve of each fold: mean order price by month; patience of nine months."""
    from loanlens.plans.training import best_rounds
    o = _t(spark, sf, "orders")
    month = ((F.year("o_orderdate") - 1992) * 12 + F.month("o_orderdate")).cast("int")
    curve = o.groupBy((F.col("o_custkey") % 8).cast("int").alias("fold"), month.alias("round")) \
        .agg(F.avg("o_totalprice").alias("loss"))
    return best_rounds(curve, 9)


# ---------------------------------------------------------------------------
# A18-A20, A23, X17 through the real installments plan: a projection of its
# output on the crosswalked tables, checked against SQL written from scratch.
# ---------------------------------------------------------------------------
_INST_COLS = ["COUNT_INSTALLMENTS_PAID_(INSTALL_PAY)", "COUNT_INSTALLMENTS_ACCTS_CAT_(INSTALL_PAY)",
              "NUM_INSTALMENT_VERSION_NUNIQUE_(INSTALL_PAY)", "DAYS_PAST_DUE_MAX_(INSTALL_PAY)",
              "DAYS_PAST_DUE_SUM_(INSTALL_PAY)", "DAYS_BEFORE_DUE_MEAN_(INSTALL_PAY)",
              "DAYS_INSTALMENT_MIN_(INSTALL_PAY)", "PCTG_PAYMENT_MEAN_(INSTALL_PAY)",
              "DIFF_PAYMENT_VAR_(INSTALL_PAY)", "AMT_PAYMENT_SUM_(INSTALL_PAY)",
              "PAYMENT_AMOUNT_CV_(INSTALL_PAY)"]


@register("a18_a23_installments_plan_checked", """
WITH x AS (
  SELECT l.l_orderkey AS prev, o.o_custkey AS curr, l.l_linenumber AS num,
         CASE WHEN l.l_linestatus = 'F' THEN 1.0 ELSE 0.0 END AS ver,
         CASE WHEN l.l_partkey % 29 = 0 THEN NULL
              ELSE CAST(datediff('day', DATE '2002-01-01', CAST(l.l_shipdate AS DATE)) AS DOUBLE) END AS due,
         CASE WHEN l.l_suppkey % 31 = 0 THEN NULL
              ELSE CAST(datediff('day', DATE '2002-01-01', CAST(l.l_shipdate AS DATE)) AS DOUBLE)
                   + (l.l_partkey % 11) - 5 END AS entry,
         l.l_extendedprice AS inst, l.l_extendedprice * (1 - l.l_discount) AS pay
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
y AS (SELECT *, CASE WHEN entry - due IS NOT NULL THEN greatest(entry - due, 0) END AS dpd,
             CASE WHEN due - entry IS NOT NULL THEN greatest(due - entry, 0) END AS dbd,
             pay / (inst + 1e-8) AS pctg, inst - pay AS diff FROM x)
SELECT curr AS SK_ID_CURR,
  CAST(count(num) AS BIGINT) AS "COUNT_INSTALLMENTS_PAID_(INSTALL_PAY)",
  CAST(count(DISTINCT prev) AS BIGINT) AS "COUNT_INSTALLMENTS_ACCTS_CAT_(INSTALL_PAY)",
  CAST(count(DISTINCT ver) AS BIGINT) AS "NUM_INSTALMENT_VERSION_NUNIQUE_(INSTALL_PAY)",
  round(max(dpd), 4) AS "DAYS_PAST_DUE_MAX_(INSTALL_PAY)",
  round(coalesce(sum(dpd), 0), 4) AS "DAYS_PAST_DUE_SUM_(INSTALL_PAY)",
  round(avg(dbd), 4) AS "DAYS_BEFORE_DUE_MEAN_(INSTALL_PAY)",
  round(min(due), 4) AS "DAYS_INSTALMENT_MIN_(INSTALL_PAY)",
  round(avg(pctg), 4) AS "PCTG_PAYMENT_MEAN_(INSTALL_PAY)",
  round(var_samp(diff / 1000.0), 4) AS "DIFF_PAYMENT_VAR_(INSTALL_PAY)",
  round(sum(pay), 4) AS "AMT_PAYMENT_SUM_(INSTALL_PAY)",
  round(CASE WHEN abs(avg(pay)) >= 1e-10 THEN stddev_samp(pay) / avg(pay) END, 4) AS "PAYMENT_AMOUNT_CV_(INSTALL_PAY)"
FROM y GROUP BY curr
""")
def installments_checked(spark, sf):
    from loanlens.plans.installments import installment_features
    out = installment_features(_domain(spark, sf)["installments"])
    var = "DIFF_PAYMENT_VAR_(INSTALL_PAY)"
    out = out.withColumn(var, F.col(var) / 1e6)  # variance of thousands (rounding scale)
    return _round_all(out.select("SK_ID_CURR", *_INST_COLS), ["SK_ID_CURR"])


# ---------------------------------------------------------------------------
# A1-A10, W1, J2 through the real bureau plan (projection, SQL from scratch).
# ---------------------------------------------------------------------------
_BUREAU_COLS = ["BUREAU_SK_ID_BUREAU_COUNT", "BUREAU_AMT_CREDIT_SUM_SUM",
                "BUREAU_ACTIVE_AMT_CREDIT_SUM_MEAN", "BUREAU_CLOSED_MONTHS_BALANCE_SIZE_SUM",
                "BUREAU_MONTHS_BALANCE_SIZE_MEAN",
                "RATIO_BUREAU_ACTIVE_AMT_CREDIT_SUM_SUM_TO_BUREAU_CLOSED_AMT_CREDIT_SUM_SUM",
                "BUREAU_RATIO_AMT_CREDIT_SUM_TO_AMT_ANNUITY_MAX",
                "BUREAU_CAT_CREDIT_TYPE_CREDIT_TYPE_CODE_MEAN",
                "COUNT_CREDIT_BUREAU_LOANS_OVERDUE_(BUREAU)", "HAS_CREDIT_BUREAU_LOANS_OVERDUE_(BUREAU)",
                "CAT_OHE_MEAN_CREDIT_ACTIVE_Active_(BUREAU)", "LATEST_CREDIT_ACTIVE_CAT_(BUREAU)",
                "BUREAU_DAYS_CREDIT_QUANTILE_(BUREAU)", "BUREAU_AMT_CREDIT_SUM_DEBT_QUANTILE_(BUREAU)"]


@register("a1_a10_w1_bureau_plan_checked", """
WITH b AS (
  SELECT o_custkey AS curr, o_orderkey AS id,
         CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Sold' END AS active,
         o_orderpriority AS ctype,
         datediff('day', DATE '2002-01-01', CAST(o_orderdate AS DATE)) AS days,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey % 30 AS INTEGER) ELSE 0 END AS overdue,
         o_totalprice AS amt, o_totalprice * (o_orderkey % 5) / 4 AS debt,
         CASE WHEN o_orderkey % 8 = 0 THEN 0.0 WHEN o_orderkey % 8 = 1 THEN NULL ELSE o_totalprice / 12 END AS annuity
  FROM orders),
bb AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
j AS (SELECT b.*, coalesce(bb.n, 0) AS size FROM b LEFT JOIN bb ON b.id = bb.l_orderkey),
codes AS (SELECT ctype, dense_rank() OVER (ORDER BY ctype) - 1 AS code
          FROM (SELECT DISTINCT ctype FROM j WHERE ctype IS NOT NULL)),
latest AS (SELECT curr, active AS latest_active FROM (
             SELECT curr, active, row_number() OVER (PARTITION BY curr ORDER BY days DESC, id) AS rn FROM j)
           WHERE rn = 1),
agg AS (
  SELECT curr, count(id) AS cnt, coalesce(sum(amt), 0) AS amt_sum,
    CASE WHEN count(*) FILTER (WHERE active = 'Active') > 0 THEN avg(amt) FILTER (WHERE active = 'Active') END AS act_mean,
    CASE WHEN count(*) FILTER (WHERE active = 'Active') > 0 THEN coalesce(sum(amt) FILTER (WHERE active = 'Active'), 0) END AS act_sum,
    CASE WHEN count(*) FILTER (WHERE active = 'Closed') > 0 THEN coalesce(sum(amt) FILTER (WHERE active = 'Closed'), 0) END AS clo_sum,
    CASE WHEN count(*) FILTER (WHERE active = 'Closed') > 0 THEN coalesce(sum(size) FILTER (WHERE active = 'Closed'), 0) END AS clo_size_sum,
    avg(size) AS size_mean,
    max(CASE WHEN annuity = 0 THEN NULL ELSE amt / annuity END) AS ratio_max,
    avg(coalesce(codes.code, -1)) AS code_mean,
    sum(CASE WHEN overdue > 0 THEN 1 ELSE 0 END) AS od,
    avg(CASE WHEN active = 'Active' THEN 1.0 ELSE 0.0 END) AS ohe_active,
    quantile_cont(days, 0.25) AS q_days, quantile_cont(debt, 0.75) AS q_debt
  FROM j LEFT JOIN codes ON j.ctype = codes.ctype GROUP BY curr)
SELECT agg.curr AS SK_ID_CURR,
  CAST(cnt AS BIGINT) AS BUREAU_SK_ID_BUREAU_COUNT,
  round(amt_sum, 4) AS BUREAU_AMT_CREDIT_SUM_SUM,
  round(act_mean, 4) AS BUREAU_ACTIVE_AMT_CREDIT_SUM_MEAN,
  CAST(clo_size_sum AS BIGINT) AS BUREAU_CLOSED_MONTHS_BALANCE_SIZE_SUM,
  round(size_mean, 4) AS BUREAU_MONTHS_BALANCE_SIZE_MEAN,
  round(CASE WHEN clo_sum = 0 THEN NULL ELSE act_sum / clo_sum END, 4)
      AS RATIO_BUREAU_ACTIVE_AMT_CREDIT_SUM_SUM_TO_BUREAU_CLOSED_AMT_CREDIT_SUM_SUM,
  round(ratio_max, 4) AS BUREAU_RATIO_AMT_CREDIT_SUM_TO_AMT_ANNUITY_MAX,
  round(code_mean, 4) AS BUREAU_CAT_CREDIT_TYPE_CREDIT_TYPE_CODE_MEAN,
  CAST(od AS BIGINT) AS "COUNT_CREDIT_BUREAU_LOANS_OVERDUE_(BUREAU)",
  CAST(od > 0 AS INTEGER) AS "HAS_CREDIT_BUREAU_LOANS_OVERDUE_(BUREAU)",
  round(ohe_active, 4) AS "CAT_OHE_MEAN_CREDIT_ACTIVE_Active_(BUREAU)",
  latest.latest_active AS "LATEST_CREDIT_ACTIVE_CAT_(BUREAU)",
  round(q_days, 4) AS "BUREAU_DAYS_CREDIT_QUANTILE_(BUREAU)",
  round(q_debt, 4) AS "BUREAU_AMT_CREDIT_SUM_DEBT_QUANTILE_(BUREAU)"
FROM agg JOIN latest ON agg.curr = latest.curr
""")
def bureau_checked(spark, sf):
    from loanlens.plans.bureau import bureau_features
    t = _domain(spark, sf)
    out = bureau_features(t["bureau"], t["bureau_balance"]).select("SK_ID_CURR", *_BUREAU_COLS)
    out = out.withColumns({
        "BUREAU_CLOSED_MONTHS_BALANCE_SIZE_SUM": F.col("BUREAU_CLOSED_MONTHS_BALANCE_SIZE_SUM").cast("long"),
        "COUNT_CREDIT_BUREAU_LOANS_OVERDUE_(BUREAU)": F.col("COUNT_CREDIT_BUREAU_LOANS_OVERDUE_(BUREAU)").cast("long")})
    return _round_all(out, ["SK_ID_CURR"])


# ---------------------------------------------------------------------------
# A11-A14, E7, DIV-IEEE through the real previous-application plan.
# ---------------------------------------------------------------------------
_PREV_COLS = ["PREV_COUNT_TOTAL_PREV_APP_LOANS", "PREV_COUNT_APPROVED_PREV_APP_LOANS",
              "PREV_COUNT_TOTAL_PREV_APP_LOANS_CAT", "PREV_AMT_CREDIT_MEAN_APPROVED",
              "PREV_RATIO_AMT_APPLICATION_TO_AMT_CREDIT_VAR", "PREV_CNT_PAYMENT_SUM_REFUSED",
              "PREV_NAME_CONTRACT_STATUS_CODE_MEAN"]


@register("a11_a14_previous_plan_checked", """
WITH p AS (
  SELECT o_custkey AS curr, o_orderkey AS id,
         CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END AS st,
         o_totalprice * 1.1 AS app, CASE WHEN o_orderkey % 25 = 0 THEN 0.0 ELSE o_totalprice END AS credit,
         CAST(12 + (o_orderkey % 4) * 12 AS DOUBLE) AS cnt_payment
  FROM orders),
codes AS (SELECT st, dense_rank() OVER (ORDER BY st) - 1 AS code FROM (SELECT DISTINCT st FROM p)),
agg AS (
  SELECT curr, count(DISTINCT id) AS n_total,
         count(DISTINCT id) FILTER (WHERE p.st = 'Approved') AS n_appr,
         avg(credit) FILTER (WHERE p.st = 'Approved') AS credit_appr,
         CASE WHEN count(*) FILTER (WHERE credit = 0) > 0 THEN NULL
              ELSE var_samp(app / credit) END AS ratio_var,
         CASE WHEN count(*) FILTER (WHERE p.st = 'Refused') > 0
              THEN coalesce(sum(cnt_payment) FILTER (WHERE p.st = 'Refused'), 0) END AS pay_ref,
         avg(code) AS code_mean
  FROM p JOIN codes ON p.st = codes.st GROUP BY curr)
SELECT curr AS SK_ID_CURR,
  CAST(n_total AS BIGINT) AS PREV_COUNT_TOTAL_PREV_APP_LOANS,
  CAST(n_appr AS BIGINT) AS PREV_COUNT_APPROVED_PREV_APP_LOANS,
  CASE WHEN n_total > 0 AND n_total <= 1 THEN '1' WHEN n_total > 1 AND n_total <= 3 THEN '2-3'
       WHEN n_total > 3 AND n_total <= 5 THEN '4-5' WHEN n_total > 5 AND n_total <= 10 THEN '6-10'
       WHEN n_total > 10 AND n_total <= 1000 THEN '>10' END AS PREV_COUNT_TOTAL_PREV_APP_LOANS_CAT,
  round(coalesce(credit_appr, 0), 4) AS PREV_AMT_CREDIT_MEAN_APPROVED,
  round(coalesce(ratio_var, 0), 6) AS PREV_RATIO_AMT_APPLICATION_TO_AMT_CREDIT_VAR,
  round(coalesce(pay_ref, 0), 4) AS PREV_CNT_PAYMENT_SUM_REFUSED,
  round(code_mean, 4) AS PREV_NAME_CONTRACT_STATUS_CODE_MEAN
FROM agg
""")
def previous_checked(spark, sf):
    from loanlens.plans.previous import previous_features
    out = previous_features(_domain(spark, sf)["previous_application"]).select("SK_ID_CURR", *_PREV_COLS)
    v = "PREV_RATIO_AMT_APPLICATION_TO_AMT_CREDIT_VAR"
    out = out.withColumn(v, R(v, 6))
    return _round_all(out, ["SK_ID_CURR", v])


# ---------------------------------------------------------------------------
# A15-A17, W2, X15 through the real POS plan (projection, SQL from scratch).
# Without an input-position column, ties on the latest month are broken by
# the larger payload (deterministic), mirrored in the SQL order.
# ---------------------------------------------------------------------------
_POS_COLS = ["MONTHS_BALANCE_SIZE_(POS_CASH)", "SK_DPD_SUM_(POS_CASH)",
             "RATIO_SK_DPD_TO_CNT_INSTALMENT_FUTURE_MAX_(POS_CASH)", "NAME_CONTRACT_STATUS_MEAN_(POS_CASH)",
             "COUNT_POS_CASH_LOANS_(POS_CASH)", "POS_CASH_COUNT_COMPLETED_LAST_MONTH",
             "POS_CASH_COUNT_SIGNED_LAST_MONTH"]


@register("a15_a17_pos_plan_checked", """
WITH x AS (
  SELECT l.l_orderkey AS prev, o.o_custkey AS curr,
         CAST(floor(datediff('day', DATE '2002-01-01', CAST(l.l_shipdate AS DATE)) / 30) AS INTEGER) AS mb,
         l.l_quantity - l.l_linenumber * 5 AS fut,
         CASE l.l_returnflag WHEN 'A' THEN 'Active' WHEN 'R' THEN 'Completed' ELSE 'Signed' END AS st,
         CAST(round(l.l_discount * 100) AS INTEGER) AS dpd
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
codes AS (SELECT st, dense_rank() OVER (ORDER BY st) - 1 AS code FROM (SELECT DISTINCT st FROM x)),
last AS (SELECT curr, st FROM (
           SELECT curr, st, row_number() OVER (PARTITION BY prev ORDER BY mb DESC, curr DESC, st DESC) AS rn
           FROM x) WHERE rn = 1),
recent AS (SELECT curr, count(*) FILTER (WHERE st = 'Completed') AS c, count(*) FILTER (WHERE st = 'Signed') AS s
           FROM last GROUP BY curr),
agg AS (SELECT curr, count(*) AS size, coalesce(sum(dpd), 0) AS dpd_sum,
               max(CASE WHEN fut = 0 THEN NULL ELSE dpd / fut END) AS r_max,
               avg(code) AS code_mean, count(DISTINCT prev) AS loans
        FROM x JOIN codes ON x.st = codes.st GROUP BY curr)
SELECT agg.curr AS SK_ID_CURR,
  CAST(size AS BIGINT) AS "MONTHS_BALANCE_SIZE_(POS_CASH)",
  CAST(dpd_sum AS BIGINT) AS "SK_DPD_SUM_(POS_CASH)",
  round(r_max, 4) AS "RATIO_SK_DPD_TO_CNT_INSTALMENT_FUTURE_MAX_(POS_CASH)",
  round(code_mean, 4) AS "NAME_CONTRACT_STATUS_MEAN_(POS_CASH)",
  CAST(loans AS BIGINT) AS "COUNT_POS_CASH_LOANS_(POS_CASH)",
  CAST(coalesce(recent.c, 0) AS INTEGER) AS POS_CASH_COUNT_COMPLETED_LAST_MONTH,
  CAST(coalesce(recent.s, 0) AS INTEGER) AS POS_CASH_COUNT_SIGNED_LAST_MONTH
FROM agg LEFT JOIN recent ON agg.curr = recent.curr
""")
def pos_checked(spark, sf):
    from loanlens.plans.pos_cash import pos_features
    out, fill = pos_features(_domain(spark, sf)["pos_cash"])
    out = fill_zero(out, fill).select("SK_ID_CURR", *_POS_COLS)
    return _round_all(out.withColumn("SK_DPD_SUM_(POS_CASH)", F.col("SK_DPD_SUM_(POS_CASH)").cast("long")),
                      ["SK_ID_CURR"])


# ---------------------------------------------------------------------------
# A24, A25, X16, X2 through the real credit-card plan (projection).
# ---------------------------------------------------------------------------
_CARD_COLS = ["MONTHS_BALANCE_SIZE_(CREDIT_CARD)", "AMT_BALANCE_SUM_(CREDIT_CARD)",
              "RATIO_AMT_BALANCE_TO_AMT_CREDIT_LIMIT_ACTUAL_MAX_(CREDIT_CARD)",
              "SUM_ALL_AMT_DRAWINGS_MEAN_(CREDIT_CARD)", "NAME_CONTRACT_STATUS_CODE_MEAN_(CREDIT_CARD)",
              "COUNT_CREDIT_CARD_LOANS_(CREDIT_CARD)"]


@register("a24_a25_card_plan_checked", """
WITH x AS (
  SELECT user_id AS curr, user_id * 10 + CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS prev,
         value * 100 AS bal, CASE WHEN event_id % 9 = 0 THEN 0.0 ELSE value * 150 END AS lim,
         coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END, 0) + value * 2
           + coalesce(CASE WHEN event_id % 4 = 0 THEN NULL ELSE value / 2 END, 0) + value / 3 AS draw,
         event_type AS st
  FROM events),
codes AS (SELECT st, dense_rank() OVER (ORDER BY st) - 1 AS code FROM (SELECT DISTINCT st FROM x))
SELECT curr AS SK_ID_CURR,
  CAST(count(*) AS BIGINT) AS "MONTHS_BALANCE_SIZE_(CREDIT_CARD)",
  round(sum(bal), 4) AS "AMT_BALANCE_SUM_(CREDIT_CARD)",
  round(max(CASE WHEN lim = 0 THEN NULL ELSE bal / lim END), 4) AS "RATIO_AMT_BALANCE_TO_AMT_CREDIT_LIMIT_ACTUAL_MAX_(CREDIT_CARD)",
  round(avg(draw), 4) AS "SUM_ALL_AMT_DRAWINGS_MEAN_(CREDIT_CARD)",
  round(avg(code), 4) AS "NAME_CONTRACT_STATUS_CODE_MEAN_(CREDIT_CARD)",
  CAST(count(DISTINCT prev) AS BIGINT) AS "COUNT_CREDIT_CARD_LOANS_(CREDIT_CARD)"
FROM x JOIN codes ON x.st = codes.st GROUP BY curr
""")
def card_checked(spark, sf):
    from loanlens.plans.credit_card import card_features
    out = card_features(_domain(spark, sf)["credit_card"]).select("SK_ID_CURR", *_CARD_COLS)
    return _round_all(out, ["SK_ID_CURR"])


# ---------------------------------------------------------------------------
# P1, X1, X3, X5, X7, X10, A26/X6, E8, E9/E10, E2 through the real
# application plan (projection, SQL from scratch).
# ---------------------------------------------------------------------------
_APP_COLS = ["EXT_SOURCE_MEAN", "AGE_YEARS", "YEARS_EMPLOYED", "RATIO_AMT_CREDIT_TO_AMT_GOODS_PRICE",
             "Z_AMT_CREDIT", "FLAG_AGE_GT_EMPLOYED", "HAS_JOB", "EXT_SOURCES_STD",
             "OCCUPATION_TYPE_MEAN_EXT_SOURCE_1", "OCCUPATION_TYPE_MEAN_EXT_SOURCE_1_DIFF",
             "POLY_EXT_SOURCE_1^2", "CODE_GENDER_CAT_F"]


@register("x1_x11_application_plan_checked", """
WITH a AS (
  SELECT c.c_custkey AS k,
         CASE WHEN c.c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE n.n_name END AS occ,
         CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE ((c.c_custkey * 31) % 1000) / 1000.0 END AS e1,
         CASE WHEN c.c_custkey % 17 = 0 THEN NULL ELSE ((c.c_custkey * 53) % 1000) / 1000.0 END AS e2,
         CASE WHEN c.c_custkey % 7 = 1 THEN NULL ELSE ((c.c_custkey * 71) % 1000) / 1000.0 END AS e3,
         -(7000 + (c.c_custkey * 37) % 18000) AS birth,
         CASE WHEN c.c_custkey % 10 = 0 THEN NULL ELSE -((c.c_custkey * 13) % 9000) END AS employed,
         abs(c.c_acctbal) * 40 + 50000 AS credit,
         CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE (abs(c.c_acctbal) * 40 + 50000)
              * (CAST(0.8 AS DOUBLE) + (c.c_custkey % 5) * CAST(0.05 AS DOUBLE)) END AS goods
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
g AS (SELECT occ, avg(e1) AS m FROM a WHERE occ IS NOT NULL GROUP BY occ),
s AS (SELECT avg(credit) AS mu, stddev_samp(credit) AS sd, median(e1) AS med1 FROM a)
SELECT a.k AS SK_ID_CURR,
  round((coalesce(e1, 0) + coalesce(e2, 0) + coalesce(e3, 0)) / 3, 6) AS EXT_SOURCE_MEAN,
  round(birth / -365.25, 6) AS AGE_YEARS,
  round(employed / -365.25, 6) AS YEARS_EMPLOYED,
  round(CASE WHEN goods = 0 THEN NULL ELSE credit / goods END, 6) AS RATIO_AMT_CREDIT_TO_AMT_GOODS_PRICE,
  round(CASE WHEN sd > 0 THEN (credit - mu) / sd END, 6) AS Z_AMT_CREDIT,
  CAST(coalesce(birth / -365.25 > employed / -365.25, false) AS INTEGER) AS FLAG_AGE_GT_EMPLOYED,
  CAST(coalesce(employed < 0, false) AS INTEGER) AS HAS_JOB,
  round(list_aggregate([e1, e2, e3], 'stddev_samp'), 6) AS EXT_SOURCES_STD,
  round(g.m, 6) AS OCCUPATION_TYPE_MEAN_EXT_SOURCE_1,
  round(e1 - g.m, 6) AS OCCUPATION_TYPE_MEAN_EXT_SOURCE_1_DIFF,
  round(coalesce(e1, med1) * coalesce(e1, med1), 6) AS "POLY_EXT_SOURCE_1^2",
  CAST(gender = 'F' AS INTEGER) AS CODE_GENDER_CAT_F
FROM a LEFT JOIN g ON a.occ = g.occ CROSS JOIN s
""")
def application_checked(spark, sf):
    from loanlens.plans.application import application_features
    out = application_features(_domain(spark, sf)["application"]).select("SK_ID_CURR", *_APP_COLS)
    return _round_all(out, ["SK_ID_CURR"], 6)


# ---------------------------------------------------------------------------
# A32-A35, X18, P2 through the real legacy bureau variant (projection).
# ---------------------------------------------------------------------------
_LEGACY_COLS = ["BUREAU_LOAN_COUNT", "BUREAU_LOAN_TYPES", "BUREAU_AVERAGE_LOAN_TYPE",
                "BUREAU_ACTIVE_AMT_CREDIT_SUM_SUM", "BUREAU_BUREAU_DEBT_CREDIT_RATIO_MEAN",
                "BUREAU_bureau_balance_MONTHS_BALANCE_size_SUM",
                "BUREAU_bureau_balance_STATUS_0_ratio_MEAN", "BUREAU_CREDIT_ACTIVE_Closed_SUM"]


@register("a32_a35_bureau_counts_plan_checked", """
WITH b AS (
  SELECT o_custkey AS curr, o_orderkey AS id,
         CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Sold' END AS active,
         o_orderpriority AS ctype, o_totalprice AS amt, o_totalprice * (o_orderkey % 5) / 4 AS debt
  FROM orders),
bb AS (
  SELECT l_orderkey, count(*) AS n,
         count(*) FILTER (WHERE st = '0') / count(*) AS r0
  FROM (SELECT l_orderkey,
               CASE WHEN l_returnflag = 'A' THEN '0'
                    ELSE ['0', '1', 'C', 'X', '2', '3', '5', '4'][((l_linenumber - 1) % 8) + 1] END AS st
        FROM lineitem)
  GROUP BY l_orderkey),
j AS (SELECT b.*, bb.n, bb.r0 FROM b LEFT JOIN bb ON b.id = bb.l_orderkey),
agg AS (
  SELECT curr, count(id) AS cnt, count(DISTINCT ctype) AS types,
         CASE WHEN count(*) FILTER (WHERE active = 'Active') > 0
              THEN coalesce(sum(amt) FILTER (WHERE active = 'Active'), 0) END AS act_sum,
         avg(debt / (amt + 1e-8)) AS dcr, coalesce(sum(n), 0) AS size_sum, avg(r0) AS r0_mean,
         sum(CASE WHEN active = 'Closed' THEN 1 ELSE 0 END) AS closed
  FROM j GROUP BY curr)
SELECT c.c_custkey AS SK_ID_CURR,
  CAST(coalesce(cnt, 0) AS BIGINT) AS BUREAU_LOAN_COUNT,
  CAST(coalesce(types, 0) AS BIGINT) AS BUREAU_LOAN_TYPES,
  round(coalesce(cnt, 0) / (coalesce(types, 0) + 1e-8), 4) AS BUREAU_AVERAGE_LOAN_TYPE,
  round(coalesce(act_sum, 0), 4) AS BUREAU_ACTIVE_AMT_CREDIT_SUM_SUM,
  round(coalesce(dcr, 0), 4) AS BUREAU_BUREAU_DEBT_CREDIT_RATIO_MEAN,
  CAST(coalesce(size_sum, 0) AS BIGINT) AS BUREAU_bureau_balance_MONTHS_BALANCE_size_SUM,
  round(coalesce(r0_mean, 0), 4) AS BUREAU_bureau_balance_STATUS_0_ratio_MEAN,
  CAST(coalesce(closed, 0) AS BIGINT) AS BUREAU_CREDIT_ACTIVE_Closed_SUM
FROM customer c LEFT JOIN agg ON c.c_custkey = agg.curr
""")
def bureau_counts_checked(spark, sf):
    from loanlens.plans.bureau import bureau_count_features, finish_bureau_counts
    t = _domain(spark, sf)
    agg, fill = bureau_count_features(t["bureau"], t["bureau_balance"])
    out = finish_bureau_counts(t["application"].select("SK_ID_CURR").join(agg, "SK_ID_CURR", "left"), fill)
    out = out.select("SK_ID_CURR", *_LEGACY_COLS).withColumns({
        c: F.col(c).cast("long") for c in ["BUREAU_LOAN_COUNT", "BUREAU_LOAN_TYPES",
                                           "BUREAU_bureau_balance_MONTHS_BALANCE_size_SUM",
                                           "BUREAU_CREDIT_ACTIVE_Closed_SUM"]})
    return _round_all(out, ["SK_ID_CURR"])


@register("a1_x13_balance_by_loan", wide_checks.balance_sql())
def balance_q(spark, sf):
    from loanlens.plans.bureau import balance_by_loan
    return wide_checks.canonical(balance_by_loan(_domain(spark, sf)["bureau_balance"]), "SK_ID_BUREAU")


def _whole(plan: Callable[[SparkSession, str], DataFrame]):
    return lambda spark, sf: wide_checks.canonical(plan(spark, sf))


for _name, _sql in wide_checks.SQL.items():
    QUERIES[_name], ORACLE[_name] = _whole(QUERIES[_name]), _sql()
