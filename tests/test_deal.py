"""The full build shuffles rows of the input columns, once a table, and no state."""

import math

import pytest
from pyspark.sql import functions as F

from loanlens.operators import rollup
from loanlens.operators.ordered import listed_quantiles, quantile_table
from loanlens.plans import crosswalk, features
from loanlens.session import shuffles_removed, write_table


@pytest.fixture(scope="module")
def tables(spark):
    """Orders of 40 borrowers (some of none), repeated loans and pairs, NULLs and NaN."""
    i = F.col("id")
    orders = spark.range(0, 300, 1, 3).select(
        (i % 280).alias("o_orderkey"), F.when(i % 41 != 7, i * 7 % 40).alias("o_custkey"),
        F.element_at(F.array(*map(F.lit, "FOP")), (i % 3 + 1).cast("int")).alias("o_orderstatus"),
        F.when(i % 31 == 5, float("nan")).when(i % 29 != 3, i * 1.75 + 100).alias("o_totalprice"),
        F.expr("timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(CAST(id % 97 AS int))").alias("o_orderdate"),
        F.concat(F.lit("p"), (i % 4).cast("string")).alias("o_orderpriority"))
    lines = spark.range(0, 900, 1, 5).select(
        (i * 11 % 290).alias("l_orderkey"), (i % 60).alias("l_partkey"), (i % 70).alias("l_suppkey"), (i % 7 + 1).cast("int").alias("l_linenumber"),
        (i % 50 + 1.0).alias("l_quantity"), (i * 3.5 + 10).alias("l_extendedprice"), (i % 11 / 100).alias("l_discount"), (i % 9 / 100).alias("l_tax"),
        F.element_at(F.array(*map(F.lit, "ANR")), (i % 3 + 1).cast("int")).alias("l_returnflag"),
        F.when(i % 2 == 0, "F").otherwise("O").alias("l_linestatus"),
        F.expr("timestamp_ntz'1996-01-01 00:00:00' + make_dt_interval(CAST(id % 83 AS int))").alias("l_shipdate"))
    orders, lines = write_table(orders, "orders"), write_table(lines, "lines")
    return {"bureau": crosswalk.bureau_from_orders(orders), "bureau_balance": crosswalk.bureau_balance_from_lineitem(lines),
            "previous_application": crosswalk.previous_from_orders(orders),
            "pos_cash": crosswalk.pos_from_lineitem(lines, orders), "installments": crosswalk.installments_from_lineitem(lines, orders)}


def _differences(one, other):
    """(borrower, column, value, value) where two frames differ by more than the order of a sum."""
    have, want = ({r["SK_ID_CURR"]: r.asDict() for r in df.collect()} for df in (one, other))
    assert len(want) > 20 and have.keys() == want.keys()

    def same(a, b):
        if isinstance(a, float) and isinstance(b, float):
            return math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-6) or (a != a and b != b)
        return a == b
    return [(k, c, v, want[k][c]) for k, r in have.items() for c, v in r.items() if not same(v, want[k][c])]


def _exchanges(plan):
    """Columns of every shuffle of a plan."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.inputPlan()
    found = [plan.output().size()] if plan.nodeName().startswith("Exchange") else []
    kids = plan.children()
    return found + [n for k in range(kids.size()) for n in _exchanges(kids.apply(k))]


def test_dealt_rows_give_the_same_features_and_no_wide_shuffle(spark, tables, monkeypatch):
    frames = features._child_frames(tables, {})
    widest = {}
    for name, (frame, _) in frames.items():
        widest[name] = max(_exchanges(frame._jdf.queryExecution().executedPlan()))
        assert "RebalancePartitions" not in frame._jdf.queryExecution().optimizedPlan().toString()
    # a roll-up's state has a number or more for each of up to 309 statistics
    assert all(n <= max(len(t.columns) for t in tables.values()) + 1 for n in widest.values()), widest

    monkeypatch.setattr(features, "deals_evenly", lambda df, key: False)
    gathered = features._child_frames(tables, {})
    for name, (frame, fill) in frames.items():
        other, other_fill = gathered[name]
        assert frame.columns == other.columns and fill == other_fill
        assert _differences(frame, other.where("SK_ID_CURR IS NOT NULL")) == [], name


def test_a_hot_borrower_is_gathered(spark, tables, monkeypatch):
    monkeypatch.setattr(rollup, "EVEN_ROWS", 100)
    even = spark.range(0, 8000, 1, 4).select((F.col("id") % 500).alias("SK_ID_CURR"))
    hot = even.select(F.when(F.col("SK_ID_CURR") % 3 > 0, 7).otherwise(F.col("SK_ID_CURR")).alias("SK_ID_CURR"))
    monkeypatch.setattr(rollup, "EVEN_TIMES", 3)
    assert rollup.deals_evenly(even, "SK_ID_CURR") and not rollup.deals_evenly(hot, "SK_ID_CURR")
    assert rollup.deals_evenly(hot.where("SK_ID_CURR IS NULL"), "SK_ID_CURR")
    i = F.col("SK_ID_PREV")
    loans = tables["previous_application"].withColumn("SK_ID_CURR", F.when(i % 4 > 0, F.lit(7).cast("long")).otherwise(i))
    frame, _ = features._child_frames({"previous_application": loans}, {})["previous"]
    assert "RebalancePartitions" in frame._jdf.queryExecution().optimizedPlan().toString()


def test_aggregates_share_the_dealt_rows(spark):
    rows = rollup.deal(spark.range(0, 1000, 1, 4).selectExpr("id % 50 AS k", "id AS a", "id * 2 AS b"), "k")
    out = rows.groupBy("k").agg(F.sum("a").alias("a")).join(rows.groupBy("k").agg(F.max("b").alias("b")), "k")
    got = {r["k"]: (r["a"], r["b"]) for r in out.collect()}
    assert got == {k: (sum(range(k, 1000, 50)), 2 * (950 + k)) for k in range(50)}
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_quantiles_of_lists_are_those_of_ranks(spark):
    rows = [(k, None if (k + n) % 13 == 0 else float("nan") if (k * n) % 17 == 5 else float(k * 100 + (n * n) % 23) / 7)
            for k in range(12) for n in range(k + 1)] + [(99, None)]
    df = spark.createDataFrame(rows, "k long, v double").withColumn("w", F.abs("v") + 1)
    for poison in (True, False):
        args = (df, ["k"], ["v", "w", "v"], [0.25, 0.75, 1.0], ["a", "b", "c"], poison)
        assert sorted(map(tuple, listed_quantiles(*args).collect())) == sorted(map(tuple, quantile_table(*args).collect())), poison


def test_written_tables_leave_no_shuffle(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = blocks.getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().startswith("shuffle_")}
    before = files()
    with shuffles_removed(spark):
        t = write_table(spark.range(1000).repartition(5, "id"), "left")
        assert files() <= before
    assert t.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
