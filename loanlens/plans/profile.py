"""Dataset and model profiling (the panels a dashboard shows), as Spark jobs.

Every function returns a small DataFrame computed by distributed
aggregates; none collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions.cleaning import NUMERIC_TYPES, flag
from loanlens.operators.ordered import cumulative_by_score
from loanlens.session import cut_lineage

# Risk bands (upper bounds, label, decision).
RISK_BANDS = [(0.3, "Low", "Approve"), (0.7, "Medium", "Review"), (None, "High", "Deny")]


def overview(df: DataFrame, target: str) -> DataFrame:
    """Rows, columns, labelled rows, default rate, class counts."""
    y = F.col(target)
    return df.agg(F.lit(len(df.columns)).cast("long").alias("N_COLUMNS"), F.count(F.lit(1)).alias("ROWS_TOTAL"), F.count(y).alias("ROWS_LABELLED"),
                  F.round(F.avg(y.cast("double")), 6).alias("TARGET_RATE"),
                  F.count_if(y == 1).alias("TARGET_1"), F.count_if(y == 0).alias("TARGET_0"))


def feature_types(df: DataFrame) -> DataFrame:
    """Numeric / categorical / binary column counts and their shares (D2):
    binary = numeric with exactly two distinct non-NULL values, that is, with
    no value between the least and the greatest (two plain aggregates)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    place = {c: k for k, c in enumerate(numeric)}
    ends = df.agg(*[f(c).alias(f"_{n}{place[c]}") for c in numeric for n, f in (("lo", F.min), ("hi", F.max))], F.lit(1).alias("_one"))
    between = [F.count_if((F.col(c) != F.col(f"_lo{k}")) & (F.col(c) != F.col(f"_hi{k}"))).alias(f"_b{k}") for c, k in place.items()]
    rest = df.crossJoin(F.broadcast(ends)).agg(F.count(F.lit(1)).alias("_n"), *between)  # one row
    binary = sum((F.when((F.col(f"_b{k}") == 0) & (F.col(f"_lo{k}") < F.col(f"_hi{k}")), 1).otherwise(0)
                  for k in place.values()), F.lit(0)).cast("long")
    total = F.lit(float(max(1, len(df.columns))))
    counts = ends.crossJoin(F.broadcast(rest)).select(  # one row each
        F.lit(len(numeric)).cast("long").alias("N_NUMERIC"), F.lit(len(strings)).cast("long").alias("N_CATEGORICAL"),
        binary.alias("N_BINARY"))
    return counts.select("*", *[F.round(F.col(f"N_{k}") / total, 6).alias(f"SHARE_{k}")
                                for k in ("NUMERIC", "CATEGORICAL", "BINARY")])


def histogram(df: DataFrame, col: str, start: float, width: float, bins: int) -> DataFrame:
    """Equal-width bins from ``start``; the last bin is open (D3)."""
    b = F.least(F.floor((F.col(col) - F.lit(start)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return df.where(F.col(col).isNotNull()).groupBy(b.alias("BIN")).agg(F.count(F.lit(1)).alias("N"))


def category_share(df: DataFrame, col: str) -> DataFrame:
    """Count and share per value (D4); the total is a one-row aggregate."""
    counts = df.groupBy(F.col(col).alias("VALUE")).agg(F.count(F.lit(1)).alias("N"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(
        "VALUE", "N", F.round(F.col("N") / F.col("_total"), 6).alias("SHARE"))


def correlations(df: DataFrame, cols: Sequence[str],
                 pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Pearson correlation of column pairs in one aggregate (D6); all pairs of
    ``cols`` unless given, so name the columns of a wide table."""
    if pairs is None:
        pairs = list(combinations(cols, 2))
    return df.agg(*[F.round(F.corr(a, b), 6).alias(f"CORR_{a}_{b}") for a, b in pairs])


def confusion_metrics(df: DataFrame, pred: str, label: str) -> DataFrame:
    """TP/FP/TN/FN, precision, recall, F1 at a fixed decision."""
    p, y = F.col(pred), F.col(label)
    c = df.agg(F.count_if((p == 1) & (y == 1)).alias("TP"), F.count_if((p == 1) & (y == 0)).alias("FP"),
               F.count_if((p == 0) & (y == 0)).alias("TN"), F.count_if((p == 0) & (y == 1)).alias("FN"))
    tp, fp, fn = F.col("TP"), F.col("FP"), F.col("FN")
    return c.select("TP", "FP", "TN", "FN",
                    F.round(F.when(tp + fp > 0, tp / (tp + fp)), 6).alias("PRECISION"),
                    F.round(F.when(tp + fn > 0, tp / (tp + fn)), 6).alias("RECALL"),
                    F.round(F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)), 6).alias("F1"))


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """(score, TPR, FPR) at every distinct threshold (D8), distributed."""
    c = cumulative_by_score(df, score, label)
    return c.select(score, F.round(F.col("tp") / F.col("pos_total"), 6).alias("TPR"),
                    F.round(F.col("fp") / F.col("neg_total"), 6).alias("FPR"))


def model_table(df: DataFrame, label: str, scores: Mapping[str, str], threshold: float = 0.5) -> DataFrame:
    """One row per model (name -> score column): AUC, precision, recall, F1."""
    from loanlens.plans.training import auc
    out = None
    for name, col in scores.items():
        rows = df.where(F.col(label).isNotNull() & F.col(col).isNotNull()).select(
            F.col(col).alias("_s"), F.col(label).alias("_y"), flag(F.col(col) >= threshold).alias("_p"))
        one = auc(rows, "_s", "_y").crossJoin(F.broadcast(confusion_metrics(rows, "_p", "_y"))).select(  # one row each
            F.lit(name).alias("MODEL"), F.round("AUC", 6).alias("AUC"), "PRECISION", "RECALL", "F1")
        out = one if out is None else out.union(one)
    return out


def risk_band(df: DataFrame, prob: str) -> DataFrame:
    """Risk band and decision from a default probability."""
    p = F.col(prob)
    band = dec = None
    for upper, lab, d in RISK_BANDS:
        if upper is None:
            band, dec = band.otherwise(F.lit(lab)), dec.otherwise(F.lit(d))
        elif band is None:
            band, dec = F.when(p < upper, F.lit(lab)), F.when(p < upper, F.lit(d))
        else:
            band, dec = band.when(p < upper, F.lit(lab)), dec.when(p < upper, F.lit(d))
    return df.select("*", band.alias("RISK_BAND"), dec.alias("DECISION"))


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing count and share per column (D12): one aggregate, then a
    stack into (column, n, share) rows."""
    n = F.count(F.lit(1))
    wide = df.agg(n.alias("_n"), *[(n - F.count(c)).alias(f"_m{i}") for i, c in enumerate(df.columns)])
    pairs = ", ".join(f"'{c}', _m{i}" for i, c in enumerate(df.columns))
    long = wide.selectExpr("_n", f"stack({len(df.columns)}, {pairs}) AS (COLUMN_NAME, N_MISSING)")
    return long.select("COLUMN_NAME", F.col("N_MISSING").cast("long").alias("N_MISSING"),
                       F.round(F.col("N_MISSING") / F.col("_n"), 6).alias("SHARE_MISSING"))


def similar_rows(df: DataFrame, bands: Mapping[str, tuple[float, float]], order_by: str,
                 id_col: str, k: int = 5) -> DataFrame:
    """Up to ``k`` rows inside every (center +- width) band, closest first
    on ``order_by`` (D10).  A filtered top-k: per-partition top-k then a
    bounded merge (TakeOrderedAndProject), no pairs are formed."""
    cond = F.lit(True)
    for c, (center, width) in bands.items():
        cond = cond & (F.abs(F.col(c) - F.lit(center)) <= F.lit(width))
    center = bands[order_by][0]
    return df.where(cond).orderBy(F.abs(F.col(order_by) - F.lit(center)), F.col(id_col)).limit(k)


def similar_for_probes(df: DataFrame, probes: DataFrame, tolerances: dict[str, float], order_by: str, id_col: str,
                       k: int = 5) -> DataFrame:
    """(probe_id, rank, id): for each probe its ``k`` nearest other rows by
    |difference| of ``order_by``, among rows that lie within the tolerance of
    the probe in every column; ties by id.

    A band join over a grid: each column is cut into cells as wide as its
    tolerance (a tolerance of 0 means equality), a row is in one cell, a probe
    asks its own and the two beside it, so the join is by equality and only rows
    of neighbouring cells meet.  A probe that would meet more than ``MOST_MET``
    rows asks cells of half the width in ``order_by``, and so on: ``k`` rows
    found within a narrower band are nearer than all outside it.  Where too few
    lie in it, the probe asks the wider cells again, at last those of the
    tolerance, so no row is missed.  Of rows alike in every column the first
    ``k`` + 1 ids are kept, which hold the ``k`` of any probe.  NULL, NaN and
    infinite values match nothing; a probe needs not be a row of ``df``;
    repeated probes get their rows each.
    """
    def finite(c):
        return F.abs(c.cast("double")) < F.lit(1e300)

    places = range(len(tolerances))
    rows = df.select(F.col(id_col).alias("_id"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(tolerances)])
    asked = probes.select(F.col(id_col).alias("probe_id"), F.monotonically_increasing_id().alias("_probe"),
                          *[F.col(c).cast("double").alias(f"_p{i}") for i, c in enumerate(tolerances)])
    for i in places:
        rows, asked = rows.where(finite(F.col(f"_x{i}"))), asked.where(finite(F.col(f"_p{i}")))
    alike = [f"_x{i}" for i in places]
    first = Window.partitionBy(*alike).orderBy("_id")
    rows = (rows.where("_id IS NOT NULL").groupBy(*alike, "_id").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("_copies"))
            .withColumn("_place", F.row_number().over(first)).where(F.col("_place") <= k + 1)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_id", *alike))
    rows, asked = cut_lineage(rows), cut_lineage(asked.where("probe_id IS NOT NULL"))
    at = list(tolerances).index(order_by)
    widths = [float(w) for w in tolerances.values()]
    levels = probe_levels(rows, asked, widths, at)
    distance = F.abs(F.col(f"_x{at}") - F.col(f"_p{at}"))
    order = Window.partitionBy("_probe").orderBy(distance, "_id")
    found, pending = [], None
    for level in reversed(range(len(levels))):
        pending = levels[level] if pending is None else levels[level].unionByName(pending)
        own = _halved(widths, at, level)
        close = F.col("_id") != F.col("probe_id")
        for i in places:
            close = close & (F.abs(F.col(f"_x{i}") - F.col(f"_p{i}")) <= F.lit(widths[i]))
        if level:  # short of the cells' width, so that rounding of cells loses nothing
            close = close & (distance <= F.lit(0.99 * own[at]))
        met = _in_cells(rows, own).join(_asking_cells(pending, own), [f"_c{i}" for i in places]).where(close)
        hits = (met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                .select("_probe", "probe_id", "rank", F.col("_id").alias(id_col)))
        if level:
            hits = cut_lineage(hits)
            done = hits.where(F.col("rank") == k).select("_probe")
            hits, pending = hits.join(done, "_probe", "left_semi"), cut_lineage(pending.join(done, "_probe", "left_anti"))
        found.append(hits.select("probe_id", "rank", id_col))
    return reduce(DataFrame.unionByName, found)


#: Rows that a probe meets at most where narrower cells can make them fewer.
MOST_MET = 512
#: Cells of a column at most, so that a value's cell is exact in a double.
_MOST_CELLS = 1e12


def _halved(widths: Sequence[float], at: int, level: int) -> list[float]:
    return [w / 2.0 ** level if i == at else w for i, w in enumerate(widths)]


def _cell(c: Column, width: float) -> Column:
    # cells are doubles, so that far values don't overflow
    return (F.floor(c / F.lit(width)) if width else c).cast("double")


def _in_cells(rows: DataFrame, widths: Sequence[float]) -> DataFrame:
    return rows.withColumns({f"_c{i}": _cell(F.col(f"_x{i}"), w) for i, w in enumerate(widths)})


def _asking_cells(asked: DataFrame, widths: Sequence[float]) -> DataFrame:
    """A row for each cell that a probe asks: its own and, in columns with a width, the two beside it."""
    for i, w in enumerate(widths):
        own = _cell(F.col(f"_p{i}"), w)
        asked = asked.withColumn(f"_c{i}", F.explode(F.array_distinct(F.array(own - 1.0, own, own + 1.0)) if w else F.array(own)))
    return asked


def probe_levels(rows: DataFrame, asked: DataFrame, widths: Sequence[float], at: int) -> list[DataFrame]:
    """The probes by how often the width of column ``at`` is halved until their
    cells hold at most ``MOST_MET`` rows; those without rows in them are left out."""
    cells = [f"_c{i}" for i in range(len(widths))]
    far = rows.agg(F.max(F.abs(F.col(f"_x{at}")))).first()[0] or 0.0
    out, left = [], asked
    while True:
        own = _halved(widths, at, len(out))
        held = _in_cells(rows, own).groupBy(*cells).agg(F.count(F.lit(1)).alias("_held"))
        near = _asking_cells(left, own).join(held, cells).groupBy("_probe").agg(F.sum("_held").alias("_near"))
        counted = cut_lineage(left.join(near, "_probe"))
        crowded = counted.where(F.col("_near") > MOST_MET).drop("_near")
        if not own[at] or 2 * far / own[at] > _MOST_CELLS or crowded.isEmpty():
            return [*out, counted.drop("_near")]
        out.append(counted.where(F.col("_near") <= MOST_MET).drop("_near"))
        left = crowded
