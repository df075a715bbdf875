"""Category and numeric encoders: one-hot, dummy means, binning, z-score,
median imputation, degree-2 polynomial, group-statistic recipes.

Fitting is apart from applying: value lists, moments, medians and recipe
tables can come from other rows than those they are applied to, as DataFrames
that were saved and loaded.  Fitting steps that decide *column names* (one-hot
value lists) are the only driver collects; their length is counted before, since
each value becomes a column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.operators.stats import global_mean_std, global_medians
from loanlens.session import cut_lineage


#: Dummy columns of one frame at most; ``sparse_dummies`` has no such limit.
MOST_DUMMIES = 20_000


def category_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, type, value): the distinct non-NULL values of each column, as
    strings.  Duplicates go on the map side, so a value that a third of all rows
    has is sent once a task."""
    types = dict(df.dtypes)
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(types[c]).alias("type"),
                               F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.explode(pairs).alias("_v")).select("_v.*").where("value IS NOT NULL").distinct()


def value_lists(values: DataFrame, cols: Sequence[str], most: int = MOST_DUMMIES) -> dict[str, list]:
    """The lists of a ``category_values`` table, sorted, of the columns' own types."""
    n = values.count()
    if n > most:
        raise ValueError(f"{n} values would be as many columns (at most {most}); use sparse_dummies")
    out: dict[str, list] = {c: [] for c in cols}
    for r in values.collect():
        kind = r["type"]
        read = float if kind in ("double", "float") or kind.startswith("decimal") else \
            int if kind in ("tinyint", "smallint", "int", "bigint") else (lambda v: v == "true") if kind == "boolean" else str
        out[r["feature"]].append(read(r["value"]))
    return {c: sorted(v) for c, v in out.items()}


def fit_categories(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """Sorted distinct non-NULL values per column, in one job for all columns."""
    cols = list(cols)
    return value_lists(category_values(df, cols), cols) if cols else {}


def value_label(v) -> str:
    """pandas dummy-column label of a category value (``str(value)``)."""
    return str(v)


def one_hot_exprs(col: str, values: Sequence, prefix: str | None = None,
                  sep: str = "_") -> list[Column]:
    """``{prefix}{sep}{value}`` 0/1 INT columns; a NULL row is all zeros."""
    p = col if prefix is None else prefix
    return [F.coalesce(F.col(col) == F.lit(v), F.lit(False)).cast("int")
            .alias(f"{p}{sep}{value_label(v)}") for v in values]


def one_hot(df: DataFrame, categories: Mapping[str, Sequence], prefix: Mapping | None = None,
            drop_source: bool = True) -> DataFrame:
    """``pd.get_dummies(dummy_na=False, dtype=int8)`` on the listed columns."""
    prefix = prefix or {}
    keep = [c for c in df.columns if not (drop_source and c in categories)]
    dummies = []
    for c, vals in categories.items():
        dummies += one_hot_exprs(c, vals, prefix.get(c))
    return df.select(*keep, *dummies)


def dummy_group_stats(col: str, values: Sequence, stats: Sequence[str],
                      name) -> list[Column]:
    """Mean / sum per group of each dummy of ``col`` (NULL rows count as 0)."""
    out = []
    for v in values:
        d = F.coalesce(F.col(col) == F.lit(v), F.lit(False)).cast("int")
        for s in stats:
            e = F.avg(d) if s == "mean" else F.sum(d)
            out.append(e.alias(name(col, value_label(v), s)))
    return out


# Pd.cut bin edges and labels for loan counts.
COUNT_BIN_EDGES = [0, 1, 3, 5, 10, 1000]
COUNT_BIN_LABELS = ["1", "2-3", "4-5", "6-10", ">10"]


def bin_label(c, edges: Sequence[float] = COUNT_BIN_EDGES,
              labels: Sequence[str] = COUNT_BIN_LABELS) -> Column:
    """``pd.cut(x, edges, labels)`` with right-closed bins; outside -> NULL."""
    x = F.col(c) if isinstance(c, str) else c
    e = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        e = F.when(cond, F.lit(lab)) if e is None else e.when(cond, F.lit(lab))
    return e


def add_zscores(df: DataFrame, cols: Sequence[str], prefix: str = "Z_",
                fit_on: DataFrame | None = None, moments: DataFrame | None = None) -> DataFrame:
    """``Z_{c} = (c - mean) / std`` (ddof 1) with the one row of ``moments``
    (``global_mean_std``), else a fit from ``fit_on`` (default: the frame
    itself).  A zero or undefined std gives a NULL column (fixed schema instead
    of the reference's dropped column)."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    if moments is None:
        moments = global_mean_std(fit_on if fit_on is not None else df, cols)
    joined = df.crossJoin(F.broadcast(moments))  # one row: size bound by construction
    z = [F.when(F.col(f"{c}__std") > 0,
                (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__std")).alias(f"{prefix}{c}")
         for c in cols]
    return joined.select(*df.columns, *z)


def median_impute(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                  suffix: str = "", medians: DataFrame | None = None) -> DataFrame:
    """Replace NULLs with the exact column median (``SimpleImputer('median')``),
    from the one row of ``medians`` (``global_medians``) or fitted here."""
    if medians is None:
        medians = global_medians(fit_on if fit_on is not None else df, cols)
    joined = df.crossJoin(F.broadcast(medians))  # one row
    repl = {f"{c}{suffix}": F.coalesce(F.col(c).cast("double"), F.col(f"{c}__median"))
            for c in cols}
    return joined.select(*df.columns, *[v.alias(n) for n, v in repl.items()]) if suffix else \
        joined.withColumns(repl).select(*df.columns)


def polynomial_exprs(cols: Sequence[str], prefix: str = "POLY_",
                     source: Mapping[str, str] | None = None) -> list[Column]:
    """Degree-2 expansion without bias, in the order x0..xn, then xi*xj (i<=j);
    names ``{prefix}{a}``, ``{prefix}{a}^2``, ``{prefix}{a} {b}``.
    ``source`` maps a name to the (imputed) column that holds its values."""
    source = source or {}

    def v(c):
        return F.col(source.get(c, c)).cast("double")

    out = [v(c).alias(f"{prefix}{c}") for c in cols]
    for a, b in combinations_with_replacement(range(len(cols)), 2):
        ca, cb = cols[a], cols[b]
        name = f"{prefix}{ca}^2" if a == b else f"{prefix}{ca} {cb}"
        out.append((v(ca) * v(cb)).alias(name))
    return out


Recipe = tuple[Sequence[str], Sequence[tuple[str, str]]]


def recipe_name(keys: Sequence[str], col: str, agg: str) -> str:
    return "_".join([*keys, agg.upper(), col])


#: Groups of all recipes together that are sent to every task.
SENT_GROUPS = 500_000


def _group_stat(col: str, agg: str) -> Column:
    """One statistic of a recipe; medians are ``operators.stats.group_quantiles``."""
    if agg == "sum":
        return F.coalesce(F.sum(col), F.lit(0))
    return {"mean": F.avg, "max": F.max, "min": F.min}[agg](col)


def _recipe_columns(recipes: Sequence[Recipe]) -> tuple[list[str], dict[tuple[str, str], str]]:
    """All group columns in order, and the column of the fitted table for each (column, stat)."""
    every = list(dict.fromkeys(k for keys, _ in recipes for k in keys))
    specs = dict.fromkeys((c, a) for _, specs in recipes for c, a in specs)
    return every, {spec: f"_ll_{i}" for i, spec in enumerate(specs)}


def fit_group_statistics(src: DataFrame, recipes: Sequence[Recipe]) -> DataFrame:
    """The statistics of every group of every recipe: one pass (grouping sets),
    one row a group, with the number of its set in ``_ll_set``.  NULL group keys
    never match, so their rows are left out."""
    every, wanted = _recipe_columns(recipes)
    tables = (src.groupingSets([[F.col(k) for k in keys] for keys, _ in recipes], *[F.col(k) for k in every])
              .agg(F.grouping_id(*every).cast("long").alias("_ll_set"),
                   *[_group_stat(col, agg).alias(name) for (col, agg), name in wanted.items()]))
    known = F.lit(False)
    for number, keys in {_set_number(every, keys): keys for keys, _ in recipes}.items():
        known = known | ((F.col("_ll_set") == number) & _all_not_null(keys))
    return tables.where(known)


def _set_number(every: Sequence[str], keys: Sequence[str]) -> int:
    """A bit of a grouping set's number is 1 where the column isn't part of the set."""
    return sum(1 << (len(every) - 1 - i) for i, k in enumerate(every) if k not in keys)


def join_group_statistics(df: DataFrame, recipes: Sequence[Recipe], tables: DataFrame,
                          diff_stats: Sequence[str] = ("mean", "median", "max", "min")) -> DataFrame:
    """Join a fitted table (written, since it is counted) to ``df``, with
    ``_DIFF`` / ``_ABS_DIFF`` of the row value against the group statistic.

    Up to ``SENT_GROUPS`` rows the table is sent to every task and the rows of
    ``df`` don't move; beyond that the joins shuffle, and adaptive execution
    splits hot keys.
    """
    every, wanted = _recipe_columns(recipes)
    few = tables.count() <= SENT_GROUPS
    out, diffs = df, []
    for keys, specs in recipes:
        keys = list(keys)
        table = tables.where(F.col("_ll_set") == _set_number(every, keys)).select(
            *keys, *[F.col(wanted[col, agg]).alias(recipe_name(keys, col, agg)) for col, agg in specs])
        out = out.join(F.broadcast(table) if few else table, keys, "left")
        for col, agg in specs:
            if agg in diff_stats:
                name = recipe_name(keys, col, agg)
                d = F.col(col) - F.col(name)
                diffs += [d.alias(f"{name}_DIFF"), F.abs(d).alias(f"{name}_ABS_DIFF")]
    return out.select("*", *diffs)


def add_group_statistics(df: DataFrame, recipes: Sequence[Recipe],
                         diff_stats: Sequence[str] = ("mean", "median", "max", "min"),
                         fit_on: DataFrame | None = None) -> DataFrame:
    """For every recipe (group columns, [(column, stat)]), one aggregate per
    recipe joined back on the group columns (``fit_group_statistics`` and
    ``join_group_statistics``).  An all-NULL group gives ``sum`` 0."""
    recipes = [(keys, specs) for keys, specs in recipes if specs]
    if not recipes:
        return df
    tables = cut_lineage(fit_group_statistics(fit_on if fit_on is not None else df, recipes))
    return join_group_statistics(df, recipes, tables, diff_stats)


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond
