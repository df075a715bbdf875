"""Spec-driven roll-ups: a dict ``column -> [stat, ...]`` compiled into ONE
``groupBy(key).agg(...)``.

Semantics follow pandas ``groupby().agg``:

  min / max / mean     NULLs skipped, all-NULL -> NULL
  sum                  NULLs skipped, all-NULL -> 0
  var / std            sample (ddof 1), n < 2 -> NULL
  count                non-NULL count;  size: row count
  nunique              distinct non-NULL values
  (median per group: ``operators.stats.group_quantiles``, a distributed pass)

A *conditional* roll-up ("filter(status == s) -> groupBy -> left merge")
is folded into the same aggregate: every statistic only sees rows where the
condition holds, and the whole block is NULL for a key without such rows —
exactly what the left merge of a separately filtered aggregate would give.
That keeps all/active/closed (or all/approved/refused) in one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Spec = Mapping[str, Sequence[str]]
Namer = Callable[[str, str], str]

KNOWN_STATS = ("min", "max", "mean", "sum", "var", "std", "count", "size", "nunique", "median")


def pandas_style_name(prefix: str = "", suffix: str = "") -> Namer:
    """``{prefix}{col}_{STAT}{suffix}`` (the reference's flattening rule)."""
    return lambda col, stat: f"{prefix}{col}_{stat.upper()}{suffix}"


def stat_expr(col: str | Column, stat: str, cond: Column | None = None) -> Column:
    """One statistic over the rows where ``cond`` holds (all rows if None)."""
    x = F.col(col) if isinstance(col, str) else col
    if cond is not None:
        x = F.when(cond, x)
    if stat == "min":
        return F.min(x)
    if stat == "max":
        return F.max(x)
    if stat == "mean":
        return F.avg(x)
    if stat == "sum":
        # coalesce() widens the literal 0 to the sum type (long or double)
        return F.coalesce(F.sum(x), F.lit(0))
    if stat == "var":
        return F.var_samp(x)
    if stat == "std":
        return F.stddev_samp(x)
    if stat == "count":
        return F.count(x)
    if stat == "size":
        return F.count(F.lit(1)) if cond is None else F.count_if(cond)
    if stat == "nunique":
        return F.count_distinct(x)
    if stat == "median":
        # an exact percentile aggregate buffers a whole group in one task;
        # per-group medians go through the distributed rank pass instead
        raise ValueError("per-group 'median' is computed by operators.stats.group_quantiles "
                         "(distributed, skew-safe), not inside a roll-up")
    raise ValueError(f"unknown statistic {stat!r}; expected one of {KNOWN_STATS}")


def rollup_exprs(spec: Spec, namer: Namer, cond: Column | None = None,
                 available: Sequence[str] | None = None) -> list[Column]:
    """Compile a spec into aliased aggregate expressions.

    With ``cond``, each expression is NULL when the key has no row meeting
    the condition (left-merge-miss semantics).
    """
    out = []
    for col, stats in spec.items():
        if available is not None and col not in available:
            continue
        for stat in stats:
            e = stat_expr(col, stat, cond)
            if cond is not None:
                e = F.when(F.count_if(cond) > 0, e)
            out.append(e.alias(namer(col, stat)))
    return out


def rollup(df: DataFrame, key: str | Sequence[str], spec: Spec, namer: Namer,
           extra: Sequence[Column] = ()) -> DataFrame:
    """groupBy(key).agg(spec) with pandas naming; ``extra`` adds more aggregates."""
    keys = [key] if isinstance(key, str) else list(key)
    exprs = rollup_exprs(spec, namer, available=df.columns) + list(extra)
    return df.groupBy(*keys).agg(*exprs)


def conditional_rollup(df: DataFrame, key: str | Sequence[str],
                       blocks: Sequence[tuple[Spec, Namer, Column | None]]) -> DataFrame:
    """Several (spec, namer, condition) blocks in one aggregate node.

    ``condition=None`` is the unconditional block.
    """
    keys = [key] if isinstance(key, str) else list(key)
    exprs: list[Column] = []
    for spec, namer, cond in blocks:
        exprs += rollup_exprs(spec, namer, cond, available=df.columns)
    return df.groupBy(*keys).agg(*exprs)


_PLACE = "_ll_place"


def gather(df: DataFrame, key: str) -> DataFrame:
    """Rows of a key next to each other, for an aggregate whose state is wider
    than its rows.

    Without it every task that meets a key sends a state of its own: a
    borrower's ten loans in ten tasks are ten states of hundreds of numbers.
    The rows are spread by a hash of the key, which doesn't count as grouped by
    the key, so a partial aggregate still follows, and rebalanced, so that
    adaptive execution deals a partition with a hot key over several tasks.
    """
    return df.withColumn(_PLACE, F.xxhash64(F.col(key))).hint("rebalance", _PLACE).drop(_PLACE)


#: A partition of more rows than this, and more than so many times the mean, isn't even.
EVEN_ROWS, EVEN_TIMES = 500_000, 5


def deals_evenly(df: DataFrame, key: str) -> bool:
    """Whether the partitions of ``deal`` stay near their mean, told by counting
    the rows that the key's hash would give each (a few numbers a task)."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    sizes = df.where(F.col(key).isNotNull()).groupBy(F.pmod(F.hash(key), F.lit(parts)).alias("_p")).agg(F.count("*").alias("_n"))
    most, rows = sizes.agg(F.max("_n"), F.sum("_n")).first()
    return most is None or most <= max(EVEN_ROWS, EVEN_TIMES * rows / parts)


def deal(df: DataFrame, key: str) -> DataFrame:
    """The rows that have a key, dealt by it in one shuffle for all aggregates on it.

    Every aggregate on the key then ends where its rows are, and no state of it
    is shuffled.  One key's rows are one task's, so ask ``deals_evenly`` before
    and ``gather`` them otherwise.  The last filter drops nothing: it names every
    column and numbers the rows, so that it stays above the shuffle and the columns
    below.  Without it each aggregate would shuffle a choice of columns of its own.
    """
    dealt = df.where(F.col(key).isNotNull()).repartition(F.col(key))
    return dealt.where((F.monotonically_increasing_id() >= 0) | (F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) == 0))


def spec_names(spec: Spec, namer: Namer) -> list[str]:
    return [namer(c, s) for c, stats in spec.items() for s in stats]


def chunked_conditional_rollup(df: DataFrame, key: str, blocks: Sequence[tuple[Spec, Namer, Column | None]],
                               extra: Sequence[Column] = (), max_aggs: int | None = None, dealt: bool = False,
                               apart: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``conditional_rollup`` split into several aggregate nodes of at most
    ``max_aggs`` expressions, one per group of *source columns* (every
    block of a column stays together).

    Why: an aggregate node with hundreds of expressions exceeds Spark's
    whole-stage-codegen field limit and runs interpreted (several times
    slower per row).  Splitting by source column keeps each node compiled
    while each node reads a disjoint set of columns, so the columnar scan
    volume stays that of one pass; the nodes are hash-partitioned on the
    same key, so joining them needs no further shuffle.  The rows of a key
    are gathered first, as each node's states are wider than its rows.  NULL
    keys are dropped (pandas groupby semantics), so the inner joins are exact.

    ``dealt``: the rows come from ``deal``, so they stay where they are.
    ``apart`` has columns that come from another frame with the same rows a key
    (dealt as well); such a column has a node of its own.
    """
    apart = apart or {}
    if max_aggs is None:
        max_aggs = int(df.sparkSession.conf.get("loanlens.rollup.maxAggsPerNode", "100"))
    src = df if dealt else gather(df.where(F.col(key).isNotNull()), key)
    cols: list[str] = []
    for spec, _, _ in blocks:
        cols += [c for c in spec if (c in df.columns or c in apart) and c not in cols]
    per_col = {c: sum(len(spec.get(c, ())) for spec, _, _ in blocks) for c in cols}
    chunks: list[list[str]] = [[]]
    n = 0
    for c in cols:
        if chunks[-1] and n + per_col[c] > max_aggs:
            chunks.append([])
            n = 0
        chunks[-1].append(c)
        n += per_col[c]
    parts, names = [], [key]
    for i, chunk in enumerate(chunks):
        exprs: list[Column] = []
        for spec, namer, cond in blocks:
            sub = {c: spec[c] for c in chunk if c in spec}
            exprs += rollup_exprs({c: s for c, s in sub.items() if c not in apart}, namer, cond)
            names += spec_names(sub, namer)
        if i == 0:
            exprs += list(extra)
        if exprs:
            parts.append(src.groupBy(key).agg(*exprs))
        if i == 0 and extra:
            at = len(parts[0].columns) - len(extra)
            names += parts[0].columns[at:]
    for c, other in apart.items():
        parts.append(other.groupBy(key).agg(*[e for spec, namer, cond in blocks if c in spec
                                              for e in rollup_exprs({c: spec[c]}, namer, cond)]))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, key, "inner")
    return out.select(*names) if apart else out
