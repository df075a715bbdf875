"""Cleaning expressions: sentinels, infinities, coercion, null fills, flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType)


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if(c, sentinel) -> Column:
    """Value -> NULL for one sentinel value (`replace(v, nan)`)."""
    c = as_col(c)
    return F.when(c == F.lit(sentinel), F.lit(None)).otherwise(c)


def replace_sentinels(df: DataFrame, sentinels: Mapping[str, object]) -> DataFrame:
    """Apply column-specific sentinel -> NULL maps to columns that exist."""
    present = {c: v for c, v in sentinels.items() if c in df.columns}
    if not present:
        return df
    return df.withColumns({c: null_if(c, v).cast(df.schema[c].dataType)
                           for c, v in present.items()})


def replace_strings_with_null(df: DataFrame, values: Iterable[str],
                              cols: Iterable[str] | None = None) -> DataFrame:
    """String values (e.g. 'XNA', 'XAP') -> NULL on every string column."""
    values = list(values)
    targets = [f.name for f in df.schema.fields
               if isinstance(f.dataType, T.StringType) and (cols is None or f.name in cols)]
    return df.withColumns({c: F.when(F.col(c).isin(values), F.lit(None)).otherwise(F.col(c))
                           for c in targets})


def finite_or_null(c) -> Column:
    """+-inf and NaN -> NULL (the reference's `replace([inf, -inf], nan)`)."""
    c = as_col(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def inf_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Apply ``finite_or_null`` to every floating column (or the given ones)."""
    wanted = set(cols) if cols is not None else None
    targets = [f.name for f in df.schema.fields
               if isinstance(f.dataType, FRACTIONAL_TYPES) and (wanted is None or f.name in wanted)]
    if not targets:
        return df
    return df.withColumns({c: finite_or_null(F.col(c)) for c in targets})


def nan_to_null(c) -> Column:
    return F.nanvl(as_col(c), F.lit(None).cast("double"))


def coerce_numeric(df: DataFrame, cols: Iterable[str], to: str = "double") -> DataFrame:
    """`to_numeric(errors='coerce')`: unparsable -> NULL (ANSI-safe try_cast)."""
    targets = [c for c in cols if c in df.columns
               and not isinstance(df.schema[c].dataType, NUMERIC_TYPES)]
    if not targets:
        return df
    return df.withColumns({c: F.col(c).try_cast(to) for c in targets})


def fill_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Constant 0 for NULL and NaN on the listed numeric columns."""
    targets = [c for c in cols if c in df.columns
               and isinstance(df.schema[c].dataType, NUMERIC_TYPES)]
    exprs = {}
    for c in targets:
        col = F.col(c)
        if isinstance(df.schema[c].dataType, FRACTIONAL_TYPES):
            col = nan_to_null(col)
        exprs[c] = F.coalesce(col, F.lit(0).cast(df.schema[c].dataType))
    return df.withColumns(exprs) if exprs else df


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 INT where NULL comparisons count as false (pandas)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def clip_lower_keep_null(c, lower=0) -> Column:
    """`np.maximum(x, 0)`: NULL stays NULL (bare greatest() would return 0)."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(lower)))


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def columns_with_suffix(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """'number' or 'string' columns, by schema only (no job)."""
    if kind == "number":
        return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    if kind == "string":
        return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    raise ValueError(kind)
