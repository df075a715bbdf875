"""Division policies.

The reference divides in four different ways depending on the table; each
policy is a plain column expression so it stays inside whole-stage codegen.

  div_null      zero denominator -> NULL (also: x/0 = inf then inf -> NULL)
  div_one_plus  a / (1 + b); a zero denominator gives NULL
  div_ieee      IEEE semantics: x/0 = +-inf that survives aggregation, 0/0 missing
  div_eps       a / (b + eps): a zero denominator gives a huge finite value
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlens.functions.cleaning import as_col

POS_INF, NEG_INF = float("inf"), float("-inf")


def div_null(a, b) -> Column:
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def div_one_plus(a, b) -> Column:
    return F.try_divide(as_col(a).cast("double"), F.lit(1.0) + as_col(b).cast("double"))


def div_ieee(a, b) -> Column:
    a, b = as_col(a).cast("double"), as_col(b).cast("double")
    return (F.when(b == 0, F.when(a > 0, F.lit(POS_INF)).when(a < 0, F.lit(NEG_INF)))
            .otherwise(F.try_divide(a, b)))


def div_eps(a, b, eps: float) -> Column:
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double") + F.lit(eps))
