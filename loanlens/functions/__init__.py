"""Column-expression helpers: everything here returns a Column (no jobs)."""

from loanlens.functions.cleaning import (as_col, clip_lower_keep_null, coerce_numeric,
                                         columns_of_kind, columns_with_prefix,
                                         columns_with_suffix, fill_zero, finite_or_null,
                                         flag, inf_to_null, nan_to_null, null_if,
                                         replace_sentinels, replace_strings_with_null)
from loanlens.functions.division import div_eps, div_ieee, div_null, div_one_plus
from loanlens.functions.rowwise import (null_skipping_sum, row_max, row_mean, row_median,
                                        row_min, row_std, weighted_sum, zero_filled_mean)

__all__ = [
    "as_col", "clip_lower_keep_null", "coerce_numeric", "columns_of_kind",
    "columns_with_prefix", "columns_with_suffix", "fill_zero", "finite_or_null", "flag",
    "inf_to_null", "nan_to_null", "null_if", "replace_sentinels", "replace_strings_with_null",
    "div_eps", "div_ieee", "div_null", "div_one_plus",
    "null_skipping_sum", "row_max", "row_mean", "row_median", "row_min", "row_std",
    "weighted_sum", "zero_filled_mean",
]
