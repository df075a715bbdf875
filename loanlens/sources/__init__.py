"""Typed table sources and sinks."""

from loanlens.sources.io import (assert_unique_columns, read_checked, read_features, read_table, read_tables,
                                 reject_counts, sanitize_columns, sanitize_name, write_features,
                                 write_importances, write_parquet, write_predictions)

__all__ = ["assert_unique_columns", "read_checked", "read_features", "read_table", "read_tables",
           "reject_counts", "sanitize_columns", "sanitize_name", "write_features", "write_importances",
           "write_parquet", "write_predictions"]
