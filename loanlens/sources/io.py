"""Typed readers and sinks.

Readers match CSV columns by header name and cast them to declared types
(no inference job); they can tag rows with their
input position (``_row_pos``) for the operators whose pandas semantics
depend on row order ("first row wins").  The position is the file's place in
the sorted list of files, then the split's offset in it, then the row's place
in the task's run over the split, so it follows the input whatever the order
in which Spark packs splits into tasks.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from loanlens.sources.schemas import DOMAIN_TABLES, STRING_COLUMNS

ROW_POS = "_row_pos"
# fixed values: strings that mean "missing" in CSV input
MISSING_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                   "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_table(spark: SparkSession, path: str, schema=None, fmt: str | None = None,
               with_row_position: bool = False, limit: int | None = None, quarantine: str | None = None) -> DataFrame:
    """One table.  With ``quarantine`` what a CSV file holds beside good rows is
    written below that folder (``read_checked``); without it a row of another
    length is cut or filled with NULLs and an unparsable value is NULL."""
    fmt = fmt or ("parquet" if path.endswith(".parquet") or os.path.isdir(path) else "csv")
    if fmt == "csv" and quarantine:
        df, rejects = read_checked(spark, path, schema, with_row_position)
        rejects.write.mode("overwrite").parquet(quarantine)
    elif fmt == "csv":
        # header-driven: columns are matched by NAME (a positional schema would
        # silently mistype files whose column order differs), read as strings
        # (no inference pass) and cast with ANSI-safe try_cast
        df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
        if with_row_position:
            df = with_position(df)
        df = df.replace(MISSING_STRINGS, None)
        if schema is not None:
            df = cast_by_name(df, schema)
    else:
        df = spark.read.parquet(path)
        if with_row_position:
            df = with_position(df)
    if limit is not None:  # debug sampling, off by default
        df = df.limit(limit)
    return df


#: The raw text of a row whose fields don't fit the header.
_BAD_ROW = "_bad_row"


def read_checked(spark: SparkSession, path: str, schema=None, with_row_position: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files with a header; nothing becomes NULL unseen.

    A row with fewer or more fields than the header, or with broken quotes, is
    not among the rows.  A value that its column's type can't hold is NULL in its
    row.  Both are ``rejects``: (file, reason, column, value); ``reason`` is
    ``row`` (value: the raw text) or ``type``.  Strings that mean "missing" are no
    rejects.  Both tables come from one scan each of the files.
    """
    names = spark.read.option("header", True).csv(path).columns
    fields = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _BAD_ROW]])
    # a header of another file is compared with the first one's: the columns' order must be the same
    raw = (spark.read.schema(fields).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _BAD_ROW).csv(path))
    # Spark refuses plans that read nothing but the raw text of bad rows, so both filters touch the fields
    read = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in names])) >= 0
    whole = raw.where(F.col(_BAD_ROW).isNull() & read)
    rows = (with_position(whole) if with_row_position else whole).drop(_BAD_ROW).replace(MISSING_STRINGS, None)
    file = F.col("_metadata.file_path").alias("file")
    bad = raw.where(F.col(_BAD_ROW).isNotNull() & read).select(
        file, F.lit("row").alias("reason"), F.lit(None).cast("string").alias("column"), F.col(_BAD_ROW).alias("value"))
    if schema is None:
        return rows, bad
    kinds = {f.name: f.dataType for f in cast_by_name(rows.limit(0), schema).schema.fields}
    typed = [c for c in names if not isinstance(kinds[c], T.StringType)]
    odd = [F.when(F.col(c).isNotNull() & ~F.col(c).isin(MISSING_STRINGS) & F.col(c).try_cast(kinds[c]).isNull(),
                  F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))) for c in typed]
    found = whole.select(file, F.explode(F.filter(F.array(*odd), lambda x: x.isNotNull())).alias("odd")) if typed else None
    if found is not None:
        bad = bad.unionByName(found.select("file", F.lit("type").alias("reason"), "odd.column", "odd.value"))
    return cast_by_name(rows, schema), bad


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(reason, column, n) of a quarantine."""
    return rejects.groupBy("reason", "column").agg(F.count(F.lit(1)).alias("n"))


def with_position(df: DataFrame) -> DataFrame:
    """Add ``_row_pos``: file, offset of the split, row, packed into one decimal."""
    scheme = r"^[^:/]+:/+"  # "file:/a" and "file:///a" are one file
    files = [(re.sub(scheme, "", f), k) for k, f in enumerate(sorted(df.inputFiles()))]
    ranks = df.sparkSession.createDataFrame(files, "_file string, _rank long")  # one row for each file
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    wide = T.DecimalType(38, 0)
    tagged = df.select("*", F.regexp_replace("_metadata.file_path", scheme, "").alias("_path"),
                       F.col("_metadata.file_block_start").alias("_start"), row.alias("_row"))
    position = (F.coalesce("_rank", F.lit(0)).cast(T.DecimalType(12, 0)) * F.lit("1" + 25 * "0").cast(T.DecimalType(26, 0))
                + F.col("_start").cast(T.DecimalType(15, 0)) * F.lit("1" + 10 * "0").cast(T.DecimalType(11, 0))
                + F.col("_row").cast(T.DecimalType(10, 0)))
    return (tagged.join(F.broadcast(ranks), F.col("_path") == F.col("_file"), "left")
            .select(*df.columns, position.cast(wide).alias(ROW_POS)))


def cast_by_name(df: DataFrame, schema) -> DataFrame:
    """Declared columns get their declared type; undeclared columns become
    DOUBLE unless they are known string columns (unparsable -> NULL)."""
    declared = {f.name: f.dataType for f in schema.fields}
    out = []
    for c in df.columns:
        if c == ROW_POS:
            out.append(F.col(c))
            continue
        typ = declared.get(c)
        if typ is None:
            typ = T.StringType() if c in STRING_COLUMNS else T.DoubleType()
        out.append(F.col(c) if isinstance(typ, T.StringType) else F.col(c).try_cast(typ).alias(c))
    return df.select(*out)


def read_tables(spark: SparkSession, data_dir: str, fmt: str = "csv",
                with_row_position: bool = True, limit: int | None = None,
                quarantine: str | None = None) -> dict[str, DataFrame]:
    """Read the eight domain tables from ``data_dir`` (``{stem}.csv`` or
    ``{stem}.parquet``); returns name -> DataFrame.  Rejects of CSV files go
    below ``quarantine``, a folder for each table."""
    out = {}
    for stem, (name, schema) in DOMAIN_TABLES.items():
        path = os.path.join(data_dir, f"{stem}.{fmt}")
        out[name] = read_table(spark, path, schema if fmt == "csv" else None, fmt,
                               with_row_position, limit, quarantine and os.path.join(quarantine, stem))
    return out


def sanitize_name(name: str) -> str:
    """Keep letters, digits and '_' (``A_(B)`` -> ``A_B``, ``X^2`` -> ``X2``)."""
    return re.sub(r"\W", "", name)


def sanitize_columns(df: DataFrame) -> DataFrame:
    new = [sanitize_name(c) for c in df.columns]
    seen, dup = set(), []
    for n in new:
        if n in seen:
            dup.append(n)
        seen.add(n)
    if dup:
        raise ValueError(f"column names collide after sanitising: {sorted(set(dup))[:10]}")
    return df.toDF(*new)


def assert_unique_columns(df: DataFrame) -> DataFrame:
    cols = df.columns
    if len(cols) != len(set(cols)):
        dup = sorted({c for c in cols if cols.count(c) > 1})
        raise ValueError(f"duplicate columns: {dup}")
    return df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Iterable[str] = ()) -> None:
    w = df.write.mode(mode)
    pb = list(partition_by)
    if pb:
        w = w.partitionBy(*pb)
    w.parquet(path)


def write_features(train: DataFrame, test: DataFrame, out_dir: str) -> tuple[str, str]:
    tr, te = os.path.join(out_dir, "train_processed.parquet"), os.path.join(out_dir, "test_processed.parquet")
    write_parquet(train, tr)
    write_parquet(test, te)
    return tr, te


def read_features(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame]:
    tr, te = os.path.join(out_dir, "train_processed.parquet"), os.path.join(out_dir, "test_processed.parquet")
    return spark.read.parquet(tr), spark.read.parquet(te)


def write_predictions(df: DataFrame, out_dir: str, version: str, id_col: str = "SK_ID_CURR",
                      score_col: str = "TARGET") -> str:
    """CSV with header ``SK_ID_CURR,TARGET`` under a versioned name."""
    path = os.path.join(out_dir, f"predictions_{re.sub(r'[^A-Za-z0-9_.-]', '', version)}.csv")
    df.select(id_col, score_col).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_importances(df: DataFrame, path: str, name_col: str = "feature",
                      value_col: str = "importance") -> None:
    """``name: value`` lines, sorted descending (ties by name)."""
    lines = df.orderBy(F.col(value_col).desc(), F.col(name_col)).select(
        F.concat_ws(": ", F.col(name_col), F.format_string("%.6f", F.col(value_col))).alias("value"))
    lines.coalesce(1).write.mode("overwrite").text(path)
