"""Vectors of an array column as bytes that numpy reads back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.token_files import _arrow, row_ids

_ROW = T.StructType([T.StructField("uid", T.LongType()), T.StructField("vec_id", T.LongType()),
                     T.StructField("dim", T.IntegerType()), T.StructField("data", T.BinaryType())])


def packed_vectors(df: DataFrame, scale: float | None = None) -> DataFrame:
    """(uid, vec_id, dim, data): 64-bit floats of each vector, or null data.

    ``data`` is null where the vector is null or has a null or non-finite
    component.  With ``scale`` each component x becomes floor(scale * x).
    """

    def run(batches):
        uid = row_ids()
        for batch in batches:
            data, dims = [], []
            for vector in batch.column(1):
                values = vector.values if vector.is_valid else None
                if values is None or values.null_count:
                    x = None
                else:
                    x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                    x = x if scale is None else np.floor(scale * x)
                good = x is not None and bool(np.isfinite(x).all())
                data.append(x.tobytes() if good else None)
                dims.append(len(x) if good else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([next(uid) for _ in data], pa.int64()), batch.column(0),
                 pa.array(dims, pa.int32()), pa.array(data, pa.binary())], schema=_arrow(_ROW))

    return df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, _ROW)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), dim)


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with one key, from batches sorted by it."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if not len(held):
            continue
        columns = [held[k].to_numpy() for k in keys]
        new = np.zeros(len(held), bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield held.slice(a, b - a)
        held = held.slice(cuts[-1]).combine_chunks()
    if held is not None and len(held):
        yield held
