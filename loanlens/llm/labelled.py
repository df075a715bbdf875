"""Bounded samples of documents to fit a classifier on, and scoring by one."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def remainder(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of ``doc_id`` as text, modulo 3; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.crc32(text.cast("binary")) % 3


def is_held_out() -> Column:
    return (remainder() == 1).alias("held_out")


def hash_sample(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows: those with the smallest hash of ``doc_id``."""
    return ids.orderBy(F.xxhash64(F.col("doc_id"), F.lit(5)), "doc_id").limit(most)


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label) of rows to learn from; of repeated rows the largest label."""
    return (labels.where(remainder() != 1).where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(column).cast("int")).alias("label")))


def sample_frame(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) of the sampled ids; the sample is bounded, so it is sent to every task."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")


def collect_features(rows: DataFrame, features: Callable[[pa.Array], np.ndarray]) -> tuple[np.ndarray, ...]:
    """(ids, labels, features) of a bounded sample, in the order of ids."""

    def run(batches):
        for batch in batches:
            x = features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "label", "x"])

    got = rows.mapInArrow(run, "doc_id long, label int, x binary").toPandas().sort_values(["doc_id", "x"])
    width = len(got.x.iloc[0]) // 8 if len(got) else 0
    x = np.frombuffer(b"".join(got.x), np.float64).reshape(len(got), width)
    return got.doc_id.to_numpy(np.int64), got.label.to_numpy(np.int64), x


def score_documents(docs: DataFrame, features: Callable[[pa.Array], np.ndarray],
                    model: Callable[[np.ndarray], np.ndarray], threshold: float,
                    carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (else doc_id), held_out, score and predicted of every whole text."""

    def run(batches):
        for batch in batches:
            if len(batch):
                score = np.clip(model(features(batch.column(2))), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)],
                                                 ["row", "held_out", "score"])

    row = F.struct(*[F.col(c) for c in carry]) if carry else F.struct(F.col("doc_id").cast("long").alias("doc_id"))
    rows = docs.select(row.alias("row"), is_held_out(), F.col("text").cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(run, schema).select("row.*", "held_out", "score")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
