"""Operator 6: packing documents into sequences of at most 1024 tokens.

Each document's ids are cut into full pieces of ``SEQUENCE`` ids and a rest.
A full piece is a sequence of its own.  The rests are packed first-fit
decreasing into bins of ``SEQUENCE`` ids: documents are dealt at random (a
hash of the row) into groups of about ``GROUP_DOCS``, and each group is
packed by itself with a tournament tree over the free room of its bins, which
finds the leftmost bin with room in logarithmic time.

Defined results: a null or empty text is the end id alone; rows with a null
or repeated ``doc_id`` are packed like any other; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.storage import Workspace
from loanlens.llm.token_files import VOCABULARY, _arrow, row_ids
from loanlens.llm.tokens import PieceEncoder

SEQUENCE = 1024
END_ID = 0
GROUP_DOCS = 8192

_PIECE = T.StructType([T.StructField("uid", T.LongType()), T.StructField("doc_id", T.LongType()),
                       T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                       T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
                       T.StructField("ids", T.BinaryType())])


class Tournament:
    """Bins in order; each inner node knows the most free room below it."""

    def __init__(self, bins: int, room: int):
        self.width = 1 << max(0, (bins - 1).bit_length())
        self.free = [room] * (2 * self.width)

    def place(self, size: int) -> tuple[int, int]:
        """(bin, free room before) of the leftmost bin that takes ``size``."""
        free, node = self.free, 1
        while node < self.width:
            node *= 2
            if free[node] < size:
                node += 1
        before = free[node]
        free[node] = before - size
        place = node - self.width
        while node > 1:
            node >>= 1
            most = max(free[2 * node], free[2 * node + 1])
            if free[node] == most:
                break
            free[node] = most
        return place, before


def first_fit_decreasing(sizes: np.ndarray, room: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size (1..room); the larger go first, ties in order."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    if len(sizes):
        tree = Tournament(len(sizes), room)
        for k in np.argsort(-sizes, kind="stable").tolist():
            bins[k], before = tree.place(int(sizes[k]))
            offsets[k] = room - before
    return bins, offsets


def cut_pieces(docs: DataFrame, vocabulary: str, end_id: int, sequence: int) -> DataFrame:
    """One row for each piece of each document, ids as unsigned 32-bit integers."""

    def run(batches):
        encoder, uid = PieceEncoder.get(vocabulary), row_ids()
        for batch in batches:
            columns = [[] for _ in range(7)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encoder.encode(text).astype("<u4"), np.uint32(end_id)).astype("<u4").tobytes()
                row, n = next(uid), len(ids) // 4
                for piece, start in enumerate(range(0, n, sequence)):
                    part = ids[4 * start:4 * (start + sequence)]
                    for column, value in zip(columns, (row, doc_id, piece, start, len(part) // 4, n, part)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _arrow(_PIECE))], schema=_arrow(_PIECE))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _PIECE)


def assign_sequences(rows: DataFrame, sequence: int, group_docs: int, n_rows: int) -> DataFrame:
    """(uid, full_base, rest_sequence, rest_offset) of (uid, doc_tokens) rows.

    A group's bins come first, then its full pieces; ``sequence_id`` carries
    the group in its upper half.
    """
    groups = max(1, math.ceil(n_rows / group_docs))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        tokens = table["doc_tokens"].to_numpy()
        full, rest = tokens // sequence, tokens % sequence
        some = np.flatnonzero(rest)
        bins, offsets = first_fit_decreasing(rest[some], sequence)
        base = int(table["grp"][0].as_py()) << 32
        n_bins = int(bins.max()) + 1 if len(bins) else 0
        place, offset = np.full(len(tokens), -1, np.int64), np.zeros(len(tokens), np.int64)
        place[some], offset[some] = bins + base, offsets
        return pa.table({"uid": table["uid"], "full_base": base + n_bins + np.cumsum(full) - full,
                         "rest_sequence": place, "rest_offset": offset})

    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("uid", F.lit(20240601)), F.lit(groups)))
    return dealt.groupBy("grp").applyInArrow(
        run, "uid long, full_base long, rest_sequence long, rest_offset long")


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                   sequence: int = SEQUENCE, group_docs: int = GROUP_DOCS,
                   carry: Column | None = None) -> DataFrame:
    """Pieces with their place: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``carry`` is what travels with a piece in place of its ids.
    """
    work = Workspace(docs.sparkSession, "packing")
    pieces = work.write(cut_pieces(docs, vocabulary, end_id, sequence), "pieces")
    rows = pieces.where("piece = 0").select("uid", "doc_tokens")
    places = assign_sequences(rows, sequence, group_docs, rows.count())
    whole = F.col("length") == sequence
    pieces = pieces.withColumn("ids", F.col("ids") if carry is None else carry)
    return (pieces.join(places, "uid")
            .select("doc_id", "start", "length", "ids", "doc_tokens",
                    F.when(whole, F.col("full_base") + F.col("piece")).otherwise(F.col("rest_sequence"))
                    .alias("sequence_id"),
                    F.when(whole, F.lit(0)).otherwise(F.col("rest_offset")).cast("long").alias("offset")))


def packing_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The query: each piece's place and the checksum of its ids."""
    return pack_documents(docs, carry=F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
