"""Operator 1: token ids in Huffman-coded files.

``write_token_files`` encodes every whole text, counts the ids of the whole
corpus, builds one canonical Huffman code of at most 16 bits from these
counts and writes the ids in ascending ``doc_id`` order.  ``read_token_files``
decodes them.

File format, below one folder; each table is a Parquet folder so that any
file system Spark reads can hold it:

* ``code``: ``id``, ``length`` -- the canonical code in full.
* ``blocks``: one row for a block, which decodes by itself.  ``part`` and
  ``block`` give the order; ``first`` counts the ids before it in its part;
  ``doc_ids`` and ``doc_tokens`` list its whole documents; ``checkpoints``
  has the bit offset of every ``LANE``-th id of each document, from its first
  id on; ``payload`` holds the bits.  A block ends with the document that
  fills ``BLOCK_IDS`` ids, so a longer document is a block of its own.

Defined results: a null or empty text is the end id alone; a null ``doc_id``
sorts first and is kept; repeated rows are kept, in any order among
themselves; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.huffman import Code, limited_lengths
from loanlens.llm.storage import Workspace
from loanlens.llm.tokens import PieceEncoder

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
BLOCK_IDS = 1 << 16
LANE = 512

_RAW = T.StructType([T.StructField("uid", T.LongType()), T.StructField("doc_id", T.LongType()),
                     T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
_BLOCK = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("first", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("doc_tokens", T.ArrayType(T.LongType())),
    T.StructField("checkpoints", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType())])
_DOC = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("doc_id", T.LongType()),
                     T.StructField("before", T.LongType()), T.StructField("n_tokens", T.LongType()),
                     T.StructField("ids", T.BinaryType())])


def row_ids() -> Iterator[int]:
    """Numbers that no other task of the job gives out."""
    return iter(range(TaskContext.get().partitionId() << 33, (TaskContext.get().partitionId() + 1) << 33))


def encode_texts(docs: DataFrame, vocabulary: str, end_id: int | None) -> DataFrame:
    """(uid, doc_id, n_tokens, ids) of all texts; ids little-endian, zstd."""

    def run(batches):
        encoder, uid = PieceEncoder.get(vocabulary), row_ids()
        press = zstandard.ZstdCompressor(level=1)
        end = np.array([] if end_id is None else [end_id], encoder.dtype).tobytes()
        for batch in batches:
            ids = [encoder.encode(t).tobytes() + end for t in batch.column(1).to_pylist()]
            sizes = [len(x) // encoder.dtype.itemsize for x in ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array([next(uid) for _ in ids], pa.int64()), batch.column(0).cast(pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array([press.compress(x) for x in ids], pa.binary())],
                schema=_arrow(_RAW))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _RAW)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _count_ids(raw: DataFrame, dtype: str) -> DataFrame:
    """(id, n): how often each id occurs; summed in each task first."""

    def run(batches):
        total, unpress = np.zeros(0, np.int64), zstandard.ZstdDecompressor()
        for batch in batches:
            ids = np.frombuffer(b"".join([unpress.decompress(x.as_py()) for x in batch.column(0)]), dtype)
            counts = np.bincount(ids)
            if len(counts) > len(total):
                total, counts = counts, total
            total[:len(counts)] += counts
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    return raw.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _blocks(ordered: DataFrame, lengths: np.ndarray, dtype: str) -> DataFrame:
    """Code the rows of each sorted partition into blocks."""

    def run(batches):
        code, unpress = Code(lengths), zstandard.ZstdDecompressor()
        part, number, first = TaskContext.get().partitionId(), 0, 0
        docs, ids = [], []

        def block():
            sizes = np.array([len(x) for x in ids], np.int64)
            payload, at = code.encode(np.concatenate(ids))
            start = np.cumsum(sizes) - sizes
            marks = np.concatenate([at[s:s + n:LANE] for s, n in zip(start.tolist(), sizes.tolist())])
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": number, "first": first, "n_ids": int(sizes.sum()), "doc_ids": list(docs),
                "doc_tokens": sizes.tolist(), "checkpoints": marks.tolist(), "payload": payload}], schema=_arrow(_BLOCK))

        held = 0
        for batch in batches:
            for doc_id, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = np.frombuffer(unpress.decompress(x.as_py()), dtype)
                docs.append(doc_id)
                ids.append(got)
                held += len(got)
                if held >= BLOCK_IDS:
                    yield block()
                    number, first, held = number + 1, first + held, 0
                    docs.clear()
                    ids.clear()
        if docs:
            yield block()

    return ordered.select("doc_id", "ids").mapInArrow(run, _BLOCK)


def write_token_files(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Write the ids of ``docs`` (doc_id, text) below ``path`` in the file format."""
    spark = docs.sparkSession
    work = Workspace(spark, "token-ids")
    raw = work.write(encode_texts(docs, vocabulary, end_id), "raw")
    # one row for each id of the vocabulary at most
    dtype = PieceEncoder.get(vocabulary).dtype.str
    counted = {r["id"]: r["n"] for r in _count_ids(raw, dtype).collect()}
    counts = np.zeros(max(counted, default=0) + 1, np.int64)
    counts[list(counted)] = list(counted.values())
    lengths = limited_lengths(counts)
    code = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(code, "id int, length int").coalesce(1).write.parquet(f"{path}/code")
    ordered = raw.repartitionByRange("doc_id", "uid").sortWithinPartitions("doc_id", "uid")
    _blocks(ordered, lengths, dtype).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    work.remove("raw")


def _some(rows: list[dict]) -> Iterator[list[dict]]:
    """Blocks to decode together: the more lanes at once, the less a step costs."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += row["n_ids"]
        if size >= 16 * BLOCK_IDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _decoded(code: Code, rows: list[dict]) -> pa.RecordBatch:
    """One row for each document of some blocks."""
    tokens = [np.array(row["doc_tokens"], np.int64) for row in rows]
    starts = np.concatenate([row["first"] + np.cumsum(n) - n for row, n in zip(rows, tokens)])
    parts = np.repeat([row["part"] for row in rows], [len(n) for n in tokens])
    base = np.cumsum([0, *(len(row["payload"]) for row in rows[:-1])]) * 8
    offsets = np.concatenate([np.array(row["checkpoints"], np.int64) + at for row, at in zip(rows, base.tolist())])
    tokens = np.concatenate(tokens)
    lanes = (tokens + LANE - 1) // LANE
    sizes = np.full(int(lanes.sum()), LANE, np.int64)
    sizes[np.cumsum(lanes) - 1] = tokens - (lanes - 1) * LANE
    raw = code.decode(b"".join(row["payload"] for row in rows), offsets, sizes)
    cuts = np.concatenate([[0], 4 * np.cumsum(tokens)]).astype(np.int32)
    ids = pa.Array.from_buffers(pa.binary(), len(tokens), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(raw)])
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32()), pa.array([i for row in rows for i in row["doc_ids"]], pa.int64()),
         pa.array(starts), pa.array(tokens), ids], schema=_arrow(_DOC))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document, decoded from the files.

    ``ids`` are little-endian unsigned 32-bit integers; ``start`` counts the
    ids of all documents before it.
    """
    code = spark.read.parquet(f"{path}/code").collect()
    lengths = np.zeros(max((r["id"] for r in code), default=0) + 1, np.uint8)
    for r in code:
        lengths[r["id"]] = r["length"]
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")

    def run(batches):
        code = Code(lengths)
        for batch in batches:
            for rows in _some(batch.to_pylist()):
                yield _decoded(code, rows)

    found = blocks.select("part", "first", "n_ids", "doc_ids", "doc_tokens", "checkpoints", "payload").mapInArrow(run, _DOC)
    # one row for each writing task
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = sums.selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS base")
    return (found.join(F.broadcast(base), "part")
            .select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids"))


def token_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The query: write the files, read them back, one digest row a document."""
    path = Workspace(spark, "token-files").root
    write_token_files(docs, path)
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
