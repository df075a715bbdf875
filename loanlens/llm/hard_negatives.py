"""Operator 11: hard negatives by Four-Russians scoring.

A vector's integer components are kept as bit planes: plane p holds bit p of
every component (two's complement, the last plane has the sign), and eight
components of a plane make one byte.  A block of anchors has one table for
each group of eight dimensions with the sums of all 256 subsets of its eight
components.  The product of a candidate with all anchors of the block is then

    sum over planes of 2^p * sum over groups of table[group][byte]

with the sign plane counted negative: one look-up a byte, shift and add.  The
scores are exact; 32-bit sums are taken where they suffice, 64-bit sums or
Python integers where they don't.

Two passes.  The first scores anchors against rows of their own label and
keeps each anchor's best ones, its positives.  The second scores anchors
against all rows and keeps, for each positive, the best rows of another label
whose score lies in the window that the positive's score sets.  In both,
anchors and candidates are dealt into blocks by the hash of a row number, so
one label or one repeated vector with a third of all rows is spread over many
blocks; a block pair returns a few rows for each anchor.  A candidate costs
about 80 bytes a block of ``ANCHOR_BLOCK`` anchors in the shuffle, and that
many look-ups for each of them.

Defined results: rows with a null label, a null vector or a null or non-finite
component (also after scaling) take no part; a null ``vec_id`` is never an
anchor and comes last among equal scores; repeated rows count each; vectors of
different lengths are compared with their own kind only; empty vectors have
products of 0; scores outside 64 bits are cut to its range; fewer rows than
asked for give all of them; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.storage import Workspace
from loanlens.llm.token_files import _arrow, row_ids

#: Most anchors and candidates of a block; candidates' blocks get smaller until all cores have one.
ANCHOR_BLOCK, CANDIDATE_BLOCK = 8192, 65536
#: Anchors whose tables are held at a time, and candidates scored at a time.
_ANCHORS, _TILE = 64, 2048
#: Bits of a component, and of an anchor's sum of components, below which products fit 64 bits.
_NARROW = 30
_LONG = (1 << 63) - 1

_ROW = T.StructType([T.StructField("uid", T.LongType()), T.StructField("vec_id", T.LongType()),
                     T.StructField("label", T.LongType()), T.StructField("dim", T.IntegerType()),
                     T.StructField("n_planes", T.IntegerType()), T.StructField("planes", T.BinaryType())])
_FOUND = T.StructType([T.StructField(c, T.LongType()) for c in ("anchor", "slot", "uid", "vec_id", "score")])


def pack_planes(x: np.ndarray, n_planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes of integers (rows, dimensions) that fit ``n_planes`` bits."""
    shown = [np.packbits(((x >> p) & 1).astype(np.uint8), axis=1, bitorder="little") for p in range(n_planes)]
    return np.stack(shown, axis=1)


def unpack_planes(planes: np.ndarray, dim: int) -> np.ndarray:
    """The integers of ``pack_planes``: 64-bit up to 63 planes, else Python's."""
    n_planes = planes.shape[1]
    kind = np.int64 if n_planes < 64 else object
    out = np.zeros((len(planes), dim), kind)
    for p in reversed(range(n_planes)):
        bits = np.unpackbits(planes[:, p], axis=1, count=dim, bitorder="little").astype(kind)
        out = -bits if p == n_planes - 1 else 2 * out + bits
    return out


def bits_of(x: np.ndarray) -> np.ndarray:
    """Planes that each row's integers need, sign included."""
    if x.dtype == object:
        return np.array([1 + max([(v if v >= 0 else ~v).bit_length() for v in row], default=0) for row in x], np.int64)
    top = (x ^ (x >> 63)).max(axis=1, initial=0)
    return np.frexp(top.astype(np.float64))[1].astype(np.int64) + 1


def bit_planes(df: DataFrame, label: Column, scale: float = 256.0) -> DataFrame:
    """(uid, vec_id, label, dim, n_planes, planes) of the rows that take part.

    Each component x becomes floor(scale * x), x as double.
    """

    def run(batches):
        uid = row_ids()
        for batch in batches:
            kept, scaled = [], []
            for k, vector in enumerate(batch.column(2)):
                values = vector.values if vector.is_valid else None
                if values is None or values.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(x).all():
                    kept.append(k)
                    scaled.append(x)
            planes, sizes = [b""] * len(kept), np.zeros(len(kept), np.int32)
            dims = np.array([len(x) for x in scaled], np.int32)
            wide = np.array([np.abs(x).max(initial=0) >= 1 << _NARROW for x in scaled], bool)
            for dim, is_wide in sorted(set(zip(dims.tolist(), wide.tolist()))):
                rows = np.flatnonzero((dims == dim) & (wide == is_wide))
                x = np.stack([scaled[r] for r in rows])
                x = np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) if is_wide else x.astype(np.int64)
                bits = bits_of(x)
                for b in np.unique(bits).tolist():
                    own = rows[bits == b]
                    for r, shown in zip(own.tolist(), pack_planes(x[bits == b], b)):
                        planes[r], sizes[r] = shown.tobytes(), b
            yield pa.RecordBatch.from_arrays(
                [pa.array([next(uid) for _ in kept], pa.int64()), batch.column(0).take(pa.array(kept, pa.int64())),
                 batch.column(1).take(pa.array(kept, pa.int64())), pa.array(dims), pa.array(sizes),
                 pa.array(planes, pa.binary())], schema=_arrow(_ROW))

    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                     F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where("label IS NOT NULL AND embedding IS NOT NULL").mapInArrow(run, _ROW)


class SubsetTables:
    """Subset-sum tables of some anchors, eight dimensions each."""

    def __init__(self, anchors: np.ndarray, n_planes: int):
        count, dim = anchors.shape
        most = max([int(v) for v in np.abs(anchors).sum(axis=1)], default=0) << n_planes
        kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object
        self.groups = (dim + 7) // 8
        own = np.zeros((8 * self.groups, count), kind)
        own[:dim] = anchors.T
        own = own.reshape(self.groups, 8, 1, count)
        self.tables = np.zeros((self.groups, 256, count), kind)
        for bit in range(8):
            half = 1 << bit
            self.tables[:, half:2 * half] = self.tables[:, :half] + own[:, bit]

    def scores(self, planes: np.ndarray) -> np.ndarray:
        """(candidates, anchors) products with packed candidates."""
        n, n_planes = planes.shape[:2]
        total = np.zeros((n, self.tables.shape[2]), self.tables.dtype)
        found = np.empty_like(total)
        for p in reversed(range(n_planes)):
            total *= 2
            for g in range(self.groups):
                np.take(self.tables[g], planes[:, p, g], axis=0, out=found, mode="clip")
                total += found
            if p == n_planes - 1:
                np.negative(total, out=total)
        return total


def _stacked(table: pa.Table, groups: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, their planes) of narrow and of wide vectors; shorter ones repeat their sign plane."""
    bits = table["n_planes"].to_numpy()
    raw = table["planes"]
    out = []
    for rows in (np.flatnonzero(bits <= _NARROW + 1), np.flatnonzero(bits > _NARROW + 1)):
        if len(rows):
            planes = np.zeros((len(rows), int(bits[rows].max()), groups), np.uint8)
            for b in np.unique(bits[rows]).tolist():
                own = np.flatnonzero(bits[rows] == b)
                data = b"".join(raw.take(pa.array(rows[own])).to_pylist())
                planes[own, :b] = np.frombuffer(data, np.uint8).reshape(len(own), b, groups)
                planes[own, b:] = planes[own, b - 1:b]
            out.append((rows, planes))
    return out


class _Best:
    """The best candidates of each slot, kept up to date tile by tile."""

    def __init__(self, slots: int, k: int, x_id: np.ndarray, x_uid: np.ndarray):
        self.k, self.x_id, self.x_uid = k, x_id, x_uid
        self.least = np.full(slots, -_LONG - 1, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(3)]

    def add(self, slot: np.ndarray, candidate: np.ndarray, score: np.ndarray) -> None:
        if not len(slot):
            return
        slot, candidate, score = (np.concatenate(c) for c in zip(self.rows, (slot, candidate, score)))
        # equal scores by id, then by row number; ~score reverses the order without overflow
        order = np.lexsort((self.x_uid[candidate], self.x_id[candidate], ~score, slot))
        slot, candidate, score = slot[order], candidate[order], score[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        full = rank == self.k - 1
        self.least[slot[full]] = score[full]
        kept = rank < self.k
        self.rows = [slot[kept], candidate[kept], score[kept]]


def _cut(score: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers."""
    return np.array([max(-_LONG - 1, min(_LONG, v)) for v in score.ravel()], np.int64).reshape(score.shape) \
        if score.dtype == object else score.astype(np.int64, copy=False)


def score_tiles(left: pa.Table, right: pa.Table):
    """(anchor rows, candidate rows, scores of candidates by anchors), tile by tile."""
    dim = left["dim"][0].as_py()
    groups = (dim + 7) // 8
    candidates = _stacked(right, groups)
    for anchor_rows, anchor_planes in _stacked(left, groups):
        anchors = unpack_planes(anchor_planes, dim)
        for a in range(0, len(anchor_rows), _ANCHORS):
            for rows, planes in candidates:
                tables = SubsetTables(anchors[a:a + _ANCHORS], planes.shape[1])
                for c in range(0, len(rows), _TILE):
                    yield anchor_rows[a:a + _ANCHORS], rows[c:c + _TILE], _cut(tables.scores(planes[c:c + _TILE]))


def _result(left: pa.Table, right: pa.Table, anchor: np.ndarray, slot: np.ndarray, candidate: np.ndarray,
            score: np.ndarray) -> pa.Table:
    return pa.Table.from_arrays(
        [left["uid"].take(pa.array(anchor)), pa.array(slot, pa.int64()), right["uid"].take(pa.array(candidate)),
         right["vec_id"].take(pa.array(candidate)), pa.array(score, pa.int64())], schema=_arrow(_FOUND))


def _ids(right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids for breaking ties (rows without one last) and row numbers."""
    return right["vec_id"].fill_null(_LONG).to_numpy(), right["uid"].to_numpy()


def _best_of_label(k: int):
    """Each anchor's ``k`` best other rows; both sides are of one label."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _arrow(_FOUND).empty_table()
        best = _Best(len(left), k, *_ids(right))
        uid = left["uid"].to_numpy()
        for anchors, rows, score in score_tiles(left, right):
            fits = (score >= best.least[anchors]) & (best.x_uid[rows][:, None] != uid[anchors][None, :])
            i, j = np.nonzero(fits)
            best.add(anchors[j], rows[i], score[i, j])
        slot, candidate, score = best.rows
        return _result(left, right, slot, np.zeros(len(slot), np.int64), candidate, score)

    return run


def score_window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest score s with low * positive <= 100 * s <= high * positive."""
    least, most = -(-low * positive // 100), high * positive // 100
    return max(least, -_LONG - 1), min(most, _LONG)


def _best_of_others(k: int, low: int, high: int):
    """For each positive of an anchor, the ``k`` best rows of another label in its window."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _arrow(_FOUND).empty_table()
        windows = [[score_window(p, low, high) for p in row] for row in left["positives"].to_pylist()]
        width = max(map(len, windows))
        # rows of an empty window never fit
        limits = np.array([w + [(1, 0)] * (width - len(w)) for w in windows], np.int64).reshape(-1, width, 2)
        best = _Best(len(left) * width, k, *_ids(right))
        label, x_label = left["label"].to_numpy(), right["label"].to_numpy()
        for anchors, rows, score in score_tiles(left, right):
            other = x_label[rows][:, None] != label[anchors][None, :]
            for p in range(width):
                slot = anchors * width + p
                least = np.maximum(limits[anchors, p, 0], best.least[slot])
                i, j = np.nonzero((score >= least) & (score <= limits[anchors, p, 1]) & other)
                best.add(slot[j], rows[i], score[i, j])
        slot, candidate, score = best.rows
        return _result(left, right, slot // width, slot % width, candidate, score)

    return run


def _dealt(df: DataFrame, own: str, n_own: Column, other: str, n_other: Column) -> DataFrame:
    """Each row in one block of its own kind, copied for each block of the other kind."""
    return (df.withColumn(own, F.pmod(F.xxhash64("uid"), n_own))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), n_other - 1))))


def _blocks(count: Column, size: int) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.ceil(count / F.lit(size)))


def mine_hard_negatives(rows: DataFrame, is_anchor: str, positives: int = 5, negatives: int = 10, low: int = 30,
                        high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` come from ``bit_planes`` and are written; ``is_anchor`` is the SQL
    condition of an anchor.  ``low`` and ``high`` are percents of the
    positive's score.  Equal scores go by ``vec_id``, then by row number.
    """
    work = Workspace(rows.sparkSession, "hard-negatives")
    of_label = ["dim", "label"]
    counts = work.write(rows.groupBy(*of_label).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.expr(is_anchor), 1)).alias("n_anchors")), "counts")
    total = counts.agg(F.sum("n_rows")).first()[0] or 0
    cores = rows.sparkSession.sparkContext.defaultParallelism
    candidate_block = max(1, min(CANDIDATE_BLOCK, -(-total // cores)))
    anchors = rows.where(is_anchor)

    def pairs(sizes: DataFrame, left: DataFrame, right: DataFrame, keys: list[str], run) -> DataFrame:
        sizes = sizes.where("n_anchors > 0").select(*keys, _blocks(F.col("n_anchors"), ANCHOR_BLOCK).alias("n_left"),
                                                    _blocks(F.col("n_rows"), candidate_block).alias("n_right"))
        at = [*keys, "left_block", "right_block"]
        left = _dealt(left.join(sizes, keys), "left_block", F.col("n_left"), "right_block", F.col("n_right"))
        # columns of its own: both sides come from one table
        right = right.toDF(*right.columns).join(sizes.toDF(*sizes.columns), keys)
        right = _dealt(right, "right_block", F.col("n_right"), "left_block", F.col("n_left"))
        return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(run, _FOUND)

    def ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = ranked(pairs(counts, anchors, rows, of_label, _best_of_label(positives)), ["anchor"], positives)
    near = work.write(near.select("anchor", (F.col("rank") - 1).cast("long").alias("slot"),
                                  F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    listed = (near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("listed"))
              .select(F.col("anchor").alias("uid"), F.col("listed.positive_score").alias("positives")))
    by_dim = counts.groupBy("dim").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_anchors").alias("n_anchors"))
    far = pairs(by_dim, anchors.join(listed, "uid"), rows, ["dim"], _best_of_others(negatives, low, high))
    far = ranked(far, ["anchor", "slot"], negatives).select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"),
                                                            F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (far.join(near, ["anchor", "slot"]).join(ids, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def hard_negative_digest(embeddings: DataFrame) -> DataFrame:
    """The query: anchors are rows whose id is divisible by 100.

    Where the id is divisible by 7 the label is first moved on by one.
    """
    work = Workspace(embeddings.sparkSession, "bit-planes")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine_hard_negatives(work.write(bit_planes(embeddings, moved), "rows"), "vec_id % 100 = 0")


#: The query's rows in DuckDB's SQL: all products of anchors with all rows.
ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
         CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
