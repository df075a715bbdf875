"""Operator 13: ranked lexical search with a K2-treap over the term-document grid.

Rows of the grid are the terms that the items use, by falling weight; columns
are the documents of a block, by rising length; a cell holds the impact of its
term in its document.  A block's grid is a compressed quadtree: a level keeps
only the cells that hold a point, each with a mask of its four children and the
largest impact below it (stored as the drop from its parent's).

An item is a few rows.  All its rows descend together: a range of documents has
one cell for each row, and the sum of their maxima bounds the score of every
document in it.  Ranges are expanded best first, a batch at a time, and those
below the k-th best score so far go.  A range of one document has cells of one
term and one document, so its bound is the exact score.

Texts are read once: a task keeps each document's length and the counts of the
items' terms, which are written; global counts (documents, terms, documents of
each term) come from that table.  The index of a block of at most
``BLOCK_DOCUMENTS`` documents and about ``BLOCK_POINTS`` points is one row of a
written table.  A search task goes through its blocks with the k best documents
of each item so far, and the tasks' lists are merged.  Terms are sent to the
tasks: at most ``SENT_TERMS`` at a time; more items are searched in blocks of
items, each with a pass of its own.

Terms are runs of digits, ASCII letters (A-Z lower-cased) and characters beyond
ASCII.  Impacts: w * ((1000000000 tf) div (1000 tf + 12 m)), where
w = floor(1000 ln((2N + 2) / (2 df + 1))) and
m = 100 - LENGTH_SHARE + ((LENGTH_SHARE n N) div L).

Defined results: a null or empty text has no terms, counts in no sum and is
never found; an item without terms gives no rows; equal scores go by ascending
``doc_id``, a null one last, then by row number; repeated documents are ranked
each, repeated items are searched each; very long texts are read in blocks of
``CHUNK`` bytes; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.storage import Workspace
from loanlens.llm.text import CHUNK
from loanlens.llm.token_files import _arrow, row_ids

#: Documents and points of a block of the index.
BLOCK_DOCUMENTS, BLOCK_POINTS = 8192, 1 << 21
#: Terms of items that are sent to the tasks at a time.
SENT_TERMS = 1_000_000
#: Cells looked up at a time, and cells of ranges kept before the deepest ones go first.
BATCH_CELLS, KEPT_CELLS = 1 << 15, 1 << 22
#: Percent of the length normalisation.
LENGTH_SHARE = 25

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_LONG = (1 << 63) - 1

_ITEM = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", T.LongType()),
                      T.StructField("terms", T.ArrayType(T.BinaryType())), T.StructField("counts", T.ArrayType(T.LongType()))])
_POSTING = T.StructType([T.StructField("uid", T.LongType()), T.StructField("doc_id", T.LongType()),
                         T.StructField("n_terms", T.LongType()), T.StructField("rows", T.BinaryType()),
                         T.StructField("counts", T.BinaryType())])
_BLOCK = T.StructType([
    T.StructField("height", T.IntegerType()), T.StructField("sizes", T.ArrayType(T.LongType())),
    T.StructField("masks", T.BinaryType()), T.StructField("drops", T.BinaryType()), T.StructField("width", T.IntegerType()),
    T.StructField("uids", T.ArrayType(T.LongType())), T.StructField("doc_ids", T.ArrayType(T.LongType()))])
_HIT = T.StructType([T.StructField(c, T.LongType()) for c in ("item", "item_id", "uid", "doc_id", "score")])


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text, some at a time."""
    clean = (text or "").encode().translate(_LETTERS)
    at = 0
    while at < len(clean):
        to = clean.find(b" ", at + CHUNK)
        to = len(clean) if to < 0 else to
        yield clean[at:to].split()
        at = to


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, terms, counts): the distinct terms of each item that has one."""

    def run(batches):
        uid = row_ids()
        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found: Counter = Counter()
                for terms in terms_of(text):
                    found.update(terms)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([next(uid)], pa.int64()), pa.array([item_id], pa.int64()),
                         pa.array([list(found)], pa.list_(pa.binary())), pa.array([list(found.values())], pa.list_(pa.int64()))],
                        schema=_arrow(_ITEM))

    return items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _ITEM)


def postings(docs: DataFrame, vocabulary) -> DataFrame:
    """(uid, doc_id, n_terms, rows, counts) of every document with a term.

    ``vocabulary`` is a broadcast of {term: row}; ``rows`` are ascending 32-bit
    integers, ``counts`` their occurrences in 64 bits.
    """

    def run(batches):
        uid, known = row_ids(), vocabulary.value
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, found = 0, Counter()
                for terms in terms_of(text):
                    n += len(terms)
                    found.update(map(known.get, terms))
                if n:
                    found.pop(None, None)
                    rows = np.array(sorted(found), np.int32)
                    counts = np.array([found[r] for r in rows.tolist()], np.int64)
                    out.append((next(uid), doc_id, n, rows.tobytes(), counts.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _arrow(_POSTING))]
                                             if out else [pa.array([], f.type) for f in _arrow(_POSTING)], schema=_arrow(_POSTING))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _POSTING)


def _document_counts(table: DataFrame, n_rows: int) -> np.ndarray:
    """Documents of each row; summed in each task first, one row a term on the driver."""

    def run(batches):
        total = np.zeros(n_rows, np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32)
            total += np.bincount(held, minlength=n_rows)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["row", "n"])

    out = np.zeros(n_rows, np.int64)
    for r in table.select("rows").mapInArrow(run, "row long, n long").groupBy("row").agg(F.sum("n").alias("n")).collect():
        out[r["row"]] = r["n"]
    return out


class Treap:
    """A compressed quadtree over a grid of side 2^height, with the maxima of its cells.

    Cells of a level stand in Morton order (row bit before column bit), levels
    one after the other from the root; an empty cell is number ``none``.
    """

    #: Children before each one of four, by mask.
    _RANK = np.array([[bin(mask & ((1 << q) - 1)).count("1") for q in range(4)] for mask in range(16)], np.int32)

    def __init__(self, height: int, sizes: list[int], masks: np.ndarray, maxima: np.ndarray):
        self.height, self.sizes, self.none = height, sizes, sum(sizes)
        inner = self.none - sizes[-1] if sizes else 0
        self.masks = np.zeros(self.none + 1, np.uint8)
        self.masks[:inner] = masks[:inner]
        born = np.array([bin(m).count("1") for m in range(16)], np.int32)[self.masks[:inner]]
        self.first = np.zeros(self.none + 1, np.int32)
        if inner:
            self.first[:inner] = 1 + np.cumsum(born) - born
        self.maxima = np.append(maxima, 0)

    @classmethod
    def build(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, side: int) -> Treap:
        """A tree of points with positive values; each cell of the grid holds one at most."""
        height = max(1, int(side - 1).bit_length())
        code = np.zeros(len(rows), np.int64)
        for b in range(height):
            code |= ((rows.astype(np.int64) >> b) & 1) << (2 * b + 1) | ((columns.astype(np.int64) >> b) & 1) << (2 * b)
        order = np.argsort(code, kind="stable")
        code, top = code[order], values[order]
        levels = [(code, np.zeros(len(code), np.uint8), top)]
        for _ in range(height if len(code) else 0):
            parent = code >> 2
            start = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            mask = np.bitwise_or.reduceat((1 << (code & 3)).astype(np.uint8), start)
            code, top = parent[start], np.maximum.reduceat(top, start)
            levels.append((code, mask, top))
        levels.reverse()
        sizes = [len(c) for c, _, _ in levels] if len(rows) else []
        return cls(height, sizes, np.concatenate([m for _, m, _ in levels]), np.concatenate([t for _, _, t in levels]))

    def packed(self) -> tuple[int, list[int], bytes, bytes, int]:
        """Height, sizes of levels, masks (two a byte), drops of maxima from their parents and bytes of a drop."""
        inner = self.none - self.sizes[-1] if self.sizes else 0
        masks = self.masks[:inner + inner % 2]
        own = self.maxima[:-1]
        drops = own.copy()
        if inner:
            drops[1:] = np.repeat(own[:inner], self._born(inner)) - own[1:]
        width = next(w for w in (1, 2, 4, 8) if w == 8 or int(drops.max(initial=0)) < 1 << (8 * w))
        return self.height, list(self.sizes), (masks[::2] | masks[1::2] << 4).tobytes(), drops.astype(f"<u{width}").tobytes(), width

    def _born(self, inner: int) -> np.ndarray:
        return np.array([bin(m).count("1") for m in range(16)])[self.masks[:inner]]

    @classmethod
    def unpacked(cls, height: int, sizes: list[int], masks: bytes, drops: bytes, width: int) -> Treap:
        pairs = np.frombuffer(masks, np.uint8)
        nibbles = np.stack([pairs & 15, pairs >> 4], axis=1).ravel()
        maxima = np.frombuffer(drops, f"<u{width}").astype(np.int64)
        tree = cls(height, sizes, nibbles, maxima)
        # levels from the root: a cell's maximum is its parent's less its drop
        at = 0
        for size, below in zip(sizes, sizes[1:]):
            born = tree._born(at + size)[at:]
            tree.maxima[at + size:at + size + below] = np.repeat(tree.maxima[at:at + size], born) \
                - tree.maxima[at + size:at + size + below]
            at += size
        return tree

    def children(self, cells: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """The child of each cell in the quarter given (2 * row bit + column bit)."""
        mask = self.masks[cells]
        child = self.first[cells] + self._RANK[mask, quarter]
        return np.where((mask >> quarter.astype(np.uint8)) & 1, child, self.none)


def best_documents(tree: Treap, rows: np.ndarray, counts: np.ndarray, k: int, floor: int,
                   ids: np.ndarray, uids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(columns, scores) of the k best documents of a block for one item, none below ``floor``.

    ``rows`` are the item's rows of the grid, ``counts`` their repeats.
    """
    found = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not tree.sizes:
        return found
    floor = max(1, floor)
    level, column = np.zeros(1, np.int64), np.zeros(1, np.int64)
    cells = np.zeros((1, len(rows)), np.int32)
    bound = np.array([int(tree.maxima[0]) * int(counts.sum())], np.int64)
    size = max(1, BATCH_CELLS // len(rows))
    while True:
        alive = bound >= floor
        if not alive.all():
            level, column, cells, bound = level[alive], column[alive], cells[alive], bound[alive]
        if not len(bound):
            return found
        # the deepest ranges first where too many are held, so that the pool shrinks
        key = bound if cells.size <= KEPT_CELLS else level
        take = np.argpartition(-key, size - 1)[:size] if len(key) > size else np.arange(len(key))
        now, prefix, held = level[take], column[take], cells[take]
        rest = np.ones(len(bound), bool)
        rest[take] = False
        level, column, cells, bound = level[rest], column[rest], cells[rest], bound[rest]
        row_bit = (rows[None, :] >> (tree.height - 1 - now)[:, None]) & 1
        fresh = []
        for bit in (0, 1):
            child = tree.children(held, 2 * row_bit + bit)
            top = tree.maxima[child] @ counts
            good = top >= floor
            fresh.append((now[good] + 1, 2 * prefix[good] + bit, child[good], top[good]))
        done = [f[0] == tree.height for f in fresh]
        if any(d.any() for d in done):
            found = _k_best(np.concatenate([found[0], *(f[1][d] for f, d in zip(fresh, done))]),
                            np.concatenate([found[1], *(f[3][d] for f, d in zip(fresh, done))]), k, ids, uids)
            if len(found[1]) == k:
                floor = max(floor, int(found[1][-1]))
        level, column, cells, bound = (np.concatenate([a, *(f[n][~d] for f, d in zip(fresh, done))])
                                       for n, a in enumerate((level, column, cells, bound)))


def _k_best(column: np.ndarray, score: np.ndarray, k: int, ids: np.ndarray, uids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((uids[column], ids[column], -score))[:k]
    return column[order], score[order]


def build_index(table: DataFrame, place: np.ndarray, weights: np.ndarray, n_documents: int, n_terms: int) -> DataFrame:
    """One row a block of documents, from ``postings``.

    ``place`` is the grid row of each posting row, ``weights`` its weight.
    """
    side = max(len(place), BLOCK_DOCUMENTS)

    def block(held):
        held.sort(key=lambda d: (d[2], d[0]))
        rows = np.concatenate([np.frombuffer(d[3], np.int32) for d in held])
        tf = np.concatenate([np.frombuffer(d[4], np.int64) for d in held])
        sizes = np.array([len(d[3]) // 4 for d in held])
        # the product may pass 64 bits, so it is taken document by document
        m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * d[2] * n_documents // n_terms for d in held], np.int64)
        value = weights[rows] * ((1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, sizes)))
        column = np.repeat(np.arange(len(held)), sizes)
        use = value > 0
        tree = Treap.build(place[rows[use]], column[use], value[use], side)
        height, levels, masks, drops, width = tree.packed()
        return pa.RecordBatch.from_pylist([{
            "height": height, "sizes": levels, "masks": masks, "drops": drops, "width": width,
            "uids": [d[0] for d in held], "doc_ids": [d[1] for d in held]}], schema=_arrow(_BLOCK))

    def run(batches):
        held, points = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                # documents without a term of the items have no cells
                if row[3]:
                    held.append(row)
                    points += len(row[3]) // 4
                if len(held) == BLOCK_DOCUMENTS or points >= BLOCK_POINTS:
                    yield block(held)
                    held, points = [], 0
        if held:
            yield block(held)

    return table.mapInArrow(run, _BLOCK)


def search_index(index: DataFrame, items, k: int) -> DataFrame:
    """(item, item_id, rank, doc_id, score): the k best documents of each item.

    ``items`` is a broadcast list of (item, item_id, grid rows, repeats).
    """

    def run(batches):
        best = [[] for _ in items.value]
        for batch in batches:
            for row in range(len(batch)):
                one = {c: batch.column(c)[row].as_py() for c in ("height", "sizes", "masks", "drops", "width")}
                tree = Treap.unpacked(**one)
                uids = batch.column("uids")[row].values.to_numpy()
                shown = batch.column("doc_ids")[row].values
                ids = shown.fill_null(_LONG).to_numpy()
                missing = shown.is_null().to_numpy(zero_copy_only=False)
                for held, (_, _, rows, counts) in zip(best, items.value):
                    floor = -held[-1][0] if len(held) == k else 1
                    for c, s in zip(*map(np.ndarray.tolist, best_documents(tree, rows, counts, k, floor, ids, uids))):
                        held.append((-s, bool(missing[c]), int(ids[c]), int(uids[c])))
                    held.sort()
                    del held[k:]
        out = [(item, item_id, uid, None if none else doc_id, -s)
               for held, (item, item_id, _, _) in zip(best, items.value) for s, none, doc_id, uid in held]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], schema=_arrow(_HIT))

    hits = index.mapInArrow(run, _HIT)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "uid")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item", "item_id", "rank", "doc_id", "score"))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    work = Workspace(spark, "lexical-search")
    asked = work.write(item_terms(items), "items")
    n_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(n_terms / SENT_TERMS))
    ranked = None
    for b in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        found = _rank_block(docs, part.collect(), k, work, b)
        ranked = found if ranked is None else ranked.unionByName(found)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _rank_block(docs: DataFrame, items: list, k: int, work: Workspace, b: int) -> DataFrame:
    """``rank_documents`` for items whose terms are sent to all tasks."""
    sc = docs.sparkSession.sparkContext
    vocabulary = {t: n for n, t in enumerate(sorted({bytes(t) for r in items for t in r["terms"]}))}
    table = work.write(postings(docs, sc.broadcast(vocabulary)), f"postings-{b}")
    n_documents, n_terms = table.agg(F.count(F.lit(1)), F.sum("n_terms")).first()
    held = _document_counts(table, len(vocabulary)) if vocabulary else np.zeros(0, np.int64)
    weights = np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * d + 1))) for d in held.tolist()], np.int64)
    place = np.empty(len(weights), np.int64)
    place[np.argsort(-weights, kind="stable")] = np.arange(len(weights))
    index = work.write(build_index(table, place, weights, n_documents, n_terms or 1), f"index-{b}")
    work.remove(f"postings-{b}")
    asked = [(r["item"], r["item_id"], place[[vocabulary[bytes(t)] for t in r["terms"]]], np.array(r["counts"], np.int64))
             for r in items]
    return search_index(index, sc.broadcast(asked), k)


#: The query's rows in DuckDB's SQL: all scores of all documents that share a term.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), q AS (
  SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
), asked AS (SELECT q, item_id, term, count(*) AS times FROM q GROUP BY ALL
), total AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_all FROM d WHERE len(terms) > 0
), tf AS (
  SELECT u, doc_id, n, term, count(*) AS tf
  FROM (SELECT u, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term
), impact AS (
  SELECT u, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_all))) AS impact
  FROM tf JOIN weight USING (term), total
), scored AS (
  SELECT q, item_id, u, doc_id, CAST(sum(impact * times) AS BIGINT) AS score
  FROM asked JOIN impact USING (term) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""
