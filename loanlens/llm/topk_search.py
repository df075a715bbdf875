"""Operator 10: exact top-k by inner product with multi-resolution bounds.

A vector is cut into 1, 2, 4, ... segments; each keeps its mean and its
deviation.  For a segment of m components

    q.x <= m mean(q) mean(x) + dev(q) dev(x),

which is the lower bound of the distance seen from the product
(|q-x|^2 = |q|^2 + |x|^2 - 2 q.x).  Bounds are taken coarse to fine against
the k-th best score so far, and survivors get their exact integer product.

Queries are dealt into blocks that fit a task's memory, candidates into strips.
A task holds one query block and reads its strip in batches, so the k-th best
scores of all earlier batches cut the later ones; it returns k rows a query,
and these are merged.  Every candidate is copied once for each query block
(``BLOCK_BYTES`` of queries), every query once for each strip.  Vectors of
different lengths are compared with their own kind only.

Defined results: vectors that are null or hold null or non-finite components
take no part; a query's own row is left out, other rows with its id are not;
ties go to the smaller ``vec_id``; scores outside 64 bits are cut to its range;
a table with fewer rows gives all; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm.storage import Workspace
from loanlens.llm.vectors import matrix, packed_vectors

#: Bytes of a block of queries, most rows of a strip of candidates, and least
#: rows of one (small tables are cut for the cores at hand).
BLOCK_BYTES, STRIP_ROWS, LEAST_STRIP = 16 << 20, 1 << 18, 1 << 12
_TILE = 1024
_LONG = (1 << 63) - 1


def segment_levels(x: np.ndarray) -> list[np.ndarray]:
    """Features of each level; the product of two rows bounds their product."""
    n, d = x.shape
    levels, segments = [], 1
    while segments * 2 <= d:
        edges = np.linspace(0, d, segments + 1).astype(int)
        size = np.diff(edges)
        mean = np.add.reduceat(x, edges[:-1], axis=1) / size
        dev = np.sqrt(np.add.reduceat((x - np.repeat(mean, size, axis=1)) ** 2, edges[:-1], axis=1))
        levels.append(np.concatenate([mean * np.sqrt(size), dev], axis=1))
        segments *= 2
    return levels


def _big_products(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact products of integers too large for floats."""
    out = [sum(int(a) * int(b) for a, b in zip(q[s], x[t])) for s, t in zip(i, j)]
    return np.array([max(-_LONG - 1, min(_LONG, v)) for v in out], np.int64)


def _k_best(row: np.ndarray, ident: np.ndarray, uid: np.ndarray, score: np.ndarray, k: int,
            least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the k best of each row, and the k-th best scores, ``least`` where fewer."""
    order = np.lexsort((uid, ident, -score, row))
    row = row[order]
    first = np.searchsorted(row, np.arange(len(least)))
    rank = np.arange(len(row)) - first[row]
    bars = least.copy()
    full = rank == k - 1
    bars[row[full]] = np.maximum(bars[row[full]], score[order][full])
    return order[rank < k], bars


def block_top_k(q: np.ndarray, q_uid: np.ndarray, q_levels: list[np.ndarray], x: np.ndarray, x_uid: np.ndarray,
                x_id: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of each query's k best candidates, but
    for those below ``least``."""
    norm = float(np.sqrt((q ** 2).sum(1)).max(initial=0) * np.sqrt((x ** 2).sum(1)).max(initial=0))
    small = norm < 2 ** 52
    x_levels = segment_levels(x)
    slack = 1e-9 * norm + 1e-6
    found = [(np.zeros(0, np.int64),) * 3]
    for b in range(0, len(q), _TILE // 4):
        rows = slice(b, b + _TILE // 4)
        own, own_least = [np.zeros(0, np.int64)] * 3, least[rows]
        for a in range(0, len(x), _TILE):
            cols = slice(a, a + _TILE)
            alive = q_uid[rows, None] != x_uid[None, cols]
            for ql, xl in zip(q_levels, x_levels):
                bar = own_least - slack
                if alive.mean() > 0.1:
                    alive &= ql[rows] @ xl[cols].T >= bar[:, None]
                else:
                    i, j = np.nonzero(alive)
                    fail = np.einsum("ij,ij->i", ql[rows][i], xl[cols][j]) < bar[i]
                    alive[i[fail], j[fail]] = False
            i, j = np.nonzero(alive)
            if not small:
                score = _big_products(q[rows], x[cols], i, j)
            elif alive.mean() > 0.1:
                score = (q[rows] @ x[cols].T)[i, j].astype(np.int64)
            else:
                score = np.einsum("ij,ij->i", q[rows][i], x[cols][j]).astype(np.int64)
            keep = score >= own_least[i]
            if keep.any():
                # the k-th best scores rise with every tile of candidates
                own = [np.concatenate(c) for c in zip(own, [i[keep], a + j[keep], score[keep]])]
                kept, own_least = _k_best(own[0], x_id[own[1]], x_uid[own[1]], own[2], k, own_least)
                own = [c[kept] for c in own]
        found.append((b + own[0], own[1], own[2]))
    return tuple(np.concatenate(c) for c in zip(*found))


_FOUND = pa.schema([(c, pa.int64()) for c in ("query_uid", "query_id", "vec_id", "uid", "score")])


def _strip_runs(k: int):
    """Tasks over rows sorted by (dim, query_block, strip, side): side 0 holds
    the block's queries, side 1 the strip's candidates."""

    def answers(held):
        row, x_id, known, x_uid, score = held["best"]
        return pa.RecordBatch.from_arrays(
            [pa.array(held["uid"][row], pa.int64()), held["id"].take(pa.array(row)), pa.array(x_id, pa.int64(), mask=~known),
             pa.array(x_uid, pa.int64()), pa.array(score, pa.int64())], schema=_FOUND)

    def fresh(key):
        none = np.zeros(0, np.int64)
        return {"key": key, "queries": [], "q": None, "best": [none, none, none.astype(bool), none, none]}

    def run(batches):
        held = None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in range(4)]
            new = np.ones(batch.num_rows, bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                part = pa.Table.from_batches([batch.slice(a, b - a)])
                *key, side = (int(c[a]) for c in columns)
                if held is None or held["key"] != key:
                    if held is not None and held["q"] is not None:
                        yield answers(held)
                    held = fresh(key)
                if not side:
                    held["queries"].append(part)
                    continue
                if not held["queries"]:
                    continue
                if held["q"] is None:
                    queries = pa.concat_tables(held["queries"])
                    q = matrix(queries["data"], key[0])
                    held |= {"q": q, "levels": segment_levels(q), "uid": queries["uid"].to_numpy(),
                             "id": queries["vec_id"].combine_chunks(), "least": np.full(len(q), -np.inf)}
                # rows without an id come last among equals
                x_uid, x_id = part["uid"].to_numpy(), part["vec_id"].fill_null(_LONG).to_numpy()
                known = part["vec_id"].is_valid().to_numpy()
                i, j, score = block_top_k(held["q"], held["uid"], held["levels"], matrix(part["data"], key[0]), x_uid, x_id, k,
                                          held["least"])
                more = [i, x_id[j], known[j], x_uid[j], score]
                best = [np.concatenate(c) for c in zip(held["best"], more)]
                kept, held["least"] = _k_best(best[0], best[1], best[3], best[4], k, held["least"])
                held["best"] = [c[kept] for c in best]
        if held is not None and held["q"] is not None:
            yield answers(held)

    return run


def top_k(rows: DataFrame, is_query: str, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) over ``packed_vectors`` rows.

    ``is_query`` is the SQL condition of a query row.
    """
    good = rows.where("data IS NOT NULL")
    queries = good.where(is_query)
    n_candidate, n_query, dim = good.agg(F.count(F.lit(1)), F.count_if(F.expr(is_query)), F.max("dim")).first()
    query_blocks = max(1, math.ceil(n_query * 8 * max(1, dim or 1) / BLOCK_BYTES))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    strips = max(1, math.ceil(n_candidate / STRIP_ROWS), min(math.ceil(2 * cores / query_blocks), n_candidate // LEAST_STRIP))

    def dealt(df, side, own, n_own, other, n_other):
        return (df.withColumn(own, F.pmod(F.xxhash64("uid"), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
                .select("dim", "query_block", "strip", F.lit(side).alias("side"), "uid", "vec_id", "data"))

    keys = ["dim", "query_block", "strip"]
    tasks = max(query_blocks * strips, 1)
    found = (dealt(queries, 0, "query_block", query_blocks, "strip", strips)
             .unionByName(dealt(good, 1, "strip", strips, "query_block", query_blocks))
             .repartition(tasks, *keys).sortWithinPartitions(*keys, "side")
             .mapInArrow(_strip_runs(k), "query_uid long, query_id long, vec_id long, uid long, score long"))
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_k_digest(embeddings: DataFrame) -> DataFrame:
    """The query: rows whose id is divisible by 50 against all rows, k = 5."""
    work = Workspace(embeddings.sparkSession, "topk")
    rows = work.write(packed_vectors(embeddings, scale=256.0), "vectors")
    return top_k(rows, "vec_id % 50 = 0", 5)


#: The query's rows in DuckDB's SQL: all products of queries with all rows.
ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS u, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id,
       CAST(row_number() OVER (PARTITION BY q.u ORDER BY list_inner_product(q.x, c.x) DESC, c.vec_id) AS INTEGER) AS rank,
       c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
FROM v q JOIN v c ON q.u <> c.u AND len(q.x) = len(c.x)
WHERE q.vec_id % 50 = 0
QUALIFY rank <= 5
"""
