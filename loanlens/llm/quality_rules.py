"""Operator 12: quality rules and a hashed n-gram log-likelihood ratio.

Base rules are counts of the whole text: words, their code points, symbols,
lines equal to an earlier one, and words inside 5-word windows that occur
twice or more.

The verdict compares two multinomials over hashed n-grams: one of a trusted
target (documents of ``trusted`` labels), one of the raw corpus (all
documents).  A token is a run of letters, digits and bytes beyond ASCII, or a
run of other marks; A-Z are lower-cased; unigrams and bigrams are hashed into
buckets.  A bucket's weight is the logarithm of the ratio of its smoothed
shares, in steps of 2^-16, so that sums are integers and do not depend on the
order of rows.  A document's score is the sum of its weights divided by the
number of its n-grams.  The threshold is deterministic: the score that all but
``tail`` of the trusted documents reach, less ``margin``; a document is kept
when its sum reaches threshold times n-grams.

Counts cover all documents and the number of buckets grows with the square
root of the corpus.  Up to ``SENT_BUCKETS`` buckets the weights are sent to
the tasks; larger tables are joined to the documents' bucket counts.

Defined results: a null or empty text has no words and fails the base rules;
very long texts are read in blocks of ``CHUNK`` bytes, with one 64-bit hash a
word held at a time; equal scores have equal verdicts, and a score on the
threshold is kept; repeated rows are counted and judged each; a null
``doc_id`` is never trusted; of repeated labels the largest counts; without
trusted documents every document that passes the base rules is kept; an empty
table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.labelled import training_labels
from loanlens.llm.storage import Workspace
from loanlens.llm.text import CHUNK, _LOWER, _WHITE, _hash_spans, mix64, row_runs, text_bytes, word_hashes
from loanlens.llm.token_files import _arrow, row_ids

WINDOW = 5
#: Buckets of the largest weight table that is sent to every task (64 MB).
SENT_BUCKETS = 1 << 24
#: A weight of 1.0 in the integers that are summed.
UNIT = 1 << 16

_U64 = np.uint64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
# 0 white space, 1 other marks, 2 letters, digits and bytes beyond ASCII
_KIND = np.ones(256, np.uint8)
_KIND[_WHITE] = 0
_KIND[[b for b in range(256) if b >= 128 or chr(b).isalnum()]] = 2
_SECOND = _U64(0x9FB21C651E98DF25)

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCORED = T.StructType([T.StructField("uid", T.LongType()), T.StructField("doc_id", T.LongType()),
                        *[T.StructField(c, T.LongType()) for c in BASE], T.StructField("n_grams", T.LongType()),
                        T.StructField("weight", T.LongType())])


def repeated_words(words: np.ndarray) -> int:
    """Words inside 5-word windows that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    total = words[:n].copy()
    for k in range(1, WINDOW):
        total = mix64(total) + words[k:n + k]
    _, which, counts = np.unique(total, return_inverse=True, return_counts=True)
    marks = np.zeros(len(words) + 1, np.int32)
    found = np.flatnonzero(counts[which] > 1)
    marks[found] += 1
    marks[found + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(marks[:-1])))


def base_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, 5) counts of the texts given, in the order of ``BASE``."""
    out = np.zeros((len(offsets) - 1, len(BASE)), np.int64)
    words, counts = word_hashes(data, offsets, lower=False)
    at = np.concatenate([[0], np.cumsum(counts)])
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        chars = symbols = 0
        for c in range(a, b, CHUNK):
            block = data[c:min(b, c + CHUNK)]
            # bytes 10xxxxxx continue a character
            chars += np.count_nonzero(~_WHITE[block] & ((block & 0xC0) != 0x80))
            symbols += np.count_nonzero(_SYMBOL[block])
        lines = [x for x in data[a:b].tobytes().split(b"\n") if x.strip()]
        out[row] = counts[row], chars, symbols, len(lines) - len(set(lines)), repeated_words(words[at[row]:at[row + 1]])
    return out


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens in order, tokens of each row) of the rows given."""
    base, stop = int(offsets[0]), int(offsets[-1])
    hashes, begins, at = [], [], base
    while at < stop:
        to = min(stop, at + CHUNK)
        while to < stop and not _WHITE[data[to]]:
            step = np.flatnonzero(_WHITE[data[to:min(stop, to + 4096)]])
            to = min(stop, to + 4096) if not len(step) else to + int(step[0])
        block = _LOWER[data[at:to]]
        kind = _KIND[block]
        edge = np.ones(len(kind), bool)
        edge[1:] = kind[1:] != kind[:-1]
        starts = offsets - at
        edge[starts[(starts > 0) & (starts < len(kind))]] = True
        begin = np.flatnonzero(edge)
        end = np.append(begin[1:], len(kind))
        token = kind[begin] > 0
        hashes.append(_hash_spans(block, begin[token], end[token]))
        begins.append(begin[token] + at)
        at = to
    if not hashes:
        return np.zeros(0, _U64), np.zeros(len(offsets) - 1, np.int64)
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(begins), offsets))


def gram_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every unigram and bigram; ``buckets`` is a power of two."""
    tokens, counts = token_hashes(data, offsets)
    row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    same = row[1:] == row[:-1]
    pairs = mix64(tokens[:-1] * _SECOND + tokens[1:])[same] if len(tokens) else tokens
    grams = np.concatenate([tokens, pairs])
    grams &= _U64(buckets - 1)
    return np.concatenate([row, row[1:][same]]), grams.view(np.int64)


def bucket_count(n_bytes: int) -> int:
    """A power of two that grows with the square root of the corpus."""
    return 1 << max(14, math.ceil(math.log2(4 * math.sqrt(max(1, n_bytes)))))


def _counted(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n_raw, n_target) over all documents; summed in each task first."""

    def run(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            trusted = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for i, j in row_runs(offsets):
                row, grams = gram_buckets(data, offsets[i:j + 1], buckets)
                np.add.at(raw, grams, 1)
                np.add.at(target, grams[trusted[i:j][row]], 1)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])],
                                         ["bucket", "n_raw", "n_target"])

    counted = rows.select("trusted", "text").mapInArrow(run, "bucket long, n_raw long, n_target long")
    return counted.groupBy("bucket").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target"))


def _weights(counts: DataFrame, buckets: int, smoothing: float) -> tuple[DataFrame, int]:
    """((bucket, weight), weight of a bucket without n-grams)."""
    n_raw, n_target = counts.agg(F.sum("n_raw"), F.sum("n_target")).first()
    n_raw, n_target = n_raw or 0, n_target or 0
    top, low = math.log(n_target + smoothing * buckets), math.log(n_raw + smoothing * buckets)
    ratio = F.log(F.col("n_target") + smoothing) - F.log(F.col("n_raw") + smoothing) - F.lit(top - low)
    # a corpus without trusted n-grams weighs nothing
    ratio = ratio if n_target else F.lit(0.0)
    return counts.select("bucket", F.round(ratio * UNIT).cast("long").alias("weight")), \
        round((low - top) * UNIT) if n_target else 0


def _scored(rows: DataFrame, buckets: int, table: np.ndarray | None) -> DataFrame:
    """Base counts of every row, with the sum of its weights where ``table`` is given."""

    def run(batches):
        uid = row_ids()
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            n = len(offsets) - 1
            base, grams, weight = np.zeros((n, len(BASE)), np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for i, j in row_runs(offsets):
                base[i:j] = base_counts(data, offsets[i:j + 1])
                if table is not None:
                    row, bucket = gram_buckets(data, offsets[i:j + 1], buckets)
                    grams[i:j] = np.bincount(row, minlength=j - i)
                    # whole sums below 2^53 are exact in doubles
                    weight[i:j] = np.bincount(row, table[bucket], minlength=j - i).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([next(uid) for _ in range(n)], pa.int64()), batch.column(0).cast(pa.int64()),
                 *map(pa.array, base.T), pa.array(grams), pa.array(weight)], schema=_arrow(_SCORED))

    return rows.select("doc_id", "text").mapInArrow(run, _SCORED)


def _bucket_rows(rows: DataFrame, buckets: int) -> DataFrame:
    """(uid, bucket, n) of every row, for a join with a weight table too large to send."""

    def run(batches):
        uid = row_ids()
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            ids = np.array([next(uid) for _ in range(len(offsets) - 1)], np.int64)
            for i, j in row_runs(offsets):
                row, bucket = gram_buckets(data, offsets[i:j + 1], buckets)
                key, n = np.unique(row * np.int64(buckets) + bucket, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j][key // buckets]), pa.array(key % buckets), pa.array(n)],
                                                 ["uid", "bucket", "n"])

    return rows.select("doc_id", "text").mapInArrow(run, "uid long, bucket long, n long")


def judge_quality(docs: DataFrame, trusted: DataFrame, smoothing: float = 1.0, tail: float = 0.001, margin: float = 0.2,
                  least_words: int = 10, most_repeated: int = 20) -> DataFrame:
    """doc_id, base counts, base_failed, kept, n_grams and score of every document.

    ``trusted`` has the ``doc_id`` of trusted documents.  ``tail`` is the
    share of them that may lie below the threshold before ``margin`` (nats an
    n-gram) is taken off: trusted documents have seen their own counts, others
    of their kind score up to 0.1 lower in a corpus of a thousand documents.
    ``most_repeated`` is a percentage of the words.
    """
    work = Workspace(docs.sparkSession, "quality-rules")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    ids = work.write(ids.withColumn("trusted", F.lit(True)), "trusted")
    marked = texts.join(ids, "doc_id", "left").select(F.coalesce("trusted", F.lit(False)).alias("trusted"), "text")
    buckets = bucket_count(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    counts = work.write(_counted(marked, buckets), "counts")
    weights, rest = _weights(counts, buckets, smoothing)
    if buckets <= SENT_BUCKETS:
        table = np.full(buckets, rest, np.int32)
        # one row a bucket, at most SENT_BUCKETS
        got = weights.toPandas()
        table[got.bucket.to_numpy()] = got.weight.to_numpy()
        scored = work.write(_scored(texts, buckets, table), "scored")
    else:
        # every bucket that a document has is counted, so the join misses none
        sums = (_bucket_rows(texts, buckets).join(weights, "bucket").groupBy("uid")
                .agg(F.sum("n").alias("n_grams"), F.sum(F.col("n") * F.col("weight")).alias("weight")))
        base = _scored(texts, buckets, None).drop("n_grams", "weight")
        scored = work.write(base.join(sums, "uid", "left").fillna(0, ["n_grams", "weight"]), "scored")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    limit = _threshold(scored.join(ids, "doc_id", "left_semi"), tail)
    kept = F.lit(True) if limit is None else \
        F.col("weight") >= F.col("n_grams") * F.lit(limit - round(margin * UNIT)).cast("long")
    score = F.when(F.col("n_grams") > 0, F.col("weight") / F.col("n_grams") / UNIT).otherwise(0.0)
    return scored.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & kept).alias("kept"), "n_grams",
                         score.alias("score"))


def _threshold(trusted: DataFrame, tail: float) -> int | None:
    """The score (in whole steps) that all but ``tail`` of the trusted rows reach, by steps of 1/1024 nat.

    Rows that fail the base rules don't count.
    """
    step = UNIT // 1024
    shown = trusted.where(~F.col("base_failed") & (F.col("n_grams") > 0)) \
        .groupBy(F.floor(F.col("weight") / F.col("n_grams") / step).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    # weights lie within the logarithm of the corpus' size, so there are some ten thousand steps
    steps = sorted((r["step"], r["n"]) for r in shown.collect())
    total = sum(n for _, n in steps)
    below = 0
    for at, n in steps:
        below += n
        if below > tail * total:
            return at * step
    return None


def quality_rules_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query: the trusted target is the documents labelled good (none of the held-out third)."""
    good = training_labels(labels, "quality").where("label = 1").select("doc_id")
    return judge_quality(docs, good)
