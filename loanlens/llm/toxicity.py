"""Operator 8: toxicity by gradient-boosted trees over dense features.

Features of a whole text: those of ``dense_features`` (capitals, punctuation,
repeats), and densities of three lexicons -- a fixed list of insults, whole
words and word beginnings mined from the training sample -- each also after undoing
common letter substitutions (their difference is the obfuscation rate), and
second-person words near a hit.  Trees are fitted to the logistic loss on
quantile bins; an isotonic map, fitted on out-of-fold scores, calibrates them.
An out-of-fold score comes from trees and mined entries that have seen nothing
of its own fold.

Words are runs of ASCII letters and bytes above 127, in lower case.  Mined
entries are all those of the sample whose documents are toxic far more often than
chance: at least ``MINED_LEAST`` documents and ``MINED_Z`` standard deviations.
The model learns from a bounded sample of ``SAMPLE`` labelled rows, the smallest
by a hash of ``doc_id``.

Defined results: null and empty texts are scored by the features of the empty
text; without labels of both kinds every score is the share of label 1; equal
features have equal scores, and a score of just ``THRESHOLD`` is toxic; repeated
rows are scored each; an empty table gives no rows; other columns are not read,
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.dense_features import dense_features
from loanlens.llm.labelled import collect_features, hash_sample, sample_frame, score_documents, training_labels
from loanlens.llm.storage import Workspace
from loanlens.llm.text import CHUNK, _WHITE, _hash_spans, mix64, signed, text_bytes

SAMPLE = 30_000
THRESHOLD = 0.7
MINED_LEAST, MINED_Z = 6, 6.0
FOLDS = 3
PREFIXES = (4, 5, 6)
NEAR = 5
#: Kinds of hits that are counted.
LEXICAL = 5

# fixed values: insults and second-person words
INSULTS = """arschloch asshole bastard bitch bloedmann clown connard creep cretin cretino degenerate depp dickhead
disgusting dreckig dumb dummkopf estupido fool foul freak garbage gilipollas hateful idiot idiota idioten imbecil
imbecile kill loser merde mierda mistkerl moron moronic pathetic pendejo pig punk puta retard salaud scum schwein
scheisse shit slut stupid sucker trash ugly useless vermin versager vile whore worthless""".split()
SECOND_PERSON = """du dich dein deine dir euch ihr te tes ti toi tu tus u usted ustedes vos votre vous you your yours
yourself ur""".split()
# fixed values: characters written for letters
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "u"}

_WORD = np.zeros(256, bool)
_WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_UNDONE = _PLAIN.copy()
for _mark, _letter in SUBSTITUTES.items():
    _UNDONE[ord(_mark)] = ord(_letter)


def _bounds(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    starts = starts[(starts > 0) & (starts < len(inside))]
    first[starts], last[starts - 1] = inside[starts], inside[starts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _words(block: np.ndarray, rows: np.ndarray, undo: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin, end, hash) of the words of a run of rows.

    With ``undo``, substitutes between or beside letters are read as letters
    and only words that hold one are returned.
    """
    written = _UNDONE[block] if undo else _PLAIN[block]
    begin, end = _bounds(_WORD[written] if undo else _WORD[block], rows)
    if undo:
        odd = np.cumsum(np.concatenate([[0], ~_WORD[block]]))
        own = np.cumsum(np.concatenate([[0], _WORD[block]]))
        mixed = (odd[end] > odd[begin]) & (own[end] > own[begin])
        begin, end = begin[mixed], end[mixed]
    return written, begin, end, _hash_spans(written, begin, end)


def _hash_list(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    begin, end = _bounds(_WORD[data], np.zeros(0, np.int64))
    return np.unique(_hash_spans(data, begin, end))


_INSULTS, _SECOND = _hash_list(INSULTS), _hash_list(SECOND_PERSON)


def _prefix_hashes(data, begin, end, hashes):
    """Hashes of whole words and of their first bytes; a word of just that length has its own kind."""
    yield 0, np.arange(len(hashes)), hashes
    for k in PREFIXES:
        long = np.flatnonzero(end - begin > k)
        found = _hash_spans(data, begin[long], begin[long] + k)
        yield k, long, mix64(found + np.uint64(k))


def _in(sorted_hashes: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_hashes):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_hashes, x), len(sorted_hashes) - 1)
    return sorted_hashes[at] == x


@dataclass
class ToxicFeatures:
    """Feature rows of texts, given the mined hashes (sorted)."""

    mined: np.ndarray

    def __call__(self, column: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(column)
        parts = [np.concatenate([dense, self.lexical(data, offsets[a:b + 1])], axis=1) for a, b, dense in dense_features(column)]
        return np.concatenate(parts) if parts else np.zeros((0, 0))

    def _hits(self, written, begin, end, hashes):
        mined = np.zeros(len(hashes), bool)
        for _, where, found in _prefix_hashes(written, begin, end, hashes):
            mined[where] |= _in(self.mined, found)
        return _in(_INSULTS, hashes), mined

    def lexical(self, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Hits of the rows given and their shares of the words; a long text goes in segments."""
        n = len(rows) - 1
        counts, words = np.zeros((n, LEXICAL)), np.zeros(n, np.int64)
        if n > 1 or int(rows[-1] - rows[0]) <= CHUNK:
            counts, words = self._counts(data[int(rows[0]):int(rows[-1])], rows - rows[0])
        else:
            for a, b in _segments(data, int(rows[0]), int(rows[-1])):
                own, found = self._counts(data[a:b], np.array([0, b - a]))
                counts += own
                words += found
        return np.concatenate([np.minimum(counts, 12), counts / np.maximum(words, 1)[:, None]], axis=1)

    def _counts(self, block: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(rows) - 1
        written, begin, end, hashes = _words(block, rows, False)
        of = np.searchsorted(rows, begin, side="right") - 1
        words = np.bincount(of, minlength=n)
        insult, mined = self._hits(written, begin, end, hashes)
        any_hit = insult | mined
        out = [np.bincount(of, weights=x.astype(float), minlength=n) for x in (insult, mined, any_hit)]
        second = np.flatnonzero(_in(_SECOND, hashes))
        hits = np.flatnonzero(any_hit)
        near = np.zeros(len(hits), bool)
        if len(second):
            for side in (-1, 0):
                at = np.clip(np.searchsorted(second, hits) + side, 0, len(second) - 1)
                near |= (np.abs(second[at] - hits) <= NEAR) & (of[second[at]] == of[hits])
        out.append(np.bincount(of[hits], weights=near.astype(float), minlength=n))
        written, begin, end, hashes = _words(block, rows, True)
        insult, mined = self._hits(written, begin, end, hashes)
        hidden = np.searchsorted(rows, begin, side="right") - 1
        out.append(np.bincount(hidden, weights=(insult | mined).astype(float), minlength=n))
        return np.stack(out, axis=1), words


def _segments(data: np.ndarray, lo: int, hi: int):
    """Ranges of a long text of about ``CHUNK`` bytes that begin with white space."""
    at = lo
    while at < hi:
        to = min(hi, at + CHUNK)
        while to < hi and not _WHITE[data[to]]:
            to += 1
        yield at, to
        at = to


def folds_of(ids: np.ndarray) -> np.ndarray:
    return (mix64(ids.view(np.uint64)) % np.uint64(FOLDS)).astype(np.int64)


def mine_lexicons(rows: DataFrame) -> list[np.ndarray]:
    """Sorted hashes of words and beginnings that mark toxic texts of a bounded sample.

    The first list is of all rows, those after it of all rows but one fold's.
    """

    def run(batches):
        for batch in batches:
            fold, label = folds_of(batch.column(0).to_numpy()), batch.column(2).to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(batch.column(1))
            for f in range(FOLDS):
                found, toxic = [], []
                for row in np.flatnonzero(fold == f).tolist():
                    block = data[int(offsets[row]):int(offsets[row + 1])]
                    own = [h for _, _, h in _prefix_hashes(*_words(block, np.array([0, len(block)]), False))]
                    own = np.unique(np.concatenate(own))
                    found.append(own)
                    toxic.append(np.full(len(own), label[row]))
                if found:
                    every, inverse = np.unique(np.concatenate(found), return_inverse=True)
                    n = np.bincount(inverse, minlength=len(every))
                    k = np.bincount(inverse, weights=np.concatenate(toxic), minlength=len(every))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(every)), pa.array(np.full(len(every), f, np.int32)), pa.array(n, pa.int64()),
                         pa.array(k.astype(np.int64))], ["h", "fold", "n", "k"])

    known = rows.select("doc_id", "label").toPandas()
    fold, label = folds_of(known.doc_id.to_numpy(np.int64)), known.label.to_numpy(np.int64)
    of = [F.sum(F.when(F.col("fold") == f, F.col(c)).otherwise(0)).alias(f"{c}{f}") for c in "nk" for f in range(FOLDS)]
    counts = rows.mapInArrow(run, "h long, fold int, n long, k long").groupBy("h").agg(*of)
    marks = []
    for out in (None, *range(FOLDS)):
        inside = label[fold != out] if out is not None else label
        share = float(inside.mean()) if len(inside) else 0.0
        n, k = (sum((F.col(f"{c}{f}") for f in range(FOLDS) if f != out), F.lit(0)) for c in "nk")
        # (k - n share) / sqrt(n share (1 - share)) of a word that n texts have, k of them toxic
        strong = (n >= MINED_LEAST) & (k >= 0.8 * n) & (k - n * share >= MINED_Z * F.sqrt(n * (share * (1 - share))))
        marks.append((strong if 0 < share < 1 else F.lit(False)).alias(f"in{len(marks)}"))
    names = [f"in{j}" for j in range(len(marks))]
    got = counts.select("h", *marks).where(" OR ".join(names)).toPandas()
    hashes = got.h.to_numpy(np.int64).view(np.uint64)
    return [np.unique(hashes[got[c].to_numpy(bool)]) for c in names]


@dataclass
class Trees:
    """Boosted trees on quantile bins: per tree, split feature, cut and leaf value of a full binary tree."""

    edges: list[np.ndarray]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._sum(self.bins(x))

    def _sum(self, b: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(b), self.base), np.arange(len(b))
        for feature, cut, value in self.trees:
            node = np.zeros(len(b), np.int64)
            while node[0:1].size and node[0] < len(feature):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            total += value[node - len(feature)]
        return total


def fit_trees(x: np.ndarray, y: np.ndarray, count: int = 60, depth: int = 4, rate: float = 0.15,
              ridge: float = 2.0, n_bins: int = 32) -> Trees:
    """Newton boosting of the logistic loss with histograms."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, n_bins + 1)[1:-1])) for k in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model = Trees(edges, [], float(np.log(share / (1 - share))))
    b, n_features = model.bins(x), x.shape[1]
    total, inner = np.full(len(x), model.base), (1 << depth) - 1
    rows = np.arange(len(x))
    for _ in range(count):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, n_bins, np.int64)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            key = (node - first) * n_bins
            gain = np.full((width, n_features, n_bins), -np.inf)
            for k in range(n_features):
                gs = np.bincount(key + b[:, k], weights=g, minlength=width * n_bins).reshape(width, n_bins)
                hs = np.bincount(key + b[:, k], weights=h, minlength=width * n_bins).reshape(width, n_bins)
                gl, hl = gs.cumsum(axis=1), hs.cumsum(axis=1)
                gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                split = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - gl[:, -1:] ** 2 / (hl[:, -1:] + ridge)
                gain[:, k] = np.where((hl >= 1.0) & (hr >= 1.0), split, -np.inf)
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            feature[first:first + width] = np.where(good, best // n_bins, 0)
            cut[first:first + width] = np.where(good, best % n_bins, n_bins)
            node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
        leaf = node - inner
        gs, hs = (np.bincount(leaf, weights=w, minlength=inner + 1) for w in (g, h))
        value = -rate * gs / (hs + ridge)
        model.trees.append((feature, cut, value))
        total += value[leaf]
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (scores, rising shares of label 1) of the pools."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, v in zip(score[order].tolist(), y[order].tolist()):
        pools.append([float(v), 1.0, s, s])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            v2, n2, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + v2, pools[-1][1] + n2, pools[-1][2], hi]
    at = np.array([x for p in pools for x in (p[2], p[3])])
    share = np.array([(p[0] + 0.0) / p[1] for p in pools for _ in range(2)])
    return at, share


@dataclass
class ToxicityModel:
    trees: Trees | None
    at: np.ndarray
    share: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), float(self.share[0]))
        return np.interp(self.trees.raw(x), self.at, self.share)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, fold: np.ndarray, own: list[np.ndarray]) -> ToxicityModel:
        """``own`` has the features for the scores of each fold."""
        if not len(y) or y.min() == y.max():
            return cls(None, np.zeros(1), np.array([float(y.mean()) if len(y) else 0.0]))
        out = np.zeros(len(y))
        for k, xk in enumerate(own):
            inside = fold == k
            rest = y[~inside]
            out[inside] = fit_trees(xk[~inside], rest).raw(xk[inside]) if len(rest) and rest.min() != rest.max() else 0.0
        return cls(fit_trees(x, y), *isotonic(out, y))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[ToxicFeatures, ToxicityModel]:
    """Lexicon, trees and calibration from a bounded sample of labelled documents."""
    work = Workspace(docs.sparkSession, "toxicity")
    chosen = hash_sample(training_labels(labels, "toxic"), sample)
    rows = work.write(sample_frame(docs, chosen), "sample")
    features = [ToxicFeatures(mined) for mined in mine_lexicons(rows)]
    width = 2 * LEXICAL

    def every(column: pa.Array) -> np.ndarray:
        """Dense features once, lexical ones for each lexicon."""
        data, offsets = text_bytes(column)
        parts = [np.concatenate([dense, *(f.lexical(data, offsets[a:b + 1]) for f in features)], axis=1)
                 for a, b, dense in dense_features(column)]
        return np.concatenate(parts) if parts else np.zeros((0, 0))

    ids, y, x = collect_features(rows, every)
    work.remove("sample")
    dense = x.shape[1] - len(features) * width
    of = [np.concatenate([x[:, :dense], x[:, dense + j * width:dense + (j + 1) * width]], axis=1) for j in range(len(features))]
    return features[0], ToxicityModel.fit(of[0], y.astype(float), folds_of(ids), of[1:])


def score_toxicity(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (else doc_id), held_out, score, predicted of every row of ``docs``."""
    features, model = fit_toxicity(docs, labels)
    return score_documents(docs, features, model, THRESHOLD, carry)
