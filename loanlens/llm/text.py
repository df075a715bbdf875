"""Words, shingles and lines of Arrow text columns, vectorised with numpy.

All functions work on the UTF-8 bytes of a record batch.  A text column is
cut into runs of rows of about ``CHUNK`` bytes so that the working set of a
task stays a few tens of megabytes whatever Spark puts into one batch; a
longer single text is hashed in blocks cut at white space.

A word is a maximal run of bytes other than space and ``\\t\\n\\v\\f\\r``, with
A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
SHINGLE = 5

_U64 = np.uint64
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: a bijection of 64-bit integers."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


# one random 64-bit value for each byte, and the odd base of the polynomial
_BYTE = mix64(np.arange(1, 257, dtype=_U64) * _U64(0x9E3779B97F4A7C15))
_BASE = _U64(0x9DDFEA08EB382D69)
_SLOT = mix64(np.arange(1001, 1001 + SHINGLE, dtype=_U64)) | _U64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def row_runs(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def _word_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; ``starts`` are rows' first bytes."""
    inside = ~_WHITE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    starts = starts[(starts > 0) & (starts < len(data))]
    first[starts] = inside[starts]
    last[starts - 1] = inside[starts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each non-empty span of ``data`` (disjoint, ascending)."""
    if not len(begin):
        return np.zeros(0, _U64)
    length = end - begin
    if int(length.max()) > CHUNK:
        return _hash_long_spans(data, begin, end)
    first = np.zeros(len(begin), np.int64)
    np.cumsum(length[:-1], out=first[1:])
    position = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(first, length)
    at = position + np.repeat(begin, length)
    power = np.full(int(length.max()), _BASE, dtype=_U64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.add.reduceat(_BYTE[data[at]] * power[position], first)
    return mix64(total + length.astype(_U64) * _U64(0x9E3779B97F4A7C15))


def _hash_long_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``_hash_spans`` where a span is longer than a block: block by block, with the base's power so far."""
    out = np.zeros(len(begin), _U64)
    long = end - begin > CHUNK
    out[~long] = _hash_spans(data, begin[~long], end[~long])
    power = np.full(CHUNK, _BASE, dtype=_U64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    for k in np.flatnonzero(long).tolist():
        a, b = int(begin[k]), int(end[k])
        total, before = np.zeros(1, _U64), np.ones(1, _U64)
        for c in range(a, b, CHUNK):
            block = _BYTE[data[c:min(b, c + CHUNK)]]
            total += before * (block * power[:len(block)]).sum(dtype=_U64)
            before *= power[-1] * _BASE
        out[k] = mix64(total + np.array([b - a], _U64) * _U64(0x9E3779B97F4A7C15))[0]
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, words of each row) of the rows given; A-Z are lower-cased unless told otherwise."""
    base, stop = int(offsets[0]), int(offsets[-1])
    hashes, begins = [], []
    at = base
    while at < stop:
        to = min(stop, at + CHUNK)
        while to < stop and not _WHITE[data[to]]:
            step = np.flatnonzero(_WHITE[data[to:min(stop, to + 4096)]])
            to = min(stop, to + 4096) if not len(step) else to + int(step[0])
        block = _LOWER[data[at:to]] if lower else data[at:to]
        begin, end = _word_bounds(block, offsets - at)
        hashes.append(_hash_spans(block, begin, end))
        begins.append(begin + at)
        at = to
    if not hashes:
        return np.zeros(0, _U64), np.zeros(len(offsets) - 1, np.int64)
    places = np.concatenate(begins)
    return np.concatenate(hashes), np.diff(np.searchsorted(places, offsets))


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's words.

    Five words make a shingle; a document with fewer is one shingle of the
    whole sequence; no words give the empty set.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, _U64)
    if n < SHINGLE:
        return mix64((words * _SLOT[:n]).sum(keepdims=True, dtype=_U64) + _U64(n))
    total = words[:n - SHINGLE + 1] * _SLOT[0]
    for k in range(1, SHINGLE):
        total = total + words[k:n - SHINGLE + 1 + k] * _SLOT[k]
    return np.unique(mix64(total))


def batch_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of each row of a text column."""
    data, offsets = text_bytes(column)
    for i, j in row_runs(offsets):
        hashes, counts = word_hashes(data, offsets[i:j + 1])
        at = 0
        for row, n in zip(range(i, j), counts.tolist()):
            yield row, hashes[at:at + n]
            at += n


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans that may be empty; the empty span hashes to 0."""
    out = np.zeros(len(begin), _U64)
    full = np.flatnonzero(end > begin)
    out[full] = _hash_spans(data, begin[full], end[full])
    return out


def word_marks(data: np.ndarray) -> np.ndarray:
    """1 where a word starts, for counting words by ranges."""
    begin, _ = _word_bounds(data, np.zeros(0, np.int64))
    marks = np.zeros(len(data) + 1, np.int64)
    marks[begin + 1] = 1
    return np.cumsum(marks)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
