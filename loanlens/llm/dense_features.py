"""Dense features of whole texts, from bytes and word hashes (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from loanlens.llm.text import row_runs, text_bytes, word_hashes

#: Classes of bytes that are counted; each byte has one.
CLASSES = ("lower", "upper", "digit", "blank", "break", "high", "stop", "bang", "pipe", "quote", "symbol")


def _classes() -> np.ndarray:
    table = np.full(256, CLASSES.index("symbol"), np.int64)
    for name, members in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
                          ("blank", (9, 11, 12, 13, 32)), ("break", (10,)), ("high", range(128, 256)),
                          ("stop", b".,;:"), ("bang", b"!?"), ("pipe", b"|\\/"), ("quote", b"'\"()-")):
        table[list(members)] = CLASSES.index(name)
    return table


_CLASS = _classes()
NAMES = (*(f"share_{c}" for c in CLASSES), "log_bytes", "log_words", "word_bytes", "symbol_runs", "distinct",
         "repeat_1", "repeat_2", "top_word", "words_a_line")


def _word_stats(words: np.ndarray) -> tuple[float, float, float, float]:
    """Distinct share, shares that repeat the word before or two before, share of the most frequent."""
    n = len(words)
    if not n:
        return 1.0, 0.0, 0.0, 0.0
    _, counts = np.unique(words, return_counts=True)
    # short texts have few repeats by nature; the distinct share is taken of 200 words at a time
    parts = [len(np.unique(words[a:a + 200])) / len(words[a:a + 200]) for a in range(0, n, 200)]
    return (float(np.mean(parts)), float((words[1:] == words[:-1]).sum() / n),
            float((words[2:] == words[:-2]).sum() / n), float(counts.max() / (n + 20)))


def dense_features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, features) of runs of rows; an empty text has a defined row too."""
    data, offsets = text_bytes(column)
    for a, b in row_runs(offsets):
        rows = offsets[a:b + 1]
        base, n = int(rows[0]), b - a
        block = data[base:int(rows[-1])]
        size = np.diff(rows)
        of = np.repeat(np.arange(n), size)
        kind = _CLASS[block]
        counts = np.bincount(of * len(CLASSES) + kind, minlength=n * len(CLASSES)).reshape(n, -1).astype(float)
        shown = kind >= CLASSES.index("bang")
        runs = np.bincount(of[1:], weights=(shown[1:] & (block[1:] == block[:-1])).astype(float), minlength=n) \
            if len(block) else np.zeros(n)
        hashes, words = word_hashes(data, rows)
        stats, at = np.zeros((n, 4)), 0
        for row, w in enumerate(words.tolist()):
            stats[row] = _word_stats(hashes[at:at + w])
            at += w
        bytes_, word = np.maximum(size, 1), np.maximum(words, 1)
        yield a, b, np.column_stack([
            counts / bytes_[:, None], np.log1p(size), np.log1p(words), size / word, runs / word, stats,
            np.log1p(words / (1 + counts[:, CLASSES.index("break")]))])


def all_features(column: pa.Array) -> np.ndarray:
    parts = [x for _, _, x in dense_features(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))
