"""Canonical length-limited Huffman code of token ids (numpy)."""

from __future__ import annotations

import numpy as np

#: Longest code, and so the width of the decoding table's index.
LIMIT = 16


def limited_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge).

    Ids that never occur get length 0; a single id gets length 1.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n > 1 << limit:
        raise ValueError(f"{n} ids need codes longer than {limit} bits")
    if n <= 1:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    levels, below = [], weight
    own = np.ones(n, bool)
    levels.append(own)
    for _ in range(limit - 1):
        even = len(below) // 2 * 2
        packages = below[0:even:2] + below[1:even:2]
        both = np.concatenate([weight, packages])
        rank = np.argsort(both, kind="stable")
        below, own = both[rank], rank < n
        levels.append(own)
    # of the 2n-2 cheapest items of the last level, packages stand for pairs below
    take, depth = 2 * n - 2, np.zeros(n, np.int64)
    for own in reversed(levels):
        single = int(own[:take].sum())
        depth[:single] += 1
        take = 2 * (take - single)
    lengths[order] = depth
    return lengths


class Code:
    """Encoder and table-driven decoder of one set of code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        width = lengths[order].astype(np.int64)
        span = np.left_shift(np.int64(1), LIMIT - width)
        first = np.zeros(len(order), np.int64)
        np.cumsum(span[:-1], out=first[1:])
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = (first >> (LIMIT - width)).astype(np.uint64)
        self.symbol = np.zeros(1 << LIMIT, np.uint32)
        self.width = np.ones(1 << LIMIT, np.int64)
        filled = int(span.sum())
        self.symbol[:filled] = np.repeat(order, span)
        self.width[:filled] = np.repeat(width, span)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(payload, bit offset of each id); bits go from high to low."""
        width = self.lengths[ids]
        end = np.cumsum(width)
        at = end - width
        words = np.zeros(int(end[-1] + 31) // 32 + 1, np.uint64)
        place = self.codes[ids] << (64 - width - (at & 31)).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.diff(word, prepend=-1))
        group = np.bitwise_or.reduceat(place, first)
        word = word[first]
        words[word] |= group >> np.uint64(32)
        words[word + 1] |= group & np.uint64(0xFFFFFFFF)
        payload = words.astype(">u4").tobytes()[:int(end[-1] + 7) // 8]
        return payload, at

    def decode(self, payload: bytes, offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ids of the lanes that begin at bit ``offsets`` and hold ``sizes`` ids.

        All lanes advance together, one table look-up for an id; long lanes
        come first so that the live ones are a prefix.
        """
        data = np.frombuffer(payload + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
        order = np.argsort(-sizes, kind="stable")
        at, size = offsets[order].astype(np.int64), sizes[order]
        out = np.zeros((int(size[0]) if len(size) else 0, len(size)), np.uint32)
        live = len(size) - np.searchsorted(size[::-1], np.arange(len(out)), side="right")
        for step, n in enumerate(live.tolist()):
            here = at[:n]
            index = (window[here >> 3] >> (8 - (here & 7)).astype(np.uint32)) & 0xFFFF
            out[step, :n] = self.symbol[index]
            here += self.width[index]
        lanes = np.empty_like(out.T)
        lanes[order] = out.T
        return lanes[np.arange(len(out))[None, :] < sizes[:, None]].astype("<u4", copy=False)
