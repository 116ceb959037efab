"""Canonical length-limited Huffman codes, written and read many ids at a time."""

from __future__ import annotations

import numpy as np

MAX_LENGTH = 20
# Ids between two checkpoints of a block.
STRIDE = 64


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Length of every id's code, 0 for ids that do not occur; no length above ``limit``.

    Package-merge: the cheapest way to pay for codes of at most ``limit`` bits. Packages
    are kept as the number of leaves among the cheapest entries of each level.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels = []  # for each level: which entries, in order of weight, are leaves
    merged = weights
    levels.append(np.ones(len(weights), dtype=bool))
    for _ in range(limit - 1):
        pairs = len(merged) // 2
        packages = merged[0:2 * pairs:2] + merged[1:2 * pairs:2]
        both = np.concatenate((weights, packages))
        place = np.argsort(both, kind="stable")
        merged = both[place]
        levels.append(place < len(weights))
    take = 2 * len(weights) - 2
    found = np.zeros(len(weights), dtype=np.int64)
    for leaves in reversed(levels):
        n_leaves = int(leaves[:take].sum())
        found[:n_leaves] += 1
        take = 2 * (take - n_leaves)
    lengths[order] = found
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id): each is the one before plus one, filled up with zeros."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code, last = 0, 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        length = int(lengths[i])
        if length:
            code <<= length - last
            codes[i], last = code, length
            code += 1
    return codes


class Coder:
    """Writes and reads blocks of ids; the same for everyone who has the code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint64)
        self.codes = canonical_codes(lengths)
        self.width = int(lengths.max(initial=1))
        self._symbols = None

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        """For each run of ``width`` bits: the id whose code it starts with, and its length."""
        if self._symbols is None:
            symbols = np.zeros(1 << self.width, dtype=np.uint32)
            steps = np.zeros(1 << self.width, dtype=np.int64)
            used = np.flatnonzero(self.lengths)
            order = used[np.lexsort((used, self.lengths[used]))]
            sizes = np.left_shift(1, self.width - self.lengths[order].astype(np.int64))
            filled = int(sizes.sum())
            symbols[:filled] = np.repeat(order, sizes)
            steps[:filled] = np.repeat(self.lengths[order].astype(np.int64), sizes)
            self._symbols, self._steps = symbols, steps
        return self._symbols, self._steps

    def write(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(payload, checkpoints): the codes one after the other, and for every STRIDE-th
        id the bit it starts at, as little-endian 32-bit numbers."""
        if not len(ids):
            return b"", b""
        lengths, codes = self.lengths[ids], self.codes[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        word, inside = (starts >> np.uint64(5)).astype(np.int64), starts & np.uint64(31)
        # A code lies in one 32-bit word and perhaps the next.
        placed = codes << (np.uint64(64) - inside - lengths)
        n_words = int(word[-1]) + 2
        # Codes are shorter than a word, so a code begins in every word up to the last.
        first = np.searchsorted(word, np.arange(n_words - 1))
        high = np.add.reduceat(placed >> np.uint64(32), first)
        low = np.add.reduceat(placed & np.uint64(0xFFFFFFFF), first)
        out = np.zeros(n_words, dtype=np.uint64)
        out[:-1] = high
        out[1:] += low
        size = (int(ends[-1]) + 7) // 8
        return out.astype(">u4").tobytes()[:size], starts[::STRIDE].astype("<u4").tobytes()

    def read(self, payload: bytes, checkpoints: bytes, n: int) -> np.ndarray:
        """The ``n`` ids of a block. All checkpoints are read from side by side."""
        if not n:
            return np.zeros(0, dtype="<u4")
        symbols, steps = self._tables()
        at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
        data = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
        # 32 bits from every byte on; a code and its offset in a byte take 27 at most.
        window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        out = np.empty((len(at), STRIDE), dtype="<u4")
        last = len(window) - 1
        shift, mask = 32 - self.width, (1 << self.width) - 1
        for i in range(STRIDE):
            bits = window[np.minimum(at >> 3, last)].astype(np.int64)
            key = (bits >> (shift - (at & 7))) & mask
            out[:, i] = symbols[key]
            at += steps[key]
        return out.reshape(-1)[:n]
