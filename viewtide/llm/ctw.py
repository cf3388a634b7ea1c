"""Context-tree weighting over bytes, as arrays.

A byte is eight binary decisions, each a node named by the bits before it. Every
context of 0 to ``depth`` preceding bytes keeps zeros and ones for each node. With
the Krichevsky-Trofimov block probability Pe of those counts, the weighted one is
``Pw = Pe/2 + prod(Pw of the longer contexts)/2`` (at full depth ``Pw = Pe``), so a
node stops at its own depth with weight ``Pe / (2 Pw)``. A bit's probability mixes
the KT estimates of all depths by these weights; contexts that training never saw
give no estimate, so the mixture ends at the longest known one.

A gram is a number: the most recent byte in the top position, then the older ones,
the predicted byte last. Its leading bytes thus name its contexts of all depths.
"""

from __future__ import annotations

import numpy as np

from viewtide.llm.common import LOWER, sum_by_key

#: Bytes that UTF-8 never uses: before the text, and at its end.
BEFORE, END = 0xFE, 0xFF


def grams_of(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of each byte and text end, lower-cased, and where each text's grams begin."""
    rows = memoryview(LOWER[data])
    gap = bytes([END]) + bytes([BEFORE]) * depth
    parts = [rows[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    joined = np.frombuffer(bytes([BEFORE]) * depth + gap.join(parts) + bytes([END]), np.uint8)
    wide = joined.astype(np.uint64)
    grams = wide[depth:].copy()
    for k in range(1, depth + 1):
        grams |= wide[depth - k : len(wide) - k] << np.uint64(8 * (depth - k + 1))
    grams = grams[joined[depth:] != BEFORE]
    return grams, offsets + np.arange(len(offsets))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after moving every argument up by eight."""
    low = np.zeros_like(x)
    for k in range(8):
        low += np.log(x + k)
    y = x + 8
    tail = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + tail - low


#: log gamma of n + 1/2 and of n + 1 for small n.
SMALL = 1 << 14
_HALF = _log_gamma(np.arange(SMALL) + 0.5)
_WHOLE = _log_gamma(np.arange(SMALL) + 1.0)


def _tabled(n: np.ndarray, table: np.ndarray, add: float) -> np.ndarray:
    out = table[np.minimum(n, SMALL - 1)]
    large = np.flatnonzero(n >= SMALL)
    out[large] = _log_gamma(n[large] + add)
    return out


def log_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The logarithm of the KT block probability of these counts."""
    return _tabled(zeros, _HALF, 0.5) + _tabled(ones, _HALF, 0.5) - np.log(np.pi) - _tabled(zeros + ones, _WHOLE, 1.0)


def bit_nodes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte its eight nodes (1 to 255) and the bit taken there."""
    level = np.arange(8)
    symbols = symbols.astype(np.int64)[:, None]
    return (1 << level) | (symbols >> (8 - level)), (symbols >> (7 - level)) & 1


class Level:
    """The binary nodes of all contexts of one length."""

    def __init__(self, contexts: np.ndarray, symbols: np.ndarray, counts: np.ndarray):
        nodes, bits = bit_nodes(symbols)
        keys = ((contexts.astype(np.uint64) << np.uint64(8))[:, None] | nodes.astype(np.uint64)).ravel()
        counts = np.repeat(counts.astype(np.int64), 8)
        order = np.argsort(keys, kind="stable")
        keys, counts, ones = keys[order], counts[order], (counts * bits.ravel())[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        self.keys = keys[first]
        self.ones = np.add.reduceat(ones, first)
        self.zeros = np.add.reduceat(counts, first) - self.ones
        self.log_pw = log_block(self.zeros, self.ones)
        self.stop = np.ones(len(self.keys))

    def weigh(self, log_children: np.ndarray) -> None:
        """Mix in the product of the longer contexts, given by its logarithm for each node."""
        own = self.log_pw - np.log(2)
        self.log_pw = np.logaddexp(own, log_children - np.log(2))
        self.stop = np.exp(own - self.log_pw)

    def parents(self) -> np.ndarray:
        """The key of the same node in the context that is one byte shorter."""
        context = self.keys >> np.uint64(16)
        return (context << np.uint64(8)) | (self.keys & np.uint64(255))

    def refine(self, keys: np.ndarray, bits: np.ndarray, longer: np.ndarray) -> np.ndarray:
        """Probabilities of the bits, from those of longer contexts (NaN: never seen)."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        ones, zeros = self.ones[at], self.zeros[at]
        kt = (np.where(bits == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
        mixed = np.where(np.isnan(longer), kt, longer + self.stop[at] * (kt - longer))
        return np.where(known, mixed, np.nan)


def children_of(level: Level, parent: Level) -> np.ndarray:
    """For each node of ``parent`` the sum of the log Pw of its longer contexts."""
    at = np.searchsorted(parent.keys, level.parents())
    return np.bincount(at, level.log_pw, len(parent.keys))


def levels_of(grams: np.ndarray, counts: np.ndarray, depth: int, shortest: int) -> list[Level]:
    """The weighted levels of ``shortest`` to ``depth`` context bytes, from trained grams."""
    symbols = grams & np.uint64(255)
    levels = []
    for d in range(shortest, depth + 1):
        pairs = ((grams >> np.uint64(8 * (depth - d + 1))) << np.uint64(8)) | symbols
        pairs, n = sum_by_key(pairs, counts)
        levels.append(Level(pairs >> np.uint64(8), pairs & np.uint64(255), n))
    for shorter, longer in zip(levels[-2::-1], levels[:0:-1], strict=True):
        shorter.weigh(children_of(longer, shorter))
    return levels


def mixed_bits(grams: np.ndarray, levels: list[Level], depth: int, shortest: int) -> np.ndarray:
    """For each gram its eight bit probabilities, mixed over these levels; NaN: none knows it."""
    nodes, bits = bit_nodes(grams & np.uint64(255))
    chance = np.full(nodes.shape, np.nan)
    for d in range(depth, shortest - 1, -1):
        context = grams >> np.uint64(8 * (depth - d + 1))
        keys = (context << np.uint64(8))[:, None] | nodes.astype(np.uint64)
        chance = levels[d - shortest].refine(keys, bits, chance)
    return chance


def log10_chance(chance: np.ndarray) -> np.ndarray:
    """The logarithm of a byte's probability; a bit that no context knows has one half."""
    return np.log10(np.where(np.isnan(chance), 0.5, chance)).sum(axis=1)

