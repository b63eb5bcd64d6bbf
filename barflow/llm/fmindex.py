"""An FM-index over the words of one shard: suffix array, wavelet matrix, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 8  # every SAMPLE-th text position is stored


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order; the last symbol is the only 0.

    Three symbols make the first sort key; then the compared length doubles, and only suffixes that still
    share their rank with others are sorted again.
    """
    n, bits = len(symbols), max(1, int(symbols.max()).bit_length())
    depth = max(1, min(3, 62 // bits))
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(depth, np.int64)])
    key = padded[:n].copy()
    for i in range(1, depth):
        key <<= bits
        key |= padded[i : n + i]
    order = np.argsort(key)
    key = key[order]
    slots, rank = np.arange(n), np.empty(n, np.int64)
    members = order
    while True:
        fresh = np.empty(len(key), bool)
        fresh[0], fresh[1:] = True, key[1:] != key[:-1]
        rank[members] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))]
        alone = fresh & np.append(fresh[1:], True)
        slots, members = slots[~alone], members[~alone]
        if not len(slots):
            return order
        key = rank[members] << 32 | rank[np.minimum(members + depth, n - 1)]
        inner = np.argsort(key)
        key, members = key[inner], members[inner]
        order[slots] = members
        depth *= 2


class Wavelet:
    """Ranks in a symbol sequence: one bit level per binary digit, zeros before ones on the next level."""

    def __init__(self, sequence: np.ndarray):
        self.bits = max(1, int(sequence.max()).bit_length())
        self.zeros, current = [], sequence.astype(np.int32)
        for level in reversed(range(self.bits)):
            zero = (current >> level & 1) == 0
            before = np.zeros(len(current) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.zeros.append(before)
            current = np.concatenate([current[zero], current[~zero]])

    def ranks(self, symbol: np.ndarray, *positions: np.ndarray) -> list[np.ndarray]:
        """How often each symbol occurs before the position beside it, for each array of positions."""
        begin, at = np.zeros(len(symbol), np.int64), [p.astype(np.int64) for p in positions]
        for level, before in zip(reversed(range(self.bits)), self.zeros):
            one = (symbol >> level & 1).astype(bool)
            all_zeros = before[-1]
            step = lambda p: np.where(one, all_zeros + p - before[p], before[p])
            begin, at = step(begin), [step(p) for p in at]
        return [p - begin for p in at]

    def read(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at the position, how often it occurs before it)."""
        symbol, begin, at = (np.zeros(len(position), np.int64) for _ in range(3))
        at += position
        for before in self.zeros:
            zero = before[at + 1] > before[at]
            all_zeros = before[-1]
            begin = np.where(zero, before[begin], all_zeros + begin - before[begin])
            at = np.where(zero, before[at], all_zeros + at - before[at])
            symbol = symbol << 1 | ~zero
        return symbol, at - begin


class FMIndex:
    """Finds phrases in a sequence of words, given as numbers from 2 on; 1 separates documents."""

    def __init__(self, words: np.ndarray):
        text = np.append(words, 0)
        order = suffix_array(text)
        self.size = len(text)
        self.wavelet = Wavelet(text[order - 1])
        counts = np.bincount(text, minlength=int(text.max()) + 2)
        self.smaller = np.concatenate([[0], np.cumsum(counts)])  # symbols below each symbol
        kept = order % SAMPLE == 0
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.positions = order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase: one phrase a line, of one length."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        alive = np.arange(len(phrases))
        for column in reversed(range(phrases.shape[1])):
            symbol = phrases[alive, column]
            a, b = self.wavelet.ranks(symbol, low[alive], high[alive])
            low[alive], high[alive] = self.smaller[symbol] + a, self.smaller[symbol] + b
            alive = alive[b > a]
            if not len(alive):
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to a stored position and count the steps."""
        found, steps = np.full(len(rows), -1, np.int64), 0
        open_rows, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(open_rows):
            known = self.kept_before[at + 1] > self.kept_before[at]
            found[open_rows[known]] = self.positions[self.kept_before[at[known]]] + steps
            open_rows, at = open_rows[~known], at[~known]
            if len(at):
                symbol, before = self.wavelet.read(at)
                at = self.smaller[symbol] + before
            steps += 1
        return found
