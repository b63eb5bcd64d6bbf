"""Texts as arrays of code points, in blocks of bounded size, with hashed words and n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

BLOCK = 1 << 18  # code points worked on at once
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xFF51AFD7ED558CCD)
WHITE = re.compile("[\x00-\x20]")
TOP = 0x110000


@dataclass
class Block:
    """Pieces of texts between single line feeds. ``owner`` names the text a piece belongs to."""

    codes: np.ndarray
    starts: np.ndarray
    owner: np.ndarray

    def piece_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1

    def owner_of(self, at: np.ndarray) -> np.ndarray:
        return self.owner[self.piece_of(at)]


def pieces(text: str, size: int) -> Iterator[str]:
    """Cuts of about ``size`` characters, always behind a space or another control character.

    No word is cut: a stretch without any goes on to its end, so a piece is at most ``size`` characters longer
    than the longest such stretch. Where a text is cut depends on the text alone.
    """
    at = 0
    while len(text) - at > size:
        end = at + size
        space = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
        if space <= at:
            found = WHITE.search(text, end)
            if not found:
                break
            space = found.start()
        yield text[at : space + 1]
        at = space + 1
    yield text[at:]


def blocks(texts: list, size: int = BLOCK) -> Iterator[Block]:
    """All texts (null: empty), packed into blocks of about ``size`` characters."""
    parts, owner, total = [], [], 0

    def packed() -> Block:
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        codes = np.frombuffer(("\n" + "\n".join(parts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
        return Block(codes, np.concatenate([[1], 1 + np.cumsum(lengths)[:-1]]), np.array(owner, np.int64))

    for i, text in enumerate(texts):
        for part in pieces(text or "", size):
            parts.append(part)
            owner.append(i)
            total += len(part) + 1
            if total >= size:
                yield packed()
                parts, owner, total = [], [], 0
    if parts:
        yield packed()


def carried(owner: np.ndarray, *columns: np.ndarray, before: list | None, back: int) -> tuple[list, int]:
    """(owner, *columns) of the words of a block behind the last ``back`` words of the blocks before, and how many these are.

    Patterns of words then run on over the border of two blocks of one text.
    """
    joined = [np.concatenate([b[max(0, len(b) - back) :], c]) for b, c in zip(before, (owner, *columns))] if before else [owner, *columns]
    return joined, len(joined[0]) - len(owner)


@lru_cache(1)
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(TOP)), bool, TOP)


@lru_cache(1)
def word_characters() -> np.ndarray:
    """For each code point, whether it is a letter or a digit."""
    return np.fromiter((chr(c).isalnum() for c in range(TOP)), bool, TOP)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true; the mask is false at both ends."""
    edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    return edges[0::2], edges[1::2]


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= MIX
    return h ^ (h >> np.uint64(29))


class Hasher:
    """64-bit hashes of any stretches of one code point array, from one running sum."""

    def __init__(self, codes: np.ndarray):
        size = 1 << max(10, int(len(codes) + 1).bit_length())
        up, self.down = _powers(size)
        terms = (codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def stretches(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, n: int) -> np.ndarray:
        """The hash of every stretch of n code points, by its start."""
        spans = self.sums[n:] - self.sums[:-n]
        return mix(spans * self.down[: len(spans)])


def combine(*parts: np.ndarray) -> np.ndarray:
    """A hash of several hashes in order; the last part may be a salt."""
    h = parts[0]
    for p in parts[1:]:
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + p)
    return h
