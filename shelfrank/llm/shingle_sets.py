"""Sets of word shingles as sorted arrays of 64-bit hashes, and the PartEnum signatures of such sets."""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import xxhash

SHINGLE = 5
CACHED_WORDS = 200_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = values ^ np.uint64(seed * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * FACTOR
    return x ^ (x >> np.uint64(32))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingles:
    """Texts to sets; words are what stands between ASCII white space, with A-Z in lower case."""

    def __init__(self, size: int = SHINGLE) -> None:
        self.size, self.words = size, _Hashes()

    def set_of(self, text: str | None) -> np.ndarray:
        """Sorted hashes of the different shingles; a text of fewer words is one shingle, an empty one none."""
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        width = min(self.size, len(words))
        out = np.full(len(words) - width + 1, np.uint64(width))
        for i in range(width):
            out = out * FACTOR + hashes[i : len(words) - width + 1 + i]
        return np.unique(mixed(out))


def fingerprint(members: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set alone; the empty set has 0, 0."""
    return tuple(int(mixed(members, seed).sum(dtype=np.uint64).astype(np.int64)) for seed in (1, 2))


@dataclass(frozen=True)
class Band:
    """Pairs whose smaller set has ``low`` < size <= ``high``; the larger one has at most ``widest``."""

    number: int
    low: int
    high: int
    widest: int
    parts: int


class PartEnum:
    """Signatures such that sets of a Jaccard similarity of at least ``percent`` / 100 share one, at least.

    Two such sets of sizes a and b differ in at most (a + b) (100 - p) / (100 + p) members.  A band fixes the largest
    such number k for its pairs.  The domain of hashes is cut into first-level parts, so many that one of them holds at most k2 of the
    differences, and each of these into n2 second-level parts; of these at least n2 - k2 are then equal.  Every subset of n2 - k2
    second-level parts gives a signature, from the band, the subset and the members in it.

    Subsets without a member say nothing and give none.  With d differences, at most d // (k2 + 1) first-level parts hold more than
    k2 of them; so if a set fills k2 + 1 second-level parts in more first-level parts than that, one signature with members
    is shared.  (With subsets of one part, filling more than d parts is enough.)  ``exposed`` tells whether a set falls short of this.
    Any members may be left out of the domain beforehand: the differences only become fewer.  Sets of up to ``tiny`` members give one
    signature for each member.
    """

    def __init__(self, percent: int = 75, n2: int = 2, k2: int = 1, tiny: int = 24, growth: float = 1.75, spare: float = 1.15) -> None:
        self.percent, self.n2, self.k2, self.tiny, self.growth, self.spare = percent, n2, k2, tiny, growth, spare
        self.subsets = list(combinations(range(n2), n2 - k2))
        self.bands = [Band(0, 0, tiny, self.widest(tiny), 0)]
        self.ends = [tiny]

    def widest(self, size: int) -> int:
        return size * 100 // self.percent

    def differences(self, a: int, b: int) -> int:
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def _bands_to(self, size: int) -> None:
        while self.ends[-1] < size:
            last = self.bands[-1]
            high = max(int(last.high * self.growth), last.widest)
            k = self.differences(high, self.widest(high))
            first = int(self.spare * (k + 1) / (self.k2 + 1)) + 1
            self.bands.append(Band(last.number + 1, last.high, high, self.widest(high), first))
            self.ends.append(high)

    def bands_of(self, size: int) -> list[Band]:
        """The band of a set, and the one below if the set can be the larger one of its pairs."""
        self._bands_to(size)
        own = bisect_left(self.ends, size)
        below = [self.bands[own - 1]] if own and size <= self.bands[own - 1].widest else []
        return [self.bands[own], *below]

    def signatures(self, members: np.ndarray, size: int | None = None, space: int = 0) -> tuple[np.ndarray, bool]:
        """Signatures of the ``members`` kept of a set of ``size`` members, and whether the set is exposed in one of its bands.

        Signatures of another ``space`` never agree.
        """
        size = len(members) if size is None else size
        found = [self._in_band(members, size, band) for band in self.bands_of(size)]
        signatures = np.concatenate([f[0] for f in found])
        return mixed(signatures, 16 + space), any(f[1] for f in found)

    def _in_band(self, members: np.ndarray, size: int, band: Band) -> tuple[np.ndarray, bool]:
        partner = min(self.widest(size), band.widest) if size <= band.high else band.high
        differences = self.differences(size, partner)
        if not band.parts:
            return mixed(members, 8 * band.number + 3), len(members) <= differences
        if not len(members):
            return members, True
        # Members are sorted, so equal ranges of the domain are runs.
        cells = np.uint64(band.parts * self.n2)
        cell = (((members >> np.uint64(32)) * cells) >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        sums, filled = np.add.reduceat(mixed(members, 5), starts), cell[starts]
        if self.n2 - self.k2 == 1:
            keys, values, exposed = filled, sums, len(filled) <= differences
        else:
            table = np.zeros((band.parts, self.n2), dtype=np.uint64)
            there = np.zeros((band.parts, self.n2), dtype=bool)
            table.ravel()[filled], there.ravel()[filled] = sums, True
            values = np.stack([self._joined(table[:, list(c)]) for c in self.subsets], axis=1)
            keep = np.stack([there[:, list(c)].any(axis=1) for c in self.subsets], axis=1).ravel()
            keys, values = np.flatnonzero(keep), values.ravel()[keep]
            exposed = int((there.sum(axis=1) > self.k2).sum()) <= differences // (self.k2 + 1)
        return mixed(values ^ mixed(keys.astype(np.uint64), 8 * band.number + 1), 2), exposed

    @staticmethod
    def _joined(parts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(parts), dtype=np.uint64)
        for i in range(parts.shape[1]):
            out = mixed(out ^ parts[:, i], 7 + i)
        return out
