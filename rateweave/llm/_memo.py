"""What a worker process has learnt, kept from task to task: hashed keys, and lists of numbers in a pool."""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Callable

import numpy as np

from rateweave.llm._common import MULTIPLIERS, _powers, mixed

#: Segments beyond this length are hashed one by one.
LONG = 256


def kept_by_worker(name: str, make: Callable[[], object]) -> object:
    """``make()``, once in a worker process: Spark gives the process many tasks."""
    held = sys.modules.setdefault("_rateweave_worker", types.ModuleType("_rateweave_worker"))
    if name not in held.__dict__:
        setattr(held, name, make())
    return getattr(held, name)


class Index:
    """Row numbers of 64-bit hashes, in order of their coming."""

    def __init__(self):
        # Sorted hashes with their rows: most of them, and the latest.
        self.parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2
        self.size = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        found = np.full(len(hashes), -1, dtype=np.int64)
        for keys, rows in self.parts:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[at] == hashes
                found[hit] = rows[at[hit]]
        return found

    def rows(self, hashes: np.ndarray, learn: Callable[[np.ndarray], None]) -> np.ndarray:
        """The row of each hash; ``learn`` gets the positions of the first of each new one, to append their values."""
        distinct, first, same = np.unique(hashes, return_index=True, return_inverse=True)
        found = self._find(distinct)
        new = found < 0
        if new.any():
            learn(first[new])
            found[new] = np.arange(self.size, self.size + int(new.sum()))
            self.size += int(new.sum())
            self.parts[1] = _merged(self.parts[1], (distinct[new], found[new]))
            if len(self.parts[1][0]) > 1 << 16:
                self.parts = [_merged(*self.parts), (np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        return found[same]


def _merged(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([one[0], two[0]])
    order = np.argsort(keys, kind="stable")
    return keys[order], np.concatenate([one[1], two[1]])[order]


class Grown:
    """An array that is appended to."""

    def __init__(self, kind: type):
        self.data, self.size = np.zeros(1024, dtype=kind), 0

    def append(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.data):
            more = np.zeros(max(2 * len(self.data), self.size + len(values)), dtype=self.data.dtype)
            more[: self.size] = self.data[: self.size]
            self.data = more
        self.data[self.size : self.size + len(values)] = values
        self.size += len(values)


class Lists:
    """Lists of numbers in one pool."""

    def __init__(self, kind: type):
        self.pool, self.begins, self.sizes = Grown(kind), Grown(np.int64), Grown(np.int32)

    def append(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        """More lists: their numbers in a row, and how many each has."""
        self.begins.append(self.pool.size + np.cumsum(sizes) - sizes)
        self.sizes.append(sizes)
        self.pool.append(flat)

    def gathered(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows' lists one after the other, and their sizes."""
        sizes = self.sizes.data[rows].astype(np.int64)
        return self.pool.data[runs(self.begins.data[rows], sizes)], sizes


def runs(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, as many as its size, one run after the other."""
    return np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def flat_lists(lists: list[list[int]], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The lists' numbers in a row, and how many each has."""
    return np.array([v for x in lists for v in x], dtype=kind), np.array([len(x) for x in lists], dtype=np.int64)


def run_hashes(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of numbers, by differences of running sums."""
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * np.uint64(MULTIPLIERS[0]) * up[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * down[begins])


def segment_hashes(text: str, points: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of segments of a text, whose code points are given."""
    hashes = run_hashes(points, begins, ends)
    for k in np.flatnonzero(ends - begins > LONG):
        raw = text[begins[k] : ends[k]].encode("utf-8", "surrogatepass")
        hashes[k] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    return hashes
