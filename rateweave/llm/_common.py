"""Small helpers shared by the operators: stored tables, held-out splits, hashed words."""

from __future__ import annotations

import sys

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.session import fresh_path

# Odd 64-bit multipliers for combining and mixing hashes.
MULTIPLIERS = [
    0x9E3779B97F4A7C15,
    0xC2B2AE3D27D4EB4F,
    0x165667B19E3779F9,
    0xD6E8FEB86659FD93,
    0xFF51AFD7ED558CCD,
    0xC4CEB9FE1A85EC53,
    0x94D049BB133111EB,
    0xBF58476D1CE4E5B9,
]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back.

    Cuts the lineage with files that every executor sees, so a lost executor
    costs no recomputation, and gives later plans the table's true size.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(MULTIPLIERS[4])
    h = (h ^ (h >> np.uint64(33))) * np.uint64(MULTIPLIERS[5])
    return h ^ (h >> np.uint64(33))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` consecutive words, repeats included; of
    the whole sequence if it is shorter; none for no words."""
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    total = np.full(n - size + 1, size, dtype=np.uint64)
    for j in range(size):
        total += (words[j : n - size + 1 + j] ^ np.uint64(j + 1)) * np.uint64(MULTIPLIERS[j % 8])
        total ^= total >> np.uint64(29)
        total *= np.uint64(MULTIPLIERS[(j + 3) % 8])
    return mixed(total)


# What a token is made of: runs of word characters; those and runs of signs; runs without white space.
WORDS, WORDS_AND_SIGNS, UNSPACED = "words", "words and signs", "unspaced"
#: Code points hashed at once, which bounds a task's memory on very long texts.
SLICE = 1 << 20


class Scratch(dict):
    """Tables that a process makes once; a function that uses them travels without."""

    def __reduce__(self):
        return Scratch, ()


_tables = Scratch()


def _kinds(tokens: str) -> np.ndarray:
    """For each code point: 0 between tokens, else the kind of token it can be part of."""
    if "kinds" not in _tables:
        every = [chr(c) for c in range(sys.maxunicode + 1)]
        word = np.array([c.isalnum() or c == "_" for c in every])
        space = np.array([c.isspace() for c in every])
        _tables["kinds"] = {
            WORDS: word.astype(np.uint8),
            WORDS_AND_SIGNS: np.where(word, 1, np.where(space, 0, 2)).astype(np.uint8),
            UNSPACED: (~space).astype(np.uint8),
        }
    return _tables["kinds"][tokens]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number modulo 2**64, and of its inverse."""
    if len(_tables.get("powers", ((),))[0]) < n:
        size = max(n, SLICE + 1)
        pair = []
        for base in (MULTIPLIERS[6], pow(MULTIPLIERS[6], -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        _tables["powers"] = tuple(pair)
    up, down = _tables["powers"]
    return up, down


def token_hashes(text: str, tokens: str) -> np.ndarray:
    """64-bit hashes of a text's tokens in order, without a Python step per token.

    A token's hash is a polynomial of its code points, taken as a difference of
    running sums.  Long texts are handled in slices that end between tokens.
    """
    kinds, found, start = _kinds(tokens), [], 0
    while start < len(text):
        points = np.frombuffer(text[start : start + SLICE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = kinds[points]
        if start + SLICE < len(text):  # end after the last point between tokens, or take in the long token whole
            gaps = np.flatnonzero(kind == 0)
            if len(gaps):
                points, kind = points[: gaps[-1] + 1], kind[: gaps[-1] + 1]
            else:
                end = start + SLICE
                while end < len(text) and kinds[ord(text[end])]:
                    end += 1
                points = np.frombuffer(text[start:end].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                kind = kinds[points]
        change = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
        at = change[kind[change] > 0]
        if len(at):
            ends = np.append(change[1:], len(kind))[kind[change] > 0]
            up, down = _powers(len(points))
            sums = np.zeros(len(points) + 1, dtype=np.uint64)
            np.cumsum((points + np.uint64(1)) * up[: len(points)], out=sums[1:])
            found.append((sums[ends] - sums[at]) * down[at])
        start += len(points)
    return mixed(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)
