"""Benchmark decontamination: size-partitioned MinHash containment search.

Finds short test items inside long documents.  MinHash estimates Jaccard
similarity, which a long document makes vanish, so both sides are partitioned
by size: items by their number of shingles into classes up to 2, 4, 8, ...,
and for each class a document is read as windows of one and a half times the
class's bound, moved by half of it.  Every run of shingles as long as an item
lies inside a window.  An item that is held in one piece has a similarity of
at least a quarter with that window, so some of ``FUNCTIONS`` minima agree
with all but a millionth of certainty.  One whose shingles lie scattered is
less alike to each window: with its halves far apart about 0.11 to each, of
which all minima miss one in three hundred, and two windows may find it.
Candidates are verified by exact containment of their shingles over the whole
document.

The items are the query set: they are searched in blocks of bounded size, each
broadcast, against all documents, which are neither shuffled nor paired with
each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rateweave.llm._common import WORDS, mixed, shingle_hashes, token_hashes

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
FUNCTIONS = 48
#: Characters of item text in a block; a benchmark of any size is searched in as many blocks as that makes.
BLOCK_CHARS = 8_000_000
#: Shingles of documents whose minima are taken at once.
BATCH_SHINGLES = 400_000
_WORD = re.compile(r"\w+")
_SEEDS = mixed(np.arange(1, FUNCTIONS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_set(text: str) -> set[str]:
    """Distinct shingles of a text: runs of five lower-cased words (fewer words: the whole sequence; none: none)."""
    words = _WORD.findall(text.lower())
    size = min(SHINGLE_WORDS, len(words))
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def _hashed(text: str) -> np.ndarray:
    return shingle_hashes(token_hashes(text.lower(), WORDS), SHINGLE_WORDS)


@dataclass
class Block:
    """Items ready for the search: their texts' distinct shingle hashes, and by
    class the minima of each hash function with the items that have them."""

    ids: list
    texts: list[str]
    hashes: list[np.ndarray]
    classes: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def build_block(items: list[tuple[object, str]]) -> Block:
    """Items without a word are left out: nothing can contain them."""
    hashed = [(i, t, np.unique(_hashed(t or ""))) for i, t in items]
    hashed = [x for x in hashed if len(x[2])]
    by_class: dict[int, list[int]] = {}
    for n, (_, _, h) in enumerate(hashed):
        by_class.setdefault(max(1, int(np.ceil(np.log2(len(h))))), []).append(n)
    classes = {}
    for c, members in by_class.items():
        classes[c] = []
        for seed in _SEEDS:
            least = np.array([(hashed[n][2] * seed).min() for n in members], dtype=np.uint64)
            order = np.argsort(least)
            seen = np.zeros(1 << 16, dtype=bool)
            seen[least >> np.uint64(48)] = True
            classes[c].append((seen, least[order], np.array(members)[order]))
    return Block([x[0] for x in hashed], [x[1] for x in hashed], [x[2] for x in hashed], classes)


def _halves(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``size`` begin if every document's values are cut into
    them, and whose they are; ``counts``: each document's values."""
    runs = -(-counts // size)
    owner = np.repeat(np.arange(len(counts)), runs)
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
    first = np.concatenate([[0], np.cumsum(runs)[:-1]])
    return begins[owner] + (np.arange(len(owner)) - first[owner]) * size, owner


def _candidates(block: Block, hashes: list[np.ndarray]) -> set[tuple[int, int]]:
    """(document, item) positions that share a minimum of a window and an item of its class."""
    counts = np.array([len(h) for h in hashes])
    if not counts.sum() or not block.classes:
        return set()
    values, found = np.concatenate(hashes), set()
    levels = []  # by class, ascending: cuts of the level below it into half windows
    size, held = 1, counts
    for c in sorted(block.classes):
        half = 1 << (c - 1)
        begins, owner = _halves(held, half // size)
        levels.append((c, begins, owner))
        held, size = np.bincount(owner, minlength=len(counts)), half
    for f, seed in enumerate(_SEEDS):
        least = values * seed
        for c, begins, owner in levels:
            least = np.minimum.reduceat(least, begins)
            window = least.copy()
            for step in (1, 2):
                same = owner[step:] == owner[:-step]
                window[:-step][same] = np.minimum(window[:-step][same], least[step:][same])
            seen, minima, items = block.classes[c][f]
            hits = np.flatnonzero(seen[window >> np.uint64(48)])
            left = np.searchsorted(minima, window[hits], "left")
            right = np.searchsorted(minima, window[hits], "right")
            for hit, a, b in zip(hits[right > left], left[right > left], right[right > left]):
                found.update((int(owner[hit]), int(n)) for n in items[a:b])
    return found


def search(block: Block, texts: list[str]) -> list[tuple[int, int, int, int]]:
    """(position of the text, position of the item, shared shingles, the item's shingles)
    for the items of which a text holds at least ``CONTAINMENT``, compared as strings."""
    hashes = [_hashed(t) for t in texts]
    found = []
    own: dict[int, set[str]] = {}
    last, whole = -1, set()
    for d, n in sorted(_candidates(block, hashes)):
        if np.isin(block.hashes[n], hashes[d]).mean() < CONTAINMENT:
            continue
        if d != last:
            last, whole = d, shingle_set(texts[d])
        item = own.setdefault(n, shingle_set(block.texts[n]))
        shared = len(item & whole)
        if shared >= CONTAINMENT * len(item):
            found.append((d, n, shared, len(item)))
    return found


def blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int = BLOCK_CHARS):
    """The items in blocks of about ``block_chars`` characters, one at a time on the driver."""
    rows = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.distinct()
    count = -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars)
    for k in range(count):
        yield build_block([tuple(r) for r in rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k).collect()])


def _batched(texts):
    """Lists of (position, text) of about ``BATCH_SHINGLES`` words each."""
    part, size = [], 0
    for at, text in enumerate(texts):
        part.append((at, text or ""))
        size += len(part[-1][1]) // 6 + 1
        if size >= BATCH_SHINGLES:
            yield part
            part, size = [], 0
    if part:
        yield part


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``(id_col, item_col, shared, item_shingles, containment)`` for every document row and item
    of whose distinct shingles the whole document holds at least 0.8.

    Null texts hold nothing; null ids, of any type, are reported as null; a
    repeated document row is reported each time, an item row repeated with the
    same id and text once; empty tables give no rows.  Texts of any length are
    read whole, a task holding one at a time.  Each block of items is one
    broadcast and one pass over the documents; a benchmark of
    ``block_chars`` is one block.
    """
    spark = docs.sparkSession
    schema = (
        f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, "
        f"`{item_col}` {items.schema[item_col].dataType.simpleString()}, "
        "shared bigint, item_shingles bigint, containment double"
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    item_type = to_arrow_type(items.schema[item_col].dataType)
    parts = []
    for block in blocks(items, item_col, item_text_col, block_chars):
        shared_block = spark.sparkContext.broadcast(tuple(vars(block).values()))

        def run(batches, shared_block=shared_block):
            own = Block(*shared_block.value)
            for batch in batches:
                ids = batch.column("id").to_pylist()
                for part in _batched(batch.column("text").to_pylist()):
                    found = search(own, [t for _, t in part])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[part[d][0]] for d, *_ in found], batch.column("id").type),
                            pa.array([own.ids[n] for _, n, *_ in found], item_type),
                            pa.array([s for *_, s, _ in found], pa.int64()),
                            pa.array([q for *_, q in found], pa.int64()),
                            pa.array([s / q for *_, s, q in found], pa.float64()),
                        ],
                        names=[id_col, item_col, "shared", "item_shingles", "containment"],
                    )

        parts.append(rows.mapInArrow(run, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def without_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs`` that hold no item: one filter per block of items, no shuffle."""
    out = docs
    for block in blocks(items, item_col, item_text_col, block_chars):
        out = out.where(_holds_none(docs, block)(F.col(text_col)))
    return out


def _holds_none(docs: DataFrame, block: Block):
    shared_block = docs.sparkSession.sparkContext.broadcast(tuple(vars(block).values()))

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Block(*shared_block.value)
        for texts in batches:
            keep = np.ones(len(texts), dtype=bool)
            for part in _batched(texts):
                for d, *_ in search(own, [t for _, t in part]):
                    keep[part[d][0]] = False
            yield pd.Series(keep)

    return clean
