"""Document fingerprints by one-permutation MinHash.

Every shingle is hashed once; the top bits of the hash choose a bin and the
rest compete for the bin's minimum.  Empty bins copy the minimum of a bin that
a fixed random sequence reaches first (optimal densification), and only the
low ``BITS`` bits of each bin are kept, packed.  Two texts' likeness is the
share of equal bins, less what equal low bits give by chance.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm._common import MULTIPLIERS, UNSPACED, Scratch, mixed, shingle_hashes, token_hashes

SHINGLE_WORDS = 5
BINS = 512
BITS = 4
_BIN_BITS = BINS.bit_length() - 1
#: Steps of the probing sequence of each bin; in the first bins of it nearly all empty bins end.
PROBES = 4096
_tables = Scratch()


def _probe_table() -> np.ndarray:
    """For each bin, the bins that it asks in turn: the same for all texts."""
    if "probes" not in _tables:
        seeds = np.arange(BINS * PROBES, dtype=np.uint64).reshape(BINS, PROBES) + np.uint64(1)
        _tables["probes"] = (mixed(mixed(seeds)) >> np.uint64(64 - _BIN_BITS)).astype(np.int16)
    return _tables["probes"]


def sketch(text: str) -> np.ndarray | None:
    """The low bits of every bin of a text's shingles (five lower-cased words;
    fewer words: the whole sequence); None for a text without words."""
    h = shingle_hashes(token_hashes(text.lower(), UNSPACED), SHINGLE_WORDS)
    if len(h) == 0:
        return None
    h = np.sort(h)
    bins = (h >> np.uint64(64 - _BIN_BITS)).astype(np.int64)
    first = np.concatenate([[True], bins[1:] != bins[:-1]])
    filled = np.zeros(BINS, dtype=bool)
    filled[bins[first]] = True
    values = np.zeros(BINS, dtype=np.uint64)
    values[bins[first]] = h[first]
    empty, start = np.flatnonzero(~filled), 0
    for stop in (8, 64, 512, PROBES):
        if len(empty) == 0:
            break
        asked = _probe_table()[empty, start:stop]
        hits = filled[asked]
        found = hits.any(axis=1)
        donors = asked[found, hits[found].argmax(axis=1)]
        values[empty[found]] = values[donors]
        empty, start = empty[~found], stop
    values[empty] = values[bins[0]]  # reached no filled bin: the first one
    # Each bin draws its low bits anew, so texts of few shingles, whose bins hold the same minimum, agree by chance no more often.
    own = values + np.arange(BINS, dtype=np.uint64) * np.uint64(MULTIPLIERS[0])
    return (mixed(own) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def pack(low: np.ndarray | None) -> str:
    """Hex text of the packed low bits; the empty string for a text without words."""
    if low is None:
        return ""
    bits = np.unpackbits(low[:, None], axis=1)[:, 8 - BITS :]
    return np.packbits(bits.ravel()).tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated Jaccard similarity of two texts' shingles, 0 to 1; two texts
    without words are alike, one of them is unlike any other text."""
    if a is None or b is None:
        return float(a is None and b is None)
    chance = 0.5**BITS
    return float(min(1.0, max(0.0, (np.mean(a == b) - chance) / (1.0 - chance))))


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _edges(rows: DataFrame, ranges: int) -> list[tuple[bool, int, str]]:
    """The last keys ``(no id, id, hash)`` of all ranges but the last: about equal ones by id, and by hash
    inside an id that more than a ``ranges``-th of the rows share (there are fewer than ``ranges`` of these)."""
    after = "~"  # behind every hash
    edges = [(False, (1 << 63) - 1, after)]  # rows without an id have ranges of their own
    marks = [(i + 1) / ranges for i in range(ranges - 1)]
    if marks:
        cuts = rows.agg(F.percentile_approx("id", marks, 100 * ranges).alias("c")).first()["c"] or []
        edges += [(False, c, after) for c in set(cuts)]
    total = rows.count()
    hot = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * ranges > total).collect()
    for own_id, n in hot:
        parts = -(-n * ranges // total)
        bounds = [f"{(i + 1) * (1 << 32) // parts:08x}" for i in range(parts - 1)]
        edges += [(own_id is None, own_id or 0, bound) for bound in bounds]
        if own_id is not None and own_id > -(1 << 63):
            edges.append((False, own_id - 1, after))
    return sorted(set(edges))


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row its text's fingerprint, that of its edited text, and their likeness.

    "Next" is the next row by ascending id (nulls last; equal ids by a hash of
    the text, equal rows in turn), and the first row for the last.  The order
    is made by ranges: each row goes to its range, the first row of a range
    also to the range before it (that of the first range to the last), and
    every range is then read once, in order, two rows at a time.  An id that
    more rows share than a range should hold, or null, is cut into ranges by
    the hash; only rows that are equal in id and text stay together.  A null
    text counts as empty; an empty table gives no rows; ids must be whole
    numbers.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    if id_type not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col} is {id_type}; the next document needs whole numbers as ids")
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    edges = _edges(rows, ranges)
    last = len(edges)

    def part_of(own_id: int | None, tie: str) -> int:
        return bisect_left(edges, (own_id is None, own_id or 0, tie))

    def first_keys(batches):
        least: dict[int, tuple] = {}
        for batch in batches:
            for own_id, tie in zip(batch.column("id").to_pylist(), batch.column("tie").to_pylist()):
                at, key = part_of(own_id, tie), (own_id is None, own_id or 0, tie)
                least[at] = min(key, least.get(at, key))
        keys = [(at, none, None if none else own_id, tie) for at, (none, own_id, tie) in least.items()]
        columns = list(zip(*keys)) or [()] * 4
        types = [pa.int32(), pa.bool_(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "none", "id", "tie"])

    keys = rows.select("id", F.md5(F.col("text").cast("binary")).alias("tie"))
    firsts = keys.mapInArrow(first_keys, "part int, none boolean, id bigint, tie string")
    firsts = firsts.groupBy("part").agg(F.min(F.struct("none", "id", "tie")).alias("first"))
    # One row for each range: its first key, and the range before it.
    starts = sorted(((r["part"], r["first"]["id"], r["first"]["tie"]) for r in firsts.collect()), key=lambda s: s[0])
    before = {(own_id, tie): starts[i - 1][0] for i, (_, own_id, tie) in enumerate(starts)}

    def sketched(batches):
        guests: dict[int, tuple] = {}
        for batch in batches:
            out = {k: [] for k in passed.names}
            for own_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                tie, low = hashlib.md5(raw).hexdigest(), sketch(text)
                row = (own_id, tie, len(text), zlib.compress(raw, 1), None if low is None else low.tobytes())
                for k, v in zip(out, (part_of(own_id, tie), 0, *row)):
                    out[k].append(v)
                if (own_id, tie) in before:  # equal rows that begin a range: any of them is the guest
                    guests[before[own_id, tie]] = row
            yield pa.RecordBatch.from_pydict(out, schema=passed)
        rows = [(at, 1, *row) for at, row in guests.items()]
        yield pa.RecordBatch.from_pydict({k: list(v) for k, v in zip(passed.names, zip(*rows))} if rows else {k: [] for k in passed.names}, schema=passed)

    passed = pa.schema(
        [("part", pa.int32()), ("guest", pa.int32()), ("id", pa.int64()), ("tie", pa.string()), ("n_chars", pa.int64()),
         ("packed", pa.binary()), ("low", pa.binary())]
    )
    moved = rows.mapInArrow(sketched, "part int, guest int, id bigint, tie string, n_chars bigint, packed binary, low binary")
    nulls = F.col("id").isNull()
    ordered = moved.repartitionById(last + 1, F.col("part")).sortWithinPartitions("part", "guest", nulls, "id", "tie")

    def paired(batches):
        names = ("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        waiting, out = None, {k: [] for k in names}
        for batch in batches:
            for row in batch.to_pylist():
                row["text"] = zlib.decompress(row["packed"]).decode("utf-8", "surrogatepass")
                row["low"] = None if row["low"] is None else np.frombuffer(row["low"], dtype=np.uint8)
                if waiting is not None and waiting["part"] == row["part"]:
                    text = edited(waiting["text"], row["text"])
                    low = sketch(text)
                    values = (
                        waiting["id"], waiting["n_chars"], hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
                        pack(waiting["low"]), pack(low), likeness(waiting["low"], low), likeness(waiting["low"], row["low"]),
                    )
                    for k, v in zip(names, values):
                        out[k].append(v)
                # The first guest ends a range; a repeated first id sends more, which nobody waits for.
                waiting = None if row["guest"] else row
                if len(out["id"]) >= 2000:
                    yield pa.RecordBatch.from_pydict(out, schema=done)
                    out = {k: [] for k in names}
        yield pa.RecordBatch.from_pydict(out, schema=done)

    done = pa.schema(
        [("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )
    found = ordered.mapInArrow(
        paired,
        "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
    return found.withColumn("id", F.col("id").cast(id_type)).withColumnRenamed("id", id_col)
