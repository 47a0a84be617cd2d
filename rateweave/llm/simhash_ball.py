"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``2 * half`` bits of each other have a value in common
among all variants within ``half`` bits of each.  So every distinct
fingerprint emits its whole ball of radius ``half``, the variants are
shuffled, and fingerprints that meet on a variant are linked.  Copies share a
fingerprint and count once, and a variant's members all lie in the variant's
own ball, so no group is larger than that ball (65 members for 64 bits and
half the radius 1), whatever the data.

Components are found by rounds of alternating star contraction over the
links; each round is a job over a written table, and only a count reaches the
driver.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateweave.llm._common import free_name, stored

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
#: Shingles hashed at once, which bounds a task's memory on very long texts.
CHUNK = 200_000
# Bits set in each byte value, most significant first.
_BIT_TABLE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text, as an unsigned number.

    A-Z are lower-cased, words are runs without ASCII white space, shingles
    are ``size`` words joined by a space, repeats included (fewer words: the
    whole sequence).  A bit is 1 if set in over half the shingles' XXH64.  A
    null text, or one without words, has fingerprint 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    n, ones, digest = len(words) - size + 1, np.zeros(BITS, dtype=np.int64), xxhash.xxh64_digest
    for start in range(0, n, CHUNK):
        part = words[start : start + CHUNK + size - 1]
        runs = zip(*(part[j : len(part) - size + 1 + j] for j in range(size)))
        lanes = np.frombuffer(b"".join([digest(b" ".join(run), SEED) for run in runs]), dtype=np.uint8).reshape(-1, 8)
        for lane in range(8):
            ones[8 * lane : 8 * lane + 8] += np.bincount(lanes[:, lane], minlength=256) @ _BIT_TABLE
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS):
    """One row per row of ``docs``: id, ``text_hash`` (tells apart rows that share an id) and ``fp`` (signed)."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(text, size) for text in batch.column(2).to_pylist()]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signed)], ["id", "text_hash", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, text_hash bigint, fp bigint")


def _masks(bits: range) -> list[int]:
    """All 64-bit numbers with as many bits set as ``bits`` names, as signed numbers."""
    found = [sum(1 << b for b in at) for k in bits for at in combinations(range(BITS), k)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def links(distinct: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links ``(a, b)``, a < b, that join all distinct fingerprints ``fp`` within ``max_distance`` bits.

    Fingerprints emit the variants within ``ceil(max_distance / 2)`` bits; the
    inner ones are within ``floor(max_distance / 2)``.  Close fingerprints
    share a variant that is an inner one of at least one of them, so linking
    all that meet on a variant to the smallest of its inner ones joins every
    close pair, directly or through it.  Each link is verified.
    """
    # A row here becomes a whole ball: spread the rows, however few bytes they are.
    distinct = distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    inner, outer = max_distance // 2, (max_distance + 1) // 2
    near = F.array(*[F.lit(m).cast("bigint") for m in _masks(range(inner + 1))])
    balls = distinct.select("fp", F.explode(near).alias("mask"), F.lit(True).alias("inner"))
    if outer > inner:
        far = F.array(*[F.lit(m).cast("bigint") for m in _masks(range(outer, outer + 1))])
        balls = balls.union(distinct.select("fp", F.explode(far).alias("mask"), F.lit(False).alias("inner")))
    balls = balls.select("fp", "inner", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    centre = F.min(F.when(F.col("inner"), F.col("fp"))).over(Window.partitionBy("variant"))
    met = balls.select("fp", centre.alias("centre")).where(F.col("fp") != F.col("centre"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) <= max_distance
    return met.where(close).select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(fp, root)`` for every end of a link: the smallest fingerprint reachable.

    Alternating large-star and small-star rounds.  A node with many neighbours
    only ever has minima taken over it, which combine before the shuffle.
    """
    edges = stored(edges, "simhash-links")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))
    previous = None
    while True:
        # Large star: neighbours above a node are linked to its smallest neighbour.
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(
            small.union(least.select("u", F.col("m").alias("v"))).distinct().select(F.col("v").alias("a"), F.col("u").alias("b")),
            "simhash-stars",
        )
        # Stars are final when every node has one parent and no parent has a parent.
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == previous:
            return edges.select(F.col("b").alias("fp"), F.col("a").alias("root"))
        previous = now


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``text_hash``, ``fingerprint``
    (16 hex digits), ``component_id``: the smallest id among the rows whose
    fingerprints are linked to it directly or through others.

    Null ids take part and never name a component (a component of null ids
    only has a null id); repeated rows stay; an empty table gives none.
    """
    rows = stored(fingerprints(docs, id_col, text_col, size), "simhash-fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least_id"))
    roots = components(links(nodes.select("fp"), max_distance))
    placed = nodes.join(roots, "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    names = placed.join(named, "root").select("fp", "root", "component_id")
    return rows.join(names, "fp").select(
        F.col("id").alias(id_col),
        "text_hash",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("root").alias("component_key"),
    )


def simhash_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (nulls
    last), then of the smallest text hash; rows equal in both are one row.
    """
    member = simhash_components(docs, id_col, text_col, size, max_distance)
    alike = member.groupBy("component_key", F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"))
    order = F.struct(F.col("_id").isNull().alias("last"), "_id", "_hash", "n")
    stays = alike.agg(F.count("*").alias("n")).groupBy("component_key").agg(F.min(order).alias("k"))
    stays = stored(stays.select("k._id", "k._hash", "k.n"), "simhash-stays")
    hashed = free_name(docs, "text_hash")
    rows = docs.withColumn(hashed, F.xxhash64(text_col))

    def chosen(keys: DataFrame) -> DataFrame:
        return rows.join(keys, rows[id_col].eqNullSafe(keys["_id"]) & (rows[hashed] == keys["_hash"]), "left_semi")

    # Repeated rows are few, and only they are grouped; as a table of their own their true size decides the join.
    several = stored(stays.where("n > 1"), "simhash-repeated")
    repeated = chosen(several).groupBy(F.col(id_col).alias("_id"), F.col(hashed).alias("_hash"))
    plain = [f.name for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    return chosen(stays.where("n = 1")).drop(hashed).union(repeated.agg(first.alias("_row")).select("_row.*"))
