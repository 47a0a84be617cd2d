"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import itertools
import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rateweave.llm import simhash_ball as S


def brute_fingerprint(text, size=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= distance:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB é\t\n\x0b 　ß", max_size=60), st.integers(1, 4))
def test_fingerprint(text, size):
    assert S.fingerprint(text, size) == brute_fingerprint(text, size)


def test_long_text_is_hashed_in_chunks(monkeypatch):
    text = " ".join(random.Random(1).choices(["alpha", "beta", "gamma", "delta"], k=500))
    monkeypatch.setattr(S, "CHUNK", 7)
    assert S.fingerprint(text) == brute_fingerprint(text)


def test_spark_xxhash64_is_the_same_hash(spark):
    got = spark.createDataFrame([("a b é",)], "t string").select(F.xxhash64("t")).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("a b é".encode(), 42)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_join_all_close_fingerprints(spark, distance):
    rng = random.Random(distance)
    fps = [rng.getrandbits(64) for _ in range(12)]
    for _ in range(60):  # chains and stars of near fingerprints
        fps.append(fps[rng.randrange(len(fps))] ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.5) * (1 << rng.randrange(64)))
    fps = sorted(set(fps), key=lambda v: v - (v >> 63 << 64))
    signed = [v - (v >> 63 << 64) for v in fps]
    edges = S.links(spark.createDataFrame([(v,) for v in signed], "fp long"), distance)
    for a, b in edges.collect():
        assert a < b and bin((a ^ b) % (1 << 64)).count("1") <= distance
    roots = {r["fp"]: r["root"] for r in S.components(edges).collect()}
    want = brute_components(fps, distance)
    assert [roots.get(v, v) for v in signed] == [signed[r] for r in want]


ROWS = [
    (5, "the quick brown fox jumps over the lazy dog again and again"),
    (3, "The QUICK brown fox jumps over the lazy dog again and again"),
    (3, "The QUICK brown fox jumps over the lazy dog again and again"),
    (9, None),
    (8, ""),
    (7, " \n\t"),
    (None, "the quick brown fox jumps over the lazy dog again and again"),
    (None, "only nulls have this text"),
    (None, "only nulls have this text"),
    (11, "one"),
    (12, "two"),
]


def test_components(docs_of):
    got = S.simhash_components(docs_of(ROWS)).select("doc_id", "fingerprint", "component_id").collect()
    fps = [brute_fingerprint(t) for _, t in ROWS]
    roots = brute_components(fps, 2)
    least = {}
    for (i, _), r in zip(ROWS, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = [(i, f"{fp:016x}", least.get(r)) for (i, _), fp, r in zip(ROWS, fps, roots)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_dedup_keeps_one_row_of_each_component(docs_of):
    docs = docs_of(ROWS)
    kept = S.simhash_dedup(docs)
    assert kept.schema == docs.schema or kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    want = [(3, ROWS[1][1]), (7, " \n\t"), (None, "only nulls have this text"), (11, "one"), (12, "two")]
    assert got == sorted(want, key=repr)


def test_long_chain_of_components(spark):
    nodes = list(range(0, 400))
    edges = spark.createDataFrame([(a, a + 1) for a in nodes], "a long, b long")
    assert {r["root"] for r in S.components(edges).collect()} == {0}


def test_empty_table(docs_of):
    assert S.simhash_components(docs_of([])).count() == 0
    assert S.simhash_dedup(docs_of([])).count() == 0
