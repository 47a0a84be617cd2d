"""One-permutation fingerprints against exact shingle sets and a brute-force edit."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from rateweave.llm import oph_fingerprint as O


def shingles(text):
    words = text.lower().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """Rows in order (nulls last, then by md5 of the text), each with the next row's text."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    out = []
    for i, (own, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        out.append((own, len(text), hashlib.sha256(new.encode()).hexdigest(), O.pack(O.sketch(text)), O.pack(O.sketch(new))))
    return out


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta épsilon zeta 日本 😀 eta theta".split()) + str(rng.randrange(40)) for _ in range(n))


@pytest.mark.parametrize("n", [1, 2, 37])
def test_rows_against_brute_force(docs_of, n):
    rng = random.Random(n)
    rows = [(i * 7 % 101, words(rng, rng.choice([0, 1, 3, 40, 300]))) for i in range(n)]
    if n > 2:
        rows += [(None, "null id"), (None, None), rows[0], rows[0], (rows[1][0], "same id"), (50_000, "x" * 100_000)]
    got = O.fingerprint_pairs(docs_of(rows)).collect()
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")
    assert sorted((tuple(r[c] for c in names) for r in got), key=repr) == sorted(brute(rows), key=repr)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))


def test_empty_table(docs_of):
    assert O.fingerprint_pairs(docs_of([])).count() == 0


def test_likeness_is_near_the_jaccard_similarity():
    rng, errors = random.Random(5), []
    for _ in range(60):
        a = words(rng, rng.choice([20, 100, 800]))
        parts = a.split()
        keep = rng.randrange(len(parts))
        b = " ".join(parts[:keep] + words(rng, len(parts) - keep).split())
        errors.append(O.likeness(O.sketch(a), O.sketch(b)) - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.12


def test_equal_and_tiny_texts():
    assert O.pack(O.sketch("a b c d e f")) == O.pack(O.sketch("A  b\nc d e F"))
    assert len(O.pack(O.sketch("one"))) == O.BINS * O.BITS // 4
    assert O.likeness(O.sketch("one"), O.sketch("one")) == 1 and O.likeness(O.sketch("one"), O.sketch("two")) < 0.1
    assert O.sketch(" ") is None and O.pack(None) == "" and O.likeness(None, None) == 1 and O.likeness(None, O.sketch("a")) == 0


@pytest.mark.parametrize("own", [5, None])
def test_a_third_of_the_rows_under_one_id(spark, docs_of, own):
    """They are cut into ranges by the hash of their texts; the results stay those of the whole order."""
    from rateweave.llm.oph_fingerprint import _edges

    rng = random.Random(8)
    rows = [(own if n % 3 == 0 else n, f"text {n} " + words(rng, 12)) for n in range(600)]
    docs = docs_of(rows)
    from pyspark.sql import functions as F

    edges = _edges(docs.select(F.col("doc_id").alias("id"), "text"), 8)
    keys = sorted((i is None, i or 0, hashlib.md5(t.encode()).hexdigest()) for i, t in rows)
    held = np.bincount([O.bisect_left(edges, k) for k in keys])
    assert held.max() < 150 and held.sum() == 600
    got = O.fingerprint_pairs(docs).collect()
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")
    assert sorted((tuple(r[c] for c in names) for r in got), key=repr) == sorted(brute(rows), key=repr)


def test_ids_are_whole_numbers(spark):
    rows = [(2, "two"), (1, "one")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = O.fingerprint_pairs(docs)
    assert got.dtypes[0] == ("doc_id", "int") and {r["doc_id"] for r in got.collect()} == {1, 2}
    with pytest.raises(TypeError, match="whole numbers"):
        O.fingerprint_pairs(spark.createDataFrame([("a1", "x")], "doc_id string, text string"))
