"""Containment search against exact shingle sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rateweave.llm import containment_search as S

VOCABULARY = [f"w{i}" for i in range(400)] + ["Été", "don't", "x_y", "日本"]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "", ",", ".\n", " —"]) for _ in range(n))


def brute(docs, items):
    sets = {(i, t): S.shingle_set(t or "") for i, t in items}
    out = []
    for d, text in docs:
        held = S.shingle_set(text or "")
        for (i, _), own in sets.items():
            if own and len(own & held) >= 0.8 * len(own):
                out.append((d, i, len(own & held), len(own), len(own & held) / len(own)))
    return sorted(out, key=repr)


def planted(seed):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.choice([1, 3, 4, 5, 6, 7, 9, 12, 25, 60, 130, 700]))) for i in range(60)]
    items += [(100, None), (101, ""), (102, "?!"), items[0], (103, items[1][1]), (None, items[7][1])]
    docs = [(900, None), (901, ""), (None, items[8][1])]
    for d in range(120):
        words = prose(rng, rng.choice([0, 2, 30, 400, 3000])).split(" ")
        for _ in range(rng.randrange(3)):
            leak = items[rng.randrange(60)][1].split(" ")
            kind = rng.randrange(4)
            if kind == 1:  # most of it
                leak = leak[: max(1, int(len(leak) * rng.uniform(0.7, 1)))]
            elif kind == 2:  # other case and signs
                leak = [w.upper() + rng.choice(["", "***", "!!"]) for w in leak]
            at = rng.randrange(len(words) + 1)
            if kind == 3:  # in two pieces far apart
                half = len(leak) // 2
                words = leak[:half] + words + leak[half:]
            else:
                words = words[:at] + leak + words[at:]
        docs.append((d, " ".join(words)))
    return docs + docs[-3:], items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_exact_sets(spark, docs_of, seed):
    docs, items = planted(seed)
    table = spark.createDataFrame(items, "item_id long, text string")
    for block_chars in (S.BLOCK_CHARS, 3000):
        got = S.contained_items(docs_of(docs), table, block_chars=block_chars)
        assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_filter_keeps_clean_rows_whole(spark, docs_of):
    docs, items = planted(4)
    table = spark.createDataFrame(items, "item_id long, text string")
    dirty = {r[0] for r in brute([(n, t) for n, (_, t) in enumerate(docs)], items)}
    for block_chars in (S.BLOCK_CHARS, 3000):
        kept = S.without_contaminated(docs_of(docs), table, block_chars=block_chars)
        want = [t for n, (_, t) in enumerate(docs) if n not in dirty]
        assert sorted((r["text"] for r in kept.collect()), key=repr) == sorted(want, key=repr)
        assert kept.columns == docs_of([]).columns


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert S.contained_items(docs_of([(1, "a b c d e f")]), none).count() == 0
    assert S.contained_items(docs_of([]), some).count() == 0
    assert S.without_contaminated(docs_of([(1, "a b c d e f")]), none).count() == 1


def test_batches_of_one_text_and_of_many(monkeypatch):
    docs, items = planted(5)
    block = S.build_block([(i, t) for i, t in items])
    texts = [t or "" for _, t in docs]
    whole = sorted(S.search(block, texts))
    monkeypatch.setattr(S, "BATCH_SHINGLES", 1)
    single = sorted((p[0][0], *r[1:]) for p in S._batched(texts) for r in S.search(block, [p[0][1]]))
    assert single == whole


@pytest.mark.parametrize("kind", ["int", "string", "bigint", "decimal(9,2)"])
def test_ids_of_any_type(spark, kind):
    items = spark.createDataFrame([(7, "a b c d e f"), (8, "p q r s t u")], "item_id int, text string").withColumn("item_id", F.col("item_id").cast(kind))
    docs = spark.createDataFrame([(1, "x a b c d e f y"), (2, "z")], "doc_id int, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    (row,) = S.contained_items(docs, items).collect()
    assert (int(float(row["doc_id"])), int(float(row["item_id"]))) == (1, 7)
    assert S.contained_items(docs, items).dtypes[:2] == [("doc_id", kind), ("item_id", kind)]


def test_a_very_long_text(spark):
    """An item in the middle of a text of a million words, and one scattered over it."""
    words = [f"w{i % 99_991}" for i in range(1_000_000)]
    whole = "here stands the item that nobody else has in such an order of its words".split()
    halves = [f"q{i}" for i in range(60)]
    words[500_000:500_000] = whole
    words[100:100], words[900_000:900_000] = halves[:32], halves[28:]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(whole)), (2, " ".join(halves)), (3, "not " + " ".join(whole[::-1]))], "item_id long, text string")
    assert sorted(r["item_id"] for r in S.contained_items(docs, items).collect()) == [1, 2]


def test_recall_of_scattered_items():
    """Items in two pieces far apart: the share that the minima find is stated in the module."""
    rng = random.Random(11)
    items = [(n, " ".join(f"i{n}x{i}" for i in range(rng.choice([20, 45, 90])))) for n in range(300)]
    texts = []
    for _, text in items:
        words = text.split()
        half = len(words) // 2
        texts.append(" ".join(words[: half + 4] + [f"f{rng.randrange(10**6)}" for _ in range(400)] + words[half:]))
    found = {(d, n) for d, n, *_ in S.search(S.build_block(items), texts)}
    assert len(found & {(n, n) for n in range(300)}) >= 0.98 * 300
