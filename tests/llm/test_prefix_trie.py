from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict

import pytest

from rateweave.llm import prefix_trie

CONVERSATIONS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The trie's rows by plain sets of prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said = (role or "", text or "")
            own[c].append(((turn is not None, turn or 0), prefix_trie_id(said), said))
    own = {c: [said for _, _, said in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                kids[turns[: d - 1]].add(turns[:d])
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in kids[p])
    out = []
    for p, own_members in members.items():
        ends = ",".join(map(str, sorted(c for c in own_members if whole[c] == p)))
        parent = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(own_members), len(p), parent, len(own_members), len(kids[p]), leaves[p], saved[p], digest))
    return ordered(out)


def prefix_trie_id(said):
    role, text = said
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[: prefix_trie.ID]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def found(df):
    return ordered(tuple(r[c] for c in COLUMNS) for r in df.collect())


def table(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, CONVERSATIONS)
    return df.withColumns({c: F.lit(7) for c in ("head", "path", "chars", "depth", "n", "key", "t", "parent", "base", "h", "id")})


ODD = [
    (100, 0, "user", "hello"), (100, 1, "bot", "hi"), (100, 2, None, None), (100, None, "system", "first"), (101, 0, "user", "own"),
    (101, 1, "bot", "more"), (102, 0, "user", "hello"), (102, 0, "user", "hello"), (103, 3, "", ""), (205, 0, "user", "no base"), (206, 1, "bot", "x"),
    (None, 0, "user", "lost"), (None, None, None, None), (-5, 0, "user", "hello"), (-100, 0, "user", "é😀"), (-100, 1, "bot", "hi"), (7, 5, "a", "bc"), (8, 5, "ab", "c"),
]


@pytest.mark.parametrize("container", [prefix_trie.CONTAINER, 2, 1])
def test_odd_rows(spark, container):
    """Null turns, roles, texts and ids, repeated turns, missing bases, conversations left without turns, clashing columns."""
    assert found(prefix_trie.trie(table(spark, ODD), container=container)) == brute(ODD)


def test_copies_and_long_shared_beginnings(spark):
    """Many copies of one conversation, and many that part only after sixty turns: few rounds, all nodes."""
    rows = [(1000 + n, t, "u", f"chain {t}") for n in range(40) for t in range(9)]
    rows += [(5000 + n, t, "u", f"deep {t}" if t < 60 else f"end {n % 25} {t}") for n in range(50) for t in range(62)]
    rows += [(9000 + n, t, "u", f"own {n} {t}") for n in range(30) for t in range(8)]
    assert found(prefix_trie.trie(table(spark, rows), container=8)) == brute(rows)


def test_bursting_skips_shared_turns(spark):
    """A container whose sequences share sixty turns is burst in one step."""
    rows = [(100 * n, t, "u", f"deep {t}" if t < 60 else f"end {n}") for n in range(1, 30) for t in range(61)]
    members = prefix_trie.rebuilt(spark.createDataFrame(rows, CONVERSATIONS))
    sequences = prefix_trie.sequences(members)
    from pyspark.sql import functions as F

    active = sequences.select(
        F.lit("root").alias("head"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent"), "path", "chars", "n", "conv_id", "ends"
    )
    small, rounds = prefix_trie._burst(active, 8)
    assert len(rounds) == 1 and rounds[0][0].first()["to"] == 60
    assert sum(s.count() for s in small) == 29


def test_empty_table(spark):
    assert prefix_trie.trie(table(spark, ODD).limit(0)).count() == 0
    lost = spark.createDataFrame([(None, 0, "user", "lost")], CONVERSATIONS)
    assert prefix_trie.trie(lost).count() == 0


def test_ends_of_many_copies_come_in_order(spark):
    """Ids of copies are put together by ranges before one task digests them."""
    from pyspark.sql import functions as F

    members = spark.range(0, 30_000, 1, 6).select((F.pmod(F.col("id") * 7919, F.lit(30_000)) + 1).alias("conv_id"), F.lit("k").alias("key"))
    (row,) = prefix_trie._ends(members).collect()
    assert (row["n"], row["conv_id"]) == (30_000, 1)
    assert row["ends"] == hashlib.sha256(",".join(map(str, range(1, 30_001))).encode()).hexdigest()
