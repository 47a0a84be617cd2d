"""The fixity audit against a plain comparison of the records."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rateweave.llm import merkle_fixity as A

SCHEMA = "file string, offset long, record binary"


def brute(ours, theirs):
    """By offset, the records that are not the same on both sides."""
    from collections import Counter

    digest = lambda r: (len(r or b""), hashlib.sha256(r or b"").hexdigest())
    a = Counter((f or "", o or 0, *digest(r)) for f, o, r in ours)
    b = Counter((f or "", o or 0, *digest(r)) for f, o, r in theirs)
    left = {k for k, n in a.items() if b.get(k) != n}
    right = {k for k, n in b.items() if a.get(k) != n}
    return left, right


def replica(rng, n):
    rows = []
    for f in range(5):
        at = 0
        for _ in range(rng.randrange(1, n)):
            record = rng.randbytes(rng.choice([0, 10, 100, 2000]))
            rows.append((f"f{f}", at, record))
            at += len(record) + 4
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_audit(spark, seed):
    rng = random.Random(seed)
    ours = replica(rng, 60)
    theirs = [(f, o, r if rng.random() > 0.03 else r[:-1] + b"?") for f, o, r in ours]
    if seed:
        theirs = [r for r in theirs if not (r[0] == "f1" and r[1] > 3000)] + [("f0", 10**7, b"more"), ("new", 0, b"file")]
        ours = [*ours, (None, None, None), ("f2", 4, b"same"), ("f2", 4, b"same")]
        theirs = [*theirs, (None, None, b"x"), ("f2", 4, b"same")]
    tables = [A.leaves(spark.createDataFrame(x, SCHEMA)) for x in (ours, theirs)]
    got = A.audit(*tables, range_bytes=500, fan_out=3).collect()
    left, right = brute(ours, theirs)
    assert {(r["file"], r["offset"], r["length"], r["hash"]) for r in got if r["hash"]} == left
    assert {(r["file"], r["offset"], r["other_length"], r["other_hash"]) for r in got if r["other_hash"]} == right
    for r in got:
        assert r["status"] == ("extra" if r["hash"] is None else "missing" if r["other_hash"] is None else "corrupt")


def test_equal_and_empty_replicas(spark):
    rows = A.leaves(spark.createDataFrame(replica(random.Random(9), 20), SCHEMA))
    none = A.leaves(spark.createDataFrame([], SCHEMA))
    assert A.audit(rows, rows, 300, 2).count() == 0 and A.audit(none, none).count() == 0
    assert A.audit(rows, none, 300, 2).count() == rows.count()
    assert {r["status"] for r in A.audit(none, rows, 300, 2).collect()} == {"extra"}


def test_descent_follows_differing_branches_only(spark):
    rows = [("f", i * 100, b"r%d" % i) for i in range(64)]
    bad = [(f, o, b"bad" if o == 4200 else r) for f, o, r in rows]
    one, two = (A.tree(A.leaves(spark.createDataFrame(x, SCHEMA)), 4, 100, 4) for x in (rows, bad))
    for level in range(4):
        differing = [tuple(r) for r in A._differing(one[level], two[level]).collect()]
        assert differing == [("f", 42 // 4**level)]
    assert one[3].count() == 1


def test_archive_offsets(spark):
    pages = [(i, f"http://x/{i}", "h" * (i % 7) if i % 5 else None) for i in range(25)]
    pages += [(None, None, None), (None, "u", "é"), (3, "twice", "x"), (3, "twice", "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("hash", F.lit("clash"))
    ours, theirs = A.archived(df, F.col("page_id") == 7, F.col("page_id") == 9, per_file=10)
    rows = ours.orderBy("file", "offset").collect()
    assert len(rows) == len(pages) and theirs.count() == len(pages) - 1
    ends = {}
    for r in rows:  # records lie end to end
        assert r["offset"] == ends.get(r["file"], 0)
        ends[r["file"]] = r["offset"] + r["length"]
    assert len({r["file"] for r in rows}) >= 4  # ids 0 to 9 are eleven records: their file is split
    got = {(r["status"], r["length"]) for r in A.audit(ours.drop("record_id"), theirs).collect()}
    assert sorted(s for s, _ in got) == ["corrupt", "missing"]
    whole = {r["record_id"]: r["hash"] for r in rows}
    record = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/6\r\nWARC-Record-ID: <urn:page:6>\r\nContent-Length: 6\r\n\r\nhhhhhh\r\n\r\n"
    assert whole[6] == hashlib.sha256(record.encode()).hexdigest()


def test_large_page_ids_have_files_of_their_own(spark):
    ids = [5_000, 100_000_000, 1_000_000_000, 1_000_001_000, 1_000_009_999, 10**12]
    pages = spark.createDataFrame([(i, f"http://x/{i}", "h") for i in ids], "page_id long, url string, html string")
    ours, theirs = A.archived(pages, F.col("page_id") == 1_000_001_000)
    rows = ours.orderBy("record_id").collect()
    assert [r["file"] for r in rows] == [
        "pages-000005.warc", "pages-100000.warc", "pages-1000000.warc", "pages-1000001.warc", "pages-1000009.warc", "pages-1000000000.warc",
    ]
    assert {r["offset"] for r in rows} == {0}
    (found,) = A.audit(ours.drop("record_id"), theirs).collect()
    assert (found["file"], found["offset"], found["status"]) == ("pages-1000001.warc", 0, "corrupt")


def test_many_records_at_one_place(spark, monkeypatch):
    """Distinct records without an offset are hashed in parts; the one that differs is found."""
    monkeypatch.setattr(A, "LEAF_RECORDS", 64)
    rows = spark.range(3000).select(
        F.lit("f").alias("file"), F.when(F.col("id") > 2900, F.col("id") * 1000).alias("offset"), F.concat(F.lit("record "), F.col("id").cast("string")).alias("record")
    )
    bad = rows.withColumn("record", F.when(F.col("record") == "record 77", "other").otherwise(F.col("record")))
    ours, theirs = A.leaves(rows), A.leaves(bad)
    found = A.audit(ours, theirs, range_bytes=10_000).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {(r["hash"], r["other_hash"]) for r in found} == {(digest("record 77"), digest("other"))}
    assert A.audit(ours, ours, range_bytes=10_000).count() == 0


def test_a_page_repeated_a_million_times(spark):
    """Its copies lie end to end, and no row holds more than some of them."""
    pages = spark.range(1_000_000).select(F.lit(5).cast("bigint").alias("page_id"), F.lit("u").alias("url"), F.lit("h").alias("html"))
    ours, theirs = A.archived(pages)
    size = ours.first()["length"]
    got = ours.agg(F.count("*"), F.countDistinct("offset"), F.min("offset"), F.max("offset"), F.countDistinct("file")).first()
    assert tuple(got) == (1_000_000, 1_000_000, 0, 999_999 * size, 1)
    assert theirs.count() == 1_000_000


def test_a_very_long_record(spark):
    rows = spark.createDataFrame([("f", 0, b"x" * 20_000_000), ("f", 20_000_000, b"y")], SCHEMA)
    bad = spark.createDataFrame([("f", 0, b"x" * 19_999_999 + b"z"), ("f", 20_000_000, b"y")], SCHEMA)
    (found,) = A.audit(A.leaves(rows), A.leaves(bad)).collect()
    assert (found["offset"], found["length"], found["status"]) == (0, 20_000_000, "corrupt")
