"""The Bloom filter cascade against plain sets, and the URL rules."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rateweave.llm import url_cascade as U


@pytest.mark.parametrize("listed_share, max_bytes", [(0.1, 1 << 20), (0.6, 1 << 20), (0.1, 64), (0.0, 1 << 20), (1.0, 1 << 20)])
def test_cascade_is_exact(spark, listed_share, max_bytes):
    rng = random.Random(2)
    keys = [f"h{i}.example" for i in range(3000)]
    listed = {k for k in keys if rng.random() < listed_share}
    universe = spark.createDataFrame([(k,) for k in keys + keys[:50]] + [(None,)], "key string")
    blocklist = spark.createDataFrame([(k,) for k in listed] + [("elsewhere.example",), (None,)], "key string")
    parts, cascades = U.build(U.hashed_keys(universe, False), U.hashed_keys(blocklist, False), max_bytes)
    assert (parts > 1) == (max_bytes == 64 and listed_share > 0)
    cascades, found, names = list(cascades), [], universe.where("key is not null").distinct()
    for n, levels in enumerate(cascades):
        shared = spark.sparkContext.broadcast(levels)
        found += [r["key"] for r in names.where(U.is_listed(shared, n, parts, F.col("key"), False)).collect()]
    assert sorted(found) == sorted(listed)
    if listed_share == 0.1 and max_bytes > 64:
        assert len(cascades[0]) >= 3  # levels for both kinds of mistakes
        bits = sum(size for size, _, _ in cascades[0])
        assert bits < 20 * len(listed)


URLS = {
    "https://WWW.Example.ORG/es/x?q#f": ("www.example.org", "/es/x", "example.org/es/", "block"),
    "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
    "http://a.org/x": ("a.org", "/x", "org/", "allow"),
    "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "http://spam-farm.example.com/fr/1": ("spam-farm.example.com", "/fr/1", "com/fr/", "allow"),
    "http://spam-farm.example.com/en/1": ("spam-farm.example.com", "/en/1", None, "block"),
    "http://deep.spam-farm.example.com": ("deep.spam-farm.example.com", "", None, "block"),
    "http://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
    "http://x.com?u=http://y.org/": ("x.com", "", None, "allow"),
    "no scheme/x": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "://": ("", "", None, "allow"),
    "http://org": ("org", "", None, "allow"),
    "http://Ünï.org/": ("Ünï.org", "/", "org/", "allow"),
    "http://a\nb.com/fr/\n?x": ("a\nb.com", "/fr/\n", "com/fr/", "allow"),
    "http://my-spam-farm.example.com/": ("my-spam-farm.example.com", "/", None, "allow"),
    "x" * 50_000 + "://ads-track.example.net/p": ("ads-track.example.net", "/p", None, "block"),
}


def test_judged(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://adult-x.example.net/"), (0, "http://x.net"), (0, "http://x.net")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("key", F.lit(1)).withColumn("host", F.lit("old"))
    got = U.judged(pages, U.default_list(spark)).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got if r["url"] in URLS}
    for i, u in enumerate(URLS):
        if i:
            assert by_id[i] == URLS[u], u
    assert [r["verdict"] for r in got if r["page_id"] is None] == ["block"]
    empty = spark.createDataFrame([], "page_id long, url string")
    assert U.judged(empty, U.default_list(spark)).count() == 0
    assert {r["verdict"] for r in U.judged(pages, U.default_list(spark).limit(0), rules=[]).collect()} == {"allow"}


@pytest.mark.parametrize("max_bytes", [U.MAX_BYTES, 8])
def test_long_hosts_and_long_lists(spark, max_bytes):
    """A host of 100,000 labels, and a list cut into many cascades, of which one is broadcast at a time."""
    names = [f"bad{i}.example.net" for i in range(40)]
    listed = spark.createDataFrame([(n,) for n in names] + [("deep.example",), (None,)], "key string")
    long = ".".join(f"l{i}" for i in range(100_000))
    urls = [f"http://{long}.deep.example/x", f"http://{long}.other.example/x", None, "", "http://bad7.example.net", "http://sub.bad39.example.net/y"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls * 2)], "page_id long, url string").withColumn("own_host", F.lit(3))
    got = U.judged(pages, listed, rules=[], max_bytes=max_bytes).orderBy("page_id").collect()
    assert [r["verdict"] for r in got] == ["block", "allow", "allow", "allow", "block", "block"] * 2
    assert got[0]["host"] == f"{long}.deep.example" and {r["own_host"] for r in got} == {3}


def test_one_cascade_is_held_at_a_time(spark, monkeypatch):
    sizes, whole = [], spark.sparkContext.broadcast
    names = spark.createDataFrame([(f"n{i}.example",) for i in range(3000)], "key string")
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sizes.append(value) or whole(value))
    pages = names.select(F.concat(F.lit("http://"), "key").alias("url"))
    assert U.judged(pages, names, rules=[], max_bytes=400).where("verdict = 'block'").count() == 3000
    levels = [v for v in sizes if isinstance(v, list)]
    assert len(levels) > 5 and all(sum(size for size, _, _ in v) / 8 < 2 * 400 for v in levels)


def test_keys_of_a_name():
    one, two = U.key_hashes("a.b.example"), U.key_hashes("b.example")
    assert len(one) == 3 * 16 and one[:32] == two and U.key_hashes("ab.example")[16:] != two[16:]
    assert len(U.key_hashes("")) == 16
