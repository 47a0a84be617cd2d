"""URL filters: exact blocklist membership by a cascade of Bloom filters.

The first level encodes the listed keys, the second those unlisted keys of the
corpus's complete key universe that the first takes for listed, the third the
listed keys that the second takes for those, and so on until nobody is
mistaken.  Every key of the universe is then answered exactly, from a few bits
a listed key that every task holds, and judging pages needs no join.

A key is a host name or any of its parent domains, so listing a domain covers
its subdomains.  Keys travel as 128-bit hashes, made label by label from the
right, so a host gives all its keys in time linear in its length.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.llm._common import free_name, mixed, stored

#: False-positive rate of the first level and of the later ones.
FIRST_RATE, LATER_RATE = 1 / 64, 1 / 16
#: Bytes of a cascade's first level, about four fifths of it; longer lists are cut by key hash into as many cascades
#: as that makes, of which the driver and every task hold one at a time.
MAX_BYTES = 32 << 20
_KEY_BYTES = 16

# The rules of the query, as (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# Names whose domains the query's blocklist holds, under these suffixes.
LISTED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
LISTED_SUFFIXES = ["example.com", "example.net", "example.org"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule (written host and path) and its verdict, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def key_hashes(name: str) -> bytes:
    """The 128-bit hashes of a name's keys, packed: its last label, its last two, ..., the name."""
    out, own = [], b""
    for label in reversed(name.split(".")):
        own = hashlib.blake2b(own + label.encode("utf-8", "surrogatepass"), digest_size=_KEY_BYTES).digest()
        out.append(own)
    return b"".join(out)


def hashed_keys(names: DataFrame, parents: bool) -> DataFrame:
    """``(h1, h2)`` of the keys of ``names(key)``: of each name and, with ``parents``, its parent domains; null names have none."""

    def run(batches):
        for batch in batches:
            packed = [key_hashes(k) for k in batch.column(0).to_pylist() if k is not None]
            halves = np.frombuffer(b"".join(p if parents else p[-_KEY_BYTES:] for p in packed), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["h1", "h2"])

    return names.select("key").mapInArrow(run, "h1 bigint, h2 bigint")


def _places(h1: np.ndarray, h2: np.ndarray, level: int, size: int, probes: int) -> np.ndarray:
    """The bits of each key in a level's filter, one row for each probe."""
    turn = mixed(np.array([level + 1], dtype=np.uint64))
    a, b = mixed(h1.view(np.uint64) ^ turn), mixed(h2.view(np.uint64) ^ turn) | np.uint64(1)
    return np.stack([(a + np.uint64(i) * b) % np.uint64(size) for i in range(probes)])


def _holds(levels: list[tuple[int, int, np.ndarray]], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """How many levels each key passes before one that it fails."""
    passed, alive = np.zeros(len(h1), dtype=np.int64), np.arange(len(h1))
    for level, (size, probes, words) in enumerate(levels):
        at = _places(h1[alive], h2[alive], level, size, probes)
        alive = alive[((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)]
        passed[alive] = level + 1
    return passed


def _bloom(keys: DataFrame, count: int, rate: float, level: int) -> tuple[int, int, np.ndarray]:
    """(bits, probes, 64-bit words) of a filter of ``keys``, made in all tasks and united by a shuffle."""
    size = max(64, math.ceil(-count * math.log(rate) / math.log(2) ** 2))
    probes = max(1, round(-math.log2(rate)))

    def run(batches):
        for batch in batches:
            h1, h2 = (np.array(batch.column(c), dtype=np.int64) for c in ("h1", "h2"))
            at = np.unique(_places(h1, h2, level, size, probes))
            words, first = np.unique(at >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_pydict({"word": words.astype(np.int64), "bits": bits.view(np.int64)})

    united = keys.select("h1", "h2").mapInArrow(run, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = united.toArrow()  # at most ``size`` bits
    words = np.zeros(-(-size // 64), dtype=np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return size, probes, words


def _passing(keys: DataFrame, levels: list[tuple[int, int, np.ndarray]]) -> DataFrame:
    """The keys that the last level holds."""
    shared, level = keys.sparkSession.sparkContext.broadcast(levels[-1]), len(levels) - 1

    def run(batches):
        size, probes, words = shared.value
        for batch in batches:
            h1, h2 = (np.array(batch.column(c), dtype=np.int64) for c in ("h1", "h2"))
            at = _places(h1, h2, level, size, probes)
            inside = ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(h1[inside]), pa.array(h2[inside])], ["h1", "h2"])

    return keys.mapInArrow(run, "h1 bigint, h2 bigint")


def build(universe: DataFrame, listed: DataFrame, max_bytes: int = MAX_BYTES) -> tuple[int, Iterator[list[tuple[int, int, np.ndarray]]]]:
    """The number of cascades over the keys ``universe(h1, h2)``, of which ``listed(h1, h2)`` are listed, and the cascades one by one.

    One cascade for each part of the key hashes (part = h1 modulo their
    number), each of at most about ``max_bytes`` in its first level.  Repeated
    keys count once.  A cascade without listed keys is empty.
    """
    listed = listed.distinct().withColumn("listed", F.lit(True))
    marked = universe.distinct().join(listed, ["h1", "h2"], "left")
    table = stored(marked.select("h1", "h2", F.coalesce("listed", F.lit(False)).alias("listed")), "url-universe")
    total = table.where("listed").count()
    parts = max(1, math.ceil(total * -math.log(FIRST_RATE) / math.log(2) ** 2 / 8 / max_bytes))

    def cascades():
        for part in range(parts):
            own = table.where(F.pmod("h1", F.lit(parts)) == part)
            # In turn: the keys that the next level encodes, and those that it may take for them.
            inside, outside = own.where("listed").select("h1", "h2"), own.where(~F.col("listed")).select("h1", "h2")
            levels: list[tuple[int, int, np.ndarray]] = []
            while count := inside.count():
                levels.append(_bloom(inside, count, LATER_RATE if levels else FIRST_RATE, len(levels)))
                inside, outside = stored(_passing(outside, levels), "url-mistaken"), inside
            yield levels

    return parts, cascades()


def is_listed(shared, part: int, parts: int, name: Column, parents: bool = True) -> Column:
    """True where a name or, with ``parents``, a parent domain, all of the universe, is listed in cascade ``part`` of ``parts``;
    ``shared`` is that cascade, broadcast."""

    @F.pandas_udf("boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for names in batches:
            packed = [key_hashes(n) if parents else key_hashes(n)[-_KEY_BYTES:] for n in names]
            sizes = np.array([len(p) // _KEY_BYTES for p in packed], dtype=np.int64)
            halves = np.frombuffer(b"".join(packed), dtype="<i8").reshape(-1, 2)
            h1, h2 = np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])
            own, inside = h1 % parts == part, np.zeros(len(h1), dtype=bool)
            # Failing an odd level means unlisted, an even one listed; the last one passed was right.
            inside[own] = _holds(shared.value, h1[own], h2[own]) % 2 == 1
            rows = np.repeat(np.arange(len(packed)), sizes)
            yield pd.Series(np.bincount(rows[inside], minlength=len(packed)) > 0)

    return judge(name)


def judged(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    url_col: str = "url",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``: the longest
    fitting rule's, else ``block`` if the host or a parent domain is listed,
    else ``allow``.  A null url, or one without ``://``, has an empty host and
    path; columns with these names are replaced; repeated rows are judged each
    time, an empty table gives an empty one.  Urls and hosts of any length are
    judged whole, in time linear in their length.

    A blocklist of up to ``max_bytes`` is one cascade, by which pages are
    judged where they lie.  For a longer one the distinct hosts are judged by
    one cascade after the other, each let go before the next, and the blocked
    hosts are joined to the pages.
    """
    spark = pages.sparkSession
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    hosts = stored(pages.select(host.alias("key")).distinct(), "url-hosts")
    parts, cascades = build(hashed_keys(hosts, True), hashed_keys(listed, False), max_bytes)
    own_host, own_path, blocked = (free_name(pages, c) for c in ("own_host", "own_path", "own_blocked"))
    rows = pages.withColumn(own_host, host).withColumn(own_path, path)
    if parts == 1:
        rows = rows.withColumn(blocked, is_listed(spark.sparkContext.broadcast(next(cascades)), 0, 1, F.col(own_host)))
    else:
        found = []
        for part, levels in enumerate(cascades):
            shared = spark.sparkContext.broadcast(levels)
            found.append(stored(hosts.where(is_listed(shared, part, parts, F.col("key"))), "url-blocked"))
            shared.unpersist()
        every = reduce(DataFrame.unionByName, found).distinct().select(F.col("key").alias(own_host), F.lit(True).alias(blocked))
        rows = rows.join(every, own_host, "left")
    rule, verdict = rule_of(F.col(own_host), F.col(own_path), rules)
    by_list = F.when(F.col(blocked), "block").otherwise("allow")
    out = {"host": F.col(own_host), "path": F.col(own_path), "rule": rule, "verdict": F.coalesce(verdict, by_list)}
    return rows.select(*[c for c in pages.columns if c not in out], *[v.alias(k) for k, v in out.items()])


def default_list(spark) -> DataFrame:
    names = spark.createDataFrame([(n,) for n in LISTED_NAMES], "name string")
    suffixes = F.explode(F.array(*[F.lit(s) for s in LISTED_SUFFIXES])).alias("suffix")
    return names.select("name", suffixes).select(F.concat_ws(".", "name", "suffix").alias("key"))
