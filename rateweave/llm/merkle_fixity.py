"""Merkle fixity audit of WARC replicas.

Records are hashed once, and every file's hashes are gathered into a tree over
ordered ranges of its offsets: a leaf covers the records that begin in one
range of bytes, an inner node a fixed number of neighbouring nodes, the root
the file.  Replicas are compared root by root, and only the children of nodes
that differ are looked at, down to the records of the ranges that differ.
Everything after the hashing pass moves hashes, never records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateweave.llm._common import stored

#: Bytes of a file that a leaf covers, and children of an inner node.
RANGE_BYTES = 1 << 16
FAN_OUT = 16
#: Records of a file that ``archived`` makes, about.
RECORDS_PER_FILE = 1000
#: Distinct records that are hashed together at most; a leaf with more is hashed in parts.
LEAF_RECORDS = 4096
#: Copies of a record that are placed by one row.
COPIES = 10_000
CORRUPT, MISSING, EXTRA = "corrupt", "missing", "extra"


def leaves(records: DataFrame) -> DataFrame:
    """``(file, offset, length, hash, copies)`` from ``(file, offset, record)``: one row for each distinct record.

    A record listed twice counts twice in its leaf; a null record is hashed as empty.
    """
    raw = F.coalesce(F.col("record").cast("binary"), F.lit("").cast("binary"))
    hashed = records.select("file", "offset", F.octet_length(raw).cast("bigint").alias("length"), F.sha2(raw, 256).alias("hash"))
    return hashed.groupBy("file", "offset", "length", "hash").agg(F.count("*").alias("copies"))


def _node(order: list[str], parts: list[str]) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(*order, F.concat_ws(":", *parts).alias("said"))))
    return F.sha2(F.array_join(F.transform(rows, lambda r: r["said"]), "\n"), 256).alias("hash")


def tree(leaf_rows: DataFrame, levels: int, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """The ``(file, node, hash)`` table of each level, leaves first, each written once.

    A leaf hashes the offsets, lengths, hashes and copies of its records in
    order.  A range in which many records begin (all those without an offset,
    or empty ones) is hashed in parts by record hash, as many as make
    ``LEAF_RECORDS`` in each; so no group is larger than that, or the fan-out.
    """
    node = F.floor(F.coalesce(F.col("offset"), F.lit(0)) / range_bytes).alias("node")
    placed = leaf_rows.select("*", node)
    sizes = placed.groupBy("file", "node").agg(F.count("*").alias("n")).where(F.col("n") > LEAF_RECORDS)
    large = stored(sizes.select("file", "node", F.ceil(F.col("n") * 2 / LEAF_RECORDS).alias("parts")), "merkle-large")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("offset", "hash"), F.col("parts")))
    # In order of offset, length and hash, which tell the records of a part apart.
    lowest = placed.join(large, ["file", "node"], "left").groupBy("file", "node", part.alias("part"))
    parts = lowest.agg(_node(["offset", "length", "hash"], ["offset", "length", "hash", "copies"]), F.max("parts").alias("parts"))
    parts = stored(parts, "merkle-parts")
    whole = parts.where(F.col("parts").isNull()).select("file", "node", "hash")
    united = parts.where(F.col("parts").isNotNull()).groupBy("file", "node").agg(_node(["part"], ["part", "hash"]))
    found = [stored(whole.unionByName(united), "merkle-0")]
    for level in range(1, levels):
        above = found[-1].select("file", F.floor(F.col("node") / fan_out).alias("node"), F.col("node").alias("child"), "hash")
        found.append(stored(above.groupBy("file", "node").agg(_node(["child"], ["child", "hash"])), f"merkle-{level}"))
    return found


def _differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """``(file, node)`` of nodes that differ or that one side lacks."""
    other = theirs.withColumnRenamed("hash", "other")
    return ours.join(other, ["file", "node"], "full").where(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node")


def audit(ours: DataFrame, theirs: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """Records of the replica ``theirs`` that differ from ``ours``, both given as ``leaves``.

    ``(file, offset, status, length, hash, other_length, other_hash)``;
    ``status`` is ``corrupt`` (another content at the offset), ``missing`` or
    ``extra``.  Equal replicas, also empty ones, give no rows; a null file is a
    file of its own, a null offset counts as 0.  Records of any length are
    hashed once, before this.
    """
    named = F.coalesce(F.col("file"), F.lit("")).alias("file")
    placed = F.coalesce(F.col("offset"), F.lit(0).cast("bigint")).alias("offset")
    sides = [stored(x.select(named, placed, "length", "hash", "copies"), "merkle-leaves") for x in (ours, theirs)]
    end = max(side.agg(F.max("offset")).first()[0] or 0 for side in sides)
    levels, nodes = 1, end // range_bytes
    while nodes:
        nodes //= fan_out
        levels += 1
    trees = [tree(side, levels, range_bytes, fan_out) for side in sides]
    differing = _differing(trees[0][-1], trees[1][-1])
    for level in range(levels - 2, -1, -1):
        parents = stored(differing, "merkle-differing").withColumnRenamed("node", "parent")
        below = [
            t[level].withColumn("parent", F.floor(F.col("node") / fan_out)).join(parents, ["file", "parent"], "left_semi").drop("parent")
            for t in trees
        ]
        differing = _differing(*below)
    ranges = stored(differing, "merkle-differing")
    node = F.floor(F.col("offset") / range_bytes).alias("node")
    one, two = (side.select("*", node).join(ranges, ["file", "node"], "left_semi") for side in sides)
    at = ["file", "offset"]
    # Records that agree in everything cancel; what is left at an offset is reported.
    same = ["file", "offset", "length", "hash", "copies"]
    left = one.join(two, same, "left_anti").select(*at, "length", "hash")
    right = two.join(one, same, "left_anti").select(*at, F.col("length").alias("other_length"), F.col("hash").alias("other_hash"))
    status = F.when(F.col("hash").isNull(), EXTRA).when(F.col("other_hash").isNull(), MISSING).otherwise(CORRUPT)
    return left.join(right, at, "full").select(*at, status.alias("status"), "length", "hash", "other_length", "other_hash")


def warc_record(url: Column, record_id: Column, payload: Column, version: Column | None = None) -> Column:
    """The text of one WARC response record; nulls are written as nothing."""
    payload = F.coalesce(payload, F.lit(""))
    head = [
        F.lit("WARC/"), version if version is not None else F.lit("1.0"), F.lit("\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")), F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"),
    ]
    return F.concat(*head, payload, F.lit("\r\n\r\n"))


def archived(pages: DataFrame, damaged: Column | None = None, lost: Column | None = None, per_file: int = RECORDS_PER_FILE):
    """The index of the WARC files that pages are packed into, as two replicas' ``leaves``, with ``record_id``.

    A file holds the records of ``per_file`` neighbouring page ids, in order;
    the first replica is whole.  Where ``damaged`` holds, the second has a
    flipped byte in the record's first line; where ``lost`` holds, it lacks
    the record.  Ids that come so often that a file would overflow, null ids
    among them, are spread over as many files as they need.
    """
    whole = warc_record(F.col("url"), F.col("page_id"), F.col("html"))
    flipped = warc_record(F.col("url"), F.col("page_id"), F.col("html"), F.lit("1.1"))
    damaged, lost = (F.coalesce(x, F.lit(False)) if x is not None else F.lit(False) for x in (damaged, lost))
    hashed = pages.select(
        F.col("page_id").alias("record_id"),
        F.floor(F.col("page_id") / per_file).alias("number"),
        F.octet_length(whole).cast("bigint").alias("length"),
        F.sha2(whole.cast("binary"), 256).alias("hash"),
        F.when(~lost, F.when(damaged, F.sha2(flipped.cast("binary"), 256)).otherwise(F.sha2(whole.cast("binary"), 256))).alias("other"),
    )
    rows = hashed.groupBy("record_id", "number", "length", "hash", "other").agg(F.count("*").alias("copies"))
    rows = stored(rows, "warc-records")
    full = stored(rows.groupBy("number").agg(F.count("*").alias("n")).where(F.col("n") > per_file), "warc-overflowing")
    full = full.select(F.col("number").alias("overflowing"), F.ceil(F.col("n") / per_file).alias("files"))
    rows = rows.join(full, F.col("number").eqNullSafe(F.col("overflowing")), "left").drop("overflowing")
    part = F.when(F.col("files").isNotNull(), F.pmod(F.xxhash64("record_id", "hash"), F.col("files"))).otherwise(0)
    digits = F.col("number").cast("string")
    # lpad also shortens, so longer numbers stay as they are.
    number = F.coalesce(F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits), F.lit("none"))
    name = F.concat(F.lit("pages-"), number, F.when(part > 0, F.concat(F.lit("-"), part.cast("string"))).otherwise(""), F.lit(".warc"))
    before = Window.partitionBy("file").orderBy("record_id", "hash", "other").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("length") * F.col("copies")).over(before), F.lit(0))
    rows = rows.withColumn("file", name).withColumn("start", start)
    # A record's copies in rows of their own, ``COPIES`` at a time.
    some = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPIES))).alias("some")
    end = F.least(F.col("copies"), (F.col("some") + 1) * COPIES) - 1
    copy = F.explode(F.sequence(F.col("some") * COPIES, end)).alias("copy")
    placed = rows.select("*", some).select("*", copy).withColumn("offset", F.col("start") + F.col("copy") * F.col("length"))
    placed = stored(placed.select("file", "offset", "record_id", "length", "hash", "other"), "warc-index")
    one = F.lit(1).cast("bigint").alias("copies")
    ours = placed.select("file", "offset", "length", "hash", one, "record_id")
    theirs = placed.where(F.col("other").isNotNull()).select("file", "offset", "length", F.col("other").alias("hash"), one)
    return ours, theirs
