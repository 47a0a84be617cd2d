"""Token ids of a corpus in rANS-coded files: written in document order, read block by block.

Writing takes three steps.  Texts become ids (a stored table), ids are counted
over the whole corpus into one shared frequency table, and the documents are
dealt by ranges of (id, hash), sorted, and coded as independent blocks.  An
archive is a folder with

``table``   the frequency table, one row for each token id that occurs
``blocks``  one row a block, in uncompressed Parquet, so that Spark's own
            readers, writers and commit protocol carry it on any file system:
            ``part`` (range) and ``first`` (its ids before the block), the
            block in the layout of ``rans``, and the documents that touch it
            (``doc_ids``, ``doc_starts``, ``doc_tokens``: begin in the range, length)

Every block is read on its own, and inside it every checkpoint; a document that
spans blocks is put together from what each of them adds to its checksum.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.llm import rans
from rateweave.llm._memo import kept_by_worker
from rateweave.llm.word_tokens import WordTokens
from rateweave.session import fresh_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Characters of text that are turned into one result.
PART_CHARS = 1_000_000


def parts_of(texts: pa.Array, limit: int = PART_CHARS) -> Iterator[list[str | None]]:
    """The texts in lists of about ``limit`` characters."""
    part, size = [], 0
    for text in texts:
        part.append(text.as_py())
        size += len(part[-1] or "")
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def tokenized(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """``(id, ids)``: every row's token ids with the end id, little-endian, 16 bits each if the vocabulary allows."""
    with open(tokenizer, encoding="utf-8") as f:
        data = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(data)
    name = f"word tokens {zlib.crc32(data.encode())}"

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = kept_by_worker(name, lambda: WordTokens(shared.value))
        for texts in batches:
            for part in parts_of(texts):
                ids, sizes = coder.encode([t or "" for t in part], end_id)
                ends = np.concatenate([[0], np.cumsum(sizes)]) * ids.itemsize
                yield pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)])

    return docs.select(F.col(id_col).alias("id"), run(F.col(text_col)).alias("ids"))


def _wide(data: str) -> bool:
    from tokenizers import Tokenizer

    return Tokenizer.from_str(data).get_vocab_size(with_added_tokens=True) > 1 << 16


def _flat(lists: pa.Array, kind: str) -> np.ndarray:
    """The numbers of all packed lists of an array, in a row."""
    ends = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1]
    return np.frombuffer(lists.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind)


def counted(lists: DataFrame, wide: bool) -> DataFrame:
    """``(token, n)`` over all rows; each task adds up its own before the shuffle."""
    kind = "<u4" if wide else "<u2"

    def run(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                own = np.bincount(_flat(batch.column(0), kind))
                total, own = (x if len(x) >= len(y) else np.pad(x, (0, len(y) - len(x))) for x, y in ((total, own), (own, total)))
                total = total + own
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["token", "n"])

    return lists.select("ids").mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    block_ids: int = rans.BLOCK_IDS,
) -> None:
    """Write the archive of ``docs`` to the new folder ``path``.

    Documents come in ascending order of their id (nulls last; equal ids by a
    hash of their ids, repeated rows as they are read).  A null text counts as
    empty: it has the end id only.  An empty table makes an archive without
    blocks.  A very long text spans blocks; a task holds one text and one block.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        wide = _wide(f.read())
    kind = "<u4" if wide else "<u2"
    lists = fresh_path(spark, "token-lists")
    rows = tokenized(docs, tokenizer, id_col, text_col, end_id)
    rows.write.option("compression", "zstd").parquet(lists)
    rows = spark.read.schema(rows.schema).parquet(lists)
    # One row for each token id at most: the vocabulary bounds what the driver gets and broadcasts.
    found = counted(rows, wide).toArrow()
    counts = np.zeros(int(max(found["token"].to_numpy(), default=0)) + 1, dtype=np.int64)
    counts[found["token"].to_numpy()] = found["n"].to_numpy()
    table = rans.table_of(counts)
    used = np.flatnonzero(table.freq)
    freq = [(int(i), int(table.freq[i]), table.bits) for i in used]
    spark.createDataFrame(freq, "token bigint, freq bigint, bits int").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast((table.bits, table.freq.astype(np.uint32)))
    id_type = rows.schema["id"].dataType.simpleString()
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("id").isNull(), F.col("id"), F.xxhash64("ids"), F.monotonically_increasing_id()]
    keyed = rows.select("id", "ids", *[c.alias(f"k{i}") for i, c in enumerate(order)])
    keys = [f"k{i}" for i in range(len(order))]
    # Equal ids, and even equal rows, are told apart by the later keys, so a hot id spreads over ranges.
    dealt = keyed.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    dealt = dealt.select(F.spark_partition_id().alias("part"), "id", "ids")

    def run(batches):
        bits, freq = shared.value
        coder = rans.Coder(rans.Table(bits, freq.astype(np.uint64)))
        part, first, held, size, touching, place = None, 0, [], 0, [], 0

        def block(ids):
            docs = [(i, s, n) for i, s, n in touching if s < first + len(ids)]
            columns = [[part], [first], [coder.encode(ids)], *([list(c)] for c in zip(*docs))]
            types = [pa.int32(), pa.int64(), pa.binary(), pa.list_(own_type), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        own_type = pa.int64()
        for batch in batches:
            own_type = batch.column("id").type
            for at, own_id, raw in zip(batch.column("part").to_pylist(), batch.column("id").to_pylist(), batch.column("ids")):
                part, ids = at, np.frombuffer(raw.as_buffer(), kind)
                touching.append((own_id, place, len(ids)))
                held.append(ids)
                size, place = size + len(ids), place + len(ids)
                if size >= block_ids:
                    whole, size = np.concatenate(held), size % block_ids
                    for begin in range(0, len(whole) - size, block_ids):
                        yield block(whole[begin : begin + block_ids])
                        first += block_ids
                        touching = [(i, s, n) for i, s, n in touching if s + n > first]
                    held = [whole[len(whole) - size :]]
        if size:
            yield block(np.concatenate(held))

    names = ["part", "first", "block", "doc_ids", "doc_starts", "doc_tokens"]
    schema = f"part int, first bigint, block binary, doc_ids array<{id_type}>, doc_starts array<bigint>, doc_tokens array<bigint>"
    dealt.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/blocks")


class Archive:
    """An archive that has been written: its table, and how many ids come before each range."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.blocks = spark.read.parquet(f"{path}/blocks")
        rows = spark.read.parquet(f"{path}/table").toArrow()  # the vocabulary at most
        size = int(max(rows["token"].to_numpy(), default=0)) + 1
        freq = np.zeros(size, dtype=np.uint32)
        freq[rows["token"].to_numpy()] = rows["freq"].to_numpy()
        bits = int(rows["bits"][0].as_py()) if len(rows) else 18
        self.shared = spark.sparkContext.broadcast((bits, freq))
        # One row for each range that was written.
        ends = F.max(F.element_at("doc_starts", -1) + F.element_at("doc_tokens", -1)).alias("n")
        self.before, total = {}, 0
        for part, n in sorted(map(tuple, self.blocks.groupBy("part").agg(ends).collect())):
            self.before[part] = total
            total += n
        self.total = total
        self.id_type = self.blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def pieces(self, first: int = 0, stop: int | None = None) -> DataFrame:
        """``(doc_id, start, n_tokens, at, ids)``: for every block, the ids of each document that touches it, from
        the document's position ``at`` on; ``first`` and ``stop`` choose ids of the whole corpus, of which only the
        blocks and sections that hold them are decoded."""
        return self._read(first, self.total if stop is None else stop, "ids array<int>", lambda ids, after: ids)

    def documents(self, id_col: str = "doc_id") -> DataFrame:
        """``(id_col, start, n_tokens, ids_crc32)`` of every document, from the decoded blocks: the ids of all documents
        before it, its ids with the end id, the CRC-32 of these as little-endian unsigned 32-bit integers."""

        def share(ids: np.ndarray, after: int) -> int:
            own = zlib.crc32(ids.astype("<u4").tobytes())
            return rans.crc_followed_by(own, 4 * after) if after else own

        found = self._read(0, self.total, "share bigint", share)
        whole = found.where(F.col("whole")).select("doc_id", "start", "n_tokens", F.col("share").alias("ids_crc32"))
        grouped = found.groupBy("doc_id", "start", "n_tokens").agg(F.bit_xor("share").alias("ids_crc32"))
        out = whole if self._none_spans() else grouped
        return out.withColumnRenamed("doc_id", id_col)

    def _none_spans(self) -> bool:
        """Whether every document lies in one block."""
        return self.blocks.where(F.element_at("doc_starts", 1) < F.col("first")).isEmpty()

    def _read(self, first: int, stop: int, value: str, of) -> DataFrame:
        shared, before, spark = self.shared, self.before, self.spark
        offsets = spark.createDataFrame(sorted(before.items()), "part int, before bigint")  # one row a range
        rows = self.blocks.join(F.broadcast(offsets), "part")
        last = F.col("before") + F.element_at("doc_starts", -1) + F.element_at("doc_tokens", -1)
        rows = rows.where((last > first) & (F.col("before") + F.col("first") < stop))
        name, kind = value.split()
        schema = f"doc_id {self.id_type}, start bigint, n_tokens bigint, at bigint, whole boolean, {value}"

        def run(batches):
            bits, freq = shared.value
            coder = rans.Coder(rans.Table(bits, freq.astype(np.uint64)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64() if kind == "bigint" else pa.list_(pa.int32())]
            for batch in batches:
                for n in range(batch.num_rows):
                    row = {k: batch.column(k)[n] for k in ("before", "first", "block", "doc_ids", "doc_starts", "doc_tokens")}
                    base, begin, raw = row["before"].as_py(), row["first"].as_py(), row["block"].as_buffer()
                    # In ids of the block.
                    lo, hi = max(0, first - base - begin), stop - base - begin
                    ids = coder.decode(raw, lo, hi)
                    hi = lo + len(ids)
                    out, chosen = [], []
                    for k, (start, size) in enumerate(zip(row["doc_starts"].as_py(), row["doc_tokens"].as_py())):
                        a, z = max(start - begin, lo), min(start + size - begin, hi)
                        if a < z:
                            done = z - (start - begin)  # ids of the document up to here
                            chosen.append(k)
                            out.append((base + start, size, a - (start - begin), z - a == size, of(ids[a - lo : z - lo], size - done)))
                    columns = list(zip(*out)) or [()] * 5
                    found = row["doc_ids"].values.take(pa.array(chosen, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [found, *[pa.array(c, t) for c, t in zip(columns, types)]],
                        ["doc_id", "start", "n_tokens", "at", "whole", name],
                    )

        return rows.mapInArrow(run, schema)


def archived(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` written as an archive in the shared folder and read back: ``Archive.documents``; no rows for an empty table."""
    path = fresh_path(docs.sparkSession, "token-archive")
    write(docs, path, tokenizer, id_col, text_col)
    return Archive(docs.sparkSession, path).documents(id_col)
