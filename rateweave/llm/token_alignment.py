"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Texts are tokenised whole by both.  Where a token of each ends at the same byte
and the next token of each begins with a space, the text is cut: such verified
shared ends are the anchors, and what lies between two of them is a window of
token ids.  The same windows come again and again, so a window's alignment is
made once and remembered by its tuple of ids.  Inside a window the shared ends
of tokens cut it into groups, and all tokens of a group are linked.

Corpus-wide counts of linked id pairs are made from each document's distinct
pairs by a shuffle; they are read back in blocks of bounded size, each
broadcast, over the documents' stored pairs.

A is a byte-level tokenizer of the tokenizers library, given the text with a
space in front; B is a SentencePiece model that puts that space there itself.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm._common import MULTIPLIERS, mixed, stored
from rateweave.llm._memo import Grown, Index, Lists, flat_lists, kept_by_worker, run_hashes, runs, segment_hashes
from rateweave.llm.token_archive import parts_of
from rateweave.llm.word_tokens import byte_alphabet
from rateweave.session import fresh_path

#: Segments and windows that a process remembers at most; beyond, it starts anew.
REMEMBERED = 1_000_000
#: Characters of text that are aligned at once; a longer text is cut into slices, which bounds a task's memory.
PART_CHARS, SLICE_CHARS = 500_000, 1_000_000
#: Id pairs whose counts are broadcast at once (17 bytes each).
MAX_PAIRS = 2_000_000
#: Documents' id pairs that a task counts at once.
COUNTED = 4_000_000
# A space where a text may be cut: the first of its run, in front of something that is no white space.
_CUT = re.compile(r"(?<! ) (?=\S)")
# White space as Python has it: a superset of what the tokenizers know.
_WHITE = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
_PLAIN = re.compile(" [A-Za-zÀ-ÖØ-öø-ÿ]+")
SPACE = "▁"


def piece_bytes(piece: str) -> bytes:
    coded = _BYTE_PIECE.fullmatch(piece)
    return bytes([int(coded[1], 16)]) if coded else piece.replace(SPACE, " ").encode("utf-8", "surrogatepass")


def slices(text: str) -> Iterator[str]:
    """Space + text, in parts of about ``SLICE_CHARS`` that both tokenizers encode on their own."""
    whole, at = " " + text, 0
    while len(whole) - at > SLICE_CHARS:
        found = _CUT.search(whole, at + SLICE_CHARS)
        if found is None:
            break
        yield whole[at : found.start()]
        at = found.start()
    yield whole[at:]


class Tokens:
    """Both tokenizers with the bytes of their tokens, and what the process has learnt of segments and windows."""

    def __init__(self, a_data: str, b_data: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_data)
        self.a.encode_special_tokens = True
        self.model = self.a.model
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_data)
        letters = byte_alphabet()
        self.alphabet = str.maketrans({chr(b): c for b, c in letters.items()})
        alphabet = {c: b for b, c in letters.items()}
        size = self.a.get_vocab_size(with_added_tokens=True)
        entries = [self.a.id_to_token(i) or "" for i in range(size)]
        a_bytes = [bytes(alphabet[c] for c in e) if all(c in alphabet for c in e) else e.encode("utf-8") for e in entries]
        b_bytes = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.sizes = len(a_bytes), len(b_bytes)
        self.lengths = [np.array([len(x) for x in side], dtype=np.int64) for side in (a_bytes, b_bytes)]
        self.spaced = [np.array([x[:1] == b" " for x in side]) for side in (a_bytes, b_bytes)]
        self.bytes, self.digits = [Lists(np.uint8), Lists(np.uint8)], Lists(np.uint8)
        for lists, side in ((self.bytes[0], a_bytes), (self.bytes[1], b_bytes), (self.digits, [b"%d" % i for i in range(max(self.sizes))])):
            lists.append(np.frombuffer(b"".join(side), np.uint8), np.array([len(x) for x in side], dtype=np.int64))
        self._forget()

    def _forget(self) -> None:
        self.segments, self.ids, self.same = Index(), (Lists(np.uint32), Lists(np.uint32)), Grown(bool)
        self.windows, self.links, self.groups, self.said = Index(), Lists(np.int64), Grown(np.int64), Lists(np.uint8)

    def _learn_segments(self, parts: list[str]) -> None:
        """The ids of both, and whether the tokens' bytes are the segment's."""
        plain = [_PLAIN.fullmatch(p) is not None for p in parts]
        # A space and letters are one word of the model, in its byte alphabet.
        tokenize, alphabet = self.model.tokenize, self.alphabet
        other = iter(self.a.encode_batch_fast([w for w, p in zip(parts, plain) if not p], add_special_tokens=False))
        one = [[t.id for t in tokenize(w.encode().decode("latin-1").translate(alphabet))] if p else next(other).ids for w, p in zip(parts, plain)]
        two = self.b.encode([p[1:] for p in parts], num_threads=1)  # it puts the space in front itself
        raw = [p.encode("utf-8", "surrogatepass") for p in parts]
        sizes, whole = np.array([len(r) for r in raw], dtype=np.int64), np.frombuffer(b"".join(raw), np.uint8)
        begins, same = np.cumsum(sizes) - sizes, np.ones(len(parts), dtype=bool)
        for side, lists in enumerate((one, two)):
            ids, counts = flat_lists(lists, np.uint32)
            self.ids[side].append(ids, counts)
            found, lengths = self.bytes[side].gathered(ids)
            own = np.repeat(np.arange(len(parts)), counts)
            total = np.bincount(own, lengths, minlength=len(parts)).astype(np.int64)
            same &= total == sizes
            # Byte by byte, of the segments whose lengths agree.
            alike = total == sizes
            differs = found[runs((np.cumsum(total) - total)[alike], total[alike])] != whole[runs(begins[alike], sizes[alike])]
            same[np.repeat(np.flatnonzero(alike), sizes[alike])[differs]] = False
        self.same.append(same)

    def _learn_windows(self, a: np.ndarray, count_a: np.ndarray, b: np.ndarray, count_b: np.ndarray) -> None:
        """Of windows given as their ids in a row: each one's groups as text, their number, and its links as
        ``A id * size of B + B id``."""
        ends_a, ends_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        # Every window has the same bytes on both sides, so ends are compared over all of them at once.
        last_a = ends_b[np.minimum(np.searchsorted(ends_b, ends_a), len(b) - 1)] == ends_a
        last_b = ends_a[np.minimum(np.searchsorted(ends_a, ends_b), len(a) - 1)] == ends_b
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        held_a, held_b = np.bincount(group_a), np.bincount(group_b)
        window_a = np.repeat(np.arange(len(count_a)), count_a)
        self.groups.append(np.bincount(window_a[last_a], minlength=len(count_a)))
        # Each token of A with all of B's in its group.
        begins_b, partners = np.cumsum(held_b) - held_b, held_b[group_a]
        links = np.repeat(a.astype(np.int64), partners) * self.sizes[1] + b[runs(begins_b[group_a], partners)]
        self.links.append(links, np.bincount(window_a, partners, minlength=len(count_a)).astype(np.int64))
        # "a1,a2|b1;a3|b2,b3;": A's ids of a group, then B's.
        ids, signs = np.zeros(len(a) + len(b), dtype=np.int64), np.zeros(len(a) + len(b), dtype=np.uint8)
        place_a = np.arange(len(a)) + begins_b[group_a]
        place_b = np.arange(len(b)) + np.cumsum(held_a)[group_b]
        for place, own, last, sign in ((place_a, a, last_a, b"|"), (place_b, b, last_b, b";")):
            ids[place], signs[place] = own, np.where(last, ord(sign), ord(","))
        digits, lengths = self.digits.gathered(ids)
        text = np.insert(digits, np.cumsum(lengths), signs)
        windows = np.zeros(len(ids), dtype=np.int64)
        windows[place_a], windows[place_b] = window_a, np.repeat(np.arange(len(count_b)), count_b)
        self.said.append(text, np.bincount(windows, lengths + 1, minlength=len(count_a)).astype(np.int64))

    def _tokenised(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The whole token sequences of parts that come back byte by byte, in a row, each token's part: A's, then B's.

        Parts are cut at spaces into segments, which both tokenizers encode
        alike alone and in the text, and each is encoded once.
        """
        joined = "".join(parts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        starts = np.cumsum([0, *(len(p) for p in parts[:-1])])
        space, white = points == 32, _WHITE[np.minimum(points, len(_WHITE) - 1)]
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[:-1] &= ~white[1:]
        cut[-1:] = False
        cut[starts] = True
        begins = np.flatnonzero(cut)
        ends = np.append(begins[1:], len(points))
        hashes = segment_hashes(joined, points, begins, ends)
        rows = self.segments.rows(hashes, lambda first: self._learn_segments([joined[begins[k] : ends[k]] for k in first]))
        owner = np.searchsorted(starts, begins, side="right") - 1
        # A segment that differs makes its text differ: tokens end where segments do.
        kept = ~np.isin(owner, owner[~self.same.data[rows]])
        rows, owner = rows[kept], owner[kept]
        out = []
        for lists in self.ids:
            ids, sizes = lists.gathered(rows)
            out += [ids, np.repeat(owner, sizes)]
        return tuple(out)

    def _windows(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where the windows of two token sequences of the same bytes begin and end in A, and in B.

        Anchors are verified shared ends: bytes at which a token of each ends
        and the next of each begins with a space.
        """
        ends_a, ends_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        at_a, at_b = np.flatnonzero(self.spaced[0][a[1:]]), np.flatnonzero(self.spaced[1][b[1:]])
        own, other = ends_a[at_a], ends_b[at_b]
        place = np.searchsorted(other, own)
        shared = np.zeros(len(own), dtype=bool)
        inside = place < len(other)
        shared[inside] = other[place[inside]] == own[inside]
        begins_a, begins_b = (np.concatenate([[0], at[x] + 1]) for at, x in ((at_a, shared), (at_b, place[shared])))
        return begins_a, np.append(begins_a[1:], len(a)), begins_b, np.append(begins_b[1:], len(b))

    def align(self, parts: list[str]) -> list[tuple[int, int, int, bytes, np.ndarray, np.ndarray]]:
        """For each part (beginning with its space): (A tokens, B tokens, groups, the groups as text with a ``;`` after
        each, distinct links, how often each); no tokens for a part that doesn't come back."""
        if self.segments.size > REMEMBERED or self.windows.size > REMEMBERED:
            self._forget()
        a, owner_a, b, owner_b = self._tokenised(parts)
        if not len(a):
            none = np.zeros(0, dtype=np.int64)
            return [(0, 0, 0, b"", none, none)] * len(parts)
        begins_a, ends_a, begins_b, ends_b = self._windows(a, b)
        hashes = mixed(run_hashes(a, begins_a, ends_a) * np.uint64(MULTIPLIERS[1]) ^ run_hashes(b, begins_b, ends_b))
        size_a, size_b = ends_a - begins_a, ends_b - begins_b

        def learn(first):
            own_a, own_b = size_a[first], size_b[first]
            self._learn_windows(a[runs(begins_a[first], own_a)], own_a, b[runs(begins_b[first], own_b)], own_b)

        rows = self.windows.rows(hashes, learn)
        count, owner = len(parts), owner_a[begins_a]
        links, sizes = self.links.gathered(rows)
        room = self.sizes[0] * self.sizes[1]
        ordered = np.sort(links + np.repeat(owner, sizes) * room)
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        distinct, times = ordered[first], np.diff(np.append(first, len(ordered)))
        cuts = np.searchsorted(distinct, np.arange(count + 1) * room)
        n_a, n_b = np.bincount(owner_a, minlength=count), np.bincount(owner_b, minlength=count)
        n_groups = np.bincount(owner, self.groups.data[rows], minlength=count).astype(np.int64)
        said, written = self.said.gathered(rows)
        texts = np.concatenate([[0], np.cumsum(written)])[np.searchsorted(owner, np.arange(count + 1))]
        return [
            (
                int(n_a[k]), int(n_b[k]), int(n_groups[k]), said[texts[k] : texts[k + 1]].tobytes(),
                distinct[cuts[k] : cuts[k + 1]] - k * room, times[cuts[k] : cuts[k + 1]],
            )
            for k in range(count)
        ]

    def aligned(self, texts: list[str | None]) -> list[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
        """For each text: (A tokens, B tokens, groups, links, digest of the groups, distinct links, how often each)."""
        nothing = 0, 0, 0, 0, "", np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        out: list[tuple] = [nothing] * len(texts)
        short = [k for k, t in enumerate(texts) if t and len(t) <= SLICE_CHARS]
        for k, found in zip(short, self.align([" " + texts[k] for k in short]) if short else ()):
            if found[0]:
                out[k] = (*found[:3], int(found[5].sum()), hashlib.sha256(found[3][:-1]).hexdigest(), *found[4:])
        for k, text in enumerate(texts):
            if text and len(text) > SLICE_CHARS:
                out[k] = self._sliced(text) or nothing
        return out

    def _sliced(self, text: str) -> tuple | None:
        """One long text, a slice at a time; ``None`` without tokens."""
        digest, counts = hashlib.sha256(), np.zeros(3, dtype=np.int64)
        pairs = times = np.zeros(0, dtype=np.int64)
        for n, part in enumerate(slices(text)):
            (found,) = self.align([part])
            if not found[0]:
                return None
            digest.update(b";" * (n > 0) + found[3][:-1])
            counts += found[:3]
            both, at = np.unique(np.concatenate([pairs, found[4]]), return_inverse=True)
            pairs, times = both, np.bincount(at, np.concatenate([times, found[5]])).astype(np.int64)
        return (*counts.tolist(), int(times.sum()), digest.hexdigest(), pairs, times)


def linked(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times)`` of every row, ``pairs`` as packed
    64-bit ``A id * size of B + B id`` in order and ``times`` as packed 32-bit numbers; written once."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        shared = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    fields = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64())]
    fields += [("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())]

    @F.arrow_udf("struct<n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string,pairs:binary,times:binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one, two = shared.value
        tokens = kept_by_worker(f"alignment {zlib.crc32(one.encode())} {zlib.crc32(two)}", lambda: Tokens(one, two))
        for texts in batches:
            for part in parts_of(texts, PART_CHARS):
                rows = [(*r[:5], r[5].astype("<i8").tobytes(), r[6].astype("<u4").tobytes()) for r in tokens.aligned(part)]
                yield pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), run(F.col(text_col)).alias("r"))
    rows = rows.select("row", "id", "r.*")
    path = fresh_path(docs.sparkSession, "aligned")
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def _size(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """``(pair, docs, best)``: in how many documents each pair is linked, and whether no other pair of its A id is in more."""

    def run(batches):
        held, size = [], 0

        def summed():
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], ["pair", "docs"])

        for batch in batches:
            for pairs in batch.column(0):
                held.append(np.frombuffer(pairs.as_buffer(), "<i8"))
                size += len(held[-1])
                if size >= COUNTED:
                    yield summed()
                    held, size = [], 0
        if held:
            yield summed()

    counts = rows.select("pairs").mapInArrow(run, "pair bigint, docs bigint").groupBy("pair").agg(F.sum("docs").alias("docs"))
    counts = stored(counts.withColumn("a", F.floor(F.col("pair") / size_b)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def _scored(rows: DataFrame, block: tuple[np.ndarray, np.ndarray, np.ndarray]):
    """``rows`` with what a block of pair counts adds to ``n_best`` and ``count_sum``; and the broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    @F.arrow_udf("struct<n_best:bigint,count_sum:bigint>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known, docs, best = shared.value
        for pairs, times in batches:
            n_best, sums = [], []
            for own, often in zip(pairs, times):
                own, often = np.frombuffer(own.as_buffer(), "<i8"), np.frombuffer(often.as_buffer(), "<u4").astype(np.int64)
                at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
                here = known[at] == own if len(known) else np.zeros(len(own), dtype=bool)
                at, often = at[here], often[here]
                n_best.append(int(often[best[at]].sum()))
                sums.append(int((often * docs[at]).sum()))
            yield pa.StructArray.from_arrays([pa.array(n_best, pa.int64()), pa.array(sums, pa.int64())], names=["n_best", "count_sum"])

    found = rows.withColumn("s", run(F.col("pairs"), F.col("times")))
    return found.select(*[c for c in rows.columns if c not in ("pairs", "times")], "s.n_best", "s.count_sum"), shared


def aligned(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", max_pairs: int = MAX_PAIRS
) -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row of ``docs``.

    Links are the pairs of tokens of a group; ``n_best`` counts those whose
    pair is linked in as many documents as any pair of its A id, ``count_sum``
    adds up these numbers over all links.  A null or empty text, or one that
    the tokenizers don't give back byte by byte, has zeros and an empty digest.
    Every row is a document: repeated rows count each time; null ids stay
    null; an empty table gives no rows; very long texts are aligned in slices.
    """
    rows = linked(docs, a_path, b_path, id_col, text_col)
    counts = stored(pair_counts(rows, _size(b_path)), "pair-best")
    blocks = max(1, -(-counts.count() // max_pairs))
    parts = []
    for k in range(blocks):
        # At most about max_pairs pairs: the parameter bounds what is collected and broadcast.
        own = counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == k).toArrow().sort_by("pair")
        block = own["pair"].to_numpy(), own["docs"].to_numpy(), own["best"].to_numpy(zero_copy_only=False)
        part, shared = _scored(rows, block)
        if blocks > 1:  # one block at a time: its sums are written before the next is broadcast
            part = stored(part, "pair-sums")
            shared.unpersist()
        parts.append(part)
    out = parts[0]
    if blocks > 1:
        same = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        whole = reduce(DataFrame.unionByName, parts).groupBy("row")
        out = whole.agg(*[F.first(c).alias(c) for c in same], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return out.select(F.col("id").alias(id_col), *columns)
