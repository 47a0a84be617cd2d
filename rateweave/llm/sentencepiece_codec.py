"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The driver reads the model file, rebuilds it (``sentencepiece_model``) and
broadcasts the pipeline, about a few MB.  Tasks cut each text in front of its
runs of spaces, where the model allows that, and encode the segments not seen
before as one multithreaded batch, many in one string where their ids can be
told apart again; the ids are those of the rebuilt pipeline.
Parity is verified, not assumed: every distinct whole text of a batch is also
encoded by the sentencepiece library, and a row whose ids differ is marked.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm._common import free_name
from rateweave.llm._memo import Index, Lists, flat_lists, kept_by_worker, segment_hashes
from rateweave.llm.sentencepiece_model import CONTROL, SPACE, USER_DEFINED, build_tokenizer, parse_model, spaces_only_lead, surfaces

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Threads of one task's batch; a cluster sets as many as spark.task.cpus.
THREADS = 2
#: Segments that a process remembers at most; beyond, it starts anew.
REMEMBERED = 600_000
#: Segments that are given to the libraries at once, and characters of text that are turned into one result.
LEARNT, PART_CHARS = 20_000, 1_000_000
#: Segments in one string: one result of the library in place of as many.
JOINED = 1_000


class Codec:
    """Encoder and decoder of one model.  ``spec`` is what ``prepared`` gives."""

    def __init__(self, spec: tuple, threads: int = THREADS):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        import sentencepiece
        from tokenizers import Tokenizer

        data, rebuilt, self.surfaces, self.hidden, self.unknown, self.prefix, self.squeezes, self.cut, self.joins = spec
        self.strips = self.prefix or self.squeezes
        self.threads = threads
        self.tokenizer = Tokenizer.from_str(rebuilt)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        # A space that stands alone is the dummy prefix of nothing: the marker's own piece.
        self.alone = [self.tokenizer.token_to_id(SPACE)] if self.prefix and self.cut else []
        self.widths = np.array([len(s) for s in self.surfaces], dtype=np.int64)
        self._forget()

    def _forget(self) -> None:
        self.segments, self.ids = Index(), Lists(np.int32)

    def _learn(self, parts: list[str]) -> None:
        for start in range(0, len(parts), LEARNT):
            chunk = parts[start : start + LEARNT]
            groups = [chunk[k : k + JOINED] for k in range(0, len(chunk), JOINED)]
            # In a string, spaces alone would lead the next segment.
            joint = [self.joins and all(p[0] == " " != p[-1] for p in g) for g in groups]
            strings = ["".join(g)[1:] for g, j in zip(groups, joint) if j]
            coded = iter(self.tokenizer.encode_batch_fast(strings, add_special_tokens=False))
            for group, j in zip(groups, joint):
                found = self._parted(group, np.array(next(coded).ids, dtype=np.int32)) if j else None
                self.ids.append(*(found or self._singly(group)))

    def _singly(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The segments' ids in a row, and how many each has."""
        given = [p[1:] if self.prefix else p for p in parts]
        coded = self.tokenizer.encode_batch_fast(given, add_special_tokens=False)
        return flat_lists([c.ids if g else self.alone for g, c in zip(given, coded)], np.int32)

    def _parted(self, parts: list[str], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of segments in one string, and how many each has; None if the surfaces don't tell.

        Without the unknown piece a surface is never longer than what it was
        found in, so if all are as long as the string, each has its true length.
        """
        ends = np.cumsum([len(p.encode()) for p in parts])
        reached = np.cumsum(self.widths[ids])
        if not len(ids) or reached[-1] != ends[-1] or (ids == self.unknown).any():
            return None
        last = np.searchsorted(reached, ends)
        return (ids, np.diff(last, prepend=-1)) if np.array_equal(reached[last], ends) else None

    def cuts(self, space: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where segments begin: at the first space of each run, and where a text does."""
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[starts] = True
        return np.flatnonzero(cut)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """32-bit ids of each text; none for a null or empty one."""
        if not self.cut:
            known = list(dict.fromkeys(t for t in texts if t))
            coded = dict(zip(known, self.tokenizer.encode_batch_fast(known, add_special_tokens=False)))
            return [_packed(coded[t].ids) if t else b"" for t in texts]
        if self.segments.size > REMEMBERED:
            self._forget()
        at = [k for k, t in enumerate(texts) if t]
        if not at:
            return [b""] * len(texts)
        # The dummy prefix in front, which the tokenizer puts there itself.
        whole = [" " * self.prefix + texts[k].replace(SPACE, " ") for k in at]
        joined = "".join(whole)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        starts = np.cumsum([0, *(len(w) for w in whole[:-1])])
        begins = self.cuts(points == 32, starts)
        ends = np.append(begins[1:], len(points))
        hashes = segment_hashes(joined, points, begins, ends)
        rows = self.segments.rows(hashes, lambda first: self._learn([joined[begins[k] : ends[k]] for k in first]))
        ids, sizes = self.ids.gathered(rows)
        owner = np.searchsorted(starts, begins, side="right") - 1
        limits = np.cumsum([0, *np.bincount(owner, sizes, minlength=len(at)).astype(np.int64)])
        out = [b""] * len(texts)
        for k, a, z in zip(at, limits, limits[1:]):
            out[k] = ids[a:z].tobytes()
        return out

    def parity(self, texts: list[str | None], ids: list[bytes]) -> list[bool]:
        """Whether the sentencepiece library gives each whole text the same ids."""
        distinct = list(dict.fromkeys(t for t in texts if t))
        theirs = dict(zip(distinct, map(_packed, self.reference.encode(distinct, num_threads=self.threads))))
        return [theirs.get(t or "", b"") == own for t, own in zip(texts, ids)]

    def decode(self, ids) -> str:
        """The text of ids: their surfaces joined, without the dummy prefix (and
        all leading markers, if the model squeezes spaces).  Bytes that are no
        UTF-8 are left to the tokenizers library."""
        raw = b"".join(map(self.surfaces.__getitem__, ids))
        lead = 0
        if self.strips and raw[:1] == b" ":
            for i in ids:
                if i in self.hidden:
                    continue
                if i == self.unknown or self.surfaces[i][:1] != b" ":
                    break
                lead += 1
                if not self.squeezes or self.surfaces[i] != b" ":
                    break
        raw = raw[lead:]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            shown = [i for i in ids if i not in self.hidden]
            return self.tokenizer.decode(shown, skip_special_tokens=False)


def prepared(data: bytes) -> tuple:
    """A serialised model as what tasks need: plain values, made once on the driver."""
    model = parse_model(data)
    plain = not model.charsmap and not model.remove_extra_whitespaces
    hidden = {i for i, (_, _, kind) in enumerate(model.pieces) if kind == CONTROL}
    cut = plain and spaces_only_lead(model)
    rebuilt = build_tokenizer(model)
    # Unknown characters have no length of their own, and user-defined pieces part a string into several with a dummy prefix each.
    joins = cut and model.add_dummy_prefix and model.byte_fallback and not any(kind == USER_DEFINED for *_, kind in model.pieces)
    flags = model.add_dummy_prefix, model.remove_extra_whitespaces, cut, joins
    return data, rebuilt.to_str(), surfaces(model), hidden, model.unk_id, *flags


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def unpacked(ids: bytes) -> memoryview:
    return memoryview(ids).cast("i")


def _lists(values: list[bytes]) -> pa.ListArray:
    offsets = pa.array([0, *accumulate(len(v) // 4 for v in values)], pa.int32())
    flat = b"".join(values)
    return pa.ListArray.from_arrays(offsets, pa.Array.from_buffers(pa.int32(), len(flat) // 4, [None, pa.py_buffer(flat)]))


def _parts(texts: pa.Array, limit: int = PART_CHARS) -> Iterator[list[str | None]]:
    part, size = [], 0
    for text in texts:
        part.append(text.as_py())
        size += len(part[-1] or "")
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(
    docs: DataFrame,
    model_path: str = MODEL_PATH,
    text_col: str = "text",
    threads: int = THREADS,
    decoded: bool = False,
    keep: bool = True,
) -> DataFrame:
    """``docs`` with ``token_ids``, ``n_tokens``, ``parity`` (the sentencepiece library gives the whole text the
    same ids) and, if asked for, ``decoded`` (the ids turned back into text) and ``round_trip`` (it equals the text).

    A null text has no ids, and null as ``decoded``; an empty one has none
    either.  Repeated rows get the same ids; an empty table gives an empty
    one.  A text of any length is one row of ids; a task holds about two
    million characters of texts, or one longer text.  With ``keep`` a worker
    process keeps the model and its segments from task to task; without, it
    gives their memory back for other stages.  Columns of ``docs`` with these
    names are replaced.
    """
    with open(model_path, "rb") as f:
        data = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(prepared(data))
    name = f"codec {zlib.crc32(data)} {threads}"
    fields = "token_ids:array<int>,parity:boolean" + ",decoded:string" * decoded

    @F.arrow_udf(f"struct<{fields}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = kept_by_worker(name, lambda: Codec(shared.value, threads)) if keep else Codec(shared.value, threads)
        for texts in batches:
            # Several small results for a batch: a batch of long texts would make a large one.
            for part in _parts(texts):
                ids = codec.encode(part)
                out = [_lists(ids), pa.array(codec.parity(part, ids), pa.bool_())]
                if decoded:
                    back = [None if t is None else codec.decode(unpacked(i)) for t, i in zip(part, ids)]
                    out.append(pa.array(back, pa.string()))
                yield pa.StructArray.from_arrays(out, names=["token_ids", "parity", "decoded"][: len(out)])

    own = free_name(docs, "codes")
    found = docs.withColumn(own, run(F.col(text_col)))
    ids, back = F.col(f"{own}.token_ids"), F.col(f"{own}.decoded")
    out = {"token_ids": ids, "n_tokens": F.size(ids), "parity": F.col(f"{own}.parity")}
    if decoded:
        out |= {"decoded": back, "round_trip": back.eqNullSafe(F.col(text_col))}
    return found.withColumns(out).drop(own)


def decode(docs: DataFrame, model_path: str = MODEL_PATH, ids_col: str = "token_ids", into: str = "decoded") -> DataFrame:
    """``docs`` with column ``into``: the text of the ids; null for null ids."""
    with open(model_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(prepared(f.read()))

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = Codec(shared.value)
        for lists in batches:
            yield pa.array([None if ids is None else codec.decode(ids) for ids in lists.to_pylist()], pa.string())

    return docs.withColumn(into, run(F.col(ids_col)))
