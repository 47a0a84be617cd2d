"""The rebuilt tokenizer against the sentencepiece library, for BPE and unigram models."""

from __future__ import annotations

import struct

import numpy as np
import pytest
import sentencepiece

from rateweave.llm import sentencepiece_codec as C
from rateweave.llm import sentencepiece_model as M

ODD = [
    "", " ", "  two  spaces ", "a\nb\t c", "▁x ▁▁y", " lead", "日本語 テキスト 🎉🎊", "<s> </s> <unk> <0x41>", "é é ﬁ",
    "\x00\x01", "a" * 3000, "x  ", " " * 50 + "y", "Is and retitioning ouen the of, nterti thorreou.\n", "Ünïcödé—dash", " nbsp",
]


def _field(number, payload):
    if isinstance(payload, bytes):
        size, out = len(payload), bytearray()
        while size >= 0x80:
            out.append(size & 0x7F | 0x80)
            size >>= 7
        return _varint(number << 3 | 2) + bytes(out) + bytes([size]) + payload
    if isinstance(payload, float):
        return _varint(number << 3 | 5) + struct.pack("<f", payload)
    return _varint(number << 3) + _varint(payload)


def _varint(n):
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out) + bytes([n])


def unigram_model(pieces, byte_fallback, dummy_prefix=1, remove_extra=0):
    """A unigram model file: given pieces with their scores, no training."""
    listed = [("<unk>", 0.0, M.UNKNOWN), ("<s>", 0.0, M.CONTROL), ("</s>", 0.0, M.CONTROL)]
    if byte_fallback:
        listed += [(f"<0x{b:02X}>", 0.0, M.BYTE) for b in range(256)]
    listed += [(t, s, M.NORMAL) for t, s in pieces]
    data = b"".join(
        _field(M.MODEL_PIECES, _field(1, t.encode()) + _field(2, float(s)) + _field(3, k)) for t, s, k in listed
    )
    trainer = _field(M.TRAINER_MODEL_TYPE, M.UNIGRAM) + _field(M.TRAINER_BYTE_FALLBACK, int(byte_fallback))
    norm = _field(1, b"identity") + _field(3, dummy_prefix) + _field(4, remove_extra) + _field(5, 1)
    return data + _field(M.MODEL_TRAINER, trainer) + _field(M.MODEL_NORMALIZER, norm)


def public_model():
    with open(C.MODEL_PATH, "rb") as f:
        return f.read()


def models():
    pieces = [(t, s / 1000 - 3.0) for t, s, kind in M.parse_model(public_model()).pieces if kind == M.NORMAL][:20_000]
    single = [(t, s) for t, s in pieces if len(t) == 1]
    pieces = pieces + [(t, s) for t, s in single if (t, s) not in set(pieces)]
    if "▁" not in dict(pieces):
        pieces.append(("▁", -8.0))
    crossing = pieces + [("of▁the", -4.0), ("e▁t", -5.0)]
    return {
        "bpe": public_model(),
        "unigram": unigram_model(pieces, True),
        "unigram without bytes": unigram_model(pieces, False),
        "unigram across spaces": unigram_model(crossing, True),
        "unigram without prefix": unigram_model(pieces, True, dummy_prefix=0),
        "unigram squeezing spaces": unigram_model(pieces, True, remove_extra=1),
    }


@pytest.mark.parametrize("name", list(models()))
def test_parity(name):
    data = models()[name]
    codec, theirs = C.Codec(C.prepared(data)), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ODD + [" ".join(["of the end", "retition", "x" * 70])]
    ids = codec.encode(texts)
    agree = codec.parity(texts, ids)
    assert agree == [list(C.unpacked(i)) == t for i, t in zip(ids, theirs.encode(texts))]
    literal = [t for t, a in zip(texts, agree) if not a and "<0x41>" not in t]  # names of byte pieces may match in unigram
    assert (not literal if name != "bpe" else all(agree)), [t for t, a in zip(texts, agree) if not a]
    assert [codec.decode(C.unpacked(i)) for i in ids] == theirs.decode([list(C.unpacked(i)) for i in ids])
    again = codec.encode(texts[::-1] + [None])
    assert again[-1] == b"" and again[:-1] == ids[::-1]


@pytest.mark.parametrize("name", ["bpe", "unigram", "unigram without prefix", "unigram squeezing spaces"])
def test_the_rebuilt_pipeline_alone(name):
    data = models()[name]
    rebuilt, theirs = M.build_tokenizer(M.parse_model(data)), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in ODD:
        if text and "<0x41>" not in text and (text != " " or name == "bpe"):
            ids = rebuilt.encode(text, add_special_tokens=False).ids
            assert ids == theirs.encode(text), text
            if name == "bpe":
                assert rebuilt.decode(ids, skip_special_tokens=False) == theirs.decode(ids)


def test_model_file_is_read():
    model, theirs = M.parse_model(public_model()), sentencepiece.SentencePieceProcessor(model_proto=public_model())
    assert len(model.pieces) == theirs.vocab_size() and model.unk_id == theirs.unk_id()
    assert [p[0] for p in model.pieces] == [theirs.id_to_piece(i) for i in range(theirs.vocab_size())]
    assert [p[1] for p in model.pieces] == [theirs.get_score(i) for i in range(theirs.vocab_size())]
    with pytest.raises(ValueError):
        M.parse_model(b"")


def test_invalid_bytes_decode_like_the_library():
    codec, theirs = C.Codec(C.prepared(public_model())), sentencepiece.SentencePieceProcessor(model_proto=public_model())
    byte = theirs.piece_to_id("<0xE3>")
    for ids in ([byte], [byte, byte, 1, 300], [300, byte], [0, 300], []):
        assert codec.decode(ids) == theirs.decode(ids)


def test_memory_of_segments_is_bounded(monkeypatch):
    monkeypatch.setattr(C, "REMEMBERED", 10)
    codec, theirs = C.Codec(C.prepared(public_model())), sentencepiece.SentencePieceProcessor(model_proto=public_model())
    for part in (["one two three four five six seven"], ["alpha beta one"] * 2, [f"w{i}" for i in range(30)], ["one w3 new"]):
        ids = codec.encode(part)
        assert [list(C.unpacked(i)) for i in ids] == theirs.encode(part)


def test_a_broken_pipeline_shows_in_ids_and_parity():
    """The ids are the rebuilt pipeline's own, and a row in which they differ from the library's is marked."""
    from tokenizers import Tokenizer, normalizers

    codec = C.Codec(C.prepared(public_model()))
    whole = codec.tokenizer.normalizer
    codec.tokenizer.normalizer = normalizers.Sequence([whole, normalizers.Replace(M.SPACE, "")])  # it forgets the marker
    texts = ["hello there", "", None, "hello there", "hello"]
    ids = codec.encode(texts)
    broken = Tokenizer.from_str(codec.tokenizer.to_str())
    assert [list(C.unpacked(i)) for i in ids[::3]] == [
        [i for part in ("hello", "there") for i in broken.encode(part, add_special_tokens=False).ids]
    ] * 2
    assert codec.parity(texts, ids) == [False, True, True, False, False]


def test_an_error_of_the_cutting_shows_in_parity(monkeypatch):
    """Parity is that of whole texts: segments that are right one by one don't hide a wrong cut."""
    codec = C.Codec(C.prepared(public_model()))
    texts = ["retitioning the end", "plain"]
    right = codec.cuts
    monkeypatch.setattr(codec, "cuts", lambda space, starts: np.sort(np.append(right(space, starts), 4)))
    assert codec.parity(texts, codec.encode(texts)) == [False, True]


def test_encode_and_decode_tables(docs_of):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (1, "again"), (1, "again"), (99, "word " * 100_000)]
    docs = docs_of(rows)
    coded = C.encode(docs, decoded=True)
    theirs = sentencepiece.SentencePieceProcessor(model_proto=public_model())
    for r in coded.collect():
        want = theirs.encode(r["text"] or "")
        assert r["token_ids"] == want and r["n_tokens"] == len(want) and r["parity"]
        assert r["decoded"] == (None if r["text"] is None else theirs.decode(want))
        assert r["round_trip"] == (r["decoded"] == r["text"])
    back = C.decode(coded.select("text", "token_ids"), into="own").collect()
    assert all(r["own"] == theirs.decode(r["token_ids"]) for r in back)
    assert C.encode(docs_of([])).count() == 0


def test_several_results_for_a_batch(monkeypatch, docs_of):
    monkeypatch.setattr(C, "_parts", lambda texts: ([t.as_py()] for t in texts))
    docs = docs_of([(i, f"text number {i}") for i in range(300)]).coalesce(1)
    assert {(r["doc_id"], r["decoded"]) for r in C.encode(docs, decoded=True).collect()} == {(i, f"text number {i}") for i in range(300)}


def test_segments_are_learnt_in_chunks(monkeypatch):
    monkeypatch.setattr(C, "LEARNT", 3)
    codec, theirs = C.Codec(C.prepared(public_model())), sentencepiece.SentencePieceProcessor(model_proto=public_model())
    texts = [" ".join(f"w{i}" for i in range(20)), "w3 again"]
    assert [list(C.unpacked(i)) for i in codec.encode(texts)] == theirs.encode(texts)


class Counting:
    """A tokenizer that counts the strings it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.given += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("name", ["bpe", "unigram", "unigram without bytes"])
def test_new_segments_share_strings(name, monkeypatch):
    """A string of the library holds many new segments, and each gets the ids it has alone."""
    monkeypatch.setattr(C, "JOINED", 100)
    spec = C.prepared(models()[name])
    codec, single = C.Codec(spec), C.Codec(spec)
    codec.tokenizer, single.joins = Counting(codec.tokenizer), False
    plain = [" ".join(f"w{i}é日 🎉{i}\nx\x00" for i in range(k, k + 200)) for k in range(0, 2000, 200)]
    assert codec.encode(plain) == single.encode(plain)
    assert (codec.tokenizer.given < 100) == (name != "unigram without bytes") and single.segments.size == 4000
    odd = ODD + ["<0x41> <unk> a", "ends  ", "   ", "b", " ⁇  ⁇ c", "▁ ▁"]
    assert codec.encode(odd) == single.encode(odd)


def test_surfaces_that_do_not_tell_are_not_used():
    """Ids that don't fill the segments, or cross them, or hold the unknown piece, are not shared out."""
    codec = C.Codec(C.prepared(public_model()))
    ids = lambda text: np.array(codec.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32)
    flat, sizes = codec._parted([" the", " end"], ids("the end"))
    assert flat.tolist() == ids("the end").tolist() and sizes.tolist() == [len(ids("the")), len(ids("end"))]
    assert codec._parted([" the", " end"], ids("the ends")) is None
    assert codec._parted([" t", "he"], ids("the")) is None
    assert codec._parted([" the", " end"], np.append(ids("the"), codec.unknown).astype(np.int32)) is None
    assert codec._parted([" the"], ids("")) is None
