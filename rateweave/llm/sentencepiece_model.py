"""A SentencePiece ``.model`` file read without the sentencepiece library and
rebuilt as a pipeline of the ``tokenizers`` library.

The file is one protobuf message.  Only the fields that decide how a text is
cut are read: the pieces (text, score, type), the trainer's model type and
byte fallback, and the normaliser's flags and precompiled character map.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field

# Field numbers and enumerations of the published
# sentencepiece_model.proto, and the marker that stands for a space.
MODEL_PIECES, MODEL_TRAINER, MODEL_NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
TRAINER_MODEL_TYPE, TRAINER_BYTE_FALLBACK, TRAINER_SUFFIX_WS, TRAINER_UNK_SURFACE = 3, 35, 24, 44
NORM_CHARSMAP, NORM_DUMMY_PREFIX, NORM_REMOVE_EXTRA, NORM_ESCAPE = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"


@dataclass
class SentencePieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    treat_whitespace_as_suffix: bool = False
    unk_surface: str = " ⁇ "
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    @property
    def unk_id(self) -> int:
        return next(i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(data: bytes):
    """(field number, value) pairs of one message; nested messages and strings stay bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif wire == 5:
            value, at = struct.unpack_from("<f", data, at)[0], at + 4
        elif wire == 1:
            value, at = struct.unpack_from("<d", data, at)[0], at + 8
        else:
            raise ValueError(f"not a SentencePiece model: wire type {wire}")
        yield number, value


def parse_model(data: bytes) -> SentencePieceModel:
    """The parts of a serialised ``ModelProto`` that encoding and decoding need."""
    model = SentencePieceModel()
    for number, value in _fields(data):
        if number == MODEL_PIECES:
            piece = dict(_fields(value))
            model.pieces.append(
                (piece[PIECE_TEXT].decode("utf-8"), piece.get(PIECE_SCORE, 0.0), piece.get(PIECE_TYPE, NORMAL))
            )
        elif number == MODEL_TRAINER:
            spec = dict(_fields(value))
            model.model_type = spec.get(TRAINER_MODEL_TYPE, UNIGRAM)
            model.byte_fallback = bool(spec.get(TRAINER_BYTE_FALLBACK, 0))
            model.treat_whitespace_as_suffix = bool(spec.get(TRAINER_SUFFIX_WS, 0))
            if TRAINER_UNK_SURFACE in spec:
                model.unk_surface = spec[TRAINER_UNK_SURFACE].decode("utf-8")
        elif number == MODEL_NORMALIZER:
            spec = dict(_fields(value))
            model.charsmap = spec.get(NORM_CHARSMAP, b"")
            model.add_dummy_prefix = bool(spec.get(NORM_DUMMY_PREFIX, 1))
            model.remove_extra_whitespaces = bool(spec.get(NORM_REMOVE_EXTRA, 1))
            model.escape_whitespaces = bool(spec.get(NORM_ESCAPE, 1))
    if not model.pieces:
        raise ValueError("not a SentencePiece model: no pieces")
    if model.model_type not in (UNIGRAM, BPE):
        raise ValueError(f"model type {model.model_type} is neither unigram nor BPE")
    if model.treat_whitespace_as_suffix or not model.escape_whitespaces:
        raise ValueError("suffix or unescaped white space is not supported")
    return model


def spaces_only_lead(model: SentencePieceModel) -> bool:
    """True if no piece holds a marker after another character, so a cut in
    front of each run of markers can never fall inside a piece (the marker
    itself must be a piece, or unknown characters would join across the cut)."""
    texts = [text for text, _, _ in model.pieces]
    return SPACE in texts and not any(re.search(f"[^{SPACE}]{SPACE}", text) for text in texts)


def surfaces(model: SentencePieceModel) -> list[bytes]:
    """What each id contributes to a decoded text, as UTF-8."""
    found = []
    for text, _, kind in model.pieces:
        if kind == BYTE:
            found.append(bytes([int(text[1:-1], 16)]))
        elif kind == CONTROL:
            found.append(b"")
        else:
            found.append((model.unk_surface if kind == UNKNOWN else text.replace(SPACE, " ")).encode("utf-8"))
    return found


def bpe_merges(model: SentencePieceModel) -> list[tuple[str, str]]:
    """Every pair of pieces whose concatenation is a piece, best score first.

    SentencePiece merges the neighbouring pair whose joined piece scores best,
    however that piece is split, so each split becomes a merge rule.
    """
    ids = {text: i for i, (text, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for text, i in ids.items():
        score = model.pieces[i][1]
        for cut in range(1, len(text)):
            left, right = text[:cut], text[cut:]
            if left in ids and right in ids:
                found.append((-score, i, cut, left, right))
    found.sort()
    return [(left, right) for *_, left, right in found]


def build_tokenizer(model: SentencePieceModel):
    """A ``tokenizers.Tokenizer`` that cuts as SentencePiece does.

    Normaliser: the precompiled character map, white space squeezed if the
    model says so, the dummy prefix, spaces replaced by the marker.  Model:
    unigram scores, or merges ranked by score, with byte fallback.  Where no
    piece holds a marker behind another character the text is first cut in
    front of each run of markers; the result is the same and short segments
    are cached.
    """
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unk = model.unk_id
    if model.model_type == UNIGRAM:
        worst = min(score for _, score, kind in model.pieces if kind == NORMAL)
        # Controls and the unknown piece never match text: they get a name that no text has.
        vocab = [
            ("\uf8ff" + t if kind in (UNKNOWN, CONTROL) else t, s if kind in (NORMAL, USER_DEFINED) else worst)
            for t, s, kind in model.pieces
        ]
        core = models.Unigram(vocab, unk, model.byte_fallback)
    else:
        core = models.BPE(
            {text: i for i, (text, _, _) in enumerate(model.pieces)},
            bpe_merges(model),
            unk_token=model.pieces[unk][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    steps.append(normalizers.Replace(" ", SPACE))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if spaces_only_lead(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}*[^{SPACE}]+|{SPACE}+"), "isolated")
    user = [AddedToken(t, normalized=False) for t, _, kind in model.pieces if kind == USER_DEFINED]
    if user:
        tokenizer.add_tokens(user)
    parts = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.add_dummy_prefix:
        parts.append(decoders.Strip(content=" ", left=1, right=0))
    tokenizer.decoder = decoders.Sequence(parts)
    return tokenizer
