"""Token ids of many texts at once, for tokenizers that keep words apart.

Where a tokenizer drops white space, a text's ids are its words' ids in a row.
Words of a batch are found and hashed by numpy, only those that the process has
not met are given to the tokenizers library, and the batch's ids are gathered
from a pool.  Any other tokenizer gets the whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array

import numpy as np

from rateweave.llm._common import MULTIPLIERS, _powers, mixed

#: Words and their ids that a process remembers at most; beyond, it starts anew.
MAX_WORDS, MAX_POOL = 2_000_000, 16_000_000
#: Words beyond this length are hashed one by one.
LONG = 256
# The normaliser and pre-tokeniser that are recognised, as the tokenizer's file spells them.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# A sign that ends a word, after something that is no plain letter or digit: it may belong to a run of signs.
_RUN = re.compile(r"[.,](?= )(?<![0-9A-Za-zÀ-ÖØ-öø-ÿ][.,])")
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes are
    themselves, the others, in order, the characters from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def canonical(text: str) -> str:
    """A text with the same ids whose words vary less: in small letters, line ends as spaces, and a
    comma or full stop after a word apart from it.  Only what is sure to make no difference is changed."""
    try:
        text.encode("latin-1")
        text = text.lower()
    except UnicodeEncodeError:
        pass
    text = text.replace("\n", " ")
    if _RUN.search(text) is None:
        text = text.replace(", ", " , ").replace(". ", " . ")
    return text


class WordTokens:
    def __init__(self, data: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        spec = json.loads(data)
        self.tokenizer = Tokenizer.from_str(data)
        self.model = self.tokenizer.model
        self.apart = spec["normalizer"] == NORMALIZER and spec["pre_tokenizer"] == PRE_TOKENIZER
        # Special tokens inside a text would be found across spaces only if they held one.
        self.apart = self.apart and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        self.alphabet = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})
        self.kind = np.uint32 if self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16 else np.uint16
        self._forget()

    def _forget(self) -> None:
        none = np.zeros(0, dtype=np.int64)
        # Sorted hashes with place and number of their ids in the pool: most of them, and the latest.
        self.known = [[none.astype(np.uint64), none, none], [none.astype(np.uint64), none, none]]
        self.pool, self.used = np.zeros(1 << 16, dtype=self.kind), 0

    def _learn(self, words: list[str]) -> list[list[int]]:
        plain = [_PLAIN.fullmatch(w) is not None for w in words]
        # A run of small letters is one word of the model, in its byte alphabet.
        tokenize, alphabet = self.model.tokenize, self.alphabet
        other = iter(self.tokenizer.encode_batch_fast([w for w, p in zip(words, plain) if not p], add_special_tokens=False))
        return [
            [t.id for t in tokenize(w.encode().decode("latin-1").translate(alphabet))] if p else next(other).ids
            for w, p in zip(words, plain)
        ]

    def _remember(self, hashes: np.ndarray, words: list[str]) -> None:
        """Learn words; ``hashes`` ascend."""
        ids = self._learn(words)
        sizes = np.array([len(i) for i in ids], dtype=np.int64)
        flat = np.array(array("I", [x for i in ids for x in i]), dtype=self.kind)
        if self.used + len(flat) > len(self.pool):
            grown = np.zeros(max(2 * len(self.pool), self.used + len(flat)), dtype=self.kind)
            grown[: self.used] = self.pool[: self.used]
            self.pool = grown
        self.pool[self.used : self.used + len(flat)] = flat
        begins = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        self.known[1] = self._merged(self.known[1], [hashes, begins, sizes])
        if len(self.known[1][0]) > 1 << 16:
            self.known = [self._merged(*self.known), [x[:0] for x in self.known[1]]]

    @staticmethod
    def _merged(one: list[np.ndarray], two: list[np.ndarray]) -> list[np.ndarray]:
        both = [np.concatenate(pair) for pair in zip(one, two)]
        order = np.argsort(both[0], kind="stable")
        return [x[order] for x in both]

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of words begin in the pool, -1 for unknown ones, and how many they are."""
        begins, sizes = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        for keys, at, size in self.known:
            if len(keys):
                found = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[found] == hashes
                begins[hit], sizes[hit] = at[found[hit]], size[found[hit]]
        return begins, sizes

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each followed by ``end_id``, and each text's number of ids with that."""
        if not self.apart:
            coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            sizes = np.array([len(c.ids) + 1 for c in coded], dtype=np.int64)
            return np.array([i for c in coded for i in (*c.ids, end_id)], dtype=self.kind), sizes
        if len(self.known[0][0]) > MAX_WORDS or self.used > MAX_POOL:
            self._forget()
        texts = [canonical(t) for t in texts]
        joined = " ".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        # Word k lies between gaps k and k + 1.
        gaps = np.concatenate([[-1], np.flatnonzero(points == 32), [len(points)]])
        begins, ends = gaps[:-1] + 1, gaps[1:]
        begins, ends = begins[begins < ends], ends[begins < ends]
        owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begins, side="right")
        up, down = _powers(len(points) + 1)
        sums = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * np.uint64(MULTIPLIERS[0]) * up[: len(points)], out=sums[1:])
        hashes = mixed((sums[ends] - sums[begins]) * down[begins])
        for k in np.flatnonzero(ends - begins > LONG):
            raw = joined[begins[k] : ends[k]].encode("utf-8", "surrogatepass")
            hashes[k] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
        distinct, first, same = np.unique(hashes, return_index=True, return_inverse=True)
        places, sizes = self._places(distinct)
        if (places < 0).any():
            new = places < 0
            self._remember(distinct[new], [joined[begins[k] : ends[k]] for k in first[new]])
            places, sizes = self._places(distinct)
        places, sizes = places[same], sizes[same]
        total = int(sizes.sum())
        source = np.repeat(places - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
        counts = np.bincount(owner, sizes, minlength=len(texts)).astype(np.int64)
        ids = np.insert(self.pool[source], np.cumsum(counts), self.kind(end_id))
        return ids, counts + 1
