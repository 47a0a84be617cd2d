"""A static range asymmetric numeral system (rANS) over token ids, in numpy.

All blocks share one frequency table.  A block is coded by ``lanes``
interleaved states that take its ids in turn: id ``i`` belongs to lane
``i % lanes``, so one numpy step codes as many ids as there are lanes.  A state
is an unsigned 64-bit number in ``[2**31, 2**63)`` that gives away or takes in
32-bit words.  Every ``SECTION_STEPS`` steps the decoder's states are stored:
such a checkpoint begins a section, which is decoded without those before it
and has the checksum of its ids.

Layout of a block, all little-endian: the header ``HEADER`` (magic, scale bits,
lanes, ids, sections, checksum of the table, checksum of all that follows), for
each section its number of words and the CRC-32 of its ids as unsigned 32-bit
integers, the states of each section (64 bits a lane), the words (32 bits).
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

HEADER = "<4sIIIIII"
HEADER_SIZE = struct.calcsize(HEADER)
MAGIC = b"RWA1"
#: Ids of a block, the lanes of a full one, and steps from one checkpoint to the next.
BLOCK_IDS, LANES, SECTION_STEPS = 1 << 20, 1024, 256
#: Ids that a lane of a short block has at least, so that states stay a small part of it.
IDS_PER_LANE = 256
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


@dataclass(frozen=True)
class Table:
    """Frequencies of ids that sum to ``2 ** bits``; 0 for ids that never occur."""

    bits: int
    freq: np.ndarray  # uint64 by id

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[np.uint64(0)], np.cumsum(self.freq, dtype=np.uint64)[:-1]])

    @property
    def slots(self) -> np.ndarray:
        """The id of each of the ``2 ** bits`` slots."""
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))

    @property
    def checksum(self) -> int:
        return zlib.crc32(self.freq.astype("<u4").tobytes())


def table_of(counts: np.ndarray) -> Table:
    """Counts scaled to a power of two, at least four slots for each id that occurs; nothing occurring: an empty table.

    Every id that occurs keeps a slot.  What rounding leaves over or lacks is
    taken from, or given to, the most frequent ids.
    """
    occurs = np.flatnonzero(counts)
    bits = max(18, int(4 * len(occurs) - 1).bit_length()) if len(occurs) else 18
    freq = np.zeros(len(counts), dtype=np.int64)
    if len(occurs):
        share = counts[occurs].astype(np.float64) / float(counts[occurs].sum(dtype=np.float64))
        freq[occurs] = np.maximum(1, np.floor(share * (1 << bits)).astype(np.int64))
        order = occurs[np.argsort(-counts[occurs], kind="stable")]
        rest, at = (1 << bits) - int(freq.sum()), 0
        while rest:
            own = order[at % len(order)]
            step = rest if rest > 0 else -min(-rest, int(freq[own]) // 2)
            freq[own] += step
            rest -= step
            at += 1
    return Table(bits, freq.astype(np.uint64))


class Coder:
    """Encoder and decoder of blocks under one table."""

    def __init__(self, table: Table):
        self.bits, self.checksum = table.bits, table.checksum
        self.freq, self.starts, self.slots = table.freq, table.starts, table.slots

    def encode(self, ids: np.ndarray, max_lanes: int = LANES) -> bytes:
        """A block of the ids, all of which the table knows."""
        n = len(ids)
        lanes = max(1, min(max_lanes, n // IDS_PER_LANE))
        steps = -(-n // lanes)
        shift, grow = np.uint64(self.bits), np.uint64(63 - self.bits)
        state = np.full(lanes, _LOW, dtype=np.uint64)
        words: list[list[np.ndarray]] = [[] for _ in range(-(-steps // SECTION_STEPS))]
        states: list[np.ndarray] = [state] * len(words)
        for step in range(steps - 1, -1, -1):
            own = ids[step * lanes : (step + 1) * lanes]
            m = len(own)
            freq, start, x = self.freq[own], self.starts[own], state[:m]
            # In steps of a table's share: a larger state would leave its range.
            full = (x >> grow) >= freq
            words[step // SECTION_STEPS].append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x = np.where(full, x >> _WORD, x)
            whole, rest = np.divmod(x, freq)
            state[:m] = (whole << shift) + rest + start
            if step % SECTION_STEPS == 0:
                states[step // SECTION_STEPS] = state.copy()
        size = lanes * SECTION_STEPS
        body = bytearray()
        for k, own_words in enumerate(words):
            crc = zlib.crc32(ids[k * size : (k + 1) * size].astype("<u4").tobytes())
            body += struct.pack("<II", sum(map(len, own_words)), crc)
        for x in states:
            body += x.astype("<u8").tobytes()
        for own_words in words:  # written backwards, read forwards
            for w in reversed(own_words):
                body += w.tobytes()
        return struct.pack(HEADER, MAGIC, self.bits, lanes, n, len(words), self.checksum, zlib.crc32(body)) + bytes(body)

    def decode(self, block: bytes, first: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids ``first`` to ``stop`` (all) of a block, from the sections that hold them, side by side.

        A block that is damaged, or was made with another table, is an error.
        """
        magic, bits, lanes, n, sections, table, crc = struct.unpack_from(HEADER, block)
        if magic != MAGIC or bits != self.bits or table != self.checksum:
            raise ValueError("not a block of this table")
        if zlib.crc32(memoryview(block)[HEADER_SIZE :]) != crc:
            raise ValueError("damaged block")
        stop = n if stop is None else min(stop, n)
        if first >= stop:
            return np.zeros(0, dtype=np.uint32)
        size, at = lanes * SECTION_STEPS, HEADER_SIZE
        counts, sums = np.frombuffer(block, "<u4", 2 * sections, at).reshape(sections, 2).T.astype(np.int64)
        at += 8 * sections
        states = np.frombuffer(block, "<u8", sections * lanes, at).reshape(sections, lanes)
        words = np.frombuffer(block, "<u4", -1, at + states.nbytes).astype(np.uint64)
        chosen = range(first // size, (stop - 1) // size + 1)
        begins = np.concatenate([[0], np.cumsum(counts)])
        # The sections advance together, each from its checkpoint and its own words.
        state = states[chosen.start : chosen.stop].astype(np.uint64)
        place = begins[chosen.start : chosen.stop].copy()
        lengths = np.array([min(size, n - k * size) for k in chosen])
        out = np.zeros((len(chosen), size), dtype=np.uint32)
        mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
        lane = np.arange(lanes)
        for step in range(-(-int(lengths.max()) // lanes)):
            live = np.clip(lengths - step * lanes, 0, lanes)
            slot = state & mask
            ids = self.slots[slot.astype(np.int64)]
            x = self.freq[ids] * (state >> shift) + slot - self.starts[ids]
            if live.min() < lanes:  # the last section may end early
                active = lane < live[:, None]
                x = np.where(active, x, state)
            out[:, step * lanes : (step + 1) * lanes] = ids
            low = x < _LOW
            taken = low.sum(axis=1)
            if taken.any():
                source = np.repeat(place - np.concatenate([[0], np.cumsum(taken)[:-1]]), taken) + np.arange(int(taken.sum()))
                x[low] = (x[low] << _WORD) | words[source]
                place += taken
            state = x
        for k, row, length in zip(chosen, out, lengths):
            if zlib.crc32(row[:length].astype("<u4").tobytes()) != sums[k]:
                raise ValueError("damaged section")
        whole = np.concatenate([row[:length] for row, length in zip(out, lengths)])
        return whole[first - chosen.start * size : stop - chosen.start * size]


# Fixed value: the polynomial of CRC-32, lowest power first in the highest bit.
_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """The product of two polynomials modulo the CRC's."""
    product, bit = 0, 1 << 31
    while bit:
        if a & bit:
            product ^= b
        b = (b >> 1) ^ (_POLYNOMIAL if b & 1 else 0)
        bit >>= 1
    return product


def crc_followed_by(crc: int, zeros: int) -> int:
    """What a piece of data with checksum ``crc`` adds to the CRC-32 of data in which ``zeros`` bytes follow it:
    the exclusive or of all pieces' shares is the checksum of the whole."""
    power, square = 1 << 31, 1 << 23  # x**0, x**8
    while zeros:
        if zeros & 1:
            power = _times(power, square)
        square = _times(square, square)
        zeros >>= 1
    return _times(power, crc)
