"""Wavelet matrix over 16-bit token ids, in one compressed blob.

A level holds one bit of every id, most significant first; after each level the ids are put in
order of that bit, stably. Bits are cut into blocks, each compressed on its own, with a count of
the ones before it: a look-up opens one block a level, and all of them give back the sequence.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

LEVELS = 16
MAGIC = b"WVM1"

#: Bits of one block.
BLOCK_BITS = 1 << 17

#: Open blocks that a reader keeps.
OPEN_BLOCKS = 256

_HEAD = struct.Struct("<4sQI")


def build(ids: np.ndarray) -> bytes:
    """The blob of a sequence of 16-bit ids."""
    packer = zstandard.ZstdCompressor(level=1)
    row = pa.array(ids.astype("<u2"))
    blocks = -(-len(row) // BLOCK_BITS)
    zeros, ones, sizes, data = [], [], [], []
    for level in range(LEVELS):
        bit = row.to_numpy() & np.uint16(1 << (LEVELS - 1 - level)) != 0
        packed = np.packbits(bit, bitorder="little")
        mask = pa.Array.from_buffers(pa.bool_(), len(bit), [None, pa.py_buffer(packed)])
        row = pa.concat_arrays([row.filter(pc.invert(mask)), row.filter(mask)])
        zeros.append(len(bit) - int(np.count_nonzero(bit)))
        before = 0
        for at in range(0, len(bit), BLOCK_BITS):
            ones.append(before)
            before += int(np.count_nonzero(bit[at : at + BLOCK_BITS]))
            data.append(packer.compress(packed[at // 8 : (at + BLOCK_BITS) // 8].tobytes()))
            sizes.append(len(data[-1]))
    return b"".join([
        _HEAD.pack(MAGIC, len(ids), blocks),
        np.array(zeros, "<u8").tobytes(), np.array(ones, "<u8").tobytes(), np.array(sizes, "<u4").tobytes(),
        *data,
    ])


class Wavelet:
    """Reads one blob: access, rank, select, counting, occurrences, and the whole sequence."""

    def __init__(self, blob: bytes):
        magic, self.n, self.blocks = _HEAD.unpack_from(blob)
        if magic != MAGIC:
            raise ValueError("not a wavelet blob")
        at, cells = _HEAD.size, LEVELS * self.blocks
        self.zeros = np.frombuffer(blob, "<u8", LEVELS, at).tolist()
        at += 8 * LEVELS
        self.ones = np.frombuffer(blob, "<u8", cells, at).reshape(LEVELS, self.blocks)
        at += 8 * cells
        sizes = np.frombuffer(blob, "<u4", cells, at).astype(np.int64)
        ends = at + 4 * cells + np.cumsum(sizes)
        self.ends = ends.reshape(LEVELS, self.blocks)
        self.begins = (ends - sizes).reshape(LEVELS, self.blocks)
        self.blob = blob
        self.opener = zstandard.ZstdDecompressor()
        self._block = lru_cache(maxsize=OPEN_BLOCKS)(self._open)

    def _open(self, level: int, block: int) -> np.ndarray:
        raw = self.opener.decompress(self.blob[self.begins[level, block] : self.ends[level, block]])
        size = min(BLOCK_BITS, self.n - block * BLOCK_BITS)
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=size, bitorder="little").view(bool)

    def _ones_before(self, level: int, place: int) -> int:
        if place >= self.n:
            return self.n - self.zeros[level]
        block, rest = divmod(place, BLOCK_BITS)
        return int(self.ones[level, block]) + int(np.count_nonzero(self._block(level, block)[:rest]))

    def _bits(self, token: int):
        return ((level, token >> (LEVELS - 1 - level) & 1) for level in range(LEVELS))

    def access(self, place: int) -> int:
        """The token at a place."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        token = 0
        for level in range(LEVELS):
            block, rest = divmod(place, BLOCK_BITS)
            bit = int(self._block(level, block)[rest])
            ones = self._ones_before(level, place)
            place = self.zeros[level] + ones if bit else place - ones
            token = token << 1 | bit
        return token

    def rank(self, token: int, place: int) -> int:
        """How often the token stands before a place."""
        begin, end = 0, min(place, self.n)
        for level, bit in self._bits(token):
            first, last = self._ones_before(level, begin), self._ones_before(level, end)
            if bit:
                begin, end = self.zeros[level] + first, self.zeros[level] + last
            else:
                begin, end = begin - first, end - last
        return end - begin

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, nth: int) -> int:
        """The place of the token's nth occurrence, from 0."""
        begin = 0
        for level, bit in self._bits(token):
            ones = self._ones_before(level, begin)
            begin = self.zeros[level] + ones if bit else begin - ones
        if not 0 <= nth < self.count(token):
            raise IndexError(nth)
        place = begin + nth
        for level in reversed(range(LEVELS)):
            bit = token >> (LEVELS - 1 - level) & 1
            place = self._find(level, bit, place - self.zeros[level] if bit else place)
        return place

    def _find(self, level: int, bit: int, nth: int) -> int:
        """The place of a level's nth bit of a kind."""
        starts = np.arange(self.blocks, dtype=np.int64) * BLOCK_BITS
        before = self.ones[level].astype(np.int64)
        before = before if bit else starts - before
        block = int(np.searchsorted(before, nth, side="right")) - 1
        places = np.flatnonzero(self._block(level, block) == bool(bit))
        return block * BLOCK_BITS + int(places[nth - int(before[block])])

    def occurrences(self, token: int) -> list[int]:
        """Every place of the token, in order."""
        return [self.select(token, nth) for nth in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """The whole sequence, from the last level back to the first."""
        row = np.zeros(self.n, "<u2")
        for level in reversed(range(LEVELS)):
            bit = np.concatenate([self._open(level, block) for block in range(self.blocks)] or [np.zeros(0, bool)])
            earlier = np.empty_like(row)
            earlier[~bit] = row[: self.zeros[level]]
            earlier[bit] = row[self.zeros[level] :] | (1 << (LEVELS - 1 - level))
            row = earlier
        return row
