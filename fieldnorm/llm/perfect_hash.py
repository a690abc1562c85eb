"""A minimal perfect hash over distinct 64-bit keys, as stacked bit arrays."""

from __future__ import annotations

import struct

import numpy as np

from fieldnorm.llm.words import mixed

SPREAD = 2  # bits for each key of a level


class PerfectHash:
    """Maps each of n keys to its own place from 0 to n - 1.

    On each level a key marks one bit. Bits marked by one key stay, the other keys go to the
    next level. A key's place is the number of marked bits before its own. A key that is not
    in the set gets some place or -1; who asks must compare a fingerprint.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        before = np.cumsum([0, *[int(bits.sum()) for bits in levels]])
        self.ranks = [np.cumsum(bits, dtype=np.int64) - 1 + n for bits, n in zip(levels, before[:-1], strict=True)]

    @staticmethod
    def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (mixed(keys ^ salt) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(64, SPREAD * len(keys))
            bit = cls._bit(keys, len(levels), size)
            alone = np.bincount(bit, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[bit]]
        return cls(levels)

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            bit = self._bit(keys[left], level, len(bits))
            marked = bits[bit]
            out[left[marked]] = ranks[bit[marked]]
            left = left[~marked]
        return out

    def dump(self) -> bytes:
        sizes = [len(bits) for bits in self.levels]
        head = struct.pack(f"<{len(sizes) + 1}q", len(sizes), *sizes)
        return head + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def load(cls, raw: bytes) -> PerfectHash:
        (n,) = struct.unpack_from("<q", raw)
        sizes, at, levels = struct.unpack_from(f"<{n}q", raw, 8), 8 * (n + 1), []
        for size in sizes:
            packed = np.frombuffer(raw, np.uint8, -(-size // 8), at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return cls(levels)
