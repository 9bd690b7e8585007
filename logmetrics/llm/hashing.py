"""64-bit rolling hashes of byte ranges, for numpy."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BYTE = np.random.default_rng(4).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64)] * 2


def _grown(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for later calls."""
    if n > len(_powers[0]):
        n = max(n, 2 * len(_powers[0]), 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def prefix_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, down): ``(sums[b] - sums[a]) * down[a]`` is a hash of the bytes a to b - 1
    that does not depend on where they stand."""
    up, down = _grown(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    return sums, down


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all its bits (multiply and shift, twice)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ranges_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range, never 0, whatever its place."""
    sums, down = prefix_sums(raw)
    h = mix((sums[ends] - sums[starts]) * down[starts]) ^ (ends - starts).astype(np.uint64)
    h[h == 0] = 1
    return h


class HashTable:
    """Hashes (not 0) to the numbers in which they were added: open addressing with
    linear probing, looked up many at a time."""

    def __init__(self, capacity: int):
        self.bits = max(8, (2 * capacity - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)  # 0: free
        self.entry = np.zeros(1 << self.bits, dtype=np.int32)
        self.n = 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each hash, or -1."""
        out = np.full(len(h), -1, dtype=np.int64)
        left = np.arange(len(h))
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(left):
            key = self.keys[slot]
            hit = key == h[left]
            out[left[hit]] = self.entry[slot[hit]]
            more = ~hit & (key != 0)
            left, slot = left[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, h: np.ndarray) -> None:
        """Add distinct hashes that are not in the table."""
        mask = (1 << self.bits) - 1
        for key, slot in zip(h, (h >> np.uint64(64 - self.bits)).tolist(), strict=True):
            while self.keys[slot]:
                slot = (slot + 1) & mask
            self.keys[slot] = key
            self.entry[slot] = self.n
            self.n += 1
