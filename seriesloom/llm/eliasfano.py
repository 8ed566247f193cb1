"""Elias-Fano sequences in flat byte arrays, read in vectors straight from a memory map."""

from __future__ import annotations

import numpy as np

WORDS = 4  # 64-bit words between two directory entries


def _pack_low(values: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(8, np.uint8)
    out = np.zeros(((len(values) * bits + 7) // 8 + 8) * 8, np.uint8)
    for b in range(bits):
        out[np.arange(len(values)) * bits + b] = (values >> np.uint64(b)) & np.uint64(1)
    return np.packbits(out, bitorder="little")


class EliasFano:
    """A non-decreasing sequence of whole numbers: low bits side by side, high bits in unary with a sampled directory."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.bits, self.low, self.high, self.ones = n, bits, low, high, ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
        place = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        span = ((top >> bits) + n + 2 + 64 * WORDS) // (64 * WORDS) + 1
        flags = np.zeros(span * 64 * WORDS, np.uint8)
        flags[place] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(high).reshape(span, WORDS).sum(axis=1)
        return cls(n, bits, _pack_low(values & np.uint64((1 << bits) - 1), bits), high, np.append(0, np.cumsum(counts)).astype(np.int64))

    def arrays(self) -> dict[str, np.ndarray]:
        return {"shape": np.array([self.n, self.bits], np.int64), "low": self.low, "high": self.high, "ones": self.ones}

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, bits = arrays[name + ".shape"].tolist()
        return cls(n, bits, *(arrays[f"{name}.{c}"] for c in ("low", "high", "ones")))

    def _select(self, k: np.ndarray, zeros: bool) -> np.ndarray:
        """Place of the k-th (from 0) one or zero in the unary part."""
        directory = np.arange(len(self.ones)) * 64 * WORDS - self.ones if zeros else self.ones
        block = np.searchsorted(directory, k, "right") - 1
        word, left = block * WORDS, k - directory[block]
        more = np.ones(len(k), bool)
        bits = np.zeros(len(k), np.uint64)
        for _ in range(WORDS):
            w = self.high[np.minimum(word, len(self.high) - 1)]
            bits = np.where(more, ~w if zeros else w, bits)
            count = np.bitwise_count(bits).astype(np.int64)
            more = more & (left >= count)
            left = np.where(more, left - count, left)
            word = word + more
            if not more.any():
                break
        place = word * 64
        for width in (32, 16, 8, 4, 2, 1):
            half = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            over = left >= half
            left = np.where(over, left - half, left)
            bits = np.where(over, bits >> np.uint64(width), bits)
            place = place + np.where(over, width, 0)
        return place

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.bits
        out = np.zeros(len(i), np.uint64)
        for b in range((self.bits + 7 + 7) // 8):
            out |= self.low[(at >> 3) + b].astype(np.uint64) << np.uint64(8 * b)
        return (out >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = (self._select(i, False) - i).astype(np.uint64)
        return (high << np.uint64(self.bits) | self._low(i)).astype(np.int64)

    def find(self, value: np.ndarray) -> np.ndarray:
        """Place of the first element not below each value (next greater or equal); n if there is none."""
        value = np.maximum(value, 0)
        high = value >> self.bits
        last = self._select(np.array([self.n - 1]), False)[0] - (self.n - 1) if self.n else -1
        inside = high <= last
        out = np.full(len(value), self.n, np.int64)
        h = high[inside]
        lo = np.where(h > 0, self._select(np.maximum(h - 1, 0), True) - np.maximum(h - 1, 0), 0)
        hi = self._select(h, True) - h
        target = (value[inside] & ((1 << self.bits) - 1)).astype(np.uint64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            below = np.zeros(len(lo), bool)
            below[open_] = self._low(mid[open_]) < target[open_]
            lo = np.where(open_ & below, mid + 1, lo)
            hi = np.where(open_ & ~below, mid, hi)
        out[inside] = lo
        return out
