"""Hashes of words and word shingles of many texts at once, with numpy."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes of text hashed in one go; powers of the base are kept for as many.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of the words of byte strings; words lie between ASCII white space, A-Z lower-cased."""

    def __init__(self):
        self.power = self._powers(_BASE, CHUNK)
        self.inverse = self._powers(_INVERSE, CHUNK)

    @staticmethod
    def _powers(base: np.uint64, n: int) -> np.ndarray:
        out = np.full(n + 1, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and where those of each text begin (one more at the end)."""
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        if len(self.power) <= bounds[-1]:
            self.power, self.inverse = self._powers(_BASE, int(bounds[-1])), self._powers(_INVERSE, int(bounds[-1]))
        raw = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
        letter = ~_SPACE[raw]
        edge = np.diff(letter.astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * self.power[:len(raw)], out=total[1:])
        hashes = mix((total[end] - total[start]) * self.inverse[start] + (end - start).astype(np.uint64) * _STEP)
        return hashes, np.searchsorted(start, bounds[:-1].tolist() + [len(raw)])

    def groups(self, texts: list[bytes]):
        """Lists of neighbouring texts, of about ``CHUNK`` bytes together, with their numbers."""
        at = 0
        while at < len(texts):
            size, end = len(texts[at]) + 1, at + 1
            while end < len(texts) and size + len(texts[end]) + 1 <= CHUNK:
                size, end = size + len(texts[end]) + 1, end + 1
            yield at, texts[at:end]
            at = end

    def shingle_sets(self, texts: list[bytes], size: int):
        """Per text the sorted distinct hashes of its shingles of ``size`` words, or of all words if fewer."""
        for _, part in self.groups(texts):
            hashes, at = self.words(part)
            rolled = np.zeros(len(hashes), dtype=np.uint64)
            full = max(len(hashes) - size + 1, 0)
            for k in range(size):
                rolled[:full] = rolled[:full] * _STEP + hashes[k:k + full]
            rolled = mix(rolled)
            for a, b in zip(at[:-1], at[1:], strict=True):
                if b - a >= size:
                    yield np.unique(rolled[a:b - size + 1])
                elif b > a:
                    whole = np.uint64(0)
                    for h in hashes[a:b]:
                        whole = np.uint64((int(whole) * int(_STEP) + int(h)) & 0xFFFFFFFFFFFFFFFF)
                    yield mix(np.array([int(whole) ^ int(b - a)], dtype=np.uint64))
                else:
                    yield np.empty(0, dtype=np.uint64)
