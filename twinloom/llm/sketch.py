"""Word shingles of a text and their MinHash values, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

SEED = 20_240_229
#: Shingles times functions worked on at once: keeps the table in the processor's cache.
CELLS = 1 << 17
BLOCK = 2048
ODD = 0x9E3779B97F4A7C15


def _space_and_lower() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return lower, space


LOWER, SPACE = _space_and_lower()


class TextCodes:
    """Codes of the words of a text: words are separated by ASCII white space, A-Z count as a-z.

    A word's code is the sum of a random number for each byte times a power of an odd number,
    modulo 2**64, so that one running sum over a text gives the codes of all its words.
    """

    def __init__(self, seed: int = SEED):
        self.byte_codes = np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64)
        self.back = np.uint64(pow(ODD, -1, 1 << 64))
        self._grow(1 << 12)

    def _grow(self, size: int) -> None:
        self.powers = np.cumprod(np.full(size, ODD, np.uint64))
        self.inverse = np.cumprod(np.full(size, self.back, np.uint64))

    def words(self, text: str | None) -> tuple[np.ndarray, bytes]:
        """Codes of the words, and the words themselves with one space between them."""
        raw = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
        if not len(raw):
            return np.empty(0, np.uint64), b""
        if len(raw) > len(self.powers):
            self._grow(2 * len(raw))
        space = SPACE[raw]
        inside = ~space
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return np.empty(0, np.uint64), b""
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.byte_codes[raw] * self.powers[: len(raw)], out=sums[1:])
        codes = (sums[ends] - sums[starts]) * self.inverse[starts]
        codes ^= codes >> np.uint64(32)
        kept = inside.copy()
        kept[ends[:-1]] = True  # the first blank after each word
        raw[space] = 32
        return codes, raw[kept].tobytes()


def digest_of(words: bytes) -> bytes:
    """The same for two texts of the same words in the same order."""
    return hashlib.sha256(words).digest()


def shingle_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words; of all words, if fewer."""
    if not len(codes):
        return codes
    width = min(width, len(codes))
    runs = len(codes) - width + 1
    mixed = np.full(runs, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ codes[k : k + runs]) * np.uint64(ODD)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    mixed.sort()
    return mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))]


def shingle_set(words: bytes, width: int) -> set:
    """The shingles themselves, to confirm a link with."""
    parts = words.split()
    if not parts:
        return set()
    width = min(width, len(parts))
    return set(zip(*(parts[k : len(parts) - width + 1 + k] for k in range(width))))


class MinHash:
    """Function i maps a shingle hash h to ((h ^ flips[i]) * factors[i]) modulo 2**32."""

    def __init__(self, values: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.flips = rng.integers(0, 1 << 32, values, np.uint32)
        self.factors = rng.integers(0, 1 << 32, values, np.uint32) | np.uint32(1)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The least value of each function over a set; all ones for an empty set."""
        low = shingles.astype(np.uint32)
        least = np.full(len(self.flips), 0xFFFFFFFF, np.uint32)
        step = max(1, CELLS // max(1, min(len(low), BLOCK)))
        for at in range(0, len(low), BLOCK):
            part = low[at : at + BLOCK]
            for i in range(0, len(least), step):
                block = part[None, :] ^ self.flips[i : i + step, None]
                block *= self.factors[i : i + step, None]
                np.minimum(least[i : i + step], block.min(axis=1), out=least[i : i + step])
        return least


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each signature and band; equal keys mean equal rows of that band."""
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        keys = (keys ^ parts[:, :, k]) * np.uint64(ODD)
        keys ^= keys >> np.uint64(31)
    keys *= np.uint64(0x94D049BB133111EB)
    return (keys ^ (keys >> np.uint64(30))).view(np.int64)
