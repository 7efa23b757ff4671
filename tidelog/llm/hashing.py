"""Rolling hashes in numpy: of a text's words, and of all windows of a sequence."""

from __future__ import annotations

import numpy as np

# Odd multipliers of the polynomials, and a random number per byte.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PIECE = 1 << 20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers modulo 2^64, and those of its inverse, up to n - 1 at least."""
    known = _powers.get(multiplier)
    if known is None or len(known[0]) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        factors = [np.full(size, m, np.uint64) for m in (multiplier, pow(multiplier, -1, 1 << 64))]
        for f in factors:
            f[0] = 1
        known = tuple(np.cumprod(f) for f in factors)
        if size <= 1 << 22:  # larger ones, for very long texts, aren't kept
            _powers[multiplier] = known
    return known


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def ranges_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, multiplier: int) -> np.ndarray:
    """The polynomial hash of values[start:end] for each range."""
    up, down = powers(multiplier, len(values) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def windows_hash(values: np.ndarray, width: int, multiplier: int) -> np.ndarray:
    """The hash of each window of the width; none if there are fewer values."""
    starts = np.arange(max(0, len(values) - width + 1))
    return ranges_hash(values, starts, starts + width, multiplier)


def _pieces(text: bytes):
    """The text in pieces that end between words."""
    at = 0
    while len(text) - at > _PIECE:
        end = at + _PIECE
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(text: bytes) -> np.ndarray:
    """A hash per word (maximal run of bytes other than the six ASCII spaces), in order."""
    found = []
    for piece in _pieces(text):
        data = np.frombuffer(piece, np.uint8)
        inside = np.concatenate([[False], ~_SPACE[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        found.append(ranges_hash(BYTES[data], edges[::2], edges[1::2], MULTIPLIERS[2]))
    return np.concatenate(found)
