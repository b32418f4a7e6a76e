"""Words of many texts at once as 64-bit numbers, from their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _mask(inside) -> np.ndarray:
    return np.array([bool(inside(code)) for code in range(256)])


LOWER = _lowered()
IDENTITY = np.arange(256, dtype=np.uint8)
# Bytes of a multi-byte character are never in the ASCII ranges that part words.
NOT_BLANK = _mask(lambda code: code != 32 and not 9 <= code <= 13)
ALPHANUMERIC = _mask(
    lambda code: code >= 128 or 48 <= code <= 57 or 65 <= code <= 90 or 97 <= code <= 122
)
_VALUES = np.random.default_rng(20240131).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; a bijection."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(log2: int) -> tuple[np.ndarray, np.ndarray]:
    if log2 not in _TABLES:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(1 << log2, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _TABLES.clear()  # texts that need a larger table are rare
        _TABLES[log2] = (tables[0], tables[1])
    return _TABLES[log2]


def word_bounds(
    codes: np.ndarray, bounds: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one byte of each word; no word crosses from one text to the next."""
    member = inside[codes]
    opens = member.copy()
    opens[1:] &= ~member[:-1]
    closes = member.copy()
    closes[:-1] &= ~member[1:]
    edges = bounds[(bounds > 0) & (bounds < len(codes))]
    opens[edges] = member[edges]
    closes[edges - 1] = member[edges - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def hash_words(
    data: np.ndarray, bounds: np.ndarray, inside: np.ndarray, lower: np.ndarray = LOWER
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word, and the index of each text's first word.

    ``data`` holds the texts back to back, ``bounds`` their offsets. A word's number is a
    polynomial over its bytes, taken from running sums, so the cost does not depend on words.
    """
    codes = lower[data]
    starts, ends = word_bounds(codes, bounds, inside)
    if not len(codes):
        return np.zeros(0, np.uint64), starts, ends, np.zeros(len(bounds), np.int64)
    power, inverse = _powers(max(16, int(len(codes)).bit_length()))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_VALUES[codes] * power[: len(codes)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, starts, ends, np.searchsorted(starts, bounds).astype(np.int64)


_TURNS = [np.uint64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(1, 65)]


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; the whole sequence if it is shorter; none if empty."""
    if not len(words):
        return words
    width = min(width, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        total += words[k : len(words) - width + 1 + k] * _TURNS[k]
    # A short whole sequence never equals a full shingle by its length.
    return mix(total + np.uint64(width))
