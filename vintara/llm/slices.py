"""64-bit XXH64 hashes, and comparison, of many slices of one byte string at once."""

from __future__ import annotations

import numpy as np
import xxhash

# The primes of XXH64.
P1 = np.uint64(11400714785074694791)
P2 = np.uint64(14029467366897019727)
P3 = np.uint64(1609587929392839161)
P4 = np.uint64(9650029242287828579)
P5 = np.uint64(2870177450012600261)

# Slices from this length are hashed by the library, one by one.
STRIPE = 32
PAD = 8


def padded(raw: bytes) -> np.ndarray:
    """The bytes and PAD more, so that eight bytes can be read at every place."""
    return np.frombuffer(raw + bytes(PAD), np.uint8)


def lanes(octets: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a little-endian number; no copy."""
    return np.ndarray((len(octets) - 7,), np.dtype("<u8"), octets.data, 0, (1,))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64(octets: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH64 with seed 0 of each slice of ``octets`` (see ``padded``)."""
    eight = lanes(octets)
    h = sizes.astype(np.uint64) + P5
    at = starts.copy()
    left = np.where(sizes < STRIPE, sizes, 0)
    for _ in range(STRIPE // 8 - 1):
        live = np.flatnonzero(left >= 8)
        if not len(live):
            break
        h[live] = _turned(h[live] ^ (_turned(eight[at[live]] * P2, 31) * P1), 27) * P1 + P4
        at[live] += 8
        left[live] -= 8
    live = np.flatnonzero(left >= 4)
    h[live] = _turned(h[live] ^ ((eight[at[live]] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
    at[live] += 4
    left[live] -= 4
    for _ in range(3):
        live = np.flatnonzero(left > 0)
        if not len(live):
            break
        h[live] = _turned(h[live] ^ (octets[at[live]] * P5), 11) * P1
        at[live] += 1
        left[live] -= 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    h ^= h >> np.uint64(32)
    for k in np.flatnonzero(sizes >= STRIPE):
        h[k] = xxhash.xxh64_intdigest(octets[starts[k] : starts[k] + sizes[k]].tobytes())
    return h


def equal(octets: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the slices at ``a`` and at ``b`` of the same ``sizes`` have the same bytes."""
    eight = lanes(octets)
    same = np.ones(len(a), bool)
    live = np.flatnonzero(a != b)
    done = 0
    while len(live):
        left = sizes[live] - done
        tail = np.where(left < 8, (np.uint64(1) << (np.minimum(left, 7) * 8).astype(np.uint64)) - np.uint64(1), np.uint64(2**64 - 1))
        good = ((eight[a[live] + done] ^ eight[b[live] + done]) & tail) == 0
        same[live[~good]] = False
        done += 8
        live = live[good & (left > 8)]
    return same
