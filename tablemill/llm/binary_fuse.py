"""Static filters of 64-bit keys: three-wise binary fuse filters with 8-bit fingerprints.

A key has one slot in each of three neighbouring segments, and the three slots' values together give its fingerprint.
A filter takes about nine bits a key. It answers yes for all of its keys and for about one in 256 others. Sizes and
segment lengths are those of the published construction. Keys are peeled in rounds: all that are alone in a slot at
once, so a round is a few array operations.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np

_TRIES = 100


class FuseFilter(NamedTuple):
    seed: int
    segment: int  # slots in a segment, a power of two
    segments: int  # first segments that a key can have; there are two more
    values: bytes

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """True for every key of the filter, false for nearly all others."""
        if not self.values:
            return np.zeros(len(keys), bool)
        slots, prints = _places(keys, self.seed, self.segment, self.segments)
        values = np.frombuffer(self.values, np.uint8)
        return values[slots[0]] ^ values[slots[1]] ^ values[slots[2]] == prints


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    keys = (keys ^ (keys >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return keys ^ (keys >> np.uint64(33))


def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of each key, and its fingerprint."""
    first = _mixed(keys.astype(np.uint64) + np.uint64(seed))
    second = _mixed(first + np.uint64(0x9E3779B97F4A7C15))
    at = ((second >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    mask, bits = np.uint64(segment - 1), segment.bit_length() - 1
    slots = np.stack([(at + np.uint64(k)) * np.uint64(segment) + ((first >> np.uint64(k * bits)) & mask) for k in range(3)])
    return slots.astype(np.int64), (second & np.uint64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> FuseFilter:
    """The filter of these keys (any 64-bit integers; repeats count once). No keys give a filter that holds nothing."""
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    if not n:
        return FuseFilter(0, 1, 1, b"")
    bits = min(18, int(math.log(n) / math.log(3.33) + 2.25)) if n > 1 else 2
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segment = 1 << bits
    segments = max(1, math.ceil(n * factor / segment) - 2)
    for seed in range(1, _TRIES):
        slots, prints = _places(keys, seed, segment, segments)
        rounds = _peeled(slots, (segments + 2) * segment)
        if rounds is not None:
            break
        segments += seed % 4 == 0  # a hopeless size must not stay
    else:
        raise RuntimeError(f"no filter of {n} keys after {_TRIES} tries")
    values = np.zeros((segments + 2) * segment, np.uint8)
    for key, slot in reversed(rounds):
        others = slots[:, key]
        values[slot] = prints[key] ^ values[others[0]] ^ values[others[1]] ^ values[others[2]]
    return FuseFilter(seed, segment, segments, values.tobytes())


def _peeled(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Keys with a slot that no key of a later round has, round by round; none if some keys cannot be peeled."""
    n = slots.shape[1]
    count = np.bincount(slots.ravel(), minlength=size)
    total = np.bincount(slots.ravel(), np.tile(np.arange(n, dtype=np.float64), 3), size).astype(np.int64)
    rounds, left = [], n
    alone = np.flatnonzero(count == 1)
    while len(alone):
        key, first = np.unique(total[alone], return_index=True)
        rounds.append((key, alone[first]))
        left -= len(key)
        touched = slots[:, key].ravel()
        np.subtract.at(count, touched, 1)
        np.subtract.at(total, touched, np.tile(key, 3))
        touched = np.unique(touched)
        alone = touched[count[touched] == 1]
    return None if left else rounds
