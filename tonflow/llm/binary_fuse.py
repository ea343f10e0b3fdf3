"""Static binary-fuse filters over 64-bit keys, in numpy.

A key has three places, in three neighbouring segments of one array, and is in the filter when
the fingerprints at its places xor to its own.  The array is filled by peeling: places that only one
key left uses are given to that key, in rounds, and filled in reverse.  About nine bits a key; a
key that is not in is taken for one that is with probability 1/256.  Sizes follow the published
rules for three places.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_MOST_SEEDS = 100


@dataclass
class BinaryFuse:
    seed: int
    segment: int
    segments: int
    fingerprints: np.ndarray

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """False only for keys that are not in."""
        if not len(self.fingerprints):
            return np.zeros(len(keys), bool)
        mixed = _mix(keys, self.seed)
        at = _places(mixed, self.segment, self.segments)
        found = self.fingerprints[at[0]] ^ self.fingerprints[at[1]] ^ self.fingerprints[at[2]]
        return found == _fingerprint(mixed)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer: every bit of the key changes every bit of the result."""
    h = keys.view(np.uint64) + np.uint64(seed)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _fingerprint(mixed: np.ndarray) -> np.ndarray:
    return (mixed ^ (mixed >> np.uint64(32))).astype(np.uint8)


def _places(mixed: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three places for each key."""
    mask = np.uint64(segment - 1)
    first = ((mixed >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
    second = (first + np.uint64(segment)) ^ ((mixed >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (mixed & mask)
    return np.stack([first, second, third]).astype(np.int64)


def build(keys: np.ndarray) -> BinaryFuse:
    """The filter of these 64-bit integers; repeated keys count once."""
    keys = np.unique(keys)
    n = len(keys)
    if not n:
        return BinaryFuse(0, 1, 1, np.zeros(0, np.uint8))
    segment = min(1 << 18, 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1_000_000) / np.log(max(n, 2)))
    segments = max(1, -(-int(n * factor) // segment) - 2)
    for attempt in range(_MOST_SEEDS):
        seed = (0x9E3779B97F4A7C15 * (attempt + 1)) % (1 << 64)
        mixed = _mix(keys, seed)
        at = _places(mixed, segment, segments)
        rounds = _peel(at, (segments + 2) * segment)
        if rounds is not None:
            break
        if attempt % 8 == 7:
            segments += max(1, segments // 8)
    else:
        raise RuntimeError(f"no binary-fuse filter for {n} keys")
    prints, array = _fingerprint(mixed), np.zeros((segments + 2) * segment, np.uint8)
    for key, place in reversed(rounds):
        own = at[:, key]
        others = array[own[0]] ^ array[own[1]] ^ array[own[2]]  # the key's own place is still 0
        array[place] = prints[key] ^ others
    return BinaryFuse(seed, segment, segments, array)


def _peel(at: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Keys and their places, round by round; None if some keys can't be placed."""
    n = at.shape[1]
    count, keys = np.zeros(size, np.int32), np.zeros(size, np.int64)
    for places in at:
        np.add.at(count, places, 1)
        np.bitwise_xor.at(keys, places, np.arange(n))
    rounds, left = [], n
    single = np.flatnonzero(count == 1)
    while len(single):
        key, first = np.unique(keys[single], return_index=True)
        place = single[first]
        rounds.append((key, place))
        left -= len(key)
        touched = at[:, key]
        for places in touched:
            np.subtract.at(count, places, 1)
            np.bitwise_xor.at(keys, places, key)
        touched = np.unique(touched)
        single = touched[count[touched] == 1]
    return rounds if left == 0 else None
