"""Static binary-fuse filters (three slots, eight-bit fingerprints) over 64-bit keys."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

# A 64-bit mixing function, and the slot layout published for three slots.
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
LAYOUT_BASE, LAYOUT_SHIFT, LEAST_FACTOR = 3.33, 2.25, 1.125
MAX_SEGMENT = 1 << 18
ATTEMPTS = 100


@dataclass(frozen=True)
class FuseFilter:
    """Answers "maybe" for every key it was built from and for about one in 256 others."""

    seed: int
    segment: int
    segments: int
    slots: bytes

    @staticmethod
    def build(keys: np.ndarray) -> FuseFilter:
        """From distinct uint64 keys, in vectorised peeling rounds."""
        n = len(keys)
        segment, segments = _layout(n)
        for seed in range(ATTEMPTS):
            hashed = _mixed(keys, seed)
            places = _places(hashed, segment, segments)
            order = _peel(places, (segments + 2) * segment)
            if order is None:
                continue
            slots = np.zeros((segments + 2) * segment, dtype=np.uint8)
            marks = _marks(hashed)
            for members, own in reversed(order):
                others = slots[places[members]]
                value = marks[members] ^ np.bitwise_xor.reduce(others, axis=1)
                # The own slot still holds zero, so it does not change the sum.
                slots[own] = value
            return FuseFilter(seed, segment, segments, slots.tobytes())
        raise ValueError("keys are not distinct")

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        hashed = _mixed(keys, self.seed)
        slots = np.frombuffer(self.slots, dtype=np.uint8)
        found = slots[_places(hashed, self.segment, self.segments)]
        return np.bitwise_xor.reduce(found, axis=1) == _marks(hashed)


def _layout(n: int) -> tuple[int, int]:
    """Length and number of the segments a key's first slot may lie in."""
    if n < 2:
        return 4, 1
    segment = min(MAX_SEGMENT, 1 << int(math.log(n) / math.log(LAYOUT_BASE) + LAYOUT_SHIFT))
    factor = max(LEAST_FACTOR, 0.875 + 0.25 * math.log(1_000_000) / math.log(n))
    return segment, max(1, -(-round(n * factor) // segment) - 2)


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
        for factor in MIX:
            h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _marks(hashed: np.ndarray) -> np.ndarray:
    return ((hashed ^ (hashed >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)


def _places(hashed: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """The three slots of each key, one in each of three consecutive segments."""
    high = hashed >> np.uint64(32)
    first = ((high * np.uint64(segments * segment)) >> np.uint64(32)).astype(np.int64)
    mask = segment - 1
    second = (first + segment) ^ ((hashed >> np.uint64(18)).astype(np.int64) & mask)
    third = (first + 2 * segment) ^ (hashed.astype(np.int64) & mask)
    return np.stack([first, second, third], axis=1)


def _peel(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot each has alone); None if some keys cannot be separated."""
    n = len(places)
    numbers = np.arange(n, dtype=np.int64)
    counts = np.bincount(places.ravel(), minlength=size)
    sums = np.zeros(size, dtype=np.int64)
    for column in range(3):
        np.bitwise_xor.at(sums, places[:, column], numbers)
    left, rounds = n, []
    alone = np.flatnonzero(counts == 1)
    while len(alone):
        members, at = np.unique(sums[alone], return_index=True)
        rounds.append((members, alone[at]))
        left -= len(members)
        touched = places[members]
        np.subtract.at(counts, touched.ravel(), 1)
        for column in range(3):
            np.bitwise_xor.at(sums, touched[:, column], members)
        near = np.unique(touched)
        alone = near[counts[near] == 1]
    return None if left else rounds
