"""Static binary-fuse filters: about nine bits a key, one false positive in 256, no false negative."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import splitmix

_ATTEMPTS = 100


@dataclass(frozen=True)
class FuseFilter:
    """Three cells a key in three neighbouring segments; their xor is the key's fingerprint."""

    seed: int
    segment: int  # cells of a segment, a power of two
    segments: int  # segments in which a key may start
    cells: np.ndarray

    def __contains__(self, key: int) -> bool:
        return bool(self.contains(np.array([key], np.uint64))[0])

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """For each 64-bit key whether it may be among those the filter was made of."""
        places, prints = _places(keys, self.seed, self.segment, self.segments)
        return np.bitwise_xor.reduce(self.cells[places], axis=1) == prints


def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three cells and the fingerprint of each key."""
    hashed = splitmix(keys ^ splitmix(np.array([seed], np.uint64)))
    start = ((hashed >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
    offsets, mask = splitmix(hashed), np.uint64(segment - 1)
    second = (start + np.uint64(segment)) ^ (offsets & mask)
    third = (start + np.uint64(2 * segment)) ^ ((offsets >> np.uint64(20)) & mask)
    places = np.stack([start, second, third], axis=1).astype(np.int64)
    return places, (offsets >> np.uint64(56)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> FuseFilter:
    """The filter of distinct 64-bit keys; the same keys in any order give the same filter.

    A cell that one key alone uses can be set for that key last; taking such keys away frees further
    cells. Keys that go in one round share no cell of their own, so a round is done at once. Where
    keys are left that all share their cells, another seed is tried.
    """
    keys = np.sort(keys.astype(np.uint64))
    n = max(len(keys), 2)
    segment = 1 << min(int(np.log(n) / np.log(3.33) + 2.25), 18)
    room = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n)))
    segments = max(-(-room // segment) - 2, 1)
    size = (segments + 2) * segment
    for seed in range(_ATTEMPTS):
        places, prints = _places(keys, seed, segment, segments)
        rounds = _peeled(places, size)
        if rounds is None:
            continue
        cells = np.zeros(size, np.uint8)
        for gone, own in reversed(rounds):
            cells[own] = prints[gone] ^ np.bitwise_xor.reduce(cells[places[gone]], axis=1)
        return FuseFilter(seed, segment, segments, cells)
    raise ValueError("no seed tells the keys apart; are they distinct?")


def _peeled(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys taken away, the cell each had alone); None where some keys cannot go."""
    users = np.bincount(places.ravel(), minlength=size)
    who = np.zeros(size, np.int64)  # xor of the numbers of a cell's keys
    np.bitwise_xor.at(who, places.ravel(), np.repeat(np.arange(len(places)), 3))
    rounds, left, lone = [], len(places), np.flatnonzero(users == 1)
    while len(lone):
        gone, first = np.unique(who[lone], return_index=True)
        rounds.append((gone, lone[first]))
        left -= len(gone)
        touched = places[gone].ravel()
        np.subtract.at(users, touched, 1)
        np.bitwise_xor.at(who, touched, np.repeat(gone, 3))
        touched = np.unique(touched)
        lone = touched[users[touched] == 1]
    return None if left else rounds
