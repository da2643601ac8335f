"""xxhash64 of 64-bit integers in numpy, bit for bit what Spark's ``xxhash64`` gives for BIGINT columns."""

from __future__ import annotations

import numpy as np

#: The primes of the public XXH64 algorithm.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9),
    np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5),
)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def hash_long(value: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """One step: the hash of int64 ``value`` under ``seed`` (an array of the same length or a number), as uint64."""
    with np.errstate(over="ignore"):
        seed = np.uint64(seed) if isinstance(seed, int) else seed.view(np.uint64)
        h = seed + _P5 + np.uint64(8)
        h = h ^ (_rotl(value.view(np.uint64) * _P2, 31) * _P1)
        h = _rotl(h, 27) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


def xxhash64(*columns: np.ndarray) -> np.ndarray:
    """Equal to ``xxhash64(c1, c2, ...)`` over non-null BIGINT columns, as int64."""
    h: np.ndarray | int = 42
    for column in columns:
        h = hash_long(np.ascontiguousarray(column, dtype=np.int64), h)
    return h.view(np.int64)
