"""Packed messages between blocks and buckets: sorted numbers as compressed differences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard


def squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueezed(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned integers as differences, byte by byte, compressed."""
    d = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return squeezed(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_sorted(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(unsqueezed(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel().cumsum(dtype=np.uint64)


def groups(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, start, stop) of each run of equal keys."""
    if not len(sorted_keys):
        return
    edges = np.flatnonzero(np.diff(sorted_keys, prepend=-1))
    for a, b in zip(edges.tolist(), np.append(edges[1:], len(sorted_keys)).tolist(), strict=True):
        yield int(sorted_keys[a]), a, b
