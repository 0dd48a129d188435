"""Arrays of numbers as compressed bytes: their bytes in planes, so that empty high planes take no room."""

from __future__ import annotations

import numpy as np
import zstandard


def _squeezed(x: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _expanded(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed(keys: np.ndarray) -> bytes:
    """Ascending keys of 64 bits, by their differences."""
    return _squeezed(np.diff(keys, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_expanded(data, np.uint64), dtype=np.uint64)


def numbers(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in 32 bits each or, where one needs them, 64; the first byte says which."""
    wide = len(x) and int(x.max()) >= 1 << 32
    return (b"\x08" if wide else b"\x04") + _squeezed(x.astype(np.uint64 if wide else np.uint32))


def read(data: bytes) -> np.ndarray:
    return _expanded(data[1:], np.uint64 if data[:1] == b"\x08" else np.uint32)
