"""Arrays of whole numbers as compressed bytes, for cells that hold many of them."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

HEAD = struct.Struct("<qB")


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes; high planes of small numbers vanish."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T[:width])
    return HEAD.pack(len(values), width) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(raw: bytes) -> np.ndarray:
    n, width = HEAD.unpack_from(raw)
    out = np.zeros((n, 8), dtype=np.uint8)
    if n and width:
        flat = pa.decompress(raw[HEAD.size :], n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(flat, dtype=np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.uint64)
