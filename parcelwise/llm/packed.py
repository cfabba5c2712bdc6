"""Long integers as compressed bytes, for rows that hold many of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(numbers: np.ndarray, ascending: bool = False) -> bytes:
    """Their count, then their bytes plane by plane; of ascending numbers the steps are kept."""
    values = np.diff(numbers, prepend=0) if ascending else numbers
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(data: bytes, ascending: bool = False) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    values = np.ascontiguousarray(planes.T).view("<i8").reshape(-1)
    return np.cumsum(values) if ascending else values
