"""The words of many texts at once, as Arrow arrays."""

import numpy as np
import pyarrow as pa

#: Each byte as itself, A-Z as a-z.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def words_of(data: bytes, between: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, starts): the maximal runs of bytes that don't stand between words, A-Z in lower case, as a binary array, and the byte at which each starts. between: for each of the 256 bytes whether it does."""
    codes = np.frombuffer(data, dtype=np.uint8)
    inside = ~between[codes]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    kept = LOWER[codes[inside]]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]), starts
