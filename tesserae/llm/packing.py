"""Compressed arrays and lists for shuffles between chunks of documents and buckets of learned entries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def squeeze(x: bytes) -> bytes:
    return len(x).to_bytes(8, "little") + pa.compress(x, codec="zstd", asbytes=True)


def loosen(x: bytes) -> bytes:
    return pa.decompress(x[8:], decompressed_size=int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True)


def planes(x: np.ndarray, width: int) -> bytes:
    """Integers by byte, highest bytes of all first, compressed: bytes that hardly change cost next to nothing."""
    return squeeze(np.ascontiguousarray(x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T).tobytes())


def whole(x: bytes, n: int, width: int) -> np.ndarray:
    """The ``n`` integers of ``planes``."""
    b = np.zeros((n, 8), np.uint8)
    b[:, 8 - width :] = np.frombuffer(loosen(x), np.uint8).reshape(width, n).T
    return b.view(">u8").ravel().astype(np.int64)


def dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its rows in their order), by rising bucket."""
    by = np.argsort(bucket, kind="stable")
    cut = np.nonzero(bucket[by][1:] != bucket[by][:-1])[0] + 1
    for rows in np.split(by, cut):
        if len(rows):
            yield int(bucket[rows[0]]), rows
