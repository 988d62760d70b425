"""What several operators of this subpackage need."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.session import cut as checkpoint  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex64(value: Column) -> Column:
    """A BIGINT as 16 lowercase hex digits of its bits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def mix(keys: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    keys = keys ^ (keys >> np.uint64(32))
    keys = keys * np.uint64(0xD6E8FEB86659FD93)
    keys ^= keys >> np.uint64(32)
    keys *= np.uint64(0xD6E8FEB86659FD93)
    keys ^= keys >> np.uint64(32)
    return keys


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending unsigned keys as differences, each in as few bytes as the largest one takes.

    The highest bytes, which are small and uneven, are entropy-coded; the others of hashed keys cannot be.
    """
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    steps[0] = 0
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    planes = steps.view(np.uint8).reshape(-1, 8)[1:, :width]
    low = np.ascontiguousarray(planes[:, :-1]).tobytes()
    top = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes[:, -1]).tobytes())
    return bytes([width]) + int(keys[0]).to_bytes(8, "little") + len(planes).to_bytes(8, "little") + low + top


def unpack_keys(packed: bytes) -> np.ndarray:
    """The keys that ``pack_keys`` wrote."""
    if not packed:
        return np.zeros(0, np.uint64)
    width, n = packed[0], int.from_bytes(packed[9:17], "little")
    end = 17 + n * (width - 1)
    steps = np.zeros((n + 1, 8), np.uint8)
    steps[1:, : width - 1] = np.frombuffer(packed[17:end], np.uint8).reshape(n, width - 1)
    steps[1:, width - 1] = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[end:]), np.uint8)
    out = steps.reshape(-1).view("<u8")
    out[0] = int.from_bytes(packed[1:9], "little")
    return np.cumsum(out, dtype=np.uint64)
