"""Texts compressed for a shuffle: about half of what the shuffle's own compression of short blocks leaves."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F


def packed(text: Column) -> Column:
    """A text column (or binary) as compressed bytes; null stays null."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        compress = zstandard.ZstdCompressor(level=1).compress
        return pa.array([None if text is None else compress(text) for text in texts.to_pylist()], pa.binary())

    return pack(text.cast("binary"))


def unpacker() -> Callable[[bytes], bytes]:
    return zstandard.ZstdDecompressor().decompress
