"""A bitmap of hashed ids, of bounded size: what it lets through is then joined exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BITMAP_BITS = 1 << 27


def bitmap_of(ids: DataFrame, hashed: Column | None = None) -> np.ndarray:
    """One bit per hashed id in the column ``id``, at most ``BITMAP_BITS`` of them; ``hashed`` if not by ``xxhash64``."""
    bits, many = 1 << 16, ids.count()
    while bits < min(16 * many, BITMAP_BITS):
        bits *= 2
    place = (F.xxhash64("id") if hashed is None else hashed).bitwiseAND(F.lit(bits - 1))
    word = F.shiftright(place, 6).alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    rows = ids.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return out


def in_bitmap(hashed_ids: pa.Array, bitmap: np.ndarray) -> np.ndarray:
    """Whether each of the ``xxhash64`` of ids may be among those of the bitmap."""
    place = hashed_ids.to_numpy() & (64 * len(bitmap) - 1)
    return (bitmap[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0
