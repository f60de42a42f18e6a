"""A Bloom bitmap of fixed size over 64-bit hashes: looks up without a join, never misses a member."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 25


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << BITS) - 1)
    return ((h >> np.uint64(64 - BITS)) & mask).astype(np.int64), (h & mask).astype(np.int64)


def bitmap(hashes: DataFrame, column: str = "h") -> np.ndarray:
    """Bitmap of a long column: 2 ** 25 bits (4 MB), of which 2 ** 19 words at most reach the driver."""
    place = F.explode(F.array(F.shiftrightunsigned(column, 64 - BITS), F.col(column).bitwiseAND(F.lit((1 << BITS) - 1))))
    words = hashes.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << BITS - 6, np.int64)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint8)


def known(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether each hash may be a member."""
    found = np.ones(len(h), bool)
    for place in _places(h):
        found &= (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
    return found


def may_hold(bits: np.ndarray, column: str | Column) -> Column:
    """Whether a long column's values may be members."""

    @F.arrow_udf("boolean")
    def looked_up(values: pa.Array) -> pa.Array:
        return pa.array(known(values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), bits))

    return looked_up(column)
