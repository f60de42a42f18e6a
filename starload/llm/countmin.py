"""A count-min sketch of 64-bit hashes whose counters stop at two: an estimate of one proves that a hash occurs once.

Every task counts its own hashes in ROWS rows of counters and sends the counters it touched, block by block; the blocks meet in one
shuffle, and only one bit a counter, whether it reached two, goes on. The width follows the number of hashes up to
MOST_BITS. Above that more hashes pass as possibly repeated, which costs work but never changes a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.wordhash import mixed

ROWS = 3
#: A row has 2 ** LEAST_BITS counters at least and 2 ** MOST_BITS at most; of each, one bit reaches the driver (16 MB a row at most).
LEAST_BITS, MOST_BITS = 16, 27
#: Counters of a block, whose places take two bytes.
BLOCK = 1 << 16
#: A task sends its counts after so many hashes.
HELD = 1 << 20
_SEEDS = [np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1) for k in range(ROWS)]


def width(hashes: int) -> int:
    """Bits of a counter's place, for four counters a hash or more."""
    return min(MOST_BITS, max(LEAST_BITS, (4 * max(hashes, 1) - 1).bit_length()))


def _places(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mixed(h ^ _SEEDS[row]) >> np.uint64(64 - bits)).astype(np.int64) + (row << bits)


def _hashes(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _counted(h: np.ndarray, bits: int) -> pa.RecordBatch:
    places, n = np.unique(np.concatenate([_places(h, row, bits) for row in range(ROWS)]), return_counts=True)
    blocks, first = np.unique(places // BLOCK, return_index=True)
    once, twice = [], []
    for a, b in zip(first, [*first[1:], len(places)]):
        own, many = (places[a:b] % BLOCK).astype(np.uint16), n[a:b] > 1
        once.append(own[~many].tobytes())
        twice.append(own[many].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["block", "once", "twice"])


def repeated_bits(hashes: DataFrame, bits: int, column: str = "h") -> np.ndarray:
    """Bits of all counters that reached two, ``2 ** bits`` counters a row, the rows one after the other."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(_hashes(batch.column(0)))
            if sum(map(len, held)) >= HELD:
                yield _counted(np.concatenate(held), bits)
                held = []
        if held:
            yield _counted(np.concatenate(held), bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(BLOCK, np.uint8)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(total >= 2).tobytes()], pa.binary())], ["block", "bits"])

        for batch in batches:
            for block, once, twice in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if block != at:
                    if at is not None:
                        yield done()
                    at, total = block, np.zeros(BLOCK, np.uint8)
                places = np.frombuffer(once.as_py(), np.uint16)
                total[places] = np.minimum(total[places] + 1, 2)
                total[np.frombuffer(twice.as_py(), np.uint16)] = 2
        if at is not None:
            yield done()

    parts = hashes.select(column).mapInArrow(count, "block int, once binary, twice binary")
    merged = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, bits binary").toArrow()
    out = np.zeros((ROWS << bits) // 8, np.uint8)
    for block, reached in zip(merged.column("block").to_pylist(), merged.column("bits").to_pylist()):
        out[block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(reached, np.uint8)
    return out


def maybe_repeated(bits: int, reached: np.ndarray, column: str | Column) -> Column:
    """Whether the estimate of a long column's values exceeds one; false proves that a value occurs once."""

    @F.arrow_udf("boolean")
    def looked_up(values: pa.Array) -> pa.Array:
        h = _hashes(values)
        found = np.ones(len(h), bool)
        for row in range(ROWS):
            place = _places(h, row, bits)
            found &= (reached[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)
        return pa.array(found)

    return looked_up(column)
