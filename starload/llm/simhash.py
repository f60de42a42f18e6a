"""SimHash near-duplicates by a hierarchical index over fingerprints in Gray order.

Fingerprints of 64 bits are cut into five blocks. Two of them with at most three differing bits agree on
two whole blocks at least, so every pair of blocks keys one table and a link is found in one table or more.
Within a table's bucket the fingerprints are sorted by Gray rank; runs of them become nodes, which hold the
bits all members share under a mask, and runs of nodes become upper nodes. The search descends pairs of nodes
and drops a pair as soon as the shared bits differ in more than the allowed places, so whole groups go at once.

Buckets are pieces of a shuffle, found by their key alone. A bucket of more than ``BUCKET`` fingerprints is cut by its next bits
in Gray order into parts, and only parts whose prefixes can still match meet: exact, with bounded groups of
work. A group gives a spanning forest of its links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import packed, prepared, stored, text_bytes, unpacked, words_of
from starload.llm.components import components

BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
DISTANCE = 3
FANOUT = 16
BUCKET = 20_000
FRONTIER = 1 << 20


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 with seed 42 of each run of ``size`` words, space-joined; of all words if there are fewer."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    count = max(1, len(words) - size + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: count - 1])).tolist()
    stops = (ends[min(size, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops)), np.uint64, count)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if more than half of the hashes have it; no hashes give zero."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255 * 256):
        part = hashes[at : at + 255 * 256]
        part = np.concatenate((part, np.zeros(-len(part) % 255, np.uint64)))
        # one byte a bit, eight of them in a word: 255 rows add up without a carry between bytes
        lanes = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
        sums = lanes.reshape(-1, 255, 8).sum(axis=1)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, name: str = "fp", text: str = "text", shingle: int = 3) -> DataFrame:
    """Add the fingerprint of each text as a signed long."""
    prepared(docs.sparkSession)

    @F.arrow_udf("long")
    def of_text(texts: pa.Array) -> pa.Array:
        found = [fingerprint(shingle_hashes(t, shingle)) for t in texts.to_pylist()]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return docs.withColumn(name, of_text(text_bytes(text)))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def build_index(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the codes up: the shared bits of each node and the mask of where they are shared."""
    levels = [(codes, np.full(len(codes), np.uint64(0xFFFFFFFFFFFFFFFF)))]
    ones, zeros = codes, ~codes  # bits set, and bits clear, in all members
    while len(ones) > FANOUT:
        cuts = np.arange(0, len(ones), FANOUT)
        ones, zeros = np.bitwise_and.reduceat(ones, cuts), np.bitwise_and.reduceat(zeros, cuts)
        levels.append((ones, ones | zeros))
    return levels


def close_pairs(codes: np.ndarray, distance: int = DISTANCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions i < j of codes, sorted in Gray order, at most ``distance`` bits apart; in bounded pieces."""
    levels = build_index(codes)
    top = np.arange(len(levels[-1][0]))
    i, j = (x.ravel() for x in np.meshgrid(top, top, indexing="ij"))
    stack = [(len(levels) - 1, i[i <= j], j[i <= j])]
    while stack:
        level, i, j = stack.pop()
        if len(i) > FRONTIER:
            stack += [(level, i[at : at + FRONTIER], j[at : at + FRONTIER]) for at in range(0, len(i), FRONTIER)]
            continue
        shared, mask = levels[level]
        near = np.bitwise_count((shared[i] ^ shared[j]) & mask[i] & mask[j]) <= distance
        i, j = i[near], j[near]
        if level == 0:
            other = i < j
            yield i[other], j[other]
        elif len(i):
            piece, below = max(1, FRONTIER // FANOUT**2), len(levels[level - 1][0])
            for at in range(0, len(i), piece):
                a = (i[at : at + piece, None, None] * FANOUT + np.arange(FANOUT)[:, None]).repeat(FANOUT, 2).ravel()
                b = (j[at : at + piece, None, None] * FANOUT + np.arange(FANOUT)[None, :]).repeat(FANOUT, 1).ravel()
                kept = (a <= b) & (b < below)
                stack.append((level - 1, a[kept], b[kept]))


def forest(codes: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links (code, root) that connect what the close pairs of distinct codes connect: at most one a code."""
    codes = codes[np.argsort(gray_rank(codes))]
    root = np.arange(len(codes))
    for i, j in close_pairs(codes, distance):
        while len(i):
            a, b = root[i], root[j]
            differ = a != b
            if not differ.any():
                break
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    moved = root != np.arange(len(codes))
    return codes[moved], codes[root[moved]]


def bucket_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of the buckets in a partition sorted by (t, k, part); one bucket is held at a time."""

    def linked(codes: np.ndarray) -> pa.RecordBatch:
        u, v = forest(np.unique(codes))
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    held, key = [], None
    for batch in batches:
        columns = [batch.column(x).to_numpy() for x in range(3)]
        codes = batch.column(3).to_numpy().view(np.uint64)
        changed = np.zeros(len(codes), bool)
        for x in columns:
            changed[1:] |= x[1:] != x[:-1]
        cuts = [0, *np.flatnonzero(changed).tolist(), len(codes)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            own = tuple(int(x[a]) for x in columns)
            if own != key and held:
                if sum(map(len, held)) > 1:
                    yield linked(np.concatenate(held))
                held = []
            key = own
            held.append(codes[a:b])
    if sum(map(len, held)) > 1:
        yield linked(np.concatenate(held))


def _block(at: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1))


def _joined_bits(blocks) -> Column:
    """Blocks of bits, one after another, as a number."""
    total = F.lit(0).cast("long")
    for at, width in blocks:
        total = F.shiftleft(total, width).bitwiseOR(_block(at, width))
    return total


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``fp`` that connect all those at most three bits apart."""
    keyed = []
    for t, pair in enumerate(combinations(BLOCKS, len(BLOCKS) - DISTANCE)):
        rest = [x for x in BLOCKS if x not in pair]
        width = sum(w for _, w in rest)
        keyed.append(
            F.struct(
                F.lit(t).alias("t"),
                _joined_bits(pair).alias("k"),
                F.shiftleft(_joined_bits(rest), 40 - width).alias("rest"),  # 40 bits, the first blocks leading
            )
        )
    rows = fps.select("fp", F.explode(F.array(*keyed)).alias("x")).select("x.*", "fp")
    large = rows.groupBy("t", "k").count().filter(F.col("count") > bucket)
    # the parts' prefix in bits; few buckets are large, and those join by Spark's own choice
    large = large.select("t", "k", F.ceil(F.log2(F.col("count") / bucket)).cast("int").alias("bits"))
    rows = rows.join(large, ["t", "k"], "left")
    own = F.expr("shiftright(rest, 40 - least(bits, 16))")
    meet = F.filter(F.sequence(F.lit(0).cast("long"), F.expr("shiftleft(1L, least(bits, 16)) - 1")), lambda x: F.bit_count(x.bitwiseXOR(own)) <= DISTANCE)
    parts = F.transform(meet, lambda x: F.shiftleft(F.least(x, own), 16).bitwiseOR(F.greatest(x, own)))
    rows = rows.select("t", "k", F.explode(F.when(F.col("bits").isNull(), F.array(F.lit(0).cast("long"))).otherwise(parts)).alias("part"), "fp")
    sorted_rows = rows.repartition("t", "k", "part").sortWithinPartitions("t", "k", "part")
    return sorted_rows.mapInArrow(bucket_forests, "u long, v long")


def near_groups(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text; other columns are not read).

    A null text counts as an empty one. Without words the fingerprint is zero and links like any other.
    component_id is the least doc_id reachable, null if all in the component are null. Repeated rows share
    a component; an empty table gives no rows.
    """
    marked = stored(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "fingerprints")
    return marked.join(fingerprint_components(marked, bucket), "fp").select("doc_id", "fp", "component_id")


def fingerprint_components(marked: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(fp, component_id, keep_fp) for each distinct fingerprint of ``marked`` (doc_id, fp).

    keep_fp belongs to the least (doc_id, fp) of the component, nulls last.
    """
    fps = marked.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(links(fps, bucket))
    named = fps.join(roots.withColumnRenamed("u", "fp"), "fp", "left")
    # only fingerprints with a link need their component's least document
    linked = named.withColumn("root", F.coalesce("root", "fp")).withColumn("first", F.struct(F.col("least_id").isNull().alias("none"), "least_id", "fp"))
    first = linked.groupBy("root").agg(F.min("first").alias("first"))
    return linked.select("fp", "root").join(first, "root").select("fp", F.col("first.least_id").alias("component_id"), F.col("first.fp").alias("keep_fp"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component of near-duplicates, with all columns of ``docs``.

    It is the row with the least doc_id (nulls last, then by fingerprint); of rows with equal id and
    fingerprint one stays. The rows are stored with their fingerprints, which are computed once.
    """
    marked = stored(with_fingerprint(packed(docs, "doc_id", "text")).drop("text"), "fingerprints")
    keep = fingerprint_components(marked.select("doc_id", "fp")).filter("fp = keep_fp").select("fp", F.col("component_id").alias("keep_id"))
    kept = marked.join(keep, "fp").filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return unpacked(kept.dropDuplicates(["fp"]))
