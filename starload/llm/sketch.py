"""Document fingerprints: bottom-k sketches of word shingles.

A sketch is the k least distinct hashes of a text's shingles. Sketches of parts merge into that of the whole; two
of them estimate resemblance and containment, and one estimates how many distinct shingles there are. With
fewer than k shingles all these are exact.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from starload.llm.common import prepared
from starload.llm.simhash import shingle_hashes

K = 128
SHINGLE = 5
#: Ranges of doc_id that are walked side by side, for each shuffle partition of the session.
RANGES_PER_PARTITION = 2


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k least distinct values, in order."""
    return np.unique(hashes)[:k]


def of_text(text: str, k: int = K, size: int = SHINGLE) -> np.ndarray:
    """Sketch of a text's shingles of ``size`` words; of all words if there are fewer, empty without words."""
    return sketch(shingle_hashes(text.encode(), size), k)


def merge(*parts: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of what the parts were made of."""
    return sketch(np.concatenate(parts), k) if parts else np.empty(0, np.uint64)


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness, 1 for two empty sketches."""
    union = merge(a, b, k=k)
    if not len(union):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(common, union[-1], "right")) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that are in b, 1 for an empty a."""
    if not len(a):
        return 1.0
    union = merge(a, b, k=k)
    return min(1.0, resemblance(a, b, k) * distinct_count(union, k) / distinct_count(a, k))


def encoded(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def decoded(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def with_sketch(docs: DataFrame, name: str = "sketch", text: str = "text", k: int = K, size: int = SHINGLE) -> DataFrame:
    """Add the encoded sketch of each text; a null text has the empty one."""
    prepared(docs.sparkSession)

    @F.arrow_udf("string")
    def made(texts: pa.Array) -> pa.Array:
        return pa.array([encoded(of_text(t or "", k, size)) for t in texts.to_pylist()], pa.string())

    return docs.withColumn(name, made(F.col(text)))


def merged_sketches(sketched: DataFrame, by: str, name: str = "sketch", k: int = K) -> DataFrame:
    """(by, sketch): one sketch for each value of ``by``, a null one included.

    Each task merges what it has read before the shuffle, so a group of any size arrives as one sketch a task.
    """
    prepared(sketched.sparkSession)
    rows = sketched.select(by, name)
    kind = to_arrow_type(rows.schema[by].dataType)

    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        texts = pa.array([encoded(x) for _, x in held], pa.string())
        return pa.RecordBatch.from_arrays([pa.array([key for key, _ in held], kind), texts], names=[by, name])

    def merged(batches: Iterator[pa.RecordBatch], hold: int) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = decoded(text or "")
                if key not in held and len(held) >= hold:
                    yield batch_of(list(held.items()))
                    held = {}
                held[key] = merge(held[key], part, k=k) if key in held else part
        yield batch_of(list(held.items()))

    first = rows.mapInArrow(lambda batches: merged(batches, 10_000), rows.schema)
    # sorted by key, so that one group is held at a time
    return first.repartition(by).sortWithinPartitions(by).mapInArrow(lambda batches: merged(batches, 1), rows.schema)


def _place(cuts: list[int], step: int = 128) -> Column:
    """How many of the sorted cuts lie below doc_id, by a look at every ``step``-th and then at one stretch."""

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda c: c < F.col("doc_id")))

    if not cuts:
        return F.lit(0)
    coarse = F.greatest(below(F.array(*map(F.lit, cuts[::step]))) - 1, F.lit(0)) * step
    return coarse + below(F.slice(F.array(*map(F.lit, cuts)), coarse + 1, step))


def _ranges(ids: DataFrame, parts: int) -> tuple[Column, list[tuple[int, int]], bool]:
    """Part number of a doc_id, the least id of each part that has any, and whether some id is null."""
    shares = [k / parts for k in range(1, parts)]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 10 * parts)).first()[0] if shares else []
    cuts = sorted(set(cuts or []))
    part = _place(cuts)
    least = ids.groupBy(part.alias("part")).agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("null"))
    found = least.collect()  # a row for each part
    return part, sorted((r.part, r.least) for r in found if r.least is not None), any(r.null for r in found)


def edited(text: str, following: str) -> str:
    """The text with its last half, rounded down, replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, guest, doc_id, text), sorted: each document meets the next.

    A guest is not returned: it follows the last document of a part (1), or all documents without an id (-1).
    """
    out: list[list] = [[] for _ in range(7)]
    waiting: list[tuple] = []  # rows of one doc_id, whose next document is not known yet
    part_now, id_now = None, None
    first: tuple | None = None  # what follows the documents without an id of this part

    def settle(following: str, following_sketch: np.ndarray) -> None:
        for doc_id, text, own in waiting:
            changed = edited(text, following)
            other = of_text(changed)
            digest = hashlib.sha256(changed.encode()).hexdigest()
            row = (doc_id, len(text), digest, encoded(own), encoded(other), resemblance(own, other), resemblance(own, following_sketch))
            for column, value in zip(out, row):
                column.append(value)
        waiting.clear()

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in EDITED.split(", ")]
    for batch in batches:
        for part, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            own = of_text(text)
            if part != part_now:
                first = None
            if guest < 0:
                first = (text, own)
            elif doc_id is None:
                waiting.append((doc_id, text, own))
                settle(*(first or (text, own)))
            else:
                if waiting and (doc_id != id_now or guest):
                    settle(text, own)
                if not guest:
                    waiting.append((doc_id, text, own))
            part_now, id_now = part, doc_id
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
        for column in out:
            column.clear()


def edited_fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprint of every text of ``docs`` (doc_id, text) and of its edited text, with their likeness.

    The edited text ends with the beginning of the next document by ascending doc_id, after the last of the first.
    A null text counts as an empty one. Of rows with equal ids the next document is that with the next greater
    id, in its least text; a null id is followed by the first document, or by itself if no id is known.
    An empty table gives no rows.

    Documents are dealt over ranges of doc_id and walked in order; of each range only the first document also
    goes to the range before it, so every text moves once. Rows with one id are few and lie in one range.
    """
    prepared(docs.sparkSession)
    ranges = ranges or RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    part, least, some_null = _ranges(rows.select("doc_id"), ranges)
    spread = F.pmod(F.xxhash64("text"), F.lit(ranges))
    home = F.when(F.col("doc_id").isNull(), -1 - spread).otherwise(part).cast("long")
    own = rows.select(home.alias("part"), F.lit(0).alias("guest"), "doc_id", "text")
    if not least:
        guests = own.filter("doc_id IS NULL").withColumn("guest", F.lit(1)).limit(0)
    else:
        before = {least[k][1]: least[k - 1][0] for k in range(len(least))}
        guest = F.lit(1).alias("guest")
        targets = F.array(*[F.struct(F.lit(i).cast("long").alias("id"), F.lit(p).cast("long").alias("part"), guest) for i, p in before.items()])
        guests = rows.filter(F.col("doc_id").isin(list(before)))
        to = F.transform(F.filter(targets, lambda t: t["id"] == F.col("doc_id")), lambda t: F.struct(t["part"].alias("part"), t["guest"].alias("guest")))
        if some_null:
            nulls = F.transform(F.sequence(F.lit(1), F.lit(ranges)), lambda p: F.struct((-p).cast("long").alias("part"), F.lit(-1).alias("guest")))
            to = F.when(F.col("doc_id") == least[0][1], F.concat(to, nulls)).otherwise(to)
        guests = guests.select(F.explode(to).alias("to"), "doc_id", "text").select("to.part", "to.guest", "doc_id", "text")
    walked = own.union(guests).repartition(ranges, "part").sortWithinPartitions("part", "guest", "doc_id", "text")
    return walked.mapInArrow(_walk, EDITED)
