"""Shards by a hierarchical weighted hash tree, in DataFrame functions only.

A row descends from regions to racks to shards. At each node every child draws ``-ln(u) / weight`` with u hashed
from the child's name and the row's key, and the least draw wins, so a child is chosen in proportion to its
weight. A changed weight moves rows only into or out of the subtree that holds it. A new shard opens a region of
its own: every other draw stays as it was, so rows move only into the new shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starload.llm.common import packed, unpacked

#: Parts of a shard that are numbered side by side.
PARTS = 1024


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def layout(shards: int, regions: int = 4, racks: int = 2) -> list[Shard]:
    """``shards`` equal shards, dealt evenly over regions and their racks."""
    return [Shard(f"g{s % regions}", f"k{s // regions % racks}", s) for s in range(shards)]


def grow(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, numbered after the greatest, in a region of its own."""
    number = max(s.shard for s in tree) + 1
    return [*tree, Shard(f"own{number}", "k0", number, weight)]


def _children(nodes: dict[str, float]) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("name"), F.lit(nodes[name]).alias("weight")) for name in sorted(nodes)])


def _winner(children: Column, key: Column) -> Column:
    """The name of the child with the least weighted draw; equal draws go to the first name."""

    def draw(child: Column) -> Column:
        # 52 bits of the hash, so that u lies strictly between 0 and 1
        bits = F.shiftrightunsigned(F.xxhash64(child["name"], key), 12)
        u = (bits + F.lit(0.5)) / F.lit(float(2**52))
        return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["name"].alias("name"))

    return F.array_min(F.transform(children, draw))["name"]


def with_shard(df: DataFrame, tree: list[Shard], key: str = "doc_id", name: str = "shard") -> DataFrame:
    """Add the shard (int) of each row's key; a null key is one more key of its own."""
    if not tree or min(s.weight for s in tree) <= 0 or len({s.shard for s in tree}) < len(tree):
        raise ValueError("a tree needs shards with different numbers and weights above zero")
    levels: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    for s in tree:
        path = ["", s.region, f"{s.region}/{s.rack}", f"{s.region}/{s.rack}/{s.shard}"]
        for level, parent, child in zip(levels, path, path[1:]):
            own = level.setdefault(parent, {})
            own[child] = own.get(child, 0.0) + s.weight
    out = packed(df, F.coalesce(F.col(key).cast("string"), F.lit("\x00null")).alias("key"), F.lit("").alias("at"))
    for level in levels:
        children = F.when(F.lit(False), _children(next(iter(level.values()))))
        for parent in sorted(level):
            children = children.when(F.col("at") == parent, _children(level[parent]))
        out = out.withColumn("at", _winner(children, F.col("key")))
    return unpacked(out.withColumn(name, F.substring_index("at", "/", -1).cast("int")), name)


def with_slots(df: DataFrame, order: list[str], shard: str = "shard", slot: str = "slot", parts: int = PARTS) -> DataFrame:
    """Number the rows of each shard from 0 without a gap.

    A shard is cut into ``parts`` by a hash of ``order``; rows are ranked within their part, and the totals of the
    parts before it, ``parts`` for each shard whatever the size of ``df``, are added. Rows equal in ``order``
    share a part and get its places in any order.
    """
    part = F.pmod(F.xxhash64(*order, F.lit("part")), F.lit(parts)).cast("int").alias("part")
    cut = packed(df, F.col(shard).alias("shard"), part, F.struct(*order).alias("order"))
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = df.select(F.col(shard).alias("shard"), part).groupBy("shard", "part").count()
    starts = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(W.partitionBy("shard", "part").orderBy("order")) - 1
    numbered = cut.withColumn("rank", rank).join(starts, ["shard", "part"])
    return unpacked(numbered.withColumn(slot, (F.col("start") + F.col("rank")).cast("long")), slot)


def sharded(docs: DataFrame, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs`` (doc_id, text).

    size is the text's UTF-8 bytes (none for a null) plus 16; text_crc32 of a null text is that of an empty one.
    The law is ``key``: doc_id and the tree decide, so repeated ids share a shard, as do all null ids.
    """
    tree = layout(shards)
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = with_shard(with_shard(rows, tree), grow(tree), name="grown_shard").withColumn("law", F.lit("key"))
    return with_slots(rows, ["doc_id", "text_crc32", "size"]).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
