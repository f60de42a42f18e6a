r"""The trie of conversation prefixes, with only possibly shared prefixes shuffled.

1. Every turn gets a digest and its place; texts do not move. Two 64-bit digests of every prefix come from running sums (exclusive or
   of the place and digest of its turns) over blocks of BLOCK places, so a conversation of any length is cut.
2. A count-min sketch of the prefix digests: an estimate of one proves that no other conversation has the prefix, nor a longer one.
   Such tails are emitted where they are. Only the other prefixes are grouped exactly.
3. A node is its conversation of smallest id, its owner, and its depth. What a conversation owns is the end of its path, from
   ``own_from`` on. So every total over a subtree is a sum over the members of its top, without walking the trie: a child or a
   leaf counts for its owner, and what a member saves is the words of its path before ``own_from``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starload.llm.common import prepared, stored
from starload.llm.countmin import maybe_repeated, repeated_bits, width

WORD = r"[^\x20\x09-\x0D]+"
#: Places of a conversation that are summed by one task.
BLOCK = 4096
#: Ids that go on as one row when those of a node's ends are joined.
IDS = 8192


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, start, n, digest, words) at the places from start on, and (conv_id, length) of every conversation.

    Turns are ordered by turn, null first, then by the digest of role and text, null as empty; n equal ones are one row. Rows without a conv_id
    belong to no conversation and are left out; extra columns are not read. The order is a range sort, so a
    conversation of any length lies in many parts.
    """
    prepared(conversations.sparkSession)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    turns = turns.groupBy("conv_id", "turn", "digest", "words").agg(F.count(F.lit(1)).alias("n"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carried = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv, n = batch.column("conv_id").to_numpy(), batch.column("n").to_numpy()
            if not len(conv):
                continue
            before = np.cumsum(n) - n
            first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            run = np.repeat(first, np.diff(np.append(first, len(conv))))
            start = before - before[run]
            if conv[0] == last:
                start[run == 0] += carried
            last, carried = conv[-1], int(start[-1] + n[-1])
            own = [pa.array(np.full(len(conv), part, np.int32)), pa.array(start)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *own, batch.column("n"), batch.column("digest"), batch.column("words")], ["conv_id", "part", "start", "n", "digest", "words"])

    order = ["conv_id", "turn", "digest"]
    rows = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(rows.mapInArrow(placed, "conv_id long, part int, start long, n long, digest binary, words int"), "turns")
    parts = rows.groupBy("conv_id", "part").agg(F.sum("n").alias("n"))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    moved = parts.withColumn("before", F.sum("n").over(before)).filter("before > 0").select("conv_id", "part", "before")
    rows = rows.join(stored(moved, "part-starts"), ["conv_id", "part"], "left")
    turns = rows.select("conv_id", (F.col("start") + F.coalesce("before", F.lit(0))).alias("start"), "n", "digest", "words")
    return turns, stored(parts.groupBy("conv_id").agg(F.sum("n").alias("length")), "lengths")


def rebuilt(turns: DataFrame, lengths: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """The same tables for conversations whose first h turns are those of the first of their group, h = crc32(conv_id) % most.

    The first is ``conv_id - conv_id % group``; it gives what it has, and nothing if it does not exist. A conversation
    without a turn left stays, with length 0. turns also gets the length of its conversation.
    """
    base = (F.col("conv_id") - F.col("conv_id") % group).alias("base")
    h = (F.crc32(F.col("conv_id").cast("string")) % most).alias("h")
    known = lengths.select("conv_id", "length", base, h)
    first = lengths.select(F.col("conv_id").alias("base"), F.col("length").alias("has")).filter(f"base % {group} = 0")
    given = F.least("h", F.coalesce("has", F.lit(0)))
    plans = known.join(first, "base", "left").select("conv_id", "base", "h", given.alias("given"), (given + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("length"))
    plans = stored(plans, "rebuilt-lengths")

    end = F.col("start") + F.col("n")
    own = turns.join(plans, "conv_id").withColumn("begin", F.greatest("start", "h")).filter(end > F.col("begin"))
    own = own.select("conv_id", (F.col("begin") - F.col("h") + F.col("given")).alias("start"), (end - F.col("begin")).alias("n"), "digest", "words", "length")
    heads = turns.filter(f"conv_id % {group} = 0 and start < {most - 1}").withColumnRenamed("conv_id", "base")
    heads = heads.join(plans, "base").withColumn("n", F.least(end, "h") - F.col("start")).filter("n > 0")
    return own.unionByName(heads.select("conv_id", "start", "n", "digest", "words", "length")), plans.select("conv_id", "length")


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, a_before, tokens, before, length), stored: digests and words of every prefix and words before its last turn."""
    cut = turns.select("*", F.explode(F.expr(f"sequence(start div {BLOCK}, (start + n - 1) div {BLOCK})")).alias("block")).repartition("conv_id", "block")
    place = F.explode(F.expr(f"sequence(greatest(start, block * {BLOCK}), least(start + n, (block + 1) * {BLOCK}) - 1)"))
    rows = cut.select("conv_id", "block", place.alias("place"), "digest", "words", "length")
    a, b = (F.xxhash64(F.lit(k), "place", F.substring("digest", 16 * k + 1, 16)) for k in range(2))
    along = W.partitionBy("conv_id", "block").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.select("conv_id", "block", "place", "words", "length", a.alias("own"), b.alias("own_b"))
    rows = rows.select("*", F.bit_xor("own").over(along).alias("a"), F.bit_xor("own_b").over(along).alias("b"), F.sum("words").over(along).alias("tokens"))
    rows = stored(rows.drop("own_b"), "prefixes")
    blocks = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    full = rows.filter(f"place % {BLOCK} = {BLOCK - 1}")
    full = full.select("conv_id", (F.col("block") + 1).alias("block"), F.bit_xor("a").over(blocks).alias("a0"), F.bit_xor("b").over(blocks).alias("b0"), F.sum("tokens").over(blocks).alias("tokens0"))
    rows = rows.join(stored(full, "block-starts"), ["conv_id", "block"], "left")
    tokens = F.col("tokens") + F.coalesce("tokens0", F.lit(0))
    a, b = F.col("a").bitwiseXOR(F.coalesce("a0", F.lit(0))), F.col("b").bitwiseXOR(F.coalesce("b0", F.lit(0)))
    return rows.select("conv_id", (F.col("place") + 1).alias("depth"), a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("own")).alias("a_before"), tokens.alias("tokens"), (tokens - F.col("words")).alias("before"), "length")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(owner, depth, ends_sha256) of rows (owner, depth, conv_id): the SHA-256 of the ids in ascending order, joined by commas.

    A range sort cuts the ids of one node over many tasks, which join them to pieces; one task then reads a node's pieces in order
    and holds one at a time.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, depth, conv = (batch.column(k).to_numpy() for k in range(3))
            if not len(conv):
                continue
            new = np.append(True, (owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1]))
            first = np.flatnonzero(new)
            cuts = sorted({*first, *(k for a, b in zip(first, [*first[1:], len(conv)]) for k in range(a, b, IDS))})
            pieces = [",".join(map(str, conv[a:b])) for a, b in zip(cuts, [*cuts[1:], len(conv)])]
            yield pa.RecordBatch.from_arrays([pa.array(owner[cuts]), pa.array(depth[cuts]), pa.array(conv[cuts]), pa.array(pieces)], ["owner", "depth", "conv_id", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()

        def rows(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"owner": o, "depth": d, "ends_sha256": x} for (o, d), x in found], pa.schema([("owner", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())]))

        for batch in batches:
            found = []
            for owner, depth, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                if node == (owner, depth):
                    state.update(b",")
                else:
                    if node is not None:
                        found.append((node, state.hexdigest()))
                    node, state = (owner, depth), hashlib.sha256()
                state.update(ids.as_py().encode())
            yield rows(found)
        if node is not None:
            yield rows([(node, state.hexdigest())])

    order = ["owner", "depth", "conv_id"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "owner long, depth long, conv_id long, ids string")
    return pieces.repartition("owner", "depth").sortWithinPartitions(*order).mapInArrow(hashed, "owner long, depth long, ends_sha256 string")


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    ``turns`` has (conv_id, start, n, digest, words, length), ``lengths`` (conv_id, length) of every conversation, also of those without a turn.
    conv_id is the smallest member; the node is that conversation's first ``depth`` turns. Without conversations there is no root and no row.
    """
    prefixes = _prefixes(turns)
    bits = width(prefixes.count())
    reached = repeated_bits(prefixes, bits, "a")
    shared, shared_before = maybe_repeated(bits, reached, "a"), maybe_repeated(bits, reached, "a_before")
    marked = prefixes.withColumn("shared", shared).withColumn("top", (F.col("depth") == 1) | shared_before)

    # exact grouping of the prefixes that are not proven single; only groups of several members are looked up
    common = stored(marked.filter("shared").select("conv_id", "depth", "a", "b", "tokens", "before", "length"), "shared-prefixes")
    groups = common.groupBy("depth", "a", "b").agg(F.min("conv_id").alias("owner"), F.max("length").alias("longest"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    members = common.join(stored(groups, "owners"), ["depth", "a", "b"], "left")
    members = members.select("conv_id", "depth", F.coalesce("owner", "conv_id").alias("owner"), F.coalesce("longest", "length").alias("longest"), "tokens", "before", "length")
    least, longest = lengths.agg(F.min("conv_id"), F.max("length")).first()
    none = F.lit(0).cast("long")
    root = lengths.select("conv_id", none.alias("depth"), F.lit(least).cast("long").alias("owner"), F.lit(longest).cast("long").alias("longest"), none.alias("tokens"), none.alias("before"), "length")
    members = stored(members.unionByName(root), "members")

    # along a path owners and words only grow, so the greatest of another owner are those of the deepest node not owned
    other, ends = F.col("owner") != F.col("conv_id"), F.col("depth") == F.col("length")
    paths = members.groupBy("conv_id").agg(
        F.coalesce(F.max(F.when(other, F.col("depth"))) + 1, none).alias("own_from"),
        F.max(F.when(other, F.col("owner"))).alias("above"),
        F.coalesce(F.max(F.when(other, F.col("tokens"))), none).alias("saved_to"),
        F.coalesce(F.max(F.when(ends, (~other & (F.col("longest") == F.col("length"))).cast("long"))), F.lit(1).cast("long")).alias("leaf"),
    )
    paths = stored(paths, "paths")

    parent = F.when(F.col("depth") > F.col("own_from"), F.col("conv_id")).otherwise(F.col("above"))
    child = F.col("depth").between(F.col("own_from") - 1, F.col("length") - 1)
    nodes = members.join(paths, "conv_id").groupBy("owner", "depth").agg(
        F.max(F.when(~other, parent)).alias("parent_conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(child.cast("long")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"), F.sum(F.greatest(F.col("saved_to") - F.col("before"), none)).alias("saved_tokens"),
    )
    digests = ends_digest(members.filter(ends))
    nothing = F.lit(hashlib.sha256().hexdigest())
    nodes = nodes.join(digests, ["owner", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)).withColumnRenamed("owner", "conv_id")

    tails = marked.filter("not shared")
    above = tails.filter("top").join(paths.select("conv_id", "own_from", "above"), "conv_id").withColumn("parent_conv_id", parent).drop("own_from", "above")
    tails = above.unionByName(tails.filter("not top").withColumn("parent_conv_id", F.col("conv_id")))
    one = F.lit(1).cast("long")
    tails = tails.select(
        "conv_id", "depth", "parent_conv_id", one.alias("n_convs"), (~ends).cast("long").alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens"),
        F.when(ends, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"),
    )
    return nodes.select(*tails.columns).unionByName(tails)
