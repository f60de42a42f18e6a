"""Change feeds applied to a table: each key holds what its last writer wrote, however often and in whatever order feeds arrive."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.columns import any_null
from starload.operators.changes import DELETE, INSERT, OP

SEQ, GONE = "_seq", "_gone"


def numbered_feed(feed: DataFrame, seq: int) -> DataFrame:
    """A feed of ``change_feed`` as the ``seq``-th one; all its rows are written by it."""
    return feed.withColumn(SEQ, F.lit(seq).cast("long"))


def replayable(table: DataFrame, seq: int = 0) -> DataFrame:
    """The state feeds are applied to: the rows of a table, as written by feed number ``seq``."""
    return table.select("*", F.lit(seq).cast("long").alias(SEQ), F.lit(False).alias(GONE))


def replay(state: DataFrame, feeds: list[DataFrame], keys: list[str]) -> DataFrame:
    """The state after the numbered feeds.

    Of all rows of a key, stored and fed, the one with the greatest sequence number stays; a delete stays as a row that is gone, so
    that an older feed that arrives late, or again, does not bring its key back. So applying a feed twice, or feeds in another order, gives the
    same state. Rows of one feed that disagree on a key are settled by their values, a delete last. The last row
    is the greatest struct, which each task finds before the shuffle: a key with very many changes sends one row per task.
    Rows with a null key match nothing: they are kept as they are, once for each different row.
    """
    rest = [name for name in state.columns if name not in (*keys, SEQ, GONE)]
    rows = [state.select(*keys, SEQ, GONE, *rest)]
    for feed in feeds:
        gone = (F.col(OP) == DELETE).alias(GONE)
        rows.append(feed.select(*keys, F.col(SEQ).cast("long"), gone, *rest))
    every = reduce(DataFrame.unionByName, rows)
    last = every.filter(~any_null(keys)).groupBy(*keys).agg(F.max(F.struct(SEQ, GONE, *rest)).alias("_last"))
    known = last.select(*keys, "_last.*")
    unknown = every.filter(any_null(keys) & ~F.col(GONE)).groupBy(*keys, GONE, *rest).agg(F.min(SEQ).alias(SEQ))
    return known.unionByName(unknown).select(*state.columns)


def visible(state: DataFrame) -> DataFrame:
    """The table a state stands for."""
    return state.filter(~F.col(GONE)).drop(SEQ, GONE)


def forget(state: DataFrame, before: int) -> DataFrame:
    """The state without the deletes of feeds before a number, once none of those can arrive any more."""
    return state.filter(~F.col(GONE) | (F.col(SEQ) >= before))


def insert_feed(rows: DataFrame, seq: int) -> DataFrame:
    """New rows as a feed of their own, for sources that only append."""
    return numbered_feed(rows.withColumn(OP, F.lit(INSERT)), seq)
