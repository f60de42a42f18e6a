"""Outcome of an extraction, computed from its request log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starload.sources.paged import UNLIMITED, Limits


def _hit(count: Column, limit: int) -> Column:
    return F.lit(False) if limit == UNLIMITED else count >= limit


def error_runs(log: DataFrame, param: str, seq: str, chunk: Column) -> DataFrame:
    """Longest run of consecutive failures per parameter.

    A failure belongs to the run named by the number of successes before it. That
    running count is built in two steps, within chunks of the sequence and then over
    the chunk totals, so no task has to sort all requests of a busy parameter.
    ``chunk`` has to grow with ``seq`` (for example ``seq`` divided by a constant).
    """
    marked = log.select(
        F.col(param).alias("_param"), F.col(seq).alias("_seq"), chunk.alias("_chunk"),
        F.when(F.col("_ok"), 1).otherwise(0).cast("long").alias("_good"),
    )
    totals = marked.groupBy("_param", "_chunk").agg(F.sum("_good").alias("_good"))
    before = W.partitionBy("_param").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_param", "_chunk", F.coalesce(F.sum("_good").over(before), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy("_param", "_chunk").orderBy("_seq").rowsBetween(W.unboundedPreceding, 0)
    placed = marked.withColumn("_within", F.sum("_good").over(inside)).filter("_good = 0")
    runs = placed.join(offsets, ["_param", "_chunk"]).groupBy(
        "_param", (F.col("_offset") + F.col("_within")).alias("_run")
    ).count()
    return runs.groupBy(F.col("_param").alias(param)).agg(F.max("count").alias("max_consecutive_errors"))


def audit_requests(
    log: DataFrame,
    param: str,
    seq: str,
    succeeded: Column,
    is_end: Column,
    chunk: Column,
    limits: Limits = Limits(),
    reader: str | None = None,
) -> DataFrame:
    """Pages, executions, errors, longest error run and outcome of each parameter.

    ``reader`` names the column that tells the readers of a parameter apart; each has a sequence of its own, so
    its error runs and its end are looked for in its own requests. A parameter is a success only if the last
    request of every reader reported the end of the data; otherwise the limit that stopped it is named. The request that
    reports the end is neither a page nor an execution.
    """
    whose = F.struct(F.col(param).alias("param"), (F.col(reader) if reader else F.lit(0)).alias("reader"))
    flagged = log.withColumn("_ok", succeeded | is_end).withColumn("_end", is_end).withColumn("_whose", whose)
    counted = flagged.groupBy("_whose").agg(
        F.count_if(F.col("_ok") & ~F.col("_end")).alias("pages"),
        F.count_if(~F.col("_end")).alias("executions"),
        F.count_if(~F.col("_ok")).alias("errors"),
        F.max_by("_end", seq).alias("_finished"),
    )
    by_reader = counted.join(error_runs(flagged, "_whose", seq, chunk), "_whose", "left")
    joined = by_reader.groupBy(F.col("_whose.param").alias(param)).agg(
        *[F.sum(name).alias(name) for name in ("pages", "executions", "errors")],
        F.coalesce(F.max("max_consecutive_errors"), F.lit(0)).alias("max_consecutive_errors"),
        F.every("_finished").alias("_finished"),
    )
    outcome = (
        F.when(F.col("_finished"), "success")
        .when(_hit(F.col("max_consecutive_errors"), limits.consecutive_errors), "consecutive errors exceeded")
        .when(_hit(F.col("errors"), limits.errors), "total errors exceeded")
        .when(_hit(F.col("executions"), limits.executions), "executions exceeded")
        .otherwise("incomplete")
    )
    return joined.select(
        param, "pages", "executions", "errors", "max_consecutive_errors", outcome.alias("outcome")
    )


def landable(records: DataFrame, audited: DataFrame, param: str = "param") -> DataFrame:
    """Records of parameters whose extraction succeeded; the others land nothing."""
    return records.join(audited.filter("outcome = 'success'").select(param), param, "left_semi")
