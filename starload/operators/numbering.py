"""Contiguous row numbers, surrogate keys and batches without a global sort."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

_SEPARATOR = "\x01"
# The leading digits of the digest that name a bucket, at least.
HEX_DIGITS = 3


def bucket_digits(spark: SparkSession) -> int:
    """Digits that give two buckets or more for each shuffle partition of the session, and fewer than 32."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(HEX_DIGITS, math.ceil(math.log(2 * partitions, 16)))


def key_digest(keys: list[str]) -> Column:
    return F.md5(F.concat_ws(_SEPARATOR, *[F.col(key).cast("string") for key in keys]))


def number_rows(
    df: DataFrame,
    keys: list[str],
    name: str,
    hex_digits: int | None = None,
    only: Column | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add numbers 1..n, in the order of the digest of the unique ``keys``.

    The leading digits of the digest form buckets of even size. Rows are ranked within
    their bucket, and the running total of the bucket counts, at most ``16 ** hex_digits``
    rows, is added. The numbers depend on the keys alone, not on partitioning or on the
    number of buckets, which follows the session's shuffle partitions.

    With ``only`` just the rows that meet it are numbered, the others get null. ``counted``
    holds the keys of the rows to number, if they can be had for less than from ``df``.
    """
    digits = hex_digits or bucket_digits(df.sparkSession)
    chosen = F.lit(True) if only is None else only
    hashed = df.withColumn("_digest", key_digest(keys)).withColumn("_chosen", chosen)
    hashed = hashed.withColumn("_bucket", F.substring("_digest", 1, digits))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    source = hashed.filter("_chosen") if counted is None else counted.withColumn(
        "_bucket", F.substring(key_digest(keys), 1, digits)
    )
    offsets = (
        source.groupBy("_bucket")
        .count()
        .select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    rank = F.row_number().over(W.partitionBy("_bucket", "_chosen").orderBy("_digest", *keys))
    # the offsets hold at most 16 ** digits rows whatever the size of df
    numbered = hashed.withColumn("_rank", rank).join(F.broadcast(offsets), "_bucket", "left")
    number = F.when(F.col("_chosen"), F.col("_offset") + F.col("_rank"))
    return numbered.withColumn(name, number).select(*df.columns, name)


def assign_surrogates(
    members: DataFrame, nk: str, sk: str, current: DataFrame | None = None, hex_digits: int | None = None
) -> DataFrame:
    """Give new dimension members the integers after the greatest key in use."""
    numbered = number_rows(members, [nk], "_number", hex_digits)
    base: Column = F.lit(0)
    if current is not None:
        base = F.coalesce(current.agg(F.max(sk)).scalar(), F.lit(0))
    return numbered.select((base + F.col("_number")).cast("int").alias(sk), *members.columns)


def exact_batches(df: DataFrame, keys: list[str], size: int, name: str = "batch") -> DataFrame:
    """Batch numbers from 1; every batch but the last has exactly ``size`` rows."""
    numbered = number_rows(df, keys, "_number")
    return numbered.withColumn(name, F.ceil(F.col("_number") / size).cast("int")).drop("_number")


def even_batches(df: DataFrame, keys: list[str], size: int, name: str = "batch") -> DataFrame:
    """Batch numbers from 1 by digest; ``ceil(rows / size)`` batches of about equal size, no sort."""
    total = df.agg(F.ceil(F.count("*") / size)).scalar()
    slot = F.conv(F.substring(key_digest(keys), 1, 15), 16, 10).cast("long")
    return df.withColumn(name, (F.pmod(slot, total) + 1).cast("int"))


def random_batches(df: DataFrame, size: int, rows: int, seed: int | None = None) -> list[DataFrame]:
    """Separate tables of about ``size`` rows each, drawn at random; ``rows`` is the row count.

    Every table is a scan of its own, so this suits a few pieces; the batch numbers
    above stamp any number of batches in one pass.
    """
    pieces = -(-rows // size)
    return df.randomSplit([float(size)] * pieces, seed) if pieces else []
