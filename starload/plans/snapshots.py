"""Tables as versioned Parquet folders.

A version is complete once Spark has written its ``_SUCCESS`` marker; readers take the
newest complete one. One writer per table is assumed. A failed write leaves the version before it in force, and no full
rewrite replaces files that its own query still reads. A slice of a partitioned table
is replaced inside its newest version, without touching the other partitions.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.columns import any_null, is_true
from starload.functions.spines import GRAINS, Window, period, period_of
from starload.operators.changes import INSERT, OP, UPDATE, difference
from starload.operators.dedupe import keep_first
from starload.operators.reload import CODEC, DICTIONARY_MOST, delete_where, delete_window, overwrite_partitions
from starload.sources.folders import matching, place, remove

PERIOD = "periodo"


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Note the schema next to the data: an empty partitioned table has no file to tell it."""
    fs, found = place(spark, f"{path}/_schema.json")
    out = fs.create(found)
    out.write(schema.json().encode())
    out.close()


def _kept_schema(spark: SparkSession, path: str) -> T.StructType | None:
    fs, found = place(spark, f"{path}/_schema.json")
    if not fs.exists(found):
        return None
    source = fs.open(found)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    source.close()
    return T.StructType.fromJson(json.loads(text))


def complete_versions(spark: SparkSession, root: str) -> list[int]:
    markers = matching(spark, f"{root}/v=*/_SUCCESS")
    return sorted(int(marker.getParent().getName().removeprefix("v=")) for marker in markers)


def newest(spark: SparkSession, root: str) -> str | None:
    versions = complete_versions(spark, root)
    return f"{root}/v={versions[-1]}" if versions else None


def _read(spark: SparkSession, path: str) -> DataFrame:
    schema = _kept_schema(spark, path)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_snapshot(spark: SparkSession, root: str, keep_period: bool = False) -> DataFrame | None:
    """The newest version, or None if there is none yet; the period of its rows is left out unless asked for."""
    path = newest(spark, root)
    if path is None:
        return None
    return _read(spark, path) if keep_period else _read(spark, path).drop(PERIOD)


def write_snapshot(df: DataFrame, root: str, partition: str | None = None, keep_period: bool = False) -> DataFrame:
    """Write the next version and return it as read back."""
    spark = df.sparkSession
    versions = complete_versions(spark, root)
    path = f"{root}/v={versions[-1] + 1 if versions else 1}"
    if partition is None:
        writer = df.write.mode("overwrite").option("parquet.dictionary.page.size", DICTIONARY_MOST)
        writer.option("compression", CODEC).parquet(path)
    else:
        df.hint("rebalance", partition).write.mode("overwrite").option("compression", CODEC).partitionBy(partition).parquet(path)
    _keep_schema(spark, path, df.schema)
    return _read(spark, path) if keep_period else _read(spark, path).drop(PERIOD)


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove all but the newest complete versions, once no query reads them any more."""
    for version in complete_versions(spark, root)[: -max(keep, 1)]:
        remove(spark, f"{root}/v={version}")


def with_period(df: DataFrame, day: str, grain: str) -> DataFrame:
    return df.withColumn(PERIOD, period(F.col(day), grain))


def replace_window(fresh: DataFrame, root: str, day: str, window: Window, grain: str) -> None:
    """Delete the rows of a date window and add ``fresh``, rewriting only the periods concerned.

    Rows of those periods outside the window are carried over. Fresh rows without a date or of other periods are
    added unless the table holds them already, so that repeating a reload changes nothing. The steps follow
    each other within the newest version: a reader in between may see some periods before and some after the
    reload, and a failed run is repaired by repeating it.
    """
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    spark = fresh.sparkSession
    path = newest(spark, root)
    first, last = period_of(window.first, grain), period_of(window.last, grain)
    concerned = F.coalesce(F.col(PERIOD).between(first, last), F.lit(False))

    dated = with_period(fresh, day, grain)
    stored = spark.read.schema(dated.schema).parquet(path)
    kept = delete_window(stored.filter(concerned), day, window)
    content = kept.unionByName(dated.filter(concerned))
    present = [int(f.getName().removeprefix(f"{PERIOD}=")) for f in matching(spark, f"{path}/{PERIOD}=[0-9]*")]
    overwrite_partitions(content, path, PERIOD, [value for value in present if first <= value <= last])
    add_missing(dated.filter(~concerned), path)


def add_missing(dated: DataFrame, path: str) -> None:
    """Append the rows that their periods do not hold yet; rows alike in every column count as one, so repeating adds nothing."""
    # one value per period reaches the driver
    periods = [row[0] for row in dated.select(PERIOD).distinct().collect()]
    if periods:
        there = dated.sparkSession.read.schema(dated.schema).parquet(path).filter(_in_periods(periods))
        added = difference(dated, there.select(*dated.columns))
        added.hint("rebalance", PERIOD).write.mode("append").option("compression", CODEC).partitionBy(PERIOD).parquet(path)


def _in_periods(values: list):
    named = is_true(F.col(PERIOD).isin([value for value in values if value is not None]))
    return named | F.col(PERIOD).isNull() if None in values else named


def replace_by_key(fresh: DataFrame, path: str, doomed: DataFrame, key: str, day: str, grain: str) -> None:
    """Delete the rows whose key is in ``doomed`` and add ``fresh``, rewriting only the periods concerned."""
    keys = doomed.distinct()
    _replace(fresh, path, day, grain, lambda rows: rows.join(doomed, key, "left_semi"), lambda rows: rows.join(keys, key, "left_anti"), [key])


def replace_where(fresh: DataFrame, path: str, condition: Column, day: str, grain: str) -> None:
    """Delete the rows that meet a condition and add ``fresh``, rewriting only the periods concerned; unknown rows stay."""
    _replace(fresh, path, day, grain, lambda rows: rows.filter(condition), lambda rows: delete_where(rows, condition))


def _replace(fresh: DataFrame, path: str, day: str, grain: str, going, staying, columns: list[str] | None = None) -> None:
    """``going`` and ``staying`` cut a table's rows in two; ``columns`` are all that telling them apart takes."""
    dated = with_period(fresh, day, grain)
    stored = fresh.sparkSession.read.schema(dated.schema).parquet(path)
    held = going(stored.select(*columns, PERIOD) if columns else stored).select(PERIOD)
    # one value per period concerned reaches the driver
    periods = [row[0] for row in held.union(dated.select(PERIOD)).distinct().collect()]
    if periods:
        kept = staying(stored.filter(_in_periods(periods))).select(*dated.columns)
        overwrite_partitions(kept.unionByName(dated), path, PERIOD, periods)


def read_periods(spark: SparkSession, path: str, periods: list) -> DataFrame:
    """The rows of some periods of one version, with their period; files of other periods are not read."""
    return _read(spark, path).filter(_in_periods(periods) if periods else F.lit(False))


def periods_of(spark: SparkSession, path: str, key: str, among: DataFrame) -> list:
    """The periods that hold a key of ``among``, found by reading the key column alone."""
    held = _read(spark, path).select(key, PERIOD).join(among, key, "left_semi")
    # one value per period concerned reaches the driver
    return [row[0] for row in held.select(PERIOD).distinct().collect()]


def changed_rows(current: DataFrame, now: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``now`` that ``current`` lacks or holds with other values, with ``old_periodo`` and ``_op``.

    Both have the columns of the table and its period; a row of another period counts as changed.
    """
    rest = [name for name in now.columns if name not in keys]
    before = current.select(*keys, F.struct(*rest).alias("_old"))
    known = F.col("_old").isNotNull()
    same = F.col("_old").eqNullSafe(F.struct(*rest))
    joined = now.join(before, keys, "left").filter(~(known & same))
    op = F.when(known, UPDATE).otherwise(INSERT).alias(OP)
    return joined.select(*now.columns, F.col(f"_old.{PERIOD}").alias(f"old_{PERIOD}"), op)


def merge_periods(path: str, delta: DataFrame, keys: list[str]) -> list:
    """Bring the rows of ``delta``, as ``changed_rows`` gives them, into one version; returns the periods written.

    Only periods that lose or get a row are read and written again.
    """
    spark = delta.sparkSession
    places = delta.select(PERIOD).union(delta.filter(F.col(OP) == UPDATE).select(f"old_{PERIOD}")).distinct()
    # one value per period concerned reaches the driver
    periods = [row[0] for row in places.collect()]
    if periods:
        kept = read_periods(spark, path, periods).join(delta.select(*keys), keys, "left_anti")
        overwrite_partitions(kept.unionByName(delta.select(*kept.columns)), path, PERIOD, periods)
    return periods


def remove_copies(
    spark: SparkSession, root: str, partition: str, keys: list[str] | None = None, among: DataFrame | None = None
) -> list:
    """De-duplicate the newest version in place, rewriting only partitions that hold copies.

    ``among`` limits the search to rows that agree with one of its rows in its columns.
    With ``keys`` one row per key stays, without them whole rows are made distinct. All
    copies of a repeated key are in the partitions rewritten, so the rest need not be
    read again. Returns the partitions concerned.
    """
    path = newest(spark, root)
    stored = _read(spark, path)
    searched = keys or stored.columns
    known = stored.filter(~any_null(keys)) if keys else stored
    if among is not None:
        known = known.join(among.distinct(), among.columns, "left_semi")
    # one struct per partition a key occurs in, at most as many as the table has partitions
    places = known.groupBy(*searched).agg(
        F.count("*").alias("_copies"), F.collect_set(F.struct(F.col(partition).alias("value"))).alias("_places")
    )
    repeated = places.filter("_copies > 1").select(F.explode("_places").alias("place")).select("place.value")
    concerned = [row[0] for row in repeated.distinct().collect()]
    if not concerned:
        return []
    named = is_true(F.col(partition).isin([value for value in concerned if value is not None]))
    chosen = stored.filter(named | F.col(partition).isNull() if None in concerned else named)
    clean = keep_first(chosen, keys) if keys else chosen.distinct()
    overwrite_partitions(clean, path, partition, concerned)
    return concerned
