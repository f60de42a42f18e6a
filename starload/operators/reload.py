"""Replacement of a slice of a table by freshly extracted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.columns import is_true
from starload.functions.spines import Window
from starload.sources.folders import drop_stale_partitions, partition_files

# Tables are stored packed: a load keeps several versions of its staging for a while.
CODEC = "zstd"
# Bytes of distinct values up to which a column of a table without partitions keeps a dictionary. Codes and labels stay below; keys and texts, of which few
# repeat, are not looked up value by value until a dictionary of Parquet's own limit, 1 MB, is full, and then written plainly all the same.
DICTIONARY_MOST = 64 << 10


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows left after a delete; rows for which the condition is unknown stay."""
    return df.filter(~is_true(condition))


def delete_window(df: DataFrame, day: str, window: Window) -> DataFrame:
    return delete_where(df, window.contains(F.col(day)))


def doomed_keys(parent: DataFrame, key: str, condition: Column) -> DataFrame:
    """Keys of the parents that meet the condition, once for each such row.

    A plain filter over a scan: the condition reaches the files, and a semi join with these keys lets Spark drop the rows of
    other keys by a Bloom filter of them before it shuffles the larger side.
    """
    return parent.filter(condition).select(key)


def delete_by_parent(child: DataFrame, parent: DataFrame, key: str, condition: Column) -> DataFrame:
    """Child rows left after deleting those whose parent meets the condition.

    Parents are cut to the distinct keys of the rows to delete before the join.
    """
    return child.join(doomed_keys(parent, key, condition).distinct(), key, "left_anti")


def reload_window(target: DataFrame, fresh: DataFrame, day: str, window: Window) -> DataFrame:
    return delete_window(target, day, window).unionByName(fresh)


def reload_by_parent(
    children: dict[str, DataFrame],
    parent: DataFrame,
    fresh: dict[str, DataFrame],
    fresh_parent: DataFrame,
    key: str,
    condition: Column,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Replace parents that meet the condition together with all their children.

    Children are filtered against the parents as they were before the reload.
    """
    kept = {
        name: delete_by_parent(child, parent, key, condition).unionByName(fresh[name])
        for name, child in children.items()
    }
    return kept, delete_where(parent, condition).unionByName(fresh_parent)


def overwrite_partitions(df: DataFrame, path: str, partition: str, values: list | None = None) -> None:
    """Replace the partitions present in ``df`` in one job; all others stay.

    ``values`` names all partitions that are replaced: those without a row in ``df`` are emptied after the write, which evaluates
    ``df`` once. A run that fails between the two keeps their old rows until it is repeated.
    """
    before = partition_files(df.sparkSession, path, partition, values or [])
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(partition)
        .parquet(path)
    )
    drop_stale_partitions(df.sparkSession, path, partition, before)
