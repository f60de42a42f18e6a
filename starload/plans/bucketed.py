"""Stored tables bucketed by their key, so that repeated merges do not move the stored side.

A version is a catalog table, ``<name>_v<number>``, with one sorted file per bucket and task. The merge of a change set shuffles the change set
alone; its result has the partitioning of the stored side, so the next version is written without another shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.operators.changes import upsert

FORMAT = "parquet"


def default_buckets(spark: SparkSession) -> int:
    """As many buckets as the session has shuffle partitions: fewer would make Spark deal out the stored side again."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def versions(spark: SparkSession, name: str) -> list[int]:
    pattern = f"{name}_v*"
    found = spark.sql(f"SHOW TABLES LIKE '{pattern}'").select("tableName").collect()
    return sorted(int(row.tableName.removeprefix(f"{name}_v")) for row in found if row.tableName.removeprefix(f"{name}_v").isdigit())


def write_bucketed(df: DataFrame, name: str, keys: list[str], root: str | None = None, buckets: int | None = None) -> DataFrame:
    """Write the next version of a bucketed table, below ``root`` or the warehouse folder, and return it as read back."""
    spark = df.sparkSession
    done = versions(spark, name)
    table = f"{name}_v{done[-1] + 1 if done else 1}"
    writer = df.write.format(FORMAT).bucketBy(buckets or default_buckets(spark), *keys).sortBy(*keys)
    if root:
        writer = writer.option("path", f"{root}/{table}")
    writer.saveAsTable(table)
    return spark.table(table)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame | None:
    """The newest version, or None."""
    done = versions(spark, name)
    return spark.table(f"{name}_v{done[-1]}") if done else None


def attach(spark: SparkSession, name: str, version: int, schema: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """Name a version that another session wrote: its files keep their buckets, the catalog learns of them."""
    columns = ", ".join(keys)
    spark.sql(
        f"CREATE TABLE {name}_v{version} ({schema}) USING {FORMAT} CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(f"{name}_v{version}")


def merge_bucketed(new: DataFrame, name: str, keys: list[str], root: str | None = None, **switches) -> DataFrame:
    """Upsert (or with ``delete=True`` mirror) the newest version by ``new`` into the next one; only ``new`` is shuffled."""
    spark = new.sparkSession
    old = read_bucketed(spark, name)
    if old is None:
        return write_bucketed(new, name, keys, root)
    buckets = int(spark.sql(f"DESCRIBE EXTENDED {name}_v{versions(spark, name)[-1]}").filter("col_name = 'Num Buckets'").first().data_type)
    return write_bucketed(upsert(old, new, keys, **switches), name, keys, root, buckets)


def drop_old_versions(spark: SparkSession, name: str, keep: int = 2) -> None:
    """Drop all but the newest versions; of tables with a path of their own only the name goes."""
    for version in versions(spark, name)[: -max(keep, 1)]:
        spark.sql(f"DROP TABLE {name}_v{version}")
