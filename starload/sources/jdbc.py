"""Relational edge: scans of a query and appends to a table.

A scan of a bare query is one partition. Given a numeric or date column and its
bounds, the scan is split so that executors read ranges in parallel.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    driver: str
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, **self.properties}


@dataclass(frozen=True)
class Split:
    column: str
    lower: str
    upper: str
    partitions: int


def scan_options(target: JdbcTarget, sql: str, split: Split | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    options = {**target.options(), "fetchsize": str(fetch_size)}
    if split is None:
        return {**options, "query": sql}
    # the query option cannot be combined with a partition column, a derived table can
    return {
        **options,
        "dbtable": f"({sql}) scan_source",
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.partitions),
    }


def read_query(spark: SparkSession, target: JdbcTarget, sql: str, split: Split | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**scan_options(target, sql, split)).load()


def append_table(df: DataFrame, target: JdbcTarget, table: str, batch_size: int = 500, connections: int = 16) -> None:
    """Append rows from the executors, with a bounded number of open connections."""
    (
        df.write.format("jdbc")
        .options(**target.options(), dbtable=table, batchsize=str(batch_size), numPartitions=str(connections))
        .mode("append")
        .save()
    )
