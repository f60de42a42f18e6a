"""Helpers shared by the operators: stored tables, table reading, text columns."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Arrow batches sent to Python hold at most so many rows and bytes, however long the texts are.
BATCH_ROWS, BATCH_BYTES = 1000, 16 * 2**20


def query(name: str, sql: str | None = None):
    """Register a function of (session, folder of tables), with its SQL where there is one."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def prepared(spark: SparkSession) -> None:
    """Session settings the operators rely on: bounded Arrow batches and splitting of skewed joins."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one (tests) gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a table below the shared folder and read it back: cuts the lineage, survives lost executors.

    ``codec`` is for tables that hold whole texts; others take the session's.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(name: str = "text") -> Column:
    """The UTF-8 bytes of a text column, none for a null."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text with A-Z in lower case."""
    return text.lower().split()


def packed(docs: DataFrame, *needed: str | Column) -> DataFrame:
    """All columns of ``docs`` in a struct ``row`` beside those an operator needs: helper columns cannot clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *needed)


def unpacked(rows: DataFrame, *added: str) -> DataFrame:
    """The columns of ``row`` and the added ones; a column of ``row`` named like an added one is replaced."""
    taken = {name.lower() for name in added}
    own = [f.name for f in rows.schema["row"].dataType.fields if f.name.lower() not in taken]
    return rows.select(*[F.col("row").getField(name).alias(name) for name in own], *added)
