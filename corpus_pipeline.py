"""The corpus pipeline: toxicity filter, near-duplicates, decontamination, mixing, sharding.

Every stage works on all that the one before kept, takes (spark, docs, folder of tables), and returns the columns of
documents; the last adds shard and slot. Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import starload.llm.queries  # noqa: F401
from starload.llm import decontaminate, mixing, shards, simhash, toxicity
from starload.llm.common import query, stored, table, text_bytes, unpacked
from starload.llm.queries import MIX_WEIGHTS

SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half. Null texts score as empty ones and stay, rows that repeat are judged alike; without labels all stay."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints; empty and null texts are one group. Without documents there is no row."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item; null texts hold none, rows that repeat are judged alike, without items all stay."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated and left out by their source's rate; the copies of one are equal rows."""
    return unpacked(mixing.drawn(docs, MIX_WEIGHTS))


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard (by doc_id, so copies meet) and slot, gapless within the shard."""
    placed = shards.with_shard(docs, shards.layout(SHARDS))
    keyed = placed.select(F.struct(*[F.col(f"`{c}`") for c in placed.columns]).alias("row"), "doc_id", "shard", F.crc32(text_bytes()).alias("crc"))
    return unpacked(shards.with_slots(keyed, ["doc_id", "crc"]), "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("mixing_sources", mix_sources),
    ("sharding", assign_shards),
]

#: Fingerprints, alignments and the learned lexicon have no SQL; the tests compare the stages with plain Python.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
