"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its share of the target mix over its share of the corpus. Each document draws a
uniform number, hashed from a seed and its id, and inverts the Poisson distribution of its source's rate; the
count says how often it is repeated. The copies are dealt over all partitions by a hash and sorted by it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import packed, prepared, stored, text_bytes, unpacked

#: The sums of one draw are exact in doubles up to this mean; a greater one is the sum of several draws.
MOST_RATE = 500.0
SENT_SOURCES = 5_000


def uniform(seed: int, *key: Column) -> Column:
    """A number strictly between 0 and 1, from a hash of the seed and the key."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 12)
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def poisson_terms(rate: float) -> list[float]:
    """Cumulative probabilities of 0, 1, 2, ... for a mean, up to the last a double can tell from one."""
    if not 0 <= rate <= MOST_RATE:
        raise ValueError(f"a repetition rate must lie between 0 and {MOST_RATE:g}, not {rate}")
    total, out, k = 0.0, [], 0
    while k <= rate or 1 - total > 1e-16 and math.exp(-rate + k * math.log(rate or 1) - math.lgamma(k + 1)) > 1e-18:
        total += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1)) if rate else float(k == 0)
        out.append(min(total, 1.0))
        k += 1
    return out


@F.udf(T.ArrayType(T.DoubleType()))
def _terms(rate):
    """One call for each source, not for each document."""
    return None if rate is None else poisson_terms(rate)


def source_rates(docs: DataFrame, weights: dict[str, float], default: float = 1.0, factor: float = 1.0) -> DataFrame:
    """(source, n_docs, weight, rate): the mean repetition rate that gives each source its share of the mix.

    ``weights`` are relative; a source not listed, a null one included, has ``default``. The mix has ``factor``
    times the rows of the corpus. Shares count documents.
    """
    listed = F.lit(default)
    for name, weight in weights.items():
        if weight < 0:
            raise ValueError(f"the weight of {name!r} is negative")
        listed = F.when(F.col("source") == name, F.lit(float(weight))).otherwise(listed)
    counts = docs.groupBy("source").agg(F.count("*").alias("n_docs")).withColumn("weight", listed.cast("double"))
    totals = counts.agg(F.sum("weight").alias("w"), F.sum("n_docs").alias("n"))
    found = totals.first()
    if not found["w"]:
        return counts.withColumn("rate", F.lit(0.0))
    return counts.withColumn("rate", F.col("weight") / F.lit(found["w"]) * F.lit(factor * found["n"]) / F.col("n_docs"))


#: The columns that a mix adds.
ADDED = ("source_rate", "copy", "copies", "mix_key")


def drawn(
    docs: DataFrame, weights: dict[str, float], default: float = 1.0, factor: float = 1.0, seed: int = 7, partitions: int | None = None
) -> DataFrame:
    """(row, source_rate, copy, copies, mix_key): each document as a struct, as often as it draws.

    The rows lie in the order of mix_key, a hash, within partitions chosen by it.
    """
    prepared(docs.sparkSession)
    rates = source_rates(docs.select("source"), weights, default, factor)
    draws = F.greatest(F.ceil(F.col("rate") / MOST_RATE), F.lit(1)).cast("int")
    rates = rates.select(F.col("source").alias("of"), F.col("rate").alias("source_rate"), draws.alias("draws"))
    rates = stored(rates.withColumn("terms", _terms(F.col("source_rate") / F.col("draws"))), "rates")
    if rates.count() <= SENT_SOURCES:
        # so few sources, each with less than a thousand numbers, go to every task; more of them are joined by a shuffle
        rates = F.broadcast(rates)
    rows = packed(docs, "doc_id", "source", F.crc32(text_bytes()).alias("crc"))
    rows = rows.join(rates, F.col("source").eqNullSafe(F.col("of")))
    key = (F.col("doc_id"), F.col("crc"))

    def one_draw(sofar: Column, k: Column) -> Column:
        # a draw counts the cumulative probabilities below its uniform number
        return sofar + F.size(F.filter("terms", lambda p: p < uniform(seed, *key, k)))

    rows = rows.withColumn("copies", F.aggregate(F.sequence(F.lit(1), F.col("draws")), F.lit(0), one_draw))
    rows = rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    rows = rows.withColumn("mix_key", F.xxhash64(F.lit(seed), F.lit("order"), *key, "copy")).select("row", *ADDED)
    dealt = rows.repartition(partitions, "mix_key") if partitions else rows.repartition("mix_key")
    return dealt.sortWithinPartitions("mix_key")


def mixed(docs: DataFrame, weights: dict[str, float], **options) -> DataFrame:
    """Every document as often as it draws, with its columns and source_rate, copy (from 0), copies and mix_key.

    Needs doc_id, source and text; options are those of ``drawn``. Repeated rows (equal doc_id and text) draw alike.
    A null or empty text is a document like any other. Documents that draw 0 are absent: that is the operator's
    meaning. Columns of ``docs`` with the names of new ones are replaced.
    """
    return unpacked(drawn(docs, weights, **options), *ADDED)
