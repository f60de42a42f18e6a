"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment scores them.

1. Every n-gram of an item is a seed, however frequent it is: which of them an edited or partial copy keeps is not known
   before, so none is left out.
2. One pass over the texts emits the passages around seeds. It looks n-grams up in a Bloom bitmap of fixed size (4 MB),
   whatever the size of the benchmark; what it lets through by mistake falls out of the join.
3. Passages join items on seeds, equal passages once. A pair is aligned word by word, which also scores copies with words
   changed, added or left out, unless the item has too few words in the passage to reach the score at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.bloom import bitmap, known
from starload.llm.common import packed, prepared, stored, text_bytes, unpacked
from starload.llm.wordhash import grouped, ngrams, word_hashes

N = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: A passage is a copy from this share of the item's best possible score; shorter items must match whole.
RATIO, SHORT = 0.5, 8


def lower_bytes() -> Column:
    """The UTF-8 bytes of the text in lower case, of all scripts."""
    return F.coalesce(F.lower("text").cast("binary"), F.lit(b""))


def item_ngrams(items: DataFrame, n: int = N) -> DataFrame:
    """(item_id, words, h): the n-grams of each item, with its words' hashes in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, b, data, cuts in grouped(batch.column(1)):
                words, texts = word_hashes(data, cuts)
                hashes, at = ngrams(words, texts, n)
                owner = texts[at]
                own = [words[texts == k].tobytes() for k in range(b - a)]
                lists = [np.unique(hashes[owner == k]).view(np.int64) for k in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [ids[a:b], pa.array(own, pa.binary()), pa.array(lists, pa.list_(pa.int64()))], names=["item_id", "words", "hashes"]
                )

    return items.select(F.col("item_id").cast("long"), lower_bytes()).mapInArrow(cut, "item_id long, words binary, hashes array<long>")


def _passages(docs: DataFrame, bits: np.ndarray, reach: int, n: int) -> DataFrame:
    """(doc_id, text_key, text_size, start, passage, words, hashes): stretches of words around seeds.

    A stretch goes ``reach`` words, the most that a copy can be long, beyond its seeds, so that it holds any copy.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, stretches, seeds = [], [], [], []
            for a, _, data, cuts in grouped(batch.column(1)):
                words, texts = word_hashes(data, cuts)
                h, at = ngrams(words, texts, n)
                hit = np.flatnonzero(known(h, bits))
                if not len(hit):
                    continue
                begins = np.searchsorted(texts, np.arange(len(cuts)))
                h, at = h[hit], at[hit]
                apart = np.flatnonzero((np.diff(at) > 2 * reach) | (np.diff(texts[at]) > 0)) + 1
                for own, places in zip(np.split(h, apart), np.split(at, apart)):
                    t = texts[places[0]]
                    lo, hi = max(begins[t], places[0] - reach), min(begins[t + 1], places[-1] + n + reach)
                    rows.append(a + int(t))
                    starts.append(int(lo - begins[t]))
                    stretches.append(words[lo:hi].tobytes())
                    seeds.append(np.unique(own).view(np.int64))
            if rows:
                columns = [batch.column(k).take(pa.array(rows)) for k in (0, 2, 3)]
                columns += [pa.array(starts, pa.int64()), pa.array(stretches, pa.binary()), pa.array(seeds, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "text_size", "start", "words", "hashes"])

    rows = docs.select(F.col("doc_id").cast("long"), lower_bytes().alias("text"), *text_key())
    schema = "doc_id long, text_key long, text_size int, start long, words binary, hashes array<long>"
    return rows.mapInArrow(found, schema).withColumn("passage", F.sha2("words", 256))


def text_key() -> tuple[Column, Column]:
    """Two columns that tell texts apart: a hash and the size in bytes."""
    text = text_bytes()
    return F.xxhash64(text).alias("text_key"), F.octet_length(text).alias("text_size")


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences, and where it ends in the passage (exclusive)."""
    best, end = 0, 0
    steps = np.arange(len(passage) + 1) * -GAP
    row = np.zeros(len(passage) + 1, np.int64)
    for word in item:
        fresh = np.maximum(row + GAP, 0)
        fresh[1:] = np.maximum(fresh[1:], row[:-1] + np.where(passage == word, MATCH, MISMATCH))
        fresh[0] = 0
        # gaps in the item: the best of all places to the left, less a step for each word between
        row = np.maximum.accumulate(fresh + steps) - steps
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _least(item_words: int, ratio: float) -> float:
    """The share of its best score that a copy of an item has to reach."""
    return 1.0 if item_words < SHORT else ratio


def _aligned(ratio: float):
    """Scores of rows (passage, item_id, item, words) that can reach the item's least one."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            out: list[tuple[int, int, int, int]] = []
            for k, (item, words) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                item, words = np.frombuffer(item, np.uint64), np.frombuffer(words, np.uint64)
                # no score exceeds that of all the item's words that the passage holds, each matched
                if np.isin(item, words).sum() / len(item) < _least(len(item), ratio):
                    continue
                score, end = align(item, words)
                if score / (MATCH * len(item)) < _least(len(item), ratio):
                    continue
                _, back = align(item[::-1], words[:end][::-1])
                rows.append(k)
                out.append((score, len(item), end - back, end))
            if rows:
                at = pa.array(rows)
                columns = [batch.column(0).take(at), batch.column(1).take(at), *(pa.array([x[k] for x in out], pa.int64()) for k in range(4))]
                yield pa.RecordBatch.from_arrays(columns, names=["passage", "item_id", "score", "item_words", "from", "to"])

    return scored


def leaks(docs: DataFrame, items: DataFrame, n: int = N, ratio: float = RATIO) -> DataFrame:
    """(doc_id, item_id, score, ratio, start_word, end_word, text_key, text_size): copies of items in documents.

    ``docs`` has doc_id and text, ``items`` item_id and text. The best passage of each pair is returned if its
    score reaches ``ratio`` of the item's best possible one; items of fewer than eight words must match whole,
    and those of fewer than n words cannot be found, nor copies that keep no n words of the item in a row. Null texts count as empty ones. Words are compared without case and
    punctuation, start_word and end_word count from 0, the end is exclusive. Rows that repeat an id and a text give
    one result; without documents or items there is none.
    """
    prepared(docs.sparkSession)
    known_items = stored(item_ngrams(items, n), "items")
    seeds = known_items.select("item_id", F.explode(F.array_distinct("hashes")).alias("h")).distinct()
    seeds = stored(seeds, "seeds")
    longest = (known_items.agg(F.max(F.octet_length("words"))).first()[0] or 0) // 8
    # each word added costs a gap, so a copy of m words' matches has at most 2 (m - ratio * words) added ones
    reach = longest + math.ceil(2 * max(0.0, 1 - ratio) * longest)
    passages = stored(_passages(docs, bitmap(seeds), reach, n), "passages")
    once = passages.groupBy("passage").agg(F.any_value("words").alias("words"), F.any_value("hashes").alias("hashes"))
    pairs = once.select("passage", F.explode("hashes").alias("h")).join(seeds, "h").select("passage", "item_id").distinct()
    texts = known_items.filter(F.size("hashes") > 0).select("item_id", F.col("words").alias("item")).distinct()
    together = pairs.join(texts, "item_id").join(once.select("passage", "words"), "passage")
    schema = "passage string, item_id long, score long, item_words long, `from` long, `to` long"
    scored = together.select("passage", "item_id", "item", "words").mapInArrow(_aligned(float(ratio)), schema)
    scored = scored.withColumn("ratio", F.col("score") / (F.lit(MATCH) * F.col("item_words")))
    found = passages.join(scored, "passage")
    best = F.max_by(F.struct("score", "ratio", (F.col("start") + F.col("from")).alias("start_word"), (F.col("start") + F.col("to")).alias("end_word")), F.struct("score", -F.col("start"))).alias("best")
    return found.groupBy("doc_id", "text_key", "text_size", "item_id").agg(best).select("doc_id", "item_id", "best.*", "text_key", "text_size")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no copy of an item, with all their columns."""
    texts = leaks(docs, items).select("text_key", "text_size").distinct()
    keyed = packed(docs, *text_key())
    return unpacked(keyed.join(texts, ["text_key", "text_size"], "left_anti"))
