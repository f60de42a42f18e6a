r"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

1. A text, its runs of white space replaced by one space, is cut into chunks where the hash of two neighbouring words says so, so
   texts that share a passage share its chunks. A document is stored once as its chunks and its recipe, their hashes in order.
2. Chunks are made distinct before and after one shuffle, hash and bytes together. Where all chunks of a hash are the same
   bytes the hash is the chunk's verified identifier; otherwise the different chunks of the hash are numbered, and the
   documents that hold one of them get these numbers beside their recipe.
3. Documents are equal if their ordered identifiers are. Only these lists move from here on, 8 bytes a chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starload.llm.common import prepared, stored

SPACE = r"[\x20\x09-\x0D]+"
#: A word of up to 64 code points and the space after it; longer words are cut.
TOKEN = r"[^ ]{1,64} ?| "
#: One of so many places between two words ends a chunk; so does every MOST-th word of a text.
EVERY, MOST = 32, 256


def normal_text(name: str = "text") -> Column:
    """The text with each run of white space replaced by one space, empty for a null."""
    return F.regexp_replace(F.coalesce(F.col(name), F.lit("")), SPACE, " ")


def chunks(text: Column) -> Column:
    """The chunks of a normal text in order; joined they are the text. An empty text has none."""

    def of(tokens: Column) -> Column:
        def end(token: Column, i: Column) -> Column:
            drawn = F.pmod(F.xxhash64(F.get(tokens, i - 1), token), F.lit(EVERY)) == 0
            return F.when(drawn | (i % MOST == MOST - 1) | (i == F.size(tokens) - 1), i + 1)

        def cut(ends: Column) -> Column:
            def piece(stop: Column, j: Column) -> Column:
                start = F.coalesce(F.get(ends, j - 1), F.lit(0))
                return F.array_join(F.slice(tokens, start + 1, stop - start), "")

            return F.transform(ends, piece)

        return _once(F.filter(F.transform(tokens, end), lambda x: x.isNotNull()), cut)

    return _once(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), of)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def chunk_hash(chunk: Column, bits: int = 64) -> Column:
    h = F.xxhash64(chunk)
    return h if bits == 64 else F.pmod(h, F.lit(1 << bits))


def recipes(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(key, doc_id, text_sha256, chunks, recipe) for every row of ``docs``, stored; key is unique.

    text_sha256 is of the normal text; recipe holds the hashes of its chunks in order, of so many bits.
    """
    prepared(docs.sparkSession)
    cut = docs.select("doc_id", normal_text().alias("normal")).select("doc_id", F.sha2("normal", 256).alias("text_sha256"), chunks(F.col("normal")).alias("chunks"))
    return stored(cut.select(F.monotonically_increasing_id().alias("key"), "*", F.transform("chunks", lambda c: chunk_hash(c, bits)).alias("recipe")), "recipes", "zstd")


def ambiguous(stock: DataFrame, bits: int = 64) -> DataFrame:
    """(h, chunk, variant) of all chunks whose hash other chunks have too; the others are verified by their hash."""
    spread = stock.select(F.explode("chunks").alias("chunk")).select(chunk_hash(F.col("chunk"), bits).alias("h"), "chunk")
    different = stored(spread.groupBy("h", "chunk").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count("one").alias("n")).filter("n > 1").select("h"), "shared-hashes")
    if different.isEmpty():
        return different.select("h", F.lit("").alias("chunk"), F.lit(0).alias("variant"))
    found = spread.join(different, "h").distinct()
    return stored(found.withColumn("variant", F.row_number().over(W.partitionBy("h").orderBy("chunk"))), "variants")


def identified(stock: DataFrame, bits: int = 64) -> DataFrame:
    """Adds variants, the numbers of a document's ambiguous chunks as (place, number) in order: with recipe its ordered identifiers."""
    many = ambiguous(stock, bits)
    none = F.array().cast("array<struct<place:int,variant:int>>")
    if many.isEmpty():
        return stock.withColumn("variants", none)
    places = stock.select("key", F.posexplode("recipe").alias("place", "h")).join(many.select("h").distinct(), "h", "left_semi")
    touched = stock.join(places.select("key").distinct(), "key", "left_semi")
    spread = touched.select("key", F.posexplode("chunks").alias("place", "chunk")).join(many, "chunk")
    numbers = spread.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "variant"))).alias("variants"))
    return stock.join(numbers, "key", "left").withColumn("variants", F.coalesce("variants", none))


def exact_groups(docs: DataFrame, bits: int = 64) -> DataFrame:
    r"""(doc_id, keep_id, group_size, kept, text_sha256, n_chunks) for every row of ``docs`` (doc_id, text).

    Texts are equal if they are after each run of white space ``[\x20\x09-\x0D]+`` became one space; a null text is empty. keep_id is the
    least doc_id of the equal texts, null if none has one; the row with it stays, one of them if rows repeat the id. Null ids
    come after all others. Extra columns are not read, and an empty table gives no row. ``bits`` shortens the hashes, for tests.
    A group of any size is counted by each task before it moves, and the join back to its rows is split by adaptive execution.
    """
    ids = identified(recipes(docs, bits), bits)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("least")
    groups = ids.groupBy("recipe", "variants").agg(least, F.count(F.lit(1)).alias("n")).filter("n > 1")
    # only groups of several rows; stored, so that the join can split one with very many
    rows = ids.select("key", "doc_id", "text_sha256", "recipe", "variants").join(stored(groups, "copies"), ["recipe", "variants"], "left")
    alone = F.col("n").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("keep_id")
    kept = (alone | (F.col("key") == F.col("least.key"))).alias("kept")
    size = F.coalesce("n", F.lit(1).cast("long")).alias("group_size")
    return rows.select("doc_id", keep_id, size, kept, "text_sha256", F.size("recipe").alias("n_chunks"))


def without_copies(docs: DataFrame, bits: int = 64) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat an id and text the least by all columns stays."""
    kept = exact_groups(docs, bits).filter("kept").select(F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "text_sha256").alias("which"))
    which = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.sha2(normal_text(), 256)).alias("which")
    rows = docs.select(which, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).join(kept, "which", "left_semi")
    return rows.groupBy("which").agg(F.min("row").alias("row")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
