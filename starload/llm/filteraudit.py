"""How filters interact when they are applied one after the other, for every order of them.

A document is its mask, the set of filters it fails, so a part of the corpus is at most ``2 ** k`` counts. In an order, the first
letter that lies in the mask removes the document. All orders that begin with the same letters have neighbouring Lehmer
ranks (ranks in lexicographic order), so a mask's removal at a step covers a few intervals of ranks. Its count is added where
an interval starts and taken off where it ends; a running sum over the ranks then gives what every order removes at that step.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starload.llm.common import prepared, stored

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"


def lehmer_rank(prefix: str, letters: str = FILTERS) -> int:
    """Rank of the first order, in lexicographic order, that begins with ``prefix``; ``letters`` are ascending."""
    rank, left = 0, list(letters)
    for letter in prefix:
        rank += left.index(letter) * factorial(len(left) - 1)
        left.remove(letter)
    return rank


def intervals(letters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last): where documents of a mask go at a step; neighbours are one interval."""
    found = []
    for mask in range(1, 1 << len(letters)):
        bad = [x for k, x in enumerate(letters) if mask >> k & 1]
        good = [x for x in letters if x not in bad]
        for step in range(1, len(good) + 2):
            width, ranges = factorial(len(letters) - step), []
            for start in sorted(lehmer_rank("".join(before) + x, letters) for before in permutations(good, step - 1) for x in bad):
                if ranges and ranges[-1][1] == start:
                    ranges[-1][1] = start + width
                else:
                    ranges.append([start, start + width])
            found += [(mask, step, *r) for r in ranges]
    return found


def corpus_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic) for every row of ``docs`` (doc_id, text, source); bit k of mask: it fails the k-th of FILTERS.

    A null text counts as empty, a null source as an empty part. A row fails E if a row with the same text has a smaller doc_id:
    rows that repeat an id do not fail through each other, and a null id is neither smaller nor greater than any. good and toxic
    say whether a label of the id has quality or toxic 1; several labels of an id count as one, those without an id for none.
    Texts are compared by their SHA-256 digests, which are all that moves. Extra columns are not read; empty tables give no row.
    """
    prepared(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n_words, chars = F.size(words), F.char_length(text)
    fails = [
        n_words < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n_words,
        100 * (chars - F.char_length(F.regexp_replace(text, "[A-Z]", ""))) > 2 * chars,
        text.rlike("[#$%&*|]"),
    ]
    own = sum((f.cast("int") * (1 << k) for k, f in enumerate(fails)), F.lit(0))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), own.alias("own"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = stored(rows, "masks")
    # only texts that occur again are looked up; stored, so that the join can split a text with very many rows
    first = stored(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "first-ids")
    marks = labels.filter("doc_id is not null").groupBy("doc_id")
    marks = marks.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marked = rows.join(first, "digest", "left").join(marks, "doc_id", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    no = F.lit(False)
    return marked.select("part", (F.col("own") + copy * 16).alias("mask"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def audit(masks: DataFrame, letters: str = FILTERS) -> DataFrame:
    """One row per part, filter_order and step, zeros included, from rows (part, mask, good, toxic).

    kept, removed: documents of the part left after the step and removed by it; redundant: those that fail its filter but are
    gone already; unique_fails: those that fail its filter alone; good_lost, toxic_lost: removed ones that are good, toxic;
    shapley: what its filter removes, summed over all orders. Rows are counted by mask before they move, so a
    part of any size is at most ``2 ** len(letters)`` rows. Without rows there is no part and the result is empty.
    """
    spark, orders = masks.sparkSession, ["".join(p) for p in permutations(letters)]
    if list(letters) != sorted(set(letters)) or not 0 < len(letters) <= 6:
        raise ValueError("one to six different letters in ascending order")
    one = F.count(F.lit(1))
    counts = masks.groupBy("part", "mask").agg(one.alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    counts = stored(counts, "mask-counts")
    values = ["n", "good", "toxic"]

    cells = ", ".join(f"({mask}, {step}, {start}, {end})" for mask, step, start, end in intervals(letters))
    where = spark.sql(f"SELECT * FROM VALUES {cells} AS t(mask, step, start, stop)")

    def ends(name: str, sign: int) -> Column:
        return F.struct(F.col(name).alias("rank"), *[(F.col(v) * sign).alias(v) for v in values])

    steps = counts.join(where, "mask").select("part", "step", F.inline(F.array(ends("start", 1), ends("stop", -1))))

    def failing(k: int, alone: bool) -> Column:
        hit = F.col("mask") == (1 << k) if alone else F.col("mask").bitwiseAND(F.lit(1 << k)) != 0
        return F.sum(F.when(hit, F.col("n")).otherwise(F.lit(0)))

    own = [F.array(*[failing(k, alone) for k in range(len(letters))]) for alone in (False, True)]
    totals = counts.groupBy("part").agg(F.sum("n").alias("total"), own[0].alias("fails"), own[1].alias("unique"))
    rank, step = F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))), F.explode(F.sequence(F.lit(1), F.lit(len(letters))))
    blank = counts.select("part").distinct().select("part", rank.alias("rank")).select("part", step.alias("step"), "rank", *[F.lit(0).cast("long").alias(v) for v in values])

    changes = steps.filter(F.col("rank") < len(orders)).unionByName(blank).groupBy("part", "step", "rank").agg(*[F.sum(v).alias(v) for v in values])
    along = W.partitionBy("part", "step").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    lost = changes.select("part", "step", "rank", *[F.sum(v).over(along).alias(v) for v in values])

    order = F.element_at(F.array(*[F.lit(x) for x in orders]), F.col("rank") + 1)
    lost = lost.withColumn("filter_order", order).withColumn("at", F.instr(F.lit(letters), F.substring("filter_order", F.col("step"), F.lit(1))))
    so_far = W.partitionBy("part", "rank").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    lost = lost.withColumn("gone", F.sum("n").over(so_far)).withColumn("shapley", F.sum("n").over(W.partitionBy("part", "at")))
    return lost.join(totals, "part").select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), (F.col("total") - F.col("gone")).alias("kept"), F.col("n").alias("removed"),
        (F.element_at("fails", F.col("at")) - F.col("n")).alias("redundant"), F.element_at("unique", F.col("at")).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
    )
