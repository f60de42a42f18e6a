"""Language-model scores by a weighted backoff automaton over all that the corpus holds.

The model is a bigram model with absolute discounting over complete unigrams. Each word that was followed twice by the same token in
training is a state; a bigram seen LEAST times or more, at any size of the corpus, is an arc, and a failure arc whose
weight is what the arcs leave leads from each state to the empty context, where every word has its unigram and one unknown word the discounted mass.

The model is never held whole. Texts are walked in blocks of consecutive rows, and every block asks for the arcs it may need:

1. Words are counted, which gives the totals and the few words that hold a large share of the tokens.
2. A block sends each distinct bigram once, grouped by its first word, with its training count. These requests are dealt out by
   the first word (by both, if it is one of the few). A bucket adds up what all blocks sent and answers each request in its order:
   the count of every bigram, and of every first word its count and the mass of its arcs.
3. Answers and texts of a block meet; one left-to-right traversal of each text carries the state and adds up log-probabilities. In a
   bigram automaton the state after a token is that token, so the steps of all texts of a block are taken together.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import prepared, stored, text_bytes
from starload.llm.wordhash import NOT_SPACE, grouped, mixed, word_hashes

#: An arc's training count at least, and what is taken off it.
LEAST, DISCOUNT = 2, 0.75
ADDED = 0.1  # to each count in the base score
END = np.uint64(0x5EED0F7E47)
#: Tokens that are counted together before they leave a task, and of a block, about.
PIECE = 1 << 21
#: Bigrams that a bucket holds, about; buckets grow in number with the corpus.
BUCKET = 1 << 20
#: Words with one in so many tokens, at most that many, have their bigrams dealt out by both words.
SHARE = 1 << 10


def token_hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of the texts between ``cuts``, an end after each text, and where each text begins."""
    words, texts = word_hashes(data, cuts, NOT_SPACE)
    count = len(cuts) - 1
    begins = np.concatenate(([0], np.cumsum(np.bincount(texts, minlength=count) + 1)))
    out = np.full(begins[-1], END, np.uint64)
    out[np.arange(len(words)) + texts] = words
    return out, begins


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts of a column, and how many each has."""
    found = [token_hashes(data, cuts) for _, _, data, cuts in grouped(column)]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate([t for t, _ in found]), np.concatenate([np.diff(b) for _, b in found])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, n), added up over pieces."""
    held, size = [], 0

    def counted() -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    for batch in batches:
        tokens, _ = _tokens(batch.column(0))
        held.append(tokens)
        size += len(tokens)
        if size >= PIECE:
            yield counted()
            held, size = [], 0
    if size:
        yield counted()


class Bigrams:
    """The distinct bigrams of a block in the order of their requests, the same whenever it is built from the same texts."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, hot: np.ndarray, buckets: int):
        self.words, number = np.unique(tokens, return_inverse=True)
        inside = np.ones(len(tokens), bool)
        inside[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
        #: places of the tokens that follow another one of their text
        self.places = np.flatnonzero(inside)
        self.number = number
        pairs, self.pair_of = np.unique(number[self.places - 1].astype(np.int64) << 32 | number[self.places], return_inverse=True)
        first, second = pairs >> 32, pairs & 0xFFFFFFFF
        v, w = self.words[first], self.words[second]
        draw = np.where(np.isin(v, hot), mixed(v ^ mixed(w)), v)
        bucket = ((draw >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        self.bucket, self.first, self.v, self.w = bucket[order], first[order], v[order], w[order]
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        #: where a run of bigrams with one first word in one bucket begins
        self.runs = np.flatnonzero(np.append(True, (self.v[1:] != self.v[:-1]) | (self.bucket[1:] != self.bucket[:-1]))) if len(order) else np.empty(0, np.int64)

    def counts(self, weights: np.ndarray) -> np.ndarray:
        """How often each bigram occurs among the weighted tokens."""
        return np.bincount(self.rank[self.pair_of], weights[self.places], minlength=len(self.v)).astype(np.int64)


def _packed(values: np.ndarray, kind) -> bytes:
    return zlib.compress(values.astype(kind).tobytes(), 1)


def _unpacked(data, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


REQUEST = "bucket int, block long, firsts binary, sizes binary, seconds binary, counts binary"
ANSWER = "block long, bucket int, counts binary, totals binary, masses binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Block, tokens, tokens of each text, and whether it is learned from, of consecutive rows (block, learn, text)."""
    at, held = None, []

    def whole():
        return at, *(np.concatenate(part) for part in zip(*held))

    for batch in batches:
        blocks = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and blocks[a] != at:
                yield whole()
                held = []
            at = int(blocks[a])
            part = batch.slice(a, b - a)
            held.append((*_tokens(part.column(2)), part.column(1).to_numpy(zero_copy_only=False)))
    if held:
        yield whole()


def _ask(hot: np.ndarray, buckets: int):
    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, tokens, sizes, learn in _blocks(batches):
            found = Bigrams(tokens, sizes, hot, buckets)
            counts = found.counts(np.repeat(learn.astype(np.float64), sizes))
            cuts = np.searchsorted(found.bucket, np.unique(found.bucket)).tolist()
            rows = []
            for a, b in zip(cuts, [*cuts[1:], len(found.bucket)]):
                runs = found.runs[np.searchsorted(found.runs, a) : np.searchsorted(found.runs, b)]
                sizes_of = np.diff(np.append(runs, b))
                rows.append((found.bucket[a], block, found.v[runs].tobytes(), _packed(sizes_of, np.uint32), found.w[a:b].tobytes(), _packed(counts[a:b], np.uint32)))
            if rows:
                kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[x.split()[0] for x in REQUEST.split(", ")])

    return asked


def _answer(hot: np.ndarray):
    """Answers of requests sorted by bucket; rows of block -1 have the words of ``hot`` and the masses of their arcs here."""
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 3]
    names = [x.split()[0] for x in ANSWER.split(", ")]

    def answered(held: list[dict]) -> pa.RecordBatch:
        bucket = held[0]["bucket"]
        firsts = [np.frombuffer(r["firsts"], np.uint64) for r in held]
        sizes = [_unpacked(r["sizes"], np.uint32) for r in held]
        v = np.concatenate([np.repeat(f, s) for f, s in zip(firsts, sizes)])
        w = np.concatenate([np.frombuffer(r["seconds"], np.uint64) for r in held])
        sent = np.concatenate([_unpacked(r["counts"], np.uint32) for r in held]).astype(np.int64)
        order = np.lexsort((w, v))
        new = np.append(True, (v[order[1:]] != v[order[:-1]]) | (w[order[1:]] != w[order[:-1]]))
        group = np.cumsum(new) - 1
        n = np.bincount(group, sent[order]).astype(np.int64)
        known, of = np.unique(v[order[new]], return_inverse=True)
        totals = np.bincount(of, n).astype(np.int64)
        masses = np.bincount(of, np.where(n >= LEAST, n - DISCOUNT, 0.0))
        counts = np.empty(len(v), np.int64)
        counts[order] = n[group]
        rows, a = [], 0
        for row, own, size in zip(held, firsts, sizes):
            b, at = a + int(size.sum()), np.searchsorted(known, own)
            rows.append((row["block"], bucket, _packed(counts[a:b], np.uint32), _packed(totals[at], np.int64), _packed(masses[at], np.float64)))
            a = b
        few = np.isin(known, hot)
        if few.any():
            rows.append((-1, bucket, b"", known[few].tobytes(), masses[few].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != held[0]["bucket"]:
                    yield answered(held)
                    held = []
                held.append(row)
        if held:
            yield answered(held)

    return answers


def traverse(p: np.ndarray, follows: np.ndarray, arc: np.ndarray, total: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Log10 of the probability of each token, given the state the one before left.

    ``p`` are unigram probabilities of all tokens, ``follows`` the places of those that follow another; of these, ``arc`` is the count of
    the bigram, ``total`` that of the word before as the state, ``mass`` what the arcs of the state hold. A token
    without an arc takes the failure arc, weighted by what the arcs leave, and then its unigram.
    """
    out = p.copy()
    lower, seen = p[follows], total > 0
    count = np.where(seen, total, 1)
    left = np.where(seen, 1 - mass / count, 1.0)
    out[follows] = np.where(arc >= LEAST, (arc - DISCOUNT) / count, 0.0) + left * lower
    return np.log10(out)


SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _score(words: int, kinds: int, ends: int, discount: float, hot: np.ndarray, hot_counts: np.ndarray, hot_masses: np.ndarray, buckets: int):
    """Scores of rows sorted by block: the answers of a block by bucket, and then its texts in the order they were asked for."""
    base = math.log10(words + ADDED * (kinds + 1))
    unknown = discount * kinds / words if words else 1.0

    def scored_block(answers: list[dict], texts: list[dict]) -> pa.RecordBatch:
        tokens, sizes = _tokens(pa.array([t["text"] for t in texts], pa.binary()))
        found = Bigrams(tokens, sizes, hot, buckets)
        counts, totals, masses = (
            np.concatenate([_unpacked(a[name], kind) for a in answers] or [np.empty(0, kind)])
            for name, kind in (("counts", np.uint32), ("totals", np.int64), ("masses", np.float64))
        )
        if len(counts) != len(found.v) or len(totals) != len(found.runs):
            raise RuntimeError("a block has other texts than it had when it asked for its arcs")
        # count and arcs of each word; every word but an end begins a bigram
        count, mass = np.zeros(len(found.words), np.int64), np.zeros(len(found.words))
        count[found.first[found.runs]], mass[found.first[found.runs]] = totals, masses
        at = np.minimum(np.searchsorted(found.words, hot), max(len(found.words) - 1, 0))
        there = found.words[at] == hot if len(found.words) else np.zeros(len(hot), bool)
        count[at[there]], mass[at[there]] = hot_counts[there], hot_masses[there]
        count[found.words == END] = ends
        n = count[found.number]
        p = np.where(n > 0, (n - discount) / max(words, 1), unknown)
        before = found.number[found.places - 1]
        steps = traverse(p, found.places, counts[found.rank[found.pair_of]].astype(np.int64), count[before], mass[before])
        begin = np.cumsum(sizes) - sizes
        sums = [np.add.reduceat(values, begin) for values in ((n > 0).astype(np.int64), np.log10(n + ADDED) - base, steps)]
        columns = [pa.array([t["doc_id"] for t in texts], pa.int64()), pa.array(sizes), *[pa.array(x) for x in sums]]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCORED.split(", ")])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, answers, texts = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != at:
                    if texts:
                        yield scored_block(answers, texts)
                    at, answers, texts = row["block"], [], []
                (texts if row["kind"] else answers).append(row)
        if texts:
            yield scored_block(answers, texts)

    return scored


def _comes_again(docs: DataFrame) -> bool:
    """Whether a second evaluation gives the rows in the same partitions and order: only scans, filters and projections."""
    plan = docs._jdf.queryExecution().sparkPlan().toString()
    return not re.search("Exchange|Aggregate|Join|Sort|Python|Arrow|Pandas|Limit|Existing|Window|Generate|Union", plan)


def scores(docs: DataFrame, training: str) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs`` (doc_id, text).

    ``training`` is a boolean SQL expression over docs: the rows the model learns from. A null text counts as an empty one,
    which is one end token. Repeated rows are counted and scored each. Without training rows every count is
    zero, and both scores are those of a model that knows only the unknown word. Extra columns are not read but for ``training``; an
    empty table gives no row. ``docs`` is read several times; what may come in another order each time is stored first.
    """
    spark = docs.sparkSession
    prepared(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"), F.coalesce(F.expr(training), F.lit(False)).alias("learn"))
    if not _comes_again(rows):
        rows = stored(rows, "texts")
    unigrams = stored(rows.filter("learn").select("text").mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "unigrams")
    once, twice = (F.sum((F.col("n") == k).cast("long")) for k in (1, 2))
    end = F.sum(F.when(F.col("h") == int(END.view(np.int64)), F.col("n")))
    total, kinds, n1, n2, ends = (x or 0 for x in unigrams.agg(F.sum("n"), F.count("*"), once, twice, end).first())
    discount = n1 / (n1 + 2 * n2) if n2 else DISCOUNT
    # at most SHARE words have so many of the tokens
    few = unigrams.filter((F.col("n") * SHARE >= total) & (F.col("h") != int(END.view(np.int64)))).toArrow()
    hot = few.column("h").to_numpy().view(np.uint64)
    by = np.argsort(hot)
    hot, hot_counts = hot[by], few.column("n").to_numpy()[by]

    per_row = 1 << max(0, min(20, int(math.log2(PIECE * max(ends, 1) / max(total, 1)))))
    buckets = max(16, math.ceil(total / BUCKET))
    numbered = rows.withColumn("id", F.monotonically_increasing_id()).withColumn("block", F.expr(f"id div {per_row}"))
    asked = numbered.select("block", "learn", "text").mapInArrow(_ask(hot, buckets), REQUEST)
    sent = asked.repartition("bucket").sortWithinPartitions("bucket")
    answers = stored(sent.mapInArrow(_answer(hot), ANSWER), "answers")
    hot_masses = np.zeros(len(hot))
    # one row of at most SHARE words for each bucket
    for row in answers.filter("block = -1").select("totals", "masses").toLocalIterator():
        np.add.at(hot_masses, np.searchsorted(hot, np.frombuffer(row.totals, np.uint64)), np.frombuffer(row.masses, np.float64))

    answered = answers.filter("block >= 0").select("block", F.lit(0).alias("kind"), F.col("bucket").cast("long").alias("place"), "counts", "totals", "masses")
    texts = numbered.select("block", F.lit(1).alias("kind"), F.col("id").alias("place"), "doc_id", "text")
    met = answered.unionByName(texts, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind", "place")
    found = met.mapInArrow(_score(total, kinds, ends, discount, hot, hot_counts, hot_masses, buckets), SCORED)
    return found.select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
