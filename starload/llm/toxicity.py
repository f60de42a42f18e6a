"""Toxicity by Levenshtein automata over a lexicon trie, with context windows that tell quotation from abuse.

The lexicon is learned from labelled documents: walking the trie of their words from the root, the first node
whose documents are toxic almost always is an entry. It is extended for as long as nearly all its documents share the
next letter, and then matches a whole word, or any word that begins with it if the endings vary.

Texts are matched with the product of the trie and the Levenshtein automata of its entries, made deterministic
as it is used: a state is a set of (trie node, whether the first letter was edited, edits so far). Edits may stand anywhere,
at the first letter and within a stem as well. An entry that several ordinary words resemble loses the edits by which they do:
those at the first letter, or all. A hit is weaker if it is misspelled or if its window shows quotation; how much weaker is learned too.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import packed, prepared, stored, text_bytes, unpacked

#: The lexicon and the weights are fitted on so many labelled documents at most, the first by a hash of their id.
FIT_ROWS = 20_000
#: Entries have so many letters, so many toxic documents and contexts, such a share of toxic ones, and so many false entries are expected.
SHORTEST, LONGEST, SUPPORT, PRECISION, CHANCE = 4, 16, 3, 0.9, 0.3
#: Words on either side of a hit that are searched for signs of quotation.
WINDOW = 6
#: Words and places of states that a task remembers before it begins anew.
MEMO, PLACES = 500_000, 1_000_000

WORD = re.compile(r"[^\W_]+")
#: Signs of quotation, and words that report speech in the corpus's languages.
QUOTES = re.compile(r"[\"“”„«»‹›]|\b(?:said|says|wrote|quoted|quote|called|sagte|schrieb|dit|écrit|dijo|escribió)\b")


def is_training(name: str = "doc_id", folds: int = 5) -> Column:
    """Whether labels of a document may be learned from: its id's crc32 leaves a remainder."""
    return F.coalesce(F.pmod(F.crc32(F.col(name).cast("string")), F.lit(folds)) != 0, F.lit(False))


def edits_allowed(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


@dataclass
class Entry:
    text: str
    stem: bool  # matches every word that begins with it
    weight: float
    exact: bool = False  # no edits are allowed
    rooted: bool = False  # none at the first letter

    @property
    def allowed(self) -> int:
        return 0 if self.exact else edits_allowed(len(self.text))


@dataclass
class Model:
    """Lexicon and weights. What the labelled sample proves of its words, so it does not grow with the documents."""

    entries: list[Entry] = field(default_factory=list)
    ordinary: set[str] = field(default_factory=set)  # words of clean documents that lie near an entry, at most one for each of its kinds of edits
    misspelled: float = 0.7
    quoted: float = 0.7
    slope: float = 1.0
    intercept: float = -3.0


class Matcher:
    """The trie of the entries with their Levenshtein automata, determinised on the way."""

    def __init__(self, entries: list[Entry]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[Entry | None] = [None]
        # the most edits that an entry below a node allows: first letter as it stands, first letter edited
        self.most: list[list[int]] = [[0, 0]]
        for entry in entries:
            node, path = 0, [0]
            for letter in entry.text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.most.append([0, -1])
                node = self.children[node][letter]
                path.append(node)
            for n in path:
                self.most[n][0] = max(self.most[n][0], entry.allowed)
                self.most[n][1] = max(self.most[n][1], -1 if entry.rooted else entry.allowed)
            self.ends[node] = entry
        self.steps: dict[tuple, tuple] = {}
        self.places = 0
        self.start = self._closed({(0, 0): 0})

    def _closed(self, places: dict[tuple[int, int], int]) -> tuple:
        """Add what missing letters lead to, within the edits the entries below allow."""
        queue = [(key, edits) for key, edits in places.items()]
        while queue:
            (node, first), edits = queue.pop()
            if places[node, first] == edits:
                first = first if node else 1
                for child in self.children[node].values():
                    if edits < self.most[child][first] and edits + 1 < places.get((child, first), 99):
                        places[child, first] = edits + 1
                        queue.append(((child, first), edits + 1))
        return tuple(sorted((*key, edits) for key, edits in places.items()))

    def step(self, state: tuple, letter: str) -> tuple:
        key = (state, letter)
        after = self.steps.get(key)
        if after is None:
            places: dict[tuple[int, int], int] = {}

            def put(node: int, first: int, edits: int) -> None:
                if edits <= self.most[node][first] and edits < places.get((node, first), 99):
                    places[node, first] = edits

            for node, first, edits in state:
                end = self.ends[node]
                edited = first if node else 1
                # whatever follows a stem belongs to it
                put(node, edited, edits if end and end.stem else edits + 1)
                for own, child in self.children[node].items():
                    if own == letter:
                        put(child, first, edits)
                    else:
                        put(child, edited, edits + 1)
            after = self._closed(places)
            self.places += len(after) + 1
            if self.places > PLACES:
                self.steps.clear()
                self.places = 0
            self.steps[key] = after
        return after

    def matches(self, word: str) -> list[tuple[int, int, Entry]]:
        """(edits, whether the first letter was edited, entry) of all entries within their edits."""
        state = self.start
        for letter in word:
            state = self.step(state, letter)
            if not state:
                return []
        return [(edits, first, self.ends[n]) for n, first, edits in state if self.ends[n]]

    def match(self, word: str) -> tuple[int, Entry] | None:
        """The entry with the fewest edits, of equals the heaviest, and the edits."""
        found = [(edits, -entry.weight, entry.text, entry) for edits, _, entry in self.matches(word)]
        best = min(found, key=lambda f: f[:3], default=None)
        return (best[0], best[3]) if best else None


class Scorer:
    def __init__(self, model: Model):
        self.model, self.matcher = model, Matcher(model.entries)
        self.memo: dict[str, tuple[int, Entry] | None] = {}

    def hits(self, text: str) -> list[tuple[str, int, bool, Entry]]:
        """(word, edits, quoted, entry) of each word of the lower-case text that meets the lexicon."""
        words = WORD.findall(text)
        memo, found = self.memo, {}
        for word in set(words):
            hit = memo.get(word, 0)
            if hit == 0:
                if len(memo) > MEMO:
                    memo.clear()
                hit = self.matcher.match(word)
                if hit and hit[0] and word in self.model.ordinary:
                    hit = None
                memo[word] = hit
            if hit:
                found[word] = hit
        if not found:
            return []
        spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
        out = []
        for k, word in enumerate(words):
            if word in found:
                a, b = spans[max(0, k - WINDOW)][0], spans[min(len(spans) - 1, k + WINDOW)][1]
                out.append((word, found[word][0], bool(QUOTES.search(text, max(0, a - 1), b + 1)), found[word][1]))
        return out

    def strength(self, hits: list[tuple[str, int, bool, Entry]]) -> float:
        """The strongest hit, and more for further ones, each counting less."""
        return strength(self.model, len(hits), strongest(hits))

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-(self.model.slope * self.strength(self.hits(text.lower())) + self.model.intercept)))


def strongest(hits: list[tuple[str, int, bool, Entry]]) -> dict[tuple[int, bool], float]:
    """The greatest weight for each number of edits, quoted or not: all that the score takes from the hits but their number."""
    out: dict[tuple[int, bool], float] = {}
    for _, edits, quoted, entry in hits:
        out[edits, quoted] = max(entry.weight, out.get((edits, quoted), 0.0))
    return out


def strength(model: Model, n: int, weights: dict[tuple[int, bool], float]) -> float:
    if not n:
        return 0.0
    return max(w * model.misspelled**edits * (model.quoted if quoted else 1) for (edits, quoted), w in weights.items()) + 3 * (1 - 1 / n)


def _unquoted(text: str) -> tuple[list[str], list[bool]]:
    """The words, and whether no sign of quotation stands in their window: what is quoted teaches no lexicon."""
    if not QUOTES.search(text):
        words = WORD.findall(text)
        return words, [True] * len(words)
    spans = [m.span() for m in WORD.finditer(text)]
    starts = [a for a, _ in spans]
    free = [True] * len(spans)
    for m in QUOTES.finditer(text):
        k = bisect.bisect_left(starts, m.start())
        lo, hi = max(0, k - WINDOW - 1), min(len(free), k + WINDOW + 1)
        free[lo:hi] = [False] * (hi - lo)
    return [text[a:b] for a, b in spans], free


def _prefix_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prefix, whole, context, n) of the words.

    Toxic ones come once for each word before them (n is 0), so that copies of one document are no evidence, and with the number
    of documents that hold them (context -1); clean ones with the number of documents (context 0).
    """
    counts: Counter = Counter()
    toxic: set[tuple[str, int, int]] = set()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words, plain = _unquoted(text.decode("utf-8", "replace").lower())
            if label:
                for before, w in ((b, w) for b, w, free in zip(["", *words], words, plain) if free):
                    context = zlib.crc32(before.encode()) + 1
                    toxic.add((w, 1, context))
                    toxic.update((w[:k], 0, context) for k in range(SHORTEST, min(len(w), LONGEST) + 1))
            kind, own = -1 if label else 0, {w for w, free in zip(words, plain) if free}
            counts.update((w, 1, kind) for w in own)
            counts.update({(w[:k], 0, kind) for w in own for k in range(SHORTEST, min(len(w), LONGEST) + 1)})
    keys = [*toxic, *counts]
    for at in range(0, len(keys), 50_000):
        part = keys[at : at + 50_000]
        columns = [pa.array([k[0] for k in part], pa.string()), pa.array([k[1] for k in part], pa.int32()), pa.array([k[2] for k in part], pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([counts.get(k, 0) for k in part], pa.int64())], names=["prefix", "whole", "context", "n"])


def chance(toxic: int, clean: int, share: float) -> float:
    """Probability of so many toxic or more if the labels were drawn at random."""
    n = toxic + clean
    log = math.lgamma(n + 1)
    return sum(math.exp(log - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log(1 - share)) for k in range(toxic, n + 1))


def lexicon(
    prefixes: dict[str, tuple[int, int]], words: dict[str, tuple[int, int]], alike: dict[int, int], share: float
) -> list[Entry]:
    """Entries from the counts, toxic and clean, of each prefix and each whole word.

    ``alike`` says how many prefixes have a count: among so many, the entry must not be a matter of chance.
    """

    def sure(pair: tuple[int, int]) -> bool:
        n = sum(pair)
        return pair[0] >= SUPPORT and pair[0] / n >= PRECISION and chance(*pair, share) * alike.get(n, 1) < CHANCE

    below: dict[str, list[str]] = {}
    for p in prefixes:
        below.setdefault(p[:-1], []).append(p)
    out, queue = [], [p for p in prefixes if len(p) == SHORTEST]
    while queue:
        p = queue.pop()
        if not sure(prefixes[p]):
            queue += below.get(p, [])
            continue
        while (kids := [k for k in below.get(p, []) if prefixes[k][0] >= 0.95 * prefixes[p][0]]) and len(p) < LONGEST:
            p = kids[0]
        own = words.get(p, (0, 0))
        odds = (prefixes[p][0] + 0.5) / (prefixes[p][1] + 0.5) * (1 - share) / share
        out.append(Entry(p, own[0] < 0.9 * prefixes[p][0], min(6.0, math.log(odds))))
    return sorted(out, key=lambda e: (-prefixes[e.text][0], e.text))


def _logistic(x: np.ndarray, y: np.ndarray, prior: tuple[float, float]) -> tuple[float, float]:
    """Slope and intercept by Newton steps, drawn a little towards the prior."""
    design, beta, mean = np.column_stack((x, np.ones(len(x)))), np.array(prior), np.array(prior)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - 0.5 * (beta - mean)
        bend = (design * (p * (1 - p))[:, None]).T @ design + 0.5 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(bend, slope), -1, 1)
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn a model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) of the training folds.

    Labels that are null are skipped; a document labelled twice is toxic if one label says so. Without labels
    the model scores every text alike, below one half.
    """
    prepared(docs.sparkSession)
    labelled = labels.filter(is_training() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # at most fit_rows rows of (long, int): a proven bound for the broadcast
    sample = F.broadcast(labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    rows = docs.select("doc_id", text_bytes().alias("text")).join(sample, "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    counted = rows.mapInArrow(_prefix_counts, "prefix string, whole int, context long, n long")
    counted = counted.groupBy("prefix", "whole", "context").agg(F.sum("n").alias("n"))
    contexts, documents, clean_documents = (F.sum(F.when(F.col("context") > 0, 1).otherwise(0)), *(F.sum(F.when(F.col("context") == k, F.col("n")).otherwise(0)) for k in (-1, 0)))
    counted = counted.groupBy("prefix", "whole").agg(F.least(contexts, documents).alias("toxic"), clean_documents.alias("clean"))
    counted = stored(counted, "prefixes")
    totals = rows.agg(F.sum("toxic"), F.count("*")).first()
    toxic, clean = totals[0] or 0, totals[1] - (totals[0] or 0)
    if not toxic or not clean:
        return Model()
    # prefixes of at least SUPPORT toxic documents out of a bounded sample
    found = counted.filter(F.col("toxic") >= SUPPORT).collect()
    whole = {w: {r.prefix: (r.toxic, r.clean) for r in found if r.whole == w} for w in (0, 1)}
    total = (F.col("toxic") + F.col("clean")).alias("n")
    # how many prefixes have each count up to a fixed one; greater counts are never a matter of chance
    alike = {r.n: r["count"] for r in counted.filter("whole = 0").groupBy(total).count().filter("n <= 1000").collect()}
    share = counted.agg(F.sum("toxic") / (F.sum("toxic") + F.sum("clean"))).first()[0]
    model = Model(lexicon(whole[0], whole[1], alike, share))

    @F.arrow_udf("array<struct<word:string,first:int,entry:string>>")
    def neighbours_of(texts: pa.Array) -> pa.Array:
        matcher = Matcher(model.entries)
        memo: dict[str, list] = {}
        out = []
        for t in texts.to_pylist():
            found = []
            for word in set(WORD.findall(t.decode("utf-8", "replace").lower())):
                if word not in memo:
                    if len(memo) > MEMO:
                        memo.clear()
                    hits = matcher.matches(word)
                    # a word that is an entry's own is no neighbour; the first letter counts as edited only if there is no other way
                    memo[word] = [] if any(e == 0 for e, _, _ in hits) else [(first, x.text) for _, first, x in hits]
                found += [{"word": word, "first": first, "entry": entry} for first, entry in memo[word]]
            out.append(found)
        return pa.array(out, pa.list_(pa.struct([("word", pa.string()), ("first", pa.int32()), ("entry", pa.string())])))

    # what the ordinary words near each entry are, and how many: two rows for an entry at most
    near = rows.filter("toxic = 0").select(F.explode(neighbours_of("text")).alias("hit")).groupBy("hit.entry", "hit.first", "hit.word").agg(F.lit(1))
    near = near.groupBy("entry", "first").agg(F.count("*").alias("n"), F.min("word").alias("word")).collect()
    crowded = {(r.entry, r.first) for r in near if r.n > 1}
    model.ordinary = {r.word for r in near if r.n == 1}
    for entry in model.entries:
        entry.exact = (entry.text, 0) in crowded
        entry.rooted = (entry.text, 1) in crowded

    @F.arrow_udf("struct<n:int,edits:boolean,quoted:boolean,kinds:array<struct<edits:int,quoted:boolean,weight:double>>>")
    def summary_of(texts: pa.Array) -> pa.Array:
        scorer = Scorer(model)
        out = []
        for t in texts.to_pylist():
            hits = scorer.hits(t.decode("utf-8", "replace").lower())
            kinds = [{"edits": e, "quoted": q, "weight": w} for (e, q), w in strongest(hits).items()]
            out.append({"n": len(hits), "edits": all(h[1] for h in hits), "quoted": all(h[2] for h in hits), "kinds": kinds})
        kind = pa.struct([("edits", pa.int32()), ("quoted", pa.bool_()), ("weight", pa.float64())])
        return pa.array(out, pa.struct([("n", pa.int32()), ("edits", pa.bool_()), ("quoted", pa.bool_()), ("kinds", pa.list_(kind))]))

    # fit_rows rows at most, of six numbers at most for each
    seen = rows.select("toxic", summary_of("text").alias("hits")).select("toxic", "hits.*").collect()

    def toxic_share(name: str) -> float:
        y = [r.toxic for r in seen if r.n and r[name]]
        return (sum(y) + 1.4) / (len(y) + 2)

    model.misspelled, model.quoted = toxic_share("edits"), toxic_share("quoted")
    x = np.array([strength(model, r.n, {(k.edits, k.quoted): k.weight for k in r.kinds}) for r in seen])
    model.slope, model.intercept = _logistic(x, np.array([r.toxic for r in seen], float), (1.5, -3.0))
    return model


def with_score(docs: DataFrame, model: Model, name: str = "score", text: str = "text") -> DataFrame:
    """Add each text's score from 0 to 1; a null text scores as an empty one, which has no hits.

    Texts are read whole, equal ones score alike, and an empty table stays empty.
    """
    prepared(docs.sparkSession)

    @F.arrow_udf("double")
    def of_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for batch in batches:
            yield pa.array([scorer.score(t.decode("utf-8", "replace")) for t in batch.to_pylist()], pa.float64())

    return docs.withColumn(name, of_texts(text_bytes(text)))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    scored = with_score(packed(docs, "text"), fit(docs, labels))
    return unpacked(scored.filter(F.col("score") < threshold))
