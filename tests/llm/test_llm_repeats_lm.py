import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from awkward import documents, with_extras

from starload.llm import lm
from starload.llm.repeats import anchors, common_prefixes, covered_spans, repeated_passages, suffix_array, with_passages, without_repeats


@pytest.mark.parametrize("size", [1, 2, 40, 900])
@pytest.mark.parametrize("letters", [1, 2, 255])
def test_suffix_arrays(size, letters):
    rng = random.Random(size * letters)
    text = bytes(rng.randrange(letters) for _ in range(size)) * 2
    order = suffix_array(np.frombuffer(text, np.uint8))
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])

    def common(a, b):
        return next((k for k, (x, y) in enumerate(zip(text[a:], text[b:])) if x != y), min(len(text) - a, len(text) - b))

    found = common_prefixes(np.frombuffer(text, np.uint8), order).tolist()
    assert found == [0] + [common(a, b) for a, b in zip(order[:-1].tolist(), order[1:].tolist())]


def plain_removal(docs):
    counts = Counter(t[i : i + 400] for _, t in docs for i in range(len(t) - 399))
    out = []
    for doc_id, text in docs:
        gone = bytearray(len(text))
        for i in range(len(text) - 399):
            if counts[text[i : i + 400]] > 1:
                gone[i : i + 400] = b"\x01" * 400
        kept = bytes(c for c, g in zip(text, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("piece", [2, 2048])
def test_removal_equals_brute_force(spark, piece, monkeypatch):
    """A small piece cuts the contexts of every block over several shards."""
    rng = random.Random(7)
    words = [rng.choice(["alpha", "beta", "gamma", "é", "x"]) + str(rng.randrange(50)) for _ in range(2000)]
    passages = [" ".join(words[i : i + 80]) for i in range(0, 1600, 80)]
    rows = []
    for i in range(70):
        s = " ".join(rng.choice(words) for _ in range(rng.randrange(5, 60)))
        k, a, b = rng.randrange(20), rng.randrange(150), rng.randrange(380, 500)
        rows.append((i, s + passages[k][a : a + b] + s[::-1] + (passages[k * 7 % 20][: rng.randrange(395, 405)] if i % 3 == 0 else "")))
    rows += [(200, "a" * 1000), (201, "a" * 399), (202, "a" * 400), (203, "ab" * 600), (204, None), (205, ""), (206, "é" * 250), (207, "abc" * 140)]
    rows += [(None, rows[5][1]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr("starload.llm.repeats.covered_spans", lambda d: covered_spans(d, piece))
    got = sorted((tuple(r) for r in without_repeats(df).drop("kept").collect()), key=str)
    assert got == plain_removal([(i, (t or "").encode()) for i, t in rows])


def test_pieces_settled_alone_equal_brute_force(spark, monkeypatch):
    """Texts that share 400 bytes and little more around a line of very many contexts, which no shard holds together."""
    rng = random.Random(11)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))

    line, rows = noise(160), []
    for i in range(40):
        shared = noise(rng.randrange(110, 130)) + line + noise(rng.randrange(110, 130))
        rows += [(2 * i + k, noise(rng.randrange(300)) + shared[: 400 + i % 5] + noise(rng.randrange(300) if i % 3 else 0)) for k in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr("starload.llm.repeats.covered_spans", lambda d: covered_spans(d, 1, 1))
    got = sorted((tuple(r) for r in without_repeats(df).drop("kept").collect()), key=str)
    expected = plain_removal([(i, t.encode()) for i, t in rows])
    assert got == expected and sum(r[2] > 0 for r in expected) > 10


def plain_passages(rows):
    """Maximal runs, and their words, of passages of 51 words that another text holds too."""
    texts = {t: [w for w in re.split("[\\x20\\x09-\\x0D]+", "".join(c.lower() if c < "\x80" else c for c in t)) if w] for t in {t or "" for _, t in rows}}
    where = {}
    for t, words in texts.items():
        for i in range(len(words) - 50):
            where.setdefault(tuple(words[i : i + 51]), set()).add(t)
    out = []
    for i, t in rows:
        words, covered = texts[t or ""], set()
        for k in range(len(words) - 50):
            if len(where[tuple(words[k : k + 51])]) > 1:
                covered.update(range(k, k + 51))
        out.append((i, sum(k - 1 not in covered for k in covered), len(covered)))
    return sorted(out, key=str)


def test_passages_equal_brute_force(spark):
    rng = random.Random(3)

    def some(n):
        return [rng.choice(["alpha", "Beta", "é", "x"]) + str(rng.randrange(900)) for _ in range(n)]

    passages, rows = [some(n) for n in (50, 51, 52, 60, 75, 76, 77, 130)], []
    for i in range(60):
        words = some(rng.randrange(0, 40))
        for p in rng.sample(passages, rng.randrange(0, 3)):
            words += p + some(rng.randrange(0, 3))
        rows.append((i, rng.choice([" ", "\n"]).join(words).swapcase() if i % 7 == 0 else " ".join(words)))
    alone = " ".join(some(80))
    rows += [(100, f"{alone} and {alone}"), (101, "w " * 200), (102, "w " * 150), (103, None), (104, ""), (None, rows[3][1]), (3, rows[3][1])]
    # swapped case changes no word of ASCII letters, but é
    found = with_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    expected = plain_passages(rows)
    assert sorted(((r.doc_id, r.n_passages, r.n_passage_words) for r in found.collect()), key=str) == expected
    assert sum(n > 0 for _, n, _ in expected) > 20 and [x for x in expected if x[0] == 100] == [(100, 0, 0)]
    kept = without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, kept.select(columns).collect()))


def test_long_texts_are_taken_in_pieces():
    """Every stretch has the anchor it has when the text is taken whole."""
    rng = np.random.default_rng(2)
    data = rng.integers(97, 101, 30_000).astype(np.uint8)
    cuts = np.array([0, 700, 20_000, 20_100, 30_000])

    def by_stretch(found):
        return {s: (p, h, t) for p, h, t, a, b in zip(*(x.tolist() for x in found)) for s in range(a, b + 1)}

    whole = by_stretch(anchors(data, cuts))
    assert by_stretch(anchors(data, cuts, 4096)) == whole and by_stretch(anchors(data, cuts, 1000)) == whole


def test_repeats_awkward_rows(spark):
    df = documents(spark)
    result = without_repeats(with_extras(df))
    assert result.count() == df.count() and result.filter("n_removed > 0").isEmpty()
    assert without_repeats(df.limit(0)).count() == 0
    marked = with_passages(with_extras(df))
    assert marked.count() == df.count() and marked.filter("n_passages > 0").isEmpty()
    assert with_passages(df.limit(0)).count() == 0 and repeated_passages(df.limit(0)).count() == 0


class PlainAutomaton:
    """States, arcs and failure arcs as dictionaries, walked token by token."""

    def __init__(self, texts):
        self.words = Counter(w for t in texts for w in t)
        pairs = Counter(p for t in texts for p in zip(t, t[1:]))
        self.total, self.kinds = sum(self.words.values()), len(self.words)
        once, twice = (sum(n == k for n in self.words.values()) for k in (1, 2))
        self.discount = once / (once + 2 * twice) if twice else lm.DISCOUNT
        self.arcs, self.failure = {}, {}
        for (v, w), n in pairs.items():
            if n >= 2:
                self.arcs.setdefault(v, {})[w] = n
        for v, arcs in self.arcs.items():
            self.failure[v] = 1 - sum(n - lm.DISCOUNT for n in arcs.values()) / self.words[v]

    def unigram(self, w):
        n = self.words[w]
        return (n - self.discount) / self.total if n else self.discount * self.kinds / self.total

    def step(self, state, w):
        if w in self.arcs.get(state, {}):
            return (self.arcs[state][w] - lm.DISCOUNT) / self.words[state] + self.failure[state] * self.unigram(w)
        return self.failure.get(state, 1.0) * self.unigram(w)

    def score(self, text):
        total, state = 0.0, "no word"
        for w in text:
            total += math.log10(self.step(state, w))
            state = w
        return total


def lm_corpus(n=200, seed=8):
    rng = random.Random(seed)
    words = ["the", "of", "and", "Über", "x y", "Z"] + [f"w{i}" for i in range(300)]

    def text(n):
        """Most words have a usual follower."""
        out = [rng.randrange(len(words))]
        while len(out) < n:
            out.append((out[-1] * 7 + 1) % len(words) if rng.random() < 0.7 else rng.randrange(len(words)))
        return rng.choice([" ", "\t", "\n "]).join(words[k] for k in out[:n])

    return [(i, None if i % 17 == 0 else text(rng.randrange(60))) for i in range(n)]


def lower(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_a_plain_automaton(spark, small, monkeypatch):
    """Small blocks and buckets, and with them most words dealt out by both words of their bigrams."""
    if small:
        monkeypatch.setattr(lm, "PIECE", 300)
        monkeypatch.setattr(lm, "BUCKET", 50)
    else:
        monkeypatch.setattr(lm, "SHARE", 20)
    docs = lm_corpus() + [(1000, "the the the the"), (1000, "the the the the"), (None, "of and of and"), (1001, "never seen before")]
    tokens = [(i, [*lower(t).split(), None]) for i, t in docs]
    learned = [ts for i, ts in tokens if i is not None and zlib.crc32(str(i).encode()) % 10]
    model = PlainAutomaton(learned)
    expected = Counter()
    for i, ts in tokens:
        base = sum(math.log10((model.words[w] + 0.1) / (model.total + 0.1 * (model.kinds + 1))) for w in ts)
        expected[i, len(ts), sum(model.words[w] > 0 for w in ts), model.total, round(base, 7), round(model.score(ts), 7)] += 1
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = lm.scores(df, "crc32(cast(doc_id as string)) % 10 <> 0").collect()
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 7), round(r.score, 7)) for r in found) == expected
    held = [r for r in found if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_the_automaton_is_a_distribution():
    model = PlainAutomaton([["a", "b", "a", "b", "c", None], ["b", "a", "b", "a", None], ["c", "d", None]])
    for state in ("a", "b", "c", "d", "no word"):
        assert math.isclose(sum(model.step(state, w) for w in [*model.words, "unseen"]), 1.0, rel_tol=1e-9)


def test_arcs_grow_with_the_corpus(spark, monkeypatch):
    """Nothing is dropped as the corpus grows: ten times the texts ask for and get all their bigrams."""
    monkeypatch.setattr(lm, "PIECE", 4000)
    sizes = []
    for n in (100, 1000):
        docs = spark.createDataFrame(lm_corpus(n), "doc_id long, text string")
        rows = docs.selectExpr("0L as block", "true as learn", "cast(coalesce(text, '') as binary) as text").coalesce(1)
        asked = rows.mapInArrow(lm._ask(np.empty(0, np.uint64), 4), lm.REQUEST).sortWithinPartitions("bucket").coalesce(1)
        answers = asked.mapInArrow(lm._answer(np.empty(0, np.uint64)), lm.ANSWER).collect()
        counts = np.concatenate([lm._unpacked(r.counts, np.uint32) for r in answers])
        pairs = Counter(p for _, t in lm_corpus(n) for ts in [[*lower(t).split(), None]] for p in zip(ts, ts[1:]))
        assert sorted(counts.tolist()) == sorted(pairs.values())
        sizes.append(int((counts >= lm.LEAST).sum()))
    assert sizes[1] > 2 * sizes[0]


def test_lm_awkward_rows(spark):
    df = documents(spark)
    result = lm.scores(with_extras(df), "doc_id > 0")
    assert result.count() == df.count() and result.filter("score is null or base_score is null").isEmpty()
    assert {r.n_tokens for r in result.filter("doc_id in (2, 3, 5)").collect()} == {1}
    untrained = lm.scores(df, "false").collect()
    assert len(untrained) == df.count() and all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0 for r in untrained)
    assert lm.scores(df.limit(0), "true").count() == 0
