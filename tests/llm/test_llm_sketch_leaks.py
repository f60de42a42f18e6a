import hashlib
import random

import numpy as np
from awkward import LONG, documents, pairs, with_extras

from starload.llm import sketch
from starload.llm.decontaminate import align, leaks, without_leaks


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    a, b = " ".join(words), " ".join(words[1000:] + [f"v{i}" for i in range(1000)])
    x, y = sketch.of_text(a), sketch.of_text(b)
    true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert abs(sketch.resemblance(x, y) - true) < 0.13
    assert abs(sketch.containment(x, y) - len(shingles(a) & shingles(b)) / len(shingles(a))) < 0.2
    assert abs(sketch.distinct_count(x) / len(shingles(a)) - 1) < 0.3
    assert (sketch.decoded(sketch.encoded(x)) == x).all()
    assert (sketch.merge(x, y) == sketch.merge(y, x)).all() and (sketch.merge(x, x) == x).all()
    texts = [" ".join(rng.sample(words, 40)) for _ in range(60)]
    df = spark.createDataFrame([(i % 3 or None, t) for i, t in enumerate(texts)], "g long, text string")
    merged = {r.g: r.sketch for r in sketch.merged_sketches(sketch.with_sketch(df.repartition(7)), "g").collect()}
    for group in (1, 2, None):
        own = [sketch.of_text(t) for i, t in enumerate(texts) if (i % 3 or None) == group]
        assert merged[group] == sketch.encoded(sketch.merge(*own))


def test_edited_texts_equal_brute_force(spark):
    rng = random.Random(2)
    docs = [(i * 7, "".join(rng.choice("ab é😀\n") for _ in range(rng.randrange(80)))) for i in range(90)]
    df = spark.createDataFrame(rng.sample(docs, len(docs)), "doc_id long, text string")
    for ranges in (1, 3, 40):
        got = {r.doc_id: r for r in sketch.edited_fingerprints(df, ranges).collect()}
        assert len(got) == 90
        for k, (i, text) in enumerate(docs):
            following = docs[(k + 1) % 90][1]
            half = len(text) // 2
            edited = text[: len(text) - half] + following[:half]
            assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(text)
            a, b = shingles(text), shingles(edited)
            assert abs(got[i].near_edited - (len(a & b) / len(a | b) if a | b else 1)) < 1e-9  # exact below k shingles


def test_sketch_awkward_rows(spark):
    df = documents(spark)
    result = sketch.edited_fingerprints(with_extras(df), 4)
    assert result.count() == df.count()
    assert {r.fingerprint for r in result.filter("doc_id in (2, 3, 5)").collect()} == {""}
    # a null id is followed by the first document
    text = "no id at all"
    first = "the quick brown fox jumps over the lazy dog"
    row = result.filter("doc_id is null and n_chars > 0").first()
    assert row.edited_sha256 == hashlib.sha256((text[:6] + first[:6]).encode()).hexdigest()
    assert len({r.fingerprint for r in result.filter("doc_id = 1").collect()}) == 1
    assert sketch.edited_fingerprints(df.limit(0), 4).count() == 0
    assert sketch.edited_fingerprints(df.filter("doc_id is null"), 4).count() == 2


def plain_score(item, passage):
    table, best = np.zeros((len(item) + 1, len(passage) + 1), int), 0
    for i, x in enumerate(item, 1):
        for j, y in enumerate(passage, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if x == y else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
            best = max(best, table[i, j])
    return best


def test_alignment_equals_dynamic_programming():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (rng.integers(0, 5, rng.integers(0, 20)).astype(np.uint64) for _ in range(2))
        score, end = align(a, b)
        assert score == plain_score(a.tolist(), b.tolist()) and 0 <= end <= len(b)


def test_leaks_find_edited_copies_and_spare_clean_documents(spark):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("an", "el", "ir", "os", "um", "ath", "ont", "iss")]

    def sentence(n):
        return [rng.choice(words) for _ in range(n)]

    items = [(i, sentence(30)) for i in range(8)] + [(8, ["short", "item", "here"]), (9, ["two", "words"]), (10, [])]
    docs, expected = [], set()
    for d in range(300):
        text = sentence(80)
        if d % 3 == 0:  # one item is in a third of all documents
            item = 0 if d % 2 else rng.randrange(8)
            copy = list(items[item][1])
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], ["changed"], ["added", copy[at]]])
            text[40:40] = copy
            expected.add((d, item))
        docs.append((d, ", ".join(text).upper() if d % 4 == 0 else " ".join(text)))
    docs += [(1000, "a short item here indeed"), (1001, "two words"), (1002, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items] + [(None, None)], "item_id long, text string")
    found = leaks(df, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected | {(1000, 8)}
    kept = {r.doc_id for r in without_leaks(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in expected} - {1000}


def test_leaks_that_miss_the_rarest_ngrams(spark):
    """Edited copies without the n-grams that stand nowhere else, and parts that many and few documents hold."""
    rng = random.Random(10)

    def sentence(name, n):
        return [f"{name}{rng.randrange(10**6)}" for _ in range(n)]

    items = [sentence("a", 30), sentence("b", 30)]
    edited = [f"new{k}" if k in (6, 13, 20) else w for k, w in enumerate(items[0])]
    parts = [items[1][:18]] * 6 + [items[1][12:]] * 2
    docs = [(d, sentence("x", 40) + copy + sentence("y", 40)) for d, copy in enumerate([edited, edited, *parts, []])]
    # a word added after each but the last three
    spread = [w for k, word in enumerate(items[0]) for w in ([word] if k > 26 else [word, f"more{k}"])]
    docs.append((20, sentence("x", 40) + spread))
    df = spark.createDataFrame([(d, " ".join(t)) for d, t in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in leaks(df, bench).collect()}
    assert found == {(d, i): s for d in range(2) for i, s in [(0, 27 * 2 - 3)]} | {(d, 1): 36 for d in range(2, 10)} | {(20, 0): 60 - 27}
    assert {r.doc_id for r in without_leaks(df, bench).collect()} == {10}


def test_leaks_awkward_rows(spark):
    df = documents(spark)
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, LONG[5000:6000])], "item_id long, text string").withColumn("words", df.schema and __import__("pyspark").sql.functions.lit(0))
    assert pairs(leaks(with_extras(df), bench), "doc_id", "item_id") == [(1, 1), (4, 3)]
    kept = without_leaks(with_extras(df), bench)
    assert kept.columns == with_extras(df).columns and kept.count() == 6
    assert without_leaks(df, bench.limit(0)).count() == df.count()
    assert without_leaks(df.limit(0), bench).count() == 0
