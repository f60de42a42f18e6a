import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from awkward import pairs
from pyspark.sql import functions as F

from starload.llm import countmin, prefixes
from starload.llm.prefixes import ends_digest, numbered, rebuilt, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def turns_of(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, x = role or "", text or ""
            key = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()
            convs[c].append((turn is not None, turn or 0, key, r, x))
    return {c: [(r, x) for *_, r, x in sorted(own)] for c, own in convs.items()}


def plain_rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    nodes = defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
    below = defaultdict(list)
    for path in nodes:
        for d in range(len(path) + 1):
            below[path[:d]].append(path)
    kids = {p: sum(len(q) == len(p) + 1 for q in below[p]) for p in nodes}
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    out = []
    for path, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(convs[c]) == len(path))))
        saved = sum((len(nodes[q]) - 1) * words(q) for q in below[path])
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), kids[path], sum(kids[q] == 0 for q in below[path]), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rows_of(seed, convs=90, most=7):
    """Conversations over few turns, so that prefixes are shared at all depths, with copies and nested ones."""
    rng = random.Random(seed)
    ids = rng.sample(range(-45, 400), convs)
    rows = []
    for c in ids:
        n = rng.randrange(1, most)
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["hi there", "ok", "two  words", ""]) if rng.random() < 0.8 else f"own {c} {t}") for t in range(n)]
    for c in rng.sample(ids, 8):
        rows += [(1000 + c, *r[1:]) for r in rows if r[0] == c]
    return rows


AWKWARD = [
    (None, 0, "user", "no conversation"), (5, None, "user", "null turn first"), (5, 0, None, None), (5, 0, "", ""), (5, 0, "user", "tie a"), (5, 0, "user", "tie b"),
    (5, 0, "user", "tie b"), (7, 3, "assistant", "x"), (-3, 1, "user", "negative"), (-20, 1, "user", "its base"), (8, 1, "a", "b:c"), (9, 1, "a:b", "c"),
    (20, 0, "user", " ".join("w%d" % i for i in range(50_000))), (21, 0, "user", "short"),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_every_prefix_counted(spark, seed, monkeypatch):
    rows = rows_of(seed) + AWKWARD
    if seed == 2:  # blocks, pieces and sketch batches so small that all that is cut is put together again
        monkeypatch.setattr(prefixes, "BLOCK", 2)
        monkeypatch.setattr(prefixes, "IDS", 2)
        monkeypatch.setattr(countmin, "HELD", 8)
    df = spark.createDataFrame(rows, SCHEMA)
    expected = plain_rebuilt(turns_of(rows))
    turns, lengths = rebuilt(*numbered(df))
    assert pairs(lengths, "conv_id", "length") == sorted(((c, len(p)) for c, p in expected.items()), key=str)
    result = trie(turns, lengths)
    assert pairs(result, *COLUMNS) == plain_trie(expected)
    assert all(t == "bigint" for c, t in result.dtypes if c != "ends_sha256")


def test_without_rebuilding_and_whatever_the_partitions(spark):
    rows = rows_of(3, convs=40)
    df = spark.createDataFrame(rows, SCHEMA)
    expected = plain_trie(turns_of(rows))
    for frame in (df, df.repartition(7), df.withColumns({c: F.lit("own") for c in ("start", "n", "digest", "words", "length", "owner", "depth", "part", "block")})):
        turns, lengths = numbered(frame)
        assert pairs(trie(turns.join(lengths, "conv_id"), lengths), *COLUMNS) == expected


def test_long_conversation_with_a_third_of_all_rows(spark):
    """Copies of one conversation of thousands of turns, longer than a block, one of them cut short."""
    turns = [("user", f"turn {i} of many") for i in range(5000)]
    rows = [(c, i, *t) for c in (1, 2) for i, t in enumerate(turns)] + [(3, i, *t) for i, t in enumerate(turns[:4500])] + [(100 + i, 0, "user", f"other {i}") for i in range(200)]
    turns_df, lengths = numbered(spark.createDataFrame(rows, SCHEMA).repartition(6))
    found = {(r.conv_id, r.depth): r for r in trie(turns_df.join(lengths, "conv_id"), lengths).collect()}
    assert len(found) == 1 + 5000 + 200
    assert found[1, 4500].n_convs == 3 and found[1, 4501].n_convs == 2 and found[1, 4500].n_leaves == 1
    assert found[1, 4500].ends_sha256 == hashlib.sha256(b"3").hexdigest() and found[1, 5000].ends_sha256 == hashlib.sha256(b"1,2").hexdigest()
    assert found[1, 4501].saved_tokens == 4 * 500 and found[1, 0].saved_tokens == 4 * (2 * 4500 + 500)
    assert found[1, 0].n_children == 201 and found[1, 0].parent_conv_id is None


def test_repeated_rows_are_turns_of_their_own(spark):
    rows = [(1, 0, "user", "same")] * 9000 + [(2, 0, "user", "same")]
    turns, lengths = numbered(spark.createDataFrame(rows, SCHEMA))
    found = trie(turns.join(lengths, "conv_id"), lengths)
    assert found.count() == 9001 and found.filter("n_convs = 2").count() == 2
    assert found.filter("depth = 9000 and n_children = 0 and parent_conv_id = 1").count() == 1


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert trie(*rebuilt(*numbered(df))).count() == 0
    assert trie(*rebuilt(*numbered(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)))).count() == 0
    # of conversation 1 (h = 3, no base) no turn is left
    assert zlib.crc32(b"1") % 4 == 3
    rows = trie(*rebuilt(*numbered(spark.createDataFrame([(1, 0, "user", "gone")], SCHEMA)))).collect()
    assert [tuple(r) for r in rows] == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


def test_an_estimate_of_one_is_a_proof(spark):
    rng = np.random.default_rng(4)
    once, more = rng.integers(-(1 << 62), 1 << 62, 30_000), rng.integers(-(1 << 62), 1 << 62, 2_000)
    df = spark.createDataFrame([(int(v),) for v in np.concatenate([once, more, more])], "h long").repartition(5)
    for bits, let_through in ((countmin.width(34_000), 0.02), (countmin.LEAST_BITS, 0.5)):
        reached = countmin.repeated_bits(df, bits)
        passed = {r.h for r in df.filter(countmin.maybe_repeated(bits, reached, "h")).collect()}
        assert passed >= set(more.tolist())
        assert len(passed & set(once.tolist())) < let_through * len(once)
    assert countmin.width(0) == countmin.LEAST_BITS and countmin.width(10**12) == countmin.MOST_BITS
    none = countmin.repeated_bits(df.limit(0), 16)
    assert not none.any()


def test_only_possibly_shared_prefixes_are_grouped(spark):
    rows = [(c, t, "user", "same start" if t == 0 else f"own {c} {t}") for c in range(300) for t in range(10)]
    turns, lengths = numbered(spark.createDataFrame(rows, SCHEMA))
    found = prefixes._prefixes(turns.join(lengths, "conv_id"))
    bits = countmin.width(found.count())
    shared = found.filter(countmin.maybe_repeated(bits, countmin.repeated_bits(found, bits, "a"), "a"))
    assert 300 <= shared.count() < 300 + 0.02 * 2700


def test_ends_of_a_hot_node(spark):
    ids = spark.range(-500, 20_000).select(F.lit(-500).cast("long").alias("owner"), F.lit(2).cast("long").alias("depth"), F.col("id").alias("conv_id"))
    other = spark.createDataFrame([(7, 1, 7)], "owner long, depth long, conv_id long")
    found = {r.owner: r.ends_sha256 for r in ends_digest(ids.repartition(8).union(other)).collect()}
    assert found == {-500: hashlib.sha256(",".join(map(str, range(-500, 20_000))).encode()).hexdigest(), 7: hashlib.sha256(b"7").hexdigest()}
