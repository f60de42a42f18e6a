import random

import numpy as np
import pytest
import xxhash
from awkward import documents, pairs, with_extras

from starload.llm.components import components
from starload.llm.simhash import close_pairs, fingerprint, forest, gray_rank, keep_one, near_groups, shingle_hashes


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def roots(codes):
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


@pytest.mark.parametrize("text", ["", None, "One", "one TWO", "a b c", "a b c d e", "Ä a\x0bb c " * 300, "x y z w " * 40_000])
def test_fingerprint(text):
    assert fingerprint(shingle_hashes((text or "").encode(), 3)) == plain_fingerprint(text)


def near_codes(rng, centres=30, each=12):
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(each):
            code = centre
            for bit in rng.sample(range(64), rng.randrange(5)):
                code ^= 1 << bit
            out.add(code)
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_index_finds_all_close_pairs(seed):
    codes = np.array(near_codes(random.Random(seed)), np.uint64)
    codes = codes[np.argsort(gray_rank(codes))]
    found = {(int(a), int(b)) for i, j in close_pairs(codes) for a, b in zip(i, j)}
    expected = {(i, j) for j in range(len(codes)) for i in range(j) if int(codes[i] ^ codes[j]).bit_count() <= 3}
    assert found == expected
    u, v = forest(codes)
    assert len(u) < len(codes)  # never all pairs


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).selectExpr("id + 1 as u", "id as v").union(spark.createDataFrame([(900, 901), (901, 900)], "u long, v long"))
    assert {tuple(r) for r in components(edges).collect()} == {(k, 0) for k in range(1, 201)} | {(901, 900)}
    assert components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("bucket", [4, 20_000])
def test_groups_equal_brute_force(spark, bucket):
    """A small bucket cuts hot buckets into parts that meet by their prefixes."""
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(60)) for _ in range(6)]
    texts = []
    for i in range(150):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"new{i}"
        texts.append(" ".join(words))
    texts += ["", None, "Alone here now"]
    ids = rng.sample(range(1000), len(texts))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    codes = [plain_fingerprint(t) for t in texts]
    least = {}
    for i, r in enumerate(roots(codes)):
        least[r] = min(least.get(r, 1000), ids[i])
    expected = {ids[i]: (codes[i], least[r]) for i, r in enumerate(roots(codes))}
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in near_groups(df, bucket).collect()}
    assert got == expected
    kept = {r.doc_id for r in keep_one(df).collect()}
    assert kept == {least[r] for r in roots(codes)}


def test_awkward_rows(spark):
    df = documents(spark)
    groups = near_groups(with_extras(df))
    assert groups.columns == ["doc_id", "fp", "component_id"] and groups.count() == df.count()
    # texts without words share the fingerprint zero
    assert {r.component_id for r in groups.filter("fp = 0").collect()} == {2}
    kept = keep_one(with_extras(df))
    assert kept.columns == with_extras(df).columns
    assert pairs(kept, "doc_id") == [(1,), (2,), (4,), (6,), (None,)]
    assert near_groups(df.limit(0)).count() == 0 and keep_one(df.limit(0)).count() == 0
