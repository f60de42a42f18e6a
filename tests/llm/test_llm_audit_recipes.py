import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from awkward import documents, pairs, with_extras
from pyspark.sql import functions as F

from starload.llm.filteraudit import FILTERS, audit, corpus_masks, intervals, lehmer_rank
from starload.llm.recipes import MOST, ambiguous, chunks, exact_groups, identified, normal_text, recipes, without_copies

LABELS = [(1, 1, 0), (1, 0, 1), (3, 1, None), (None, 1, 1), (4, None, 1), (99, 1, 1), (10, 1, 0), (11, 1, 1)]
MORE = [(10 + i, ["alpha BETA $ gamma " * 80, "", "the same words again " * 60, "x # Y"][i % 4], "en", ["a", "b"][i % 3 == 0], 0) for i in range(12)]


def corpus(spark):
    df = documents(spark)
    return df.union(spark.createDataFrame(MORE, df.schema))


def plain_masks(rows, labels):
    texts = [(r.doc_id, r.text or "", r.source or "") for r in rows]
    out = []
    for doc_id, text, part in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = [
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            bool(re.search("[#$%&*|]", text)), any(t == text and i is not None and doc_id is not None and i < doc_id for i, t, _ in texts),
        ]
        own = [x for x in labels if doc_id is not None and x[0] == doc_id]
        out.append((part, sum(b << k for k, b in enumerate(bad)), any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    return out


def plain_audit(masks, letters=FILTERS):
    out, shapley = {}, Counter()
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        fails = lambda m, x: m[1] >> letters.index(x) & 1
        for order in permutations(letters):
            left = own
            for step, x in enumerate(order, 1):
                gone, rest = [m for m in left if fails(m, x)], [m for m in left if not fails(m, x)]
                failing = [m for m in own if fails(m, x)]
                alone = [m for m in failing if m[1] == 1 << letters.index(x)]
                out[part, "".join(order), step] = [len(rest), len(gone), len(failing) - len(gone), len(alone), sum(m[2] for m in gone), sum(m[3] for m in gone)]
                shapley[part, x] += len(gone)
                left = rest
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def test_intervals_are_the_removal_steps_of_every_order():
    orders = ["".join(p) for p in permutations(FILTERS)]
    assert [lehmer_rank(o) for o in orders] == list(range(120)) and lehmer_rank("C") == 48
    found = defaultdict(list)
    for mask, step, start, end in intervals():
        for rank in range(start, end):
            found[mask, rank].append(step)
    expected = {}
    for mask in range(1, 32):
        for rank, order in enumerate(orders):
            expected[mask, rank] = [next(s for s, x in enumerate(order, 1) if mask >> FILTERS.index(x) & 1)]
    assert found == expected


def test_audit_equals_every_order_played_out(spark):
    df = corpus(spark)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    expected = plain_masks(df.collect(), LABELS)
    assert pairs(corpus_masks(with_extras(df), labels), "part", "mask", "good", "toxic") == sorted(expected, key=str)
    masks = spark.createDataFrame(expected, "part string, mask int, good boolean, toxic boolean")
    result = audit(masks.withColumns({c: F.lit(7) for c in ("step", "rank", "n", "total", "at", "gone", "shapley", "start", "stop")}))
    assert sorted(tuple(r) for r in result.collect()) == plain_audit(expected)
    assert dict(result.dtypes)["step"] == "int" and all(t == "bigint" for c, t in result.dtypes if c not in ("part", "filter_order", "step"))


def test_audit_of_fewer_filters_and_of_nothing(spark):
    rng = random.Random(5)
    rows = [(rng.choice("pq"), rng.randrange(8), rng.random() < 0.3, rng.random() < 0.2) for _ in range(300)] + [("hot", 5, True, False)] * 500
    masks = spark.createDataFrame(rows, "part string, mask int, good boolean, toxic boolean")
    assert sorted(tuple(r) for r in audit(masks, "ABC").collect()) == plain_audit(rows, "ABC")
    docs = documents(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(corpus_masks(docs.limit(0), labels)).count() == 0
    assert corpus_masks(docs, labels).filter("good or toxic").isEmpty()
    with pytest.raises(ValueError):
        audit(masks, "BA")


def texts(seed=3):
    rng = random.Random(seed)
    words = ["w%d" % rng.randrange(400) for _ in range(4000)]
    base = [" ".join(rng.choices(words, k=rng.randrange(0, 300))) for _ in range(25)]
    out = [rng.choice(base) for _ in range(60)] + base
    return [t.replace(" ", rng.choice([" ", "\n", " \t ", "\r\n\x0b"])) if rng.random() < 0.4 else t for t in out]


def plain_groups(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    left, out = dict(keep), []
    for i, t in sorted(norm, key=str):
        out.append((i, keep[t], len(groups[t]), t in left and left[t] == i, hashlib.sha256(t.encode()).hexdigest()))
        if out[-1][3]:
            del left[t]
    return sorted(out, key=str)


COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


@pytest.mark.parametrize("bits", [64, 6])
def test_groups_equal_compared_texts(spark, bits):
    """With hashes of six bits nearly every chunk shares its hash with others, so the numbers of the variants decide."""
    rows = list(enumerate(texts())) + [(None, "no id"), (None, "no  id"), (3, None), (3, ""), (3, ""), (7, " "), (2, "\n\t")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert pairs(exact_groups(df, bits), *COLUMNS) == plain_groups(rows)
    stock = recipes(df, bits)
    assert ambiguous(stock, bits).isEmpty() == (bits == 64)
    if bits < 64:
        found = identified(stock, bits)
        assert found.filter("size(variants) > 0").count() > 60 and found.count() == len(rows)


def test_chunks_are_cut_by_content(spark):
    rng = random.Random(1)
    passage = " ".join("p%d" % rng.randrange(10**6) for _ in range(700))
    rows = [(1, passage), (2, "other words before " + passage + " and after"), (3, "a " * 5000), (4, "x" * 40_000), (5, "ä😀 " * 900), (6, ""), (7, " lead")]
    cut = {r.doc_id: (r.t, r.c) for r in spark.createDataFrame(rows, "doc_id int, text string").select("doc_id", normal_text().alias("t")).select("doc_id", "t", chunks(F.col("t")).alias("c")).collect()}
    assert all("".join(c) == t for t, c in cut.values())
    assert all(len(x) <= 65 * MOST for _, c in cut.values() for x in c) and cut[6][1] == []
    assert 10 < len(cut[1][1]) < 60
    assert len(set(cut[1][1]) & set(cut[2][1])) > 0.7 * len(cut[1][1])
    assert len(cut[4][1]) > 1 and len(cut[3][1]) >= 5000 // MOST


def test_recipes_awkward_rows(spark):
    df = documents(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    clash = with_extras(df)
    assert pairs(exact_groups(clash), *COLUMNS) == plain_groups(rows) == pairs(exact_groups(df.repartition(5)), *COLUMNS)
    assert exact_groups(df.limit(0)).count() == 0 and without_copies(df.limit(0)).count() == 0
    kept = without_copies(clash)
    assert kept.columns == clash.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4, 5, 6]
    twice = spark.createDataFrame([(1, "a b", "y"), (1, "a  b", "x"), (2, "a b", "w")], "doc_id long, text string, more string")
    assert pairs(without_copies(twice), "doc_id", "more") == [(1, "x")]


def test_recipes_run_without_python(spark):
    plan = exact_groups(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
