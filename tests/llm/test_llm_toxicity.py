import random
import zlib

from awkward import documents, with_extras

from starload.llm.toxicity import Entry, Matcher, Model, Scorer, fit, with_score, without_toxic

BAD = ["dreckswort", "fiesling"]


def corpus(spark, n=600):
    """Every fifth document holds a bad word, one in ten of these only within quotation, where it is not toxic."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        kind = i % 10
        if kind in (0, 1):
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        elif kind == 2:
            at = rng.randrange(len(text))
            text[at:at] = ["“" + rng.choice(BAD) + "”"]
        elif kind == 3:  # a family of words with one stem
            text.insert(rng.randrange(len(text)), "schmutz" + rng.choice(words))
        docs.append((i, " ".join(text)))
        labels.append((i, int(kind in (0, 1, 3))))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    model = fit(docs, labels)
    assert {e.text for e in model.entries} >= set(BAD) and any(e.stem and e.text.startswith("schmutz"[:4]) for e in model.entries)
    scored = with_score(docs, model).join(labels, "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 80 and sum((r.score >= 0.5) == r.toxic for r in held) >= 0.95 * len(held)
    scorer = Scorer(model)
    assert scorer.score("you dreckswort") > scorer.score("you drecksw0rt") > scorer.score("nothing at all")
    assert scorer.score("you dreckswort") > scorer.score('he said "dreckswort" today')
    assert {r.doc_id for r in without_toxic(docs, labels).collect()} == {r.doc_id for r in scored if r.score < 0.5}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_edits(entry, word):
    """Edits to the word, or to its beginning for a stem, by dynamic programming; None beyond what the entry allows."""
    ends = range(len(word) + 1) if entry.stem else [len(word)]
    if entry.rooted:
        counts = [distance(entry.text[1:], word[1:k]) for k in ends if k and word[0] == entry.text[0]]
    else:
        counts = [distance(entry.text, word[:k]) for k in ends]
    best = min(counts, default=99)
    return best if best <= entry.allowed else None


def test_automata_equal_edit_distance():
    """Against plain dynamic programming: whole words and stems, edits anywhere, not at the first letter, or none."""
    rng = random.Random(1)
    for stem, exact, rooted in [(False, False, False), (True, False, False), (False, False, True), (True, False, True), (True, True, False), (False, True, True)]:
        texts = {"".join(rng.choice("abc") for _ in range(n)) for n in (5, 6, 7, 9, 10, 12)}
        entries = [Entry(t, stem, 1.0, exact, rooted) for t in texts if not any(o != t and t.startswith(o) for o in texts)]
        entries.append(Entry("xyz", False, 1.0))
        matcher = Matcher(entries)
        for _ in range(1500):
            word = list(rng.choice(entries).text)
            for _ in range(rng.randrange(4)):
                at = rng.choice([0, rng.randrange(len(word) + 1)])
                word[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "x"])
            word = "".join(word) + rng.choice(["", "", "ab", "cxa"])
            allowed = [(d, e.text) for e in entries if (d := plain_edits(e, word)) is not None]
            found = matcher.match(word)
            assert (found and (found[0], found[1].text)) == (min(allowed) if allowed else None), word
            every = {}
            for d, _, e in matcher.matches(word):
                every[e.text] = min(d, every.get(e.text, 99))
            assert every == {t: d for d, t in allowed}, word
    stems = Matcher([Entry("schmu", True, 1.0)])
    assert stems.match("schmutzig") and stems.match("schmu") and stems.match("xschmutz") and stems.match("zchmutzig") and not stems.match("xxschmutz")


def test_first_letters_and_stems_may_be_misspelled(spark):
    docs, labels = corpus(spark)
    scorer = Scorer(fit(docs, labels))
    for word in ("dreckswort", "xreckswort", "reckswort", "adreckswort", "fieslinx", "xiesling", "schmutzabc", "schmvtzabc"):
        assert scorer.score(f"you {word} there") >= 0.5, word
    assert scorer.score("you there") < 0.5


def test_entries_lose_the_edits_of_ordinary_words(spark):
    """Two ordinary words that differ in the first letter keep that letter fixed; two that differ elsewhere end all edits."""
    rng = random.Random(6)
    rows = []
    for i in range(400):
        text = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(12)]
        toxic = i % 4 == 0
        text += [rng.choice(["wombler", "grottig"])] if toxic else [rng.choice(["bombler", "tombler", "grattig", "grettig", ""])]
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    flags = {e.text: (e.exact, e.rooted) for e in model.entries}
    assert any("wombler".startswith(t) and f == (False, True) for t, f in flags.items())
    assert any("grottig".startswith(t) and f[0] for t, f in flags.items())
    scored = with_score(df, model).collect()
    assert all((r.score >= 0.5) == bool(r.toxic) for r in scored)


def test_awkward_rows(spark):
    docs, labels = corpus(spark, 200)
    df = documents(spark)
    model = fit(docs, labels)
    scored = with_score(df, model)
    assert scored.count() == df.count() and scored.filter("score < 0 or score > 1 or score is null").isEmpty()
    clash = with_extras(df)
    kept = without_toxic(clash, labels)
    assert kept.columns == clash.columns and kept.count() == df.count()
    assert without_toxic(df.limit(0), labels).count() == 0
    # without labels nothing is toxic; null labels and labels of null ids are skipped
    assert fit(docs, labels.limit(0)).entries == Model().entries == []
    odd = spark.createDataFrame([(None, 1), (1, None), (1, 1)], "doc_id long, toxic int").withColumn("text", labels.schema and __import__("pyspark").sql.functions.lit("x"))
    assert without_toxic(df, odd).count() == df.count()
