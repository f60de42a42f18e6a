import hashlib
import random
import re

from awkward import documents, with_extras
from pyspark.sql import functions as F

from starload.llm.mainpage import main_text, threshold, with_main_text
from starload.llm.secrets import fit, ratio, scan


def plain_spans(text):
    """The base spans, from the patterns as they are stated."""
    found = []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def listed(spans):
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(2)
    parts = [
        "password = ", "API_KEY:", 'secret"="', "token=token=abcdefghijkl ", "apikey : 'short' ", "AKIA", "AKIAABCDEFGHIJ1234", "deadbeef",
        "0123456789abcdef", " ", "\n", "é😀", "Abc123+/_.=-xyz", "PASSWD=abcdefghijklmnop", "ſecret=abcdefghijklmn", "ordinary words here ",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in scan(df, fit(df)).collect():
        spans = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert set(filter(None, listed(spans).split(","))) <= set(r.spans.split(","))


def test_random_strings_stand_out(spark):
    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = ["configuration", "initialisation", "getUserAccountName", "communication", "implementation_of", "responsibilities"]
    docs = [(i, " ".join("".join(rng.sample(words, 2)) for _ in range(30)) + f" token={'%032x' % rng.getrandbits(128)}") for i in range(60)]
    hidden = {i: "".join(rng.choice(letters) for _ in range(32)) for i in range(100, 140)}
    docs += [(i, f"see {value} for it") for i, value in hidden.items()]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    odds = fit(df)
    found = {r.doc_id: r.spans for r in scan(df, odds).collect()}
    assert sum(f"markov:4:{4 + len(v)}" in found[i] for i, v in hidden.items()) >= 38
    assert all("markov" not in found[i] for i in range(60))
    assert ratio("responsibilitiescommunication", odds) < 0 < ratio("x9QmZ27bLpW4tRk8", odds)


def test_secrets_awkward_rows(spark):
    df = documents(spark)
    result = scan(with_extras(df), fit(with_extras(df)))
    assert result.count() == df.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.base_sha256 for r in result.filter("doc_id in (2, 3, 5)").collect()} == {empty}
    assert scan(df.limit(0), fit(df.limit(0))).count() == 0


PAGES = {
    "<html><body><nav><a>Home</a></nav><article><h1>T</h1><p>One &amp; two<p>Be.<div class='ad'>buy</div></article><footer>f</footer>": "T One & two Be.",
    "<main><p>long enough text of the page, with words and words</p><form><p>Name</p></form><aside>more</aside></main>": "long enough text of the page, with words and words",
    "<div class='menu'>a | b</div><div id='c'><p>The text  of\nthe page</p><p>Ok.</p><div class='comments'><p>I like it very much, thanks</p></div></div>": "The text of the page Ok.",
    "<article><p>x<script>var a='<p>no</p>';</script>y</p><style>p{}</style></article>": "xy",
    "<article><p>caf&eacute;&nbsp;&#33;<br>next</article><article><p>a much longer article than the other one</p></article>": "a much longer article than the other one",
    "plain": "plain",
    "": "",
    "<p>open <b>bold": "open bold",
    "</div></p>stray<div>": "stray",
    "<article>": "",
}


def test_main_text_of_pages(spark):
    for html, text in PAGES.items():
        assert main_text(html) == text, html
    data = [(i, None if i == 0 else h) for i, h in enumerate([None, *PAGES, "<article>" + "<p>word " * 50_000])]
    df = spark.createDataFrame(data, "page_id long, html string").withColumn("text", F.lit("own"))
    result = {r.page_id: r.text for r in with_main_text(df).collect()}
    assert [result[i + 1] for i in range(len(PAGES))] == list(PAGES.values()) and result[0] == ""
    assert result[len(PAGES) + 1] == " ".join(["word"] * 50_000)
    assert with_main_text(df.limit(0)).count() == 0


def test_threshold_parts_two_clusters():
    import numpy as np

    assert 3 < threshold(np.array([1.0, 2, 1, 40, 50])) < 40
    assert (np.full(4, 7.0) >= threshold(np.full(4, 7.0))).all()


WORDY = "A paragraph of the article with a good many words, none of which is a link."
REGIONS = {
    # sibling articles stay if their lines are mostly content
    f"<body><article><p>{WORDY} 1</p></article><article><p>{WORDY} 2</p></article><article><a>More</a></article></body>": f"{WORDY} 1 {WORDY} 2",
    # names that say what an element has mark nothing
    f"<body><nav>Home</nav><div class='layout has-sidebar'><p>{WORDY}</p><div class='sidebar'>side</div></div></body>": WORDY,
    f"<div class='page with-menu no-comments'><div id='menu'>a b c</div><p>{WORDY}</p><p>Ok.</p></div>": f"{WORDY} Ok.",
    # a compound name is overruled by most of the content, and holds otherwise
    f"<article><h1>T</h1><div class='article-share-wrap'><p>{WORDY}</p></div></article>": f"T {WORDY}",
    f"<article><p>{WORDY}</p><p>{WORDY}</p><div class='share-bar'><a>Tweet</a></div></article>": f"{WORDY} {WORDY}",
    f"<div class='site-banner-wrap'><div class='box-ad'>buy</div><p>{WORDY}</p></div>": WORDY,
    # comments never are the article, however long, also as articles of their own
    f"<article><p>{WORDY}</p><div class='comments-area'>" + f"<p>{WORDY} Great.</p>" * 9 + "</div></article>": WORDY,
    f"<article><p>{WORDY}</p><article class='comment'><p>{WORDY} Great.</p></article></article>": WORDY,
    # neither article nor main: the clusters alone find the region
    f"<body><div><a>Home</a><br><a>News</a><br><a>Sport</a></div><div><p>{WORDY}</p><p>Ok.</p><p>{WORDY}</p></div><div><a>Imprint</a></div></body>": f"{WORDY} Ok. {WORDY}",
    f"<body><div><a>Home</a><br><a>News</a><br><a>A</a><br><a>B</a><br><a>C</a></div><div><p>{WORDY}</p><p>{WORDY}</p></div><div><p>{WORDY}</p></div></body>": f"{WORDY} {WORDY} {WORDY}",
}


def test_clusters_choose_the_region():
    for html, text in REGIONS.items():
        assert main_text(html) == text, html


def test_pages_built_from_a_known_article(spark):
    """Articles within random wrappers and between random other parts come out whole."""
    rng = random.Random(8)
    others = ["<nav><a>Home</a> <a>News</a></nav>", "<div class='ad'>buy this now</div>", "<footer>imprint</footer>", "<aside><p>see also</p></aside>", "<div class='social-links'><a>x</a></div>"]
    wrappers = ["<div class='has-sidebar'>", "<div id='content-share-wrap'>", "<section>", "<div>", "<article class='post'>", "<main>"]
    pages, expected = [], {}
    for i in range(300):
        parts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "R&amp;D"]) for _ in range(rng.randrange(8, 60))) for _ in range(rng.randrange(1, 9))]
        body = "".join(f"<p>{p}</p>" + rng.choice(["", "", others[1], others[4]]) for p in parts)
        for opening in rng.sample(wrappers, rng.randrange(1, 4)):
            body = opening + body + "</" + opening[1:].split(">")[0].split()[0] + ">"
        around = [rng.choice(others) for _ in range(rng.randrange(4))]
        pages.append((i, "<html><body>" + others[0] + body + "".join(around) + "</body></html>"))
        expected[i] = " ".join(parts).replace("&amp;", "&")
    result = {r.page_id: r.text for r in with_main_text(spark.createDataFrame(pages, "page_id long, html string")).collect()}
    assert result == expected
