"""The registered queries of the operators; each derives its digest columns from what its operator returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import decontaminate, filteraudit, lm, mainpage, mixing, prefixes, recipes, repeats, secrets, shards, simhash, sketch, toxicity
from starload.llm.common import query, table


@query("op9_simhash")
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity.with_score(docs.select("doc_id", "text"), toxicity.fit(docs, table(spark, folder, "labels")))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", (~toxicity.is_training()).alias("held_out"), "score", predicted)


#: Target weights of the mix; a source not listed has weight 1.
MIX_WEIGHTS = {"src0": 3.0, "src1": 2.0, "src2": 0.5}


@query("op1_mixing")
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"), MIX_WEIGHTS)


@query("op3_shards")
def op3_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.sharded(table(spark, folder, "documents"))


@query("op4_secrets")
def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return secrets.scan(docs, secrets.fit(docs))


@query("op10_sketch")
def op10_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.edited_fingerprints(table(spark, folder, "documents"))


@query("op7_mainpage")
def op7_mainpage(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    extracted = mainpage.with_main_text(pages)
    return extracted.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op6_leaks")
def op6_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "score", "ratio", "start_word", "end_word")


@query("op5_repeats")
def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.with_passages(table(spark, folder, "documents")).drop("kept")


@query("op2_lm")
def op2_lm(spark: SparkSession, folder: str) -> DataFrame:
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 10 == 0).alias("held_out")
    scored = lm.scores(table(spark, folder, "documents"), "crc32(cast(doc_id as string)) % 10 <> 0")
    return scored.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


AUDIT_SQL = r"""
WITH marks AS (
    SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), flags AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
        len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
        100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
        coalesce(doc_id > first, false)] AS f
    FROM (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM texts)
    LEFT JOIN marks USING (doc_id)
), counts AS (
    SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM flags GROUP BY part, f
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), runs AS (
    SELECT part, o, f, n, good, toxic, list_position(list_transform(o, lambda x: f[ascii(x) - 64]), true) AS out
    FROM counts, orders
), steps AS (
    SELECT part, array_to_string(o, '') AS filter_order, s.step, o[s.step] AS x,
        sum(n) FILTER (out IS NULL OR out > s.step) AS kept, sum(n) FILTER (out = s.step) AS removed,
        sum(n) FILTER (out < s.step AND f[ascii(o[s.step]) - 64]) AS redundant,
        sum(n) FILTER (f[ascii(o[s.step]) - 64] AND len(list_filter(f, lambda x: x)) = 1) AS unique_fails,
        sum(good) FILTER (out = s.step) AS good_lost, sum(toxic) FILTER (out = s.step) AS toxic_lost
    FROM runs, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s GROUP BY part, o, s.step
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
    coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
    coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    (sum(coalesce(removed, 0)) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM steps
"""


@query("op12_audit", AUDIT_SQL)
def op12_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filteraudit.audit(filteraudit.corpus_masks(table(spark, folder, "documents"), table(spark, folder, "labels")))


RECIPES_SQL = r"""
WITH normal AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM normal
"""


@query("op13_recipes", RECIPES_SQL)
def op13_recipes(spark: SparkSession, folder: str) -> DataFrame:
    return recipes.exact_groups(table(spark, folder, "documents")).drop("n_chunks")


PREFIXES_SQL = r"""
WITH turns AS (
    SELECT conv_id AS c, words, x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) - 1 AS p
    FROM (
        SELECT conv_id, turn, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words,
            sha256(octet_length(encode(r)) || ':' || r || t) AS x
        FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)
    )
), bytes AS (
    SELECT c, list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT) AS s FROM (SELECT DISTINCT c FROM turns)
), convs AS (
    SELECT c, c - c % 20 AS b, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], s), lambda crc, byte:
        list_reduce(list_concat([xor(crc, byte)], range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) % 4 AS h
    FROM bytes
), heads AS (
    SELECT c.c, c.h, least(c.h, count(t.p)) AS k FROM convs c LEFT JOIN turns t ON t.c = c.b GROUP BY c.c, c.h
), path AS (
    SELECT h.c, t.p - h.h + h.k AS p, x, words FROM turns t JOIN heads h ON t.c = h.c WHERE t.p >= h.h
    UNION ALL
    SELECT c.c, t.p, x, words FROM turns t JOIN convs c ON t.c = c.b WHERE t.p < c.h
), members AS (
    SELECT c, 0 AS d, '' AS path, 0 AS words FROM convs
    UNION ALL
    SELECT c, p + 1, string_agg(x, '') OVER (PARTITION BY c ORDER BY p), words FROM path
), lengths AS (
    SELECT c, max(d) AS len FROM members GROUP BY c
), nodes AS (
    SELECT path, d, any_value(words) AS words, min(c) AS c, count(*) AS n, string_agg(c, ',' ORDER BY c) FILTER (len = d) AS ends
    FROM members JOIN lengths USING (c) GROUP BY path, d
), grown AS (
    SELECT n.*, u.c AS parent, coalesce(k.kids, 0) AS kids FROM nodes n
    LEFT JOIN nodes u ON u.path = left(n.path, (64 * n.d - 64)::BIGINT) AND u.d = n.d - 1
    LEFT JOIN (SELECT left(path, (64 * d - 64)::BIGINT) AS path, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY 1) k ON k.path = n.path
)
SELECT a.c AS conv_id, a.d::BIGINT AS depth, any_value(a.parent) AS parent_conv_id, any_value(a.n) AS n_convs,
    any_value(a.kids) AS n_children, count(*) FILTER (b.kids = 0) AS n_leaves, sum((b.n - 1) * b.words)::BIGINT AS saved_tokens,
    sha256(coalesce(any_value(a.ends), '')) AS ends_sha256
FROM grown a JOIN grown b ON b.d >= a.d AND left(b.path, (64 * a.d)::BIGINT) = a.path GROUP BY a.c, a.d
"""


@query("op11_prefixes", PREFIXES_SQL)
def op11_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.trie(*prefixes.rebuilt(*prefixes.numbered(table(spark, folder, "conversations"))))
