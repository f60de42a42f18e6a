import corpus_pipeline as pipeline
import pytest
from awkward import documents, with_extras
from pyspark.sql import functions as F
from test_llm_simhash import plain_fingerprint, roots

import __spark_entry__ as entry
from starload.llm.common import stored, table

FOLDER = "/root/testdata/sf0.01"


def test_every_operator_has_a_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_stages_on_a_table(spark):
    docs = table(spark, FOLDER, "documents")
    labels = {r.doc_id: r.toxic for r in table(spark, FOLDER, "labels").collect()}
    passages = [r.text for r in table(spark, FOLDER, "benchmark").collect()]
    seen = {}
    for name, stage in pipeline.STAGES:
        seen[name] = (docs, docs := stored(stage(spark, docs, FOLDER), name))
    before, after = (df.collect() for df in seen["toxicity"])
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert sum(labels.get(d, 1) for d in gone) >= 0.9 * len(gone) > 0
    before, after = (df.collect() for df in seen["simhash_near_dedup"])
    found = roots([plain_fingerprint(r.text) for r in before])
    least = {}
    for r, root in zip(before, found):
        least[root] = min(least.get(root, 10**9), r.doc_id)
    assert {r.doc_id for r in after} == set(least.values())
    before, after = (df.collect() for df in seen["benchmark_decontamination"])
    leaked = {r.doc_id for r in before if any(p in r.text for p in passages)}
    assert leaked <= {r.doc_id for r in before} - {r.doc_id for r in after} and len(before) - len(after) <= len(leaked) + 3
    before, after = seen["mixing_sources"]
    assert after.join(before, before.columns, "left_anti").isEmpty() and not after.isEmpty()
    before, after = seen["sharding"]
    assert after.columns == [*before.columns, "shard", "slot"] and after.count() == before.count()
    assert after.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("k"), F.max("slot").alias("m")).filter("n <> k or m <> n - 1").isEmpty()


@pytest.mark.parametrize("shape", ["rows", "extras", "none"])
def test_stages_take_awkward_documents(spark, shape):
    docs = documents(spark)
    docs = with_extras(docs) if shape == "extras" else docs.limit(0) if shape == "none" else docs
    for name, stage in pipeline.STAGES:
        result = stored(stage(spark, docs, FOLDER), name)
        if name != "sharding":
            assert result.columns == docs.columns, name
        assert set(docs.columns) <= set(result.columns) or name == "sharding"
        assert result.count() <= docs.count() or name == "mixing_sources"
        docs = result
