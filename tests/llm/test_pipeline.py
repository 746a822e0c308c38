"""The stages of the pipeline on hand-made and on given documents, and the registry."""

from collections import Counter

import pytest
from llm_tables import ROWS

import __spark_entry__
import corpus_pipeline
from lexmeter.llm import mixing, registry

SF_DIR = "/root/testdata/sf0.01"


def test_stages_over_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts = [docs.count()]
    table = docs
    for name, stage in corpus_pipeline.STAGES:
        table = stage(spark, table, SF_DIR).cache()
        counts.append(table.count())
        if name != "sharding":
            assert table.columns == docs.columns
            assert set(table.collect()) <= set(docs.collect())
    assert counts[1] == 1000 and 800 < counts[2] < 1000 and 700 < counts[3] < counts[2]
    assert abs(counts[4] - counts[3]) < 0.7 * counts[3] and counts[5] == counts[4]
    shards = Counter(r.shard for r in table.select("shard").collect())
    assert max(shards.values()) - min(shards.values()) <= 1


def test_run_and_rerun_agree(spark):
    first, second = (corpus_pipeline.run(spark, "/root/testdata/sf0.001") for _ in range(2))
    assert first.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    key = lambda r: (r.shard, r.slot)
    assert sorted(first.collect(), key=key) == sorted(second.collect(), key=key)
    kept = first.select("doc_id").distinct().count()
    assert 0.3 * 200 < kept <= 200


def test_awkward_documents(spark, awkward, tmp_path):
    benchmark = spark.createDataFrame([(1, "four sheep ate grass")], "item_id bigint, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for documents in (awkward, awkward.limit(0)):
        table = documents
        for _, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, str(tmp_path))
        table.collect()
    assert len(ROWS) == awkward.count()


def test_registry():
    names = list(registry.queries())
    assert [int(name[2:].split("_")[0]) for name in names] == list(range(1, 14))
    assert set(registry.SQL) <= set(names)
    assert set(__spark_entry__.queries()) >= {*names, "pipeline"}
    assert len(corpus_pipeline.STAGES) == 5 and mixing.PASSES == 3


@pytest.mark.parametrize("name", [n for n in registry.queries() if n.split("_")[0] in ("op2", "op6", "op7", "op10")])
def test_native_queries_stay_in_the_jvm(spark, name):
    table = registry.queries()[name](spark, "/root/testdata/sf0.001")
    plan = table._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "ExistingRDD", "CartesianProduct", "BroadcastNestedLoop"):
        assert word not in plan
