"""Shards against ranks computed in plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from llm_tables import ROWS
from pyspark.sql import functions as F

from lexmeter.llm import sharding


def slow_shards(rows, shards, seed=sharding.SEED):
    """(shard, slot) of (id, source) rows with distinct ids."""
    by_source = defaultdict(list)
    for id, source in rows:
        by_source[source].append((hashlib.md5(f"{seed}:{id}".encode()).hexdigest(), id))
    placed = []
    for source, members in by_source.items():
        for rank, (key, id) in enumerate(sorted(members)):
            group = "" if source is None else f"={source}"
            shift = (int(hashlib.md5(f"{seed}:{group}".encode()).hexdigest()[:8], 16) + 0.5) / 2**32
            placed.append(((rank + shift) / len(members), group, key, id))
    total, found, slots = len(placed), {}, Counter()
    for rank, (*_, id) in enumerate(sorted(placed)):
        shard = rank * shards // total
        found[id] = (shard, slots[shard])
        slots[shard] += 1
    return found


def test_query_over_all_documents(spark, documents):
    rows = documents.collect()
    wanted = slow_shards([(r.doc_id, r.source) for r in rows], 40)
    got = sharding.op6_stratified_shards(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.shard, r.slot) for r in got} == wanted and len(got) == len(rows)
    text = {r.doc_id: r.text.encode() for r in rows}
    for r in got:
        assert (r.size, r.text_crc32) == (len(text[r.doc_id]) + 16, zlib.crc32(text[r.doc_id]))
        assert (r.law, r.grown_shard) == ("rows", None)


@pytest.mark.parametrize("per_slot", [7, 4096])
def test_a_hot_source_is_interleaved(spark, monkeypatch, per_slot):
    monkeypatch.setattr(sharding, "ROWS_PER_SLOT", per_slot)
    rows = [(i, "hot" if i % 3 else (None if i % 2 else f"s{i % 5}")) for i in range(700)]
    table = spark.createDataFrame(rows, "doc_id bigint, source string").withColumn("text", F.lit("x"))
    got = sharding.interleave(table.repartition(5), shards=9).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in got} == slow_shards(rows, 9)
    # A stretch of fractions holds each source to within one row, so a cut by rows is off
    # by at most one row of each of the seven sources.
    for shard in range(9):
        hot = sum(r.shard == shard and r.source == "hot" for r in got)
        assert abs(hot - sum(s == "hot" for _, s in rows) / 9) <= 7


def test_awkward_rows(awkward, empty):
    got = sharding.interleave(awkward, shards=4)
    assert got.columns == [*(c for c in awkward.columns if c not in ("shard", "slot")), "shard", "slot"]
    rows = got.collect()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == len(ROWS) and max(counts.values()) - min(counts.values()) <= 1
    for shard, number in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(number))
    assert sharding.interleave(empty).count() == 0
    few = sharding.interleave(awkward.limit(3), shards=40).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}


def test_a_source_for_each_row_spreads_over_all_slots_and_shards(spark):
    rows = spark.range(100_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.concat(F.lit("s"), "id").alias("source"))
    mixed = rows.unionByName(rows.select("doc_id", "text", F.lit("large").alias("source")))
    got = sharding.interleave(mixed)
    counts = got.groupBy("shard").agg(F.count("slot").alias("rows"), F.count_if(F.col("source") == "large").alias("large")).collect()
    assert {r.rows for r in counts} == {5000} and len(counts) == 40
    assert all(2250 < r.large < 2750 for r in counts)
    placed = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in placed
