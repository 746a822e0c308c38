"""The mix against its SQL, a slow computation of targets, and its order."""

import random
from collections import Counter, defaultdict

import pytest
from llm_tables import plain_columns
from pyspark.sql import functions as F

from lexmeter.llm import mixing


def test_query_matches_sql(spark, same_as_sql):
    assert same_as_sql(mixing.op2_curriculum_mix(spark, "/root/testdata/sf0.001"), mixing.OP2_SQL) == 200


def test_awkward_rows_match_sql(spark, awkward, empty, folder_of, same_as_sql):
    folder = folder_of(documents=plain_columns(awkward))
    assert same_as_sql(mixing.op2_curriculum_mix(spark, folder), mixing.OP2_SQL, folder) == 11
    got = mixing.mix(awkward)
    assert got.count() == 11 and {"own shard"} == {r.shard for r in got.collect()}
    assert mixing.mix(empty).count() == 0 and mixing.curriculum(empty).count() == 0
    assert mixing.curriculum(awkward).columns == awkward.columns


def slow_targets(sizes):
    """Share by weight; while one is above three times its size, cap it and share its excess."""
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {name: 1 + i % 3 for i, name in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        free = [n for n in names if n not in capped]
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if share[n] > 3 * sizes[n] + 1e-9]
        if not over:
            return capped | share
        capped |= {n: 3 * sizes[n] for n in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 100, 3000]) for i in range(rng.randrange(2, 12))}
    sizes |= {None: 40, "é": 7}
    table = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = mixing.targets(table, "source", "size", mixing.WEIGHTS, mixing.SLOPES, 3)
    wanted = slow_targets(sizes)
    for row in got.collect():
        assert row.target == pytest.approx(wanted[row.source], abs=1e-6)


def test_taken_words_meet_targets_and_reruns_agree(documents):
    rows = mixing.mix(documents).collect()
    taken, target = Counter(), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert sum(target.values()) == pytest.approx(sum(r.size for r in rows))
    for source, words in taken.items():
        assert abs(words - target[source]) <= 1
    again = mixing.mix(documents.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)


def test_mixture_follows_the_schedule(spark):
    """The share of a source in a stretch of positions is that of its weights there."""
    table = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.lit("a b c d").alias("text"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
    )
    rows = mixing.mix(table).collect()
    early, late = defaultdict(int), defaultdict(int)
    for r in rows:
        for copy in r.copies:
            if copy.used:
                (early if copy.position < 0.5 else late)[r.source] += copy.words
    # Weights 1, 2, 3 of all words; over the first half a slope of s gives 1 / 2 - s / 4.
    total = 9000 * 4
    for i, slope in enumerate(mixing.SLOPES):
        wanted = total * (i + 1) / 6 * (0.5 - slope / 4)
        assert early[f"s{i}"] == pytest.approx(wanted, rel=0.01)
        assert early[f"s{i}"] + late[f"s{i}"] == pytest.approx(total * (i + 1) / 6, abs=2)


def test_curriculum_is_whole_documents_in_order(documents):
    read = mixing.curriculum(documents)
    assert read.columns == documents.columns
    copies = Counter(r.doc_id for r in read.collect())
    for r in mixing.mix(documents).collect():
        assert copies[r.doc_id] == sum(c.used and 2 * c.words >= r["size"] for c in r.copies)


def test_no_words_at_all(spark):
    table = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix(table).collect()] == [(0.0, 0)] * 2
    assert mixing.curriculum(table).count() == 0
