"""Jaccard components against brute force over all pairs of shingle sets, and against SQL."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmeter.llm import jaccard_join as jj


def slow_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def slow_rows(rows):
    """(id, size, smallest id reachable) of (id, text) rows."""
    sets = [slow_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    lowest = {}
    for i, (name, _) in enumerate(rows):
        own = [x for x in (name, lowest.get(find(i))) if x is not None]
        lowest[find(i)] = min(own, default=None)
    return sorted(((n, len(s), lowest[find(i)] if s else n) for i, ((n, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


def families(rng, number, copies, length=90, shared=0):
    """Groups of edited copies, around the threshold; all hold the same first words."""
    passage = [f"p{i}" for i in range(shared)]
    texts = ["", None, " ", "A b", "a  b", "a", "a b c", "A B C"]
    for _ in range(number):
        base = [f"w{rng.randrange(60)}" for _ in range(length)]
        texts += [" ".join(passage + edited(rng, base, rng.randrange(0, 3))) for _ in range(copies)]
    return texts


def test_query_matches_its_sql(spark, same_as_sql):
    folder = "/root/testdata/sf0.01"
    assert same_as_sql(jj.op11_jaccard_join(spark, folder), jj.OP11_SQL, folder) == 1000


@pytest.mark.parametrize(
    ("rounds", "block", "frequent", "lookup", "shared"),
    [(1, 8, 10**9, 0, 60), (0, 5, 3, 2**20, 200)],
)
def test_edited_copies_in_long_lists_and_blocks(spark, rounds, block, frequent, lookup, shared):
    rng = random.Random(block)
    rows = list(enumerate(families(rng, 6, 9, shared=shared)))
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = jj.similar_groups(table, rounds=rounds, block=block, frequent=frequent, lookup=lookup)
    wanted = slow_rows(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == wanted
    assert 8 < len({w[2] for w in wanted}) < len(rows) - 8


@pytest.mark.parametrize("share", [80, 90, 100])
def test_visits_meet_every_linked_pair(share):
    rng, similarity = random.Random(share), jj.Similarity(share, 100)
    texts = [t for t in families(rng, 7, 12) if slow_set(t)]
    sets = [jj.shingle_set(t) for t in texts]
    size = np.array(list(map(len, sets)))
    bits = np.array([jj.bitmap(s) for s in sets]).view(np.uint64)
    tree = np.sort(np.array([rng.randrange(3) for _ in sets]))
    flags = np.full(len(sets), jj._LEFT | jj._RIGHT)
    levels = jj.build(tree, bits, size, np.arange(len(sets)), flags)
    assert len(levels) > 2
    met, below = set(), 0
    for x, y, most in jj.visit(levels, similarity):
        met |= {tuple(sorted(p)) for p in zip(x.tolist(), y.tolist(), strict=True)}
        below += len(x)
        assert all(m >= len(np.intersect1d(sets[i], sets[j])) for i, j, m in zip(x, y, most, strict=True))
    assert len(met) == below  # each pair once
    pairs = [(i, j) for i, j in combinations(range(len(sets)), 2) if tree[i] == tree[j]]
    for i, j in pairs:
        both = len(np.intersect1d(sets[i], sets[j]))
        if similarity.linked(both, len(sets[i]), len(sets[j])):
            assert (i, j) in met
    assert len(met) < len(pairs) / 2
    one = levels[0]._replace(first=np.zeros(len(sets), np.int64), last=np.zeros(len(sets), np.int64))
    levels = jj.build(one.tree, one.bits, one.low, one.first, one.flags)
    assert not list(x for x, *_ in jj.visit(levels, similarity) if len(x))  # one component: nothing to do


def test_frequent_shingles_stand_behind_the_others_of_the_first_quarter():
    own = np.array([1, 2, 3, 2**61, 2**63], np.uint64)
    similarity = jj.Similarity(50, 100)  # three first shingles of five
    assert jj._head(own, similarity).tolist() == own[:4].tolist()
    late = np.array([1, 3], np.uint64)
    assert jj.first_shingles(own[:4], 5, late, similarity).tolist() == [2, 2**61, 1]


def test_awkward_rows(spark, awkward, empty):
    got = jj.similar_groups(awkward).collect()
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=repr) == slow_rows(rows)
    assert jj.similar_groups(empty).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id bigint, text string")
    assert {r.component_id for r in jj.similar_groups(nameless).collect()} == {None}


def test_a_third_of_all_rows_are_near_copies(spark):
    same = F.concat(F.lit(" ".join(f"w{i}" for i in range(80))), F.lit(" x"), "id")
    other = F.concat_ws(" ", *(F.concat(F.lit(f"v{i}_"), "id") for i in range(6)))
    rows = spark.range(1500).select("id", F.when(F.col("id") % 3 == 0, same).otherwise(other).alias("text"))
    got = jj.similar_groups(rows, id="id", block=64)
    assert got.where("id % 3 = 0").select("component_id").distinct().collect() == [(0,)]
    assert got.where("id % 3 <> 0 AND id <> component_id").count() == 0


@pytest.mark.parametrize(("share", "large"), [(50, 8), (80, 3), (90, 1), (90, 40), (100, 20)])
def test_linked_sets_share_a_part(share, large):
    rng, similarity = np.random.default_rng(share + large), jj.Similarity(share, 100)
    lows, linked, classes = jj.size_classes(large), 0, set()
    for _ in range(3000):
        size = int(rng.integers(1, 200))
        both, rest = rng.integers(0, 2**64, size, np.uint64), rng.integers(0, 2**64, 2 * size, np.uint64)
        apart = int(similarity.apart(2 * size))
        a = np.unique(np.append(both, rest[:size][: rng.integers(0, apart + 1)]))
        b = np.unique(np.append(both, rest[size:][: rng.integers(0, apart + 1)]))
        if max(len(a), len(b)) >= large and similarity.linked(size, len(a), len(b)):
            shared = np.intersect1d(jj.parts(a, similarity, lows), jj.parts(b, similarity, lows))
            assert len(shared) > 0
            linked += 1
            classes.add(len(a) < large or len(b) < large)
    assert linked > 500 and (large < 4 or share == 100 or classes == {True, False})
    other = np.unique(rng.integers(0, 2**64, 150, np.uint64))
    if share >= 90:
        assert not len(np.intersect1d(jj.parts(a, similarity, lows), jj.parts(other, similarity, lows)))


def test_near_copies_below_the_threshold_make_few_pairs():
    rng, similarity = random.Random(4), jj.Similarity()
    base = [f"w{i}" for i in range(400)]
    sets = [jj.shingle_set(" ".join(edited(rng, base, 6))) for _ in range(80)]
    size = np.array(list(map(len, sets)))
    pairs = list(combinations(sets, 2))
    assert not any(similarity.linked(len(np.intersect1d(a, b)), len(a), len(b)) for a, b in pairs)
    bits = np.array(list(map(jj.bitmap, sets))).view(np.uint64)
    both = np.full(len(sets), jj._LEFT | jj._RIGHT)
    levels = jj.build(np.zeros(len(sets), np.int64), bits, size, np.arange(len(sets)), both)
    assert sum(len(x) for x, *_ in jj.visit(levels, similarity)) < len(pairs) / 20


@pytest.mark.parametrize("large", [1, 30, 90])
def test_classes_of_large_sets(spark, large):
    rng = random.Random(large)
    texts = [t for length in (14, 33, 48, 90) for t in families(rng, 4, 7, length=length)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = jj.similar_groups(table, large=large, block=16)
    assert sorted(map(tuple, got.collect()), key=repr) == slow_rows(list(enumerate(texts)))
