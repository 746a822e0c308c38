"""SimHash groups against brute force over all pairs."""

import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from lexmeter.llm import simhash
from lexmeter.sources.scratch import new_folder

MASK = 2**64 - 1


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_groups(prints):
    """Index of the smallest member of each one's group, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(prints))]


def signed(value):
    return value - 2**64 if value >> 63 else value


@pytest.mark.parametrize("text", ["", " ", "a", "A b", "a b c", "a b c d", "É é a\tb\nC d e f a b c d"])
def test_fingerprint_of_short_texts(text):
    assert simhash.fingerprint(text.encode()) & MASK == slow_fingerprint(text)


def test_query_over_all_documents(spark, documents):
    rows = documents.orderBy("doc_id").select("doc_id", "text").collect()
    prints = [slow_fingerprint(r.text) for r in rows]
    roots = slow_groups(prints)
    wanted = [(r.doc_id, f"{p:016x}", rows[i].doc_id) for r, p, i in zip(rows, prints, roots, strict=True)]
    got = simhash.op1_simhash_near_dedup(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect())) == wanted
    assert any(r[0] != r[2] for r in wanted)


def clustered(rng, size):
    """Fingerprints in chains and dense balls, some in all eight bytes."""
    prints = {rng.getrandbits(64) for _ in range(size)}
    for _ in range(4):
        one = rng.getrandbits(64)
        for _ in range(size // 4):
            prints.add(one)
            flips = rng.sample(range(64), rng.randrange(1, 6))
            prints.add(one ^ sum(1 << b for b in flips))
            if rng.random() < 0.5:
                one ^= 1 << rng.randrange(64)
    return sorted(prints, key=signed)


@pytest.mark.parametrize(("crowd", "size"), [(2048, 150), (3, 60), (1, 40)])
def test_links_connect_what_is_near(spark, crowd, size):
    prints = clustered(random.Random(size), size)
    table = spark.createDataFrame([(signed(p),) for p in prints], "print bigint").repartition(3)
    folder = new_folder(spark)
    links = simhash.near_links(table, folder, crowd)
    for a, b in links.collect():
        assert ((a ^ b) & MASK).bit_count() <= 4 or crowd == 2048
    labels = simhash.components(links, f"{folder}/rounds")
    got = dict(map(tuple, labels.collect()))
    roots = slow_groups(prints)
    wanted = {signed(p): signed(prints[r]) for p, r in zip(prints, roots, strict=True)}
    assert {p: got.get(p, p) for p in wanted} == wanted


def test_long_chains_and_stars_become_one_component(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 4000 + i) for i in range(200)]
    table = spark.createDataFrame([*chain, *star, (9, 9)], "a bigint, b bigint")
    got = dict(map(tuple, simhash.components(table, new_folder(spark)).collect()))
    assert set(got.values()) == {0, 1000, 4000}
    assert len(got) == 300 + 299 + 200


def test_awkward_rows(awkward, empty):
    got = simhash.near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    zero = [r for r in got if r.print == 0]
    assert sorted((r.doc_id or -1) for r in zero) == [-1, 2, 3, 4]
    assert {r.component_id for r in zero} == {2}
    assert simhash.near_duplicates(empty).count() == 0


def test_one_row_of_each_group_stays(awkward, empty):
    got = simhash.drop_near_duplicates(awkward)
    assert got.columns == awkward.columns
    rows = sorted((r.doc_id, (r.text or "")[:7]) for r in got.collect())
    assert rows == [(1, "another"), (1, "the cat"), (2, ""), (5, "word0 t"), (6, "1234 56"), (7, "Ünïcödé")]
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_groups_without_any_id(spark):
    table = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (None, "x")], "doc_id bigint, text string")
    assert simhash.drop_near_duplicates(table).count() == 2
    assert {r.component_id for r in simhash.near_duplicates(table).collect()} == {None}


def test_a_third_of_all_rows_is_one_text(spark):
    hot = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("same text here again")).otherwise(F.concat(F.lit("w"), "id", F.lit(" x"), "id")).alias("text"))
    got = simhash.near_duplicates(hot, id="id").where("id % 3 = 0").select("component_id").distinct()
    assert got.collect() == [(0,)]
