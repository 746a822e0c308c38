"""Ball k-means codes against comparison with every entry, in SQL and in plain Python."""

import math
import random

import numpy as np
import pytest

from lexmeter.llm import vector_codes

KINDS = "vec_id bigint, embedding array<float>, label int, codes int, error int, _label int"


def slow_codes(rows, parts, entries, rounds):
    """{row number: (codes, error)} of (id, vector) rows in order, with Python's integers."""
    whole = [[math.floor(1024 * x) for x in vector] for vector in rows]
    step = len(whole[0]) // parts
    cut = [[v[p * step : (p + 1) * step] for v in whole] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]

    def assign(p):
        far = [[sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]] for x in cut[p]]
        return [(min(range(len(d)), key=lambda i: (d[i], i)), min(d)) for d in far]

    for _ in range(rounds):
        for p in range(parts):
            own = [code for code, _ in assign(p)]
            for entry in set(own):
                mine = [x for x, code in zip(cut[p], own, strict=True) if code == entry]
                books[p][entry] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    found = [assign(p) for p in range(parts)]
    return [([f[i][0] for f in found], sum(f[i][1] for f in found)) for i in range(len(rows))], books


def clustered(rng, size, width, scale=1.0):
    centres = [[rng.uniform(-scale, scale) for _ in range(width)] for _ in range(5)]
    return [[float(np.float32(x + rng.gauss(0, 0.02 * scale))) for x in rng.choice(centres)] for _ in range(size)]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_its_sql(spark, same_as_sql, folder):
    got = vector_codes.op12_ball_vector_codes(spark, folder)
    assert same_as_sql(got, vector_codes.OP12_SQL, folder) == 500


@pytest.mark.parametrize(("scale", "entries", "rounds"), [(1.0, 8, 4), (0.001, 20, 3), (1e6, 6, 2), (1e12, 6, 2)])
def test_codes_of_clusters_ties_and_large_numbers(spark, scale, entries, rounds):
    rows = clustered(random.Random(entries), 90, 6, scale)
    rows += rows[:9]  # repeated vectors, and equal entries
    table = spark.createDataFrame([(i, v, i % 3) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>, label int")
    coded, books = vector_codes.encode(table.repartition(4), parts=3, entries=entries, rounds=rounds)
    wanted, wanted_books = slow_codes(rows, 3, entries, rounds)
    got = {r.vec_id: (list(r.codes), r.error, r.label_error) for r in coded.collect()}
    by_label = [sum(e for i, (_, e) in enumerate(wanted) if i % 3 == label) for label in range(3)]
    most = 2**63 - 1
    assert got == {i: (c, min(e, most), min(by_label[i % 3], most)) for i, (c, e) in enumerate(wanted)}
    assert [b.tolist() for b in books] == wanted_books


def test_stable_cores_and_rings_skip_work(monkeypatch):
    entries = np.array([[0], [100], [1000]], np.int64)
    of = vector_codes.balls(entries, np.array([60, 10, 10]), np.array([True, False, False]))
    assert of.number.tolist() == [1, 0, 0]  # 1000 lies beyond the ball of 0; still balls have no neighbours
    compared = []
    plain = vector_codes._squared
    monkeypatch.setattr(vector_codes, "_squared", lambda a, b: compared.append(len(a)) or plain(a, b))
    codes, apart = vector_codes.nearest(np.array([[3], [49], [50], [60]]), np.zeros(4, np.int64), of)
    assert codes.tolist() == [0, 0, 0, 1] and apart.tolist() == [9, 49**2, 50**2, 40**2]
    assert compared == [4, 2]  # 3 and 49 lie in the stable core; 50 is a tie and stays with the lower index


def test_awkward_vectors(spark):
    good = [0.5, -0.25, 1e-9, -1e-9]
    rows = [
        (7, good, 1),
        (7, good, 1),
        (None, [2.0, 2.0, 2.0, 2.0], None),
        (3, [0.0, 0.0, 0.0, 0.0], None),
        (4, None, 1),
        (5, [1.0, None, 1.0, 1.0], 1),
        (6, [1.0, float("nan"), 1.0, 1.0], 1),
        (8, [1.0, float("inf"), 1.0, 1.0], 1),
        (9, [1.0, 1.0], 1),
        (10, [], 2),
    ]
    table = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], KINDS)
    coded, books = vector_codes.encode(table)
    got = sorted(((r.vec_id, list(r.codes), r.error, r.label_error) for r in coded.collect()), key=repr)
    # In order of ids: 3, 7, 7 and NULL; the repeated row's entry is never used, the tie goes to the lower one.
    own = (7, [1, 1, 0, 1], 0, 0)  # its third part equals that of 3
    assert got == [(3, [0] * 4, 0, 0), own, own, (None, [3] * 4, 0, 0)]
    assert [b[1].tolist() for b in books] == [[512], [-256], [0], [-1]]
    for few in (table.limit(0), table.where("vec_id = 4"), table.where("vec_id = 10")):
        coded, books = vector_codes.encode(few)
        assert coded.count() == 0 and books == []


def test_a_third_of_all_vectors_is_one(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else [i / 7, i / 5, i / 3, i / 2], i % 2) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    coded, _ = vector_codes.encode(table, entries=16, rounds=2)
    wanted, _ = slow_codes([v for _, v, _ in rows], 4, 16, 2)
    assert {r.vec_id: list(r.codes) for r in coded.collect()} == {i: c for i, (c, _) in enumerate(wanted)}
