"""Base statistics and the estimate against slow computations in Python."""

import math
import random
import re
from collections import Counter
from itertools import product

import pytest
from llm_tables import plain_columns
from pyspark.sql import functions as F

from lexmeter.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit))


def check_base(rows, texts):
    for r in rows:
        wanted = slow_base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == wanted
        failed = wanted[0] < 10 or 100 * wanted[4] > 20 * wanted[0]
        assert r.base_failed == failed and not (failed and r.kept)


def test_query_over_all_documents(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = qr.op7_weak_supervision(spark, folder).collect()
    assert len(rows) == len(texts)
    check_base(rows, texts)
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [(r.kept, good[r.doc_id]) for r in rows if r.doc_id in good and not r.base_failed]
    assert sum(kept for kept, label in judged if label == 1) >= 0.98 * sum(label for _, label in judged)
    assert sum(kept for kept, label in judged if label == 0) <= 2


def test_repeats_of_any_text(spark):
    rng = random.Random(4)
    texts = {}
    for i in range(150):
        words = [rng.choice("ab") for _ in range(rng.randrange(30))]
        texts[i] = "".join(w + rng.choice([" ", "\n", "\t \n", "\r\n"]) for w in words) + rng.choice(["", "|é#", "\n\n"])
    table = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    rows = qr.statistics(table).select("doc_id", "stats.*").collect()
    for r in rows:
        assert tuple(r)[1:6] == slow_base(texts[r.doc_id])


def slow_em(patterns):
    """The same estimate over a list of (votes, texts), in plain Python."""
    chance = {votes: 0.1 if qr.BAD in votes else 0.99 for votes in patterns}
    for _ in range(qr.ROUNDS):
        total = sum(patterns.values())
        good = sum(n * chance[v] for v, n in patterns.items()) / total
        good = min(max(good, qr.FLOOR), 1 - qr.FLOOR)
        odds = []
        for i in range(len(qr.RULES)):
            bad = []
            for side in (1, 0):
                share = lambda v: chance[v] if side else 1 - chance[v]  # noqa: B023, E731
                cast = {x: sum(n * share(v) for v, n in patterns.items() if v[i] == x) for x in (1, -1)}
                part = cast[1] / (cast[1] + cast[-1]) if cast[1] + cast[-1] > 0 else 0.5
                bad.append(1 - min(max(part, qr.FLOOR), 1 - qr.FLOOR))
            if bad[1] < bad[0]:
                bad[1] = bad[0]
            odds.append({1: math.log((1 - bad[0]) / (1 - bad[1])), -1: math.log(bad[0] / bad[1]), 0: 0})
        prior = math.log(good / (1 - good))
        chance = {v: 1 / (1 + math.exp(-prior - sum(o[x] for o, x in zip(odds, v, strict=True)))) for v in patterns}
    return chance


def test_estimate(spark, monkeypatch):
    monkeypatch.setattr(qr, "CLOSE", -1.0)
    rng = random.Random(6)
    patterns = Counter()
    for _ in range(3000):
        bad = rng.random() < 0.2
        rates = [(0.7 if bad else 0.02) if i % 2 else (0.4 if bad else 0.1) for i in range(len(qr.RULES))]
        patterns[tuple(0 if rng.random() < 0.2 else (-1 if rng.random() < r else 1) for r in rates)] += 1
    names = [f"_{rule.name}" for rule in qr.RULES]
    schema = ", ".join(f"{name} int" for name in names) + ", texts bigint"
    table = spark.createDataFrame([(*v, n) for v, n in patterns.items()], schema)
    found = qr.estimate(table)
    rows = table.withColumn("p", found.probability()).collect()
    wanted = slow_em(patterns)
    for r in rows:
        assert r.p == pytest.approx(wanted[tuple(r)[:-2]], abs=1e-9)
    assert found.good == pytest.approx(0.8, abs=0.05)
    assert found.given_bad["shouts", qr.BAD] == pytest.approx(0.7, abs=0.06)


def test_no_pattern_fails(spark):
    votes = list(product((1, 0, -1), repeat=2))
    names = [f"_{rule.name}" for rule in qr.RULES]
    rows = [(*v, *[0] * (len(names) - 2), 1) for v in votes]
    schema = ", ".join(f"{name} int" for name in names) + ", texts bigint"
    table = spark.createDataFrame(rows, schema)
    for part in (table, table.limit(1), table.limit(0)):
        assert 0 < qr.estimate(part).good < 1


def test_awkward_rows(spark, awkward, empty, folder_of):
    folder = folder_of(documents=plain_columns(awkward))
    rows = qr.op7_weak_supervision(spark, folder).collect()
    assert len(rows) == awkward.count()
    texts = {r.doc_id: r.text for r in awkward.collect()}
    check_base([r for r in rows if r.doc_id in range(2, 8)], texts)
    got = qr.judge(awkward)
    assert got.select("print").distinct().collect() == [("own print",)]
    assert qr.judge(empty).count() == 0
    assert qr.judge(awkward.withColumn("text", F.lit(None).cast("string"))).where("kept").count() == 0
