"""Token alignment against plain loops over decoded bytes."""

import gc
import hashlib
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lexmeter.llm import token_alignment as ta


@pytest.fixture(scope="module")
def tokens():
    return ta.load(ta.FOLDER, ta.BYTE_BPE, ta.PIECES)


def slow_ranges(text, tokens):
    """Ids with byte ranges on both sides, or nothing where the bytes are not the text's."""
    data = f" {text}".encode()
    stand_in = {c: bytes([b]) for c, b in ta._byte_of_character().items()}
    sides = []
    ids = tokens.a.encode(f" {text}", add_special_tokens=False).ids
    sides.append([(i, b"".join(stand_in[c] for c in tokens.a.id_to_token(i))) for i in ids])
    found = []
    for i in tokens.b.encode(text):
        piece = tokens.b.id_to_piece(i)
        found.append((i, bytes([int(piece[3:5], 16)]) if tokens.b.is_byte(i) else piece.replace("▁", " ").encode()))
    sides.append(found)
    result = []
    for side in sides:
        if b"".join(b for _, b in side) != data:
            return None
        end, ranges = 0, []
        for i, b in side:
            ranges.append((i, end, end + len(b)))
            end += len(b)
        result.append(ranges)
    return result


def slow_rows(texts, tokens):
    """The contract's columns of each text, by pairs of overlapping ranges."""
    links, rows = [], []
    for text in texts:
        ranges = slow_ranges(text, tokens) if text else None
        if ranges is None:
            links.append([])
            rows.append((0, 0, 0, ""))
            continue
        a, b = ranges
        links.append([(i, j) for i, s, e in a for j, t, f in b if s < f and t < e])
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for cut in cuts:
            own = (",".join(str(i) for i, s, _ in side if start <= s < cut) for side in (a, b))
            groups.append("|".join(own))
            start = cut
        rows.append((len(a), len(b), len(cuts), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(pair for own in links for pair in set(own))
    highest = defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    result = []
    for (n_a, n_b, n_groups, digest), own in zip(rows, links, strict=True):
        best = sum(counts[p] == highest[p[0]] for p in own)
        result.append((n_a, n_b, n_groups, len(own), best, sum(counts[p] for p in own), digest))
    return result


TEXTS = [
    "Hello world, this is a plain text.",
    "a  é文😀\tb\n<s> x",
    "naïve Straße über 文字列 𝔘𝔫𝔦𝔠𝔬𝔡𝔢 👩‍👩‍👧",
    "<|endoftext|> and <unk> </s> are plain text",
    "holds ▁ as text",
    " leading and   many    spaces ",
    "é combined",
    "\x00\x01​﻿",
    "a",
    " ",
    "\n\n",
    "",
    None,
    "Hello world, this is a plain text.",
]


def test_texts_of_all_kinds(spark, tokens):
    rng = random.Random(3)
    odd = ["".join(chr(rng.choice([32, 97, 233, 0x4E2D, 0x1F600, 10, 0x2581])) for _ in range(30)) for _ in range(20)]
    texts = TEXTS + odd
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    wanted = dict(enumerate(slow_rows(texts, tokens)))
    assert wanted[0][3] > 0 and wanted[4] == wanted[11] == wanted[12] == (0, 0, 0, 0, 0, 0, "")
    for lookup in (ta.LOOKUP, 0):
        rows = ta.align_tokens(table, lookup=lookup).collect()
        assert {r[0]: tuple(r)[1:] for r in rows} == wanted


def test_words_are_cut_where_no_token_lies_across(tokens):
    assert tokens.in_words
    assert ta._BETWEEN.split(" a b  c \n d\xa0 e ▁ f ") == [" a", "b", " c", "\n d\xa0 e", "▁", "f "]
    rng = random.Random(5)
    pool = ["word", "é", "文字", "😀", "\n", "  ", " ", "\t", "\xa0", "\u3000", "\x1c", "'s", "12", "…", "\u0301", "\u200b", "<s>", "a" * 90]
    texts = ["".join(rng.choice(pool) + rng.choice(["", " "]) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    whole = tokens._replace(in_words=False, known=ta.Memory())
    wanted = [[str(x) for x in row] for row in ta.alignments(texts, whole)]
    for size in (ta.REMEMBERED, 200, 0):
        own = tokens._replace(known=ta.Memory(size))
        for start in range(0, len(texts), 50):
            rows = ta.alignments(texts[start : start + 50], own)
            assert [[str(x) for x in row] for row in rows] == wanted[start : start + 50]
            assert len(own.known.recent) <= size
        assert all(len(word) <= ta.SHORT for word in own.known.older)


def test_query_over_all_documents(spark, tokens):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(r.text) < 4000]
    got = {r.doc_id: r for r in ta.op13_token_alignment(spark, folder).collect()}
    assert len(got) == len(rows)
    for r in short[:40]:
        (wanted,) = slow_rows([r.text], tokens)
        own = got[r.doc_id]
        assert (own.n_a, own.n_b, own.n_groups, own.n_links, own.groups_sha256) == (*wanted[:4], wanted[6])
    assert all(r.n_best <= r.n_links <= r.count_sum for r in got.values())


def test_spans_are_cut_only_where_they_are_not_their_token_s_own(tokens, monkeypatch):
    refined = []
    plain = ta._refined
    monkeypatch.setattr(ta, "_refined", lambda *x: refined.append(plain(*x)) or refined[-1])
    found = ta.align(["é文"], *ta._encoded(["é文"], tokens), tokens)
    assert [x.tolist() for x in refined] == [[3, 5, 6], [3, 6]]
    assert found.cuts.tolist() == [3, 6] and len(found.link_a) == 3


def test_awkward_rows(spark, awkward, empty, tokens):
    rows = ta.align_tokens(awkward).collect()
    assert len(rows) == awkward.count()
    zero = sorted(str(r.doc_id) for r in rows if r.n_a == 0)
    assert zero == ["2", "3", "None"]
    assert len({tuple(r)[1:] for r in rows if r.doc_id == 1}) == 2  # repeated rows have the same counts
    assert ta.align_tokens(empty).count() == 0
    renamed = awkward.withColumnRenamed("doc_id", "n_a0").drop("doc_id")
    assert ta.align_tokens(renamed, id="n_a0").columns[0] == "n_a0"


def test_new_words_are_encoded_together(monkeypatch):
    tokens = ta.load(ta.FOLDER, ta.BYTE_BPE, ta.PIECES)._replace(known=ta.Memory())
    texts = [" ".join(f"wörd{i * i}x{i}" for i in range(1000)), "a  b\n c ", " x  y", "t  ", "▁ z", "e ́"]
    encoded, encode = [], ta._encoded
    monkeypatch.setattr(ta, "_encoded", lambda some, tokens: encoded.append(len(some)) or encode(some, tokens))
    rows = ta.alignments(texts, tokens)
    assert sum(encoded) < 150
    for text, row in zip(texts, rows, strict=True):
        whole = ta._row(ta.align_words([text], *encode([text], tokens), tokens))
        assert [np.array_equal(x, y) for x, y in zip(row, whole, strict=True)] == [True] * 8


def test_the_collector_passes_over_remembered_words(tokens):
    own = tokens._replace(known=ta.Memory())
    ta.alignments([" ".join(f"word{i}, naïve{i}" for i in range(300)), "holds ▁ as text"], own)
    gc.collect()
    assert len(own.known.recent) > 600 and None in own.known.recent.values()
    assert not any(map(gc.is_tracked, own.known.recent.values()))


class Recorder:
    """A tokenizer that notes what it is asked for."""

    def __init__(self, own, asked):
        self.own, self.asked = own, asked

    def encode(self, texts, **how):
        self.asked.append(how["return_type"])
        return self.own.encode(texts, **how)


class Lookups(dict):
    def get(self, word, *other):
        self.asked = [*getattr(self, "asked", []), word]
        return super().get(word, *other)


def test_each_word_of_a_batch_is_looked_up_once_and_no_protos_are_made(tokens):
    asked, known = [], ta.Memory()
    known.recent = Lookups()
    own = tokens._replace(b=Recorder(tokens.b, asked), known=known)
    texts = ["the cat and the dog", "the dog\n and ▁ cat", "cat the"] * 5
    rows = ta.alignments(texts, own)
    assert asked and set(asked) == {"numpy"}
    assert sorted(known.recent.asked) == sorted(set(known.recent.asked)) and len(known.recent.asked) == 6
    assert [r[:5] for r in rows] == [(*w[:4], w[6]) for w in slow_rows(texts, tokens)]


def test_arrow_cuts_texts_as_the_pattern_does():
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    texts = [f"a{x} b{x}c {x}d" for x in spaces] + [" a", "a ", "  ", " ", "a b", "a  b", "\n", None, "", "é 文 b", "a\x00 b"]
    words, cut = ta._cut(texts, True)
    assert [[words[i] for i in own] for own in cut] == [ta._BETWEEN.split(t) if t else [] for t in texts]
    assert len(words) == len(set(words))


def test_slices_are_bounded_by_bytes_and_texts(monkeypatch):
    texts = pa.array(["x" * 10, None, "é" * 300, "", "x" * 99, "x"] + ["x"] * 30)
    monkeypatch.setattr(ta, "_BYTES", 100)
    monkeypatch.setattr(ta, "_BATCH", 16)
    ends = ta._slices(texts)
    assert ends[0] == 0 and ends[-1] == len(texts) and max(np.diff(ends)) <= 16
    sizes = [len((t or "").encode()) for t in texts.to_pylist()]
    assert all(sum(sizes[s : e - 1]) < 100 or sum(sizes[s + 1 : e]) < 100 for s, e in zip(ends, ends[1:]))
    assert ta._slices(texts[:0]) == [0]
