"""Character models against a slow Kneser-Ney, and held-out accuracy."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_tables import plain_columns

from lexmeter.llm import language_id


def test_held_out_accuracy(spark, documents):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    rows = language_id.op4_language_id(spark, "/root/testdata/sf0.001").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and 0.1 < len(held) / len(rows) < 0.4
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    assert not any(r.rejected for r in rows)


class Slow:
    """Interpolated Kneser-Ney of one language, straight from the formula."""

    def __init__(self, grams, letters):
        self.counts = {4: Counter(grams)}
        for order in (3, 2, 1):
            self.counts[order] = Counter(gram[1:] for gram in self.counts[order + 1])
        self.letters = letters

    def discount(self, order):
        ones = sum(c == 1 for c in self.counts[order].values())
        twos = sum(c == 2 for c in self.counts[order].values())
        return min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)

    def probability(self, gram):
        order = len(gram)
        if order == 0:
            return 1 / self.letters
        follow = [c for g, c in self.counts[order].items() if g[:-1] == gram[:-1]]
        lower = self.probability(gram[1:])
        if not follow:
            return lower
        own = max(self.counts[order][gram] - self.discount(order), 0)
        return (own + self.discount(order) * len(follow) * lower) / sum(follow)


def grams_of(text):
    plain = "   " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    return [plain[i : i + 4] for i in range(len(plain) - 3)]


def test_model_is_interpolated_kneser_ney():
    texts = {"x": "abracadabra banana band", "y": "zebra zoo abba zz top bazaar"}
    counts = {lang: Counter(grams_of(text)) for lang, text in texts.items()}
    kinds = sorted(set().union(*counts.values()))
    matrix = np.array([[counts["x"][g], counts["y"][g]] for g in kinds])
    model = language_id.build_model(["x", "y"], kinds, matrix)
    model.most_bits = math.inf
    letters = len({g[-1] for g in kinds}) + 1
    slow = [Slow(grams_of(texts[lang]), letters) for lang in ("x", "y")]
    for text in ("banana zoo", "q", "ab", "zebra quilt  abra", "Bazaar, band!"):
        [sums], [n] = model.measure([text])
        wanted = [sum(math.log(s.probability(g)) for g in grams_of(text)) for s in slow]
        # A trailing space is a character of the fast model when the text ends in one.
        if not text[-1].isalpha():
            wanted = [w + math.log(s.probability(grams_of(text)[-1][1:] + " ")) for w, s in zip(wanted, slow, strict=True)]
        assert sums == pytest.approx(wanted, rel=1e-5)
        assert n == len(grams_of(text)) + (not text[-1].isalpha())
    # A distribution: the chances of all characters after a history add up to 1.
    for history in ("abr", "   ", "qqq"):
        chars = sorted({g[-1] for g in kinds}) + ["q"]
        assert sum(slow[0].probability(history + c) for c in chars) == pytest.approx(1)


def test_texts_in_parts_measure_alike(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc de, ") for _ in range(rng.randrange(400))) for _ in range(30)] + ["", " ,"]
    kinds = sorted({g for t in texts for g in grams_of(t)})[:150]
    model = language_id.build_model(["x"], kinds, np.array([[1 + len(k.strip())] for k in kinds]))
    whole = model.measure(texts)
    for size in (7, 64):
        monkeypatch.setattr(language_id, "_PART", size)
        parts = model.measure(texts)
        assert parts[0] == pytest.approx(whole[0], rel=1e-9) and (parts[1] == whole[1]).all()


def test_text_unlike_all_languages_is_rejected(documents):
    model = language_id.learn(documents)
    spark = documents.sparkSession
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice("qxzjkvwpfyhcm") for _ in range(7)) for _ in range(60))
    other = "Съешь ещё этих мягких французских булок да выпей чаю " * 4
    table = spark.createDataFrame([(1, noise), (2, other), (3, "the and of")], "doc_id bigint, text string")
    got = {r.doc_id: r.language.rejected for r in language_id.identify(table, model).collect()}
    assert got == {1: True, 2: True, 3: False}
    assert [r.doc_id for r in language_id.keep_identified(table, model).collect()] == [3]


def test_awkward_rows(spark, awkward, empty, folder_of):
    model = language_id.learn(awkward)
    got = language_id.keep_identified(awkward, model)
    assert got.columns == awkward.columns
    rows = language_id.identify(awkward, model).collect()
    blank = [r for r in rows if not any(c.isalpha() for c in r.text or "")]
    assert {(r.language.language, r.language.score, r.language.rejected) for r in blank} == {("und", 0.0, True)}
    assert language_id.learn(empty) is None
    assert language_id.keep_identified(awkward, None).count() == 0
    folder = folder_of(documents=plain_columns(awkward))
    assert language_id.op4_language_id(spark, folder).count() == awkward.count()
    folder = folder_of(documents=plain_columns(empty))
    assert language_id.op4_language_id(spark, folder).count() == 0


def test_nothing_but_blank_texts_to_learn_from(spark):
    table = spark.createDataFrame([(1, " ", "en"), (2, None, "fr")], "doc_id bigint, text string, lang string")
    assert language_id.learn(table) is None


def test_labels_decide_the_names(spark):
    words = defaultdict(list)
    rng = random.Random(2)
    for i in range(120):
        alphabet, lang = (("abcde", "p"), ("vwxyz", "q"))[i % 2]
        words[lang].append((i, " ".join("".join(rng.choice(alphabet) for _ in range(5)) for _ in range(20)), lang))
    table = spark.createDataFrame([r for rows in words.values() for r in rows], "doc_id bigint, text string, lang string")
    model = language_id.learn(table)
    assert all(r.language.language == r.lang for r in language_id.identify(table, model).collect())


def test_a_quotation_does_not_outweigh_the_text(documents):
    """A third of a text in another language leaves it in its own."""
    model = language_id.learn(documents)
    texts = {}
    for r in documents.collect():
        texts.setdefault(r.lang, []).append(r.text)
    own = {lang: " ".join(sorted(parts, key=len)[-3:]) for lang, parts in texts.items()}
    size = min(map(len, own.values()))
    for lang in own:
        for other in own.keys() - {lang}:
            mixed = own[lang][:size] + own[other][: size // 2]
            sums, _ = model.measure([mixed])
            assert model.languages[sums[0].argmax()] == lang


@pytest.mark.parametrize("cells", [2**22, 1])
def test_every_language_and_every_gram_is_learned(spark, monkeypatch, cells):
    """More languages than 256, and more n-grams than a share of 4,194,304 cells for each."""
    monkeypatch.setattr(language_id, "CELLS", cells)
    rng = random.Random(4)
    rows, letters = [], [chr(0x4E00 + i) for i in range(2000)]
    for lang in range(270):
        own = rng.sample(letters, 12)
        rows += [(len(rows) + i, "".join(rng.choice(own) for _ in range(40)), f"l{lang:03}") for i in range(3)]
    schema = "doc_id bigint, text string, lang string"
    table = spark.createDataFrame(rows, schema)
    model = language_id.learn(table)
    assert len(model.languages) == 270
    fitted = table.where(language_id._share(table.doc_id, 2) >= 1 / language_id.CALIBRATION).collect()
    grams = defaultdict(list)
    for r in fitted:
        grams[r.lang] += grams_of(r.text)
    letters = len({gram[-1] for own in grams.values() for gram in own}) + 1
    model.most_bits = math.inf
    for place, lang in list(enumerate(model.languages))[::30]:
        slow = Slow(grams[lang], letters)
        for text in (rows[3 * place][1], rows[0][1]):
            [sums], _ = model.measure([text])
            assert sums[place] == pytest.approx(sum(math.log(slow.probability(g)) for g in grams_of(text)), rel=1e-9)
    names = {r.doc_id: r.language.language for r in language_id.identify(spark.createDataFrame(fitted, schema), model).collect()}
    assert all(names[r.doc_id] == r.lang for r in fitted)
