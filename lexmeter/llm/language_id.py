"""Language identification: interpolated Kneser-Ney models of characters.

Each language has a model of four characters with absolute discounts, continuation counts
below the highest order, and interpolation down to a uniform alphabet. All n-grams of the
sampled texts are kept, as sorted arrays of hashes for each order. A few languages share
their arrays, with a row of log-probabilities, one for each; where n-grams are many, each
language has arrays of its own, so none pays for another's n-grams. A text goes to the language with the lowest cross-entropy per character. It is
rejected if that lies too far from texts of this language that the model has not seen,
towards the same texts with their letters shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmeter.llm.common import fresh

ORDER = 4
#: Texts a language is learned from, about, and the share of them kept for calibration.
TEXTS = 1000
CALIBRATION = 5
#: Languages that share arrays, unless all have more n-grams than this in sum.
BLOCK = 4
CELLS = 2**22
#: Rejected beyond this share of the way from a language's texts to the same letters shuffled.
BEYOND = 0.6
#: Bits a character may cost at most, so that a quotation does not outweigh the text around it.
MOST_BITS = 6.0
UNKNOWN = "und"

_PART = 2**19
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_BASE, i, 2**64) for i in range(ORDER)], np.uint64)
_SPACE = 32
_RESULT = "struct<language:string,score:double,cross_entropy:double,letters:bigint,rejected:boolean>"


@cache
def _plain_table() -> np.ndarray:
    """Maps a code point to its lower-case letter, and all that is no letter to a space."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for code in range(0x110000):
        if (char := chr(code)).isalpha():
            table[code] = ord(char.lower()[0])
    return table


def _codes(text: str) -> np.ndarray:
    return _plain_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]


def _plain(texts: list[str], contexts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts, each after its context, where each begins, and which are context.

    Runs of spaces become one; a text without letters adds nothing but its context.
    """
    parts = [part for pair in zip(contexts, map(_codes, texts), strict=True) for part in pair]
    codes = np.concatenate(parts)
    sizes = np.array([len(text) + ORDER - 1 for text in texts])
    starts = np.cumsum(sizes) - sizes
    context = np.zeros(len(codes), bool)
    for ahead in range(ORDER - 1):
        context[starts + ahead] = True
    keep = context | (codes != _SPACE) | (np.roll(codes, 1) != _SPACE)
    return codes[keep], np.append(0, np.cumsum(keep))[starts], context[keep]


def _hashes(codes: np.ndarray) -> list[np.ndarray]:
    """For each order, the hash of the n-gram that ends at each position; from index 1."""
    values = codes.astype(np.uint64) + np.uint64(1)
    found = [np.zeros(len(codes), np.uint64)]
    for order in range(ORDER):
        older = np.zeros(len(codes), np.uint64)
        older[order:] = values[: len(codes) - order]
        found.append(found[-1] + older * _POWERS[order])
    return found


@dataclass
class Tables:
    """Sorted hashes with log-probabilities, and with log-weights of the lower order."""

    keys: list[np.ndarray]
    logs: list[np.ndarray]
    history_keys: list[np.ndarray]
    history_logs: list[np.ndarray]
    unseen: np.ndarray

    def find(self, order: int, hashes: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """Natural log-probability of the character at each position, a column per language."""
        if order == 0 or not len(self.keys[order]):
            return np.repeat(self.unseen[None], len(at), 0)
        wanted = hashes[order][at]
        place = np.minimum(np.searchsorted(self.keys[order], wanted), len(self.keys[order]) - 1)
        logs = self.logs[order][place]
        missing = np.flatnonzero(self.keys[order][place] != wanted)
        if len(missing):
            lower = self.find(order - 1, hashes, at[missing])
            if order > 1:
                keys = self.history_keys[order]
                history = hashes[order - 1][at[missing] - 1]
                place = np.minimum(np.searchsorted(keys, history), len(keys) - 1)
                known = keys[place] == history
                lower[known] += self.history_logs[order][place[known]]
            logs[missing] = lower
        return logs


@dataclass
class Model:
    """The tables of all languages, in order, and the bounds of their texts' cross-entropy."""

    languages: list[str]
    blocks: list[Tables]
    typical: np.ndarray
    limit: np.ndarray
    most_bits: float = MOST_BITS

    def _sums(self, texts: list[str], contexts: list[np.ndarray]):
        """Sum of log-probabilities, number of characters and last context for each text."""
        codes, starts, context = _plain(texts, contexts)
        at = np.flatnonzero(~context)
        bounds = np.searchsorted(at, np.append(starts, len(codes)))
        hashes, sums = _hashes(codes), []
        for block in self.blocks:
            logs = np.maximum(block.find(ORDER, hashes, at), -self.most_bits * np.log(2))
            totals = np.concatenate([np.zeros((1, logs.shape[1])), np.cumsum(logs, 0, np.float64)])
            sums.append(totals[bounds[1:]] - totals[bounds[:-1]])
        ends = np.append(starts[1:], len(codes))
        tails = [codes[end - ORDER + 1 : end] for end in ends]
        return np.concatenate(sums, 1), np.diff(bounds), tails

    def measure(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log-probabilities by language, and number of characters, of whole texts."""
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts), np.int64)
        blank = np.full(ORDER - 1, _SPACE, np.uint32)
        part, size = [], 0
        for i, text in enumerate(texts):
            if len(text) > _PART:
                context = blank
                for start in range(0, len(text), _PART):
                    s, n, [context] = self._sums([text[start : start + _PART]], [context])
                    sums[i] += s[0]
                    counts[i] += n[0]
                continue
            part.append(i)
            size += len(text)
            if size > _PART:
                s, n, _ = self._sums([texts[j] for j in part], [blank] * len(part))
                sums[part], counts[part], part, size = s, n, [], 0
        if part:
            sums[part], counts[part], _ = self._sums([texts[j] for j in part], [blank] * len(part))
        return sums, counts


def _excess(entropy, typical, count):
    """How far a cross-entropy lies above the typical one; short texts vary more."""
    return (entropy - typical) / (1 + 3 / np.sqrt(count))


def build_model(languages: list[str], grams: list[str], counts: np.ndarray) -> Model:
    """Kneser-Ney from counts of n-grams of the highest order, a column per language."""
    tables = _tables(grams, counts, len({gram[-1] for gram in grams}) + 1)
    return _model(languages, [tables])


def _model(languages: list[str], blocks: list[Tables]) -> Model:
    width = len(languages)
    return Model(languages, blocks, np.zeros(width), np.full(width, np.inf))


def _tables(grams: list[str], counts: np.ndarray, letters: int) -> Tables:
    """Tables of some languages; the uniform alphabet has ``letters`` characters."""
    width = counts.shape[1]
    codes = np.frombuffer("".join(grams).encode("utf-32-le"), "<u4").reshape(-1, ORDER).astype(np.uint64)
    codes = codes + np.uint64(1)
    tables = [None] * (ORDER + 1)
    for order in range(ORDER, 0, -1):
        powers = _POWERS[:order][::-1]
        keys = (codes * powers).sum(1, dtype=np.uint64)
        sort = np.argsort(keys)
        keys, codes, counts = keys[sort], codes[sort], counts[sort]
        tables[order] = (keys, codes, counts.astype(np.float64))
        if order > 1:
            suffix = (codes[:, 1:] * powers[1:]).sum(1, dtype=np.uint64)
            _, first, inverse = np.unique(suffix, return_index=True, return_inverse=True)
            types = np.zeros((len(first), width), np.int64)
            np.add.at(types, inverse, counts > 0)
            codes, counts = codes[first][:, 1:], types
    keys, logs, history_keys, history_logs = ([None] * (ORDER + 1) for _ in range(4))
    uniform = np.full(width, 1 / letters)
    unseen = np.log(uniform)
    for order in range(1, ORDER + 1):
        keys[order], codes, counts = tables[order]
        powers = _POWERS[: order - 1][::-1]
        ones, twos = (counts == 1).sum(0), (counts == 2).sum(0)
        discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)
        history = (codes[:, :-1] * powers).sum(1, dtype=np.uint64)
        history_keys[order], inverse = np.unique(history, return_inverse=True)
        total, kinds = (np.zeros((len(history_keys[order]), width)) for _ in range(2))
        np.add.at(total, inverse, counts)
        np.add.at(kinds, inverse, counts > 0)
        seen = total > 0
        weight = np.where(seen, discount * kinds / np.where(seen, total, 1), 1.0)
        if order == 1:
            lower = np.repeat(uniform[None], len(codes), 0)
            unseen = np.log(weight[0] * uniform) if len(weight) else unseen
        else:
            suffix = (codes[:, 1:] * powers).sum(1, dtype=np.uint64)
            lower = np.exp(logs[order - 1][np.searchsorted(keys[order - 1], suffix)])
        own = np.maximum(counts - discount, 0) / np.where(seen, total, 1)[inverse]
        logs[order] = np.log(own + weight[inverse] * lower)
        history_logs[order] = np.log(weight)
    return Tables(keys, logs, history_keys, history_logs, unseen)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by language, of the texts of a batch."""
    blank = np.full(ORDER - 1, _SPACE, np.uint32)
    for batch in batches:
        counts: dict[str, Counter] = {}
        for language, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            codes, _, _ = _plain([text or ""], [blank])
            plain = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            grams = map("".join, zip(*(plain[i:] for i in range(ORDER)), strict=False))
            counts.setdefault(language, Counter()).update(grams)
        rows = [(lang, gram, n) for lang, grams in counts.items() for gram, n in grams.items()]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        kinds = (pa.string(), pa.string(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.record_batch(arrays, ["language", "gram", "number"])


def _share(row_id: Column, seed: int) -> Column:
    """A number from 0 to below 1 for each row id, alike in every run."""
    return F.pmod(F.xxhash64(F.lit(seed), row_id.cast("string")), F.lit(2**30)) / float(2**30)


def learn(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", texts: int = TEXTS
) -> Model | None:
    """A model from texts with a language and an id; None if there is none.

    It is fitted on a sample of about ``texts`` texts for each language, picked by a hash of
    the id, of which every fifth calibrates the rejection. All languages and all n-grams of
    the sample are kept.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(id).isNotNull())
    labelled = labelled.select(F.col(lang).alias("language"), F.col(text).alias("text"), F.col(id).alias("id"))
    sizes = labelled.groupBy("language").agg(F.count(F.lit(1)).alias("rows"))
    languages = sorted(row.language for row in sizes.select("language").collect())
    if not languages:
        return None
    share = sizes.select("language", F.least(F.lit(1.0), texts / F.col("rows")).alias("share"))
    sample = labelled.join(F.broadcast(share), "language").where(_share(F.col("id"), 1) < F.col("share"))
    held_back = _share(F.col("id"), 2) < 1 / CALIBRATION
    grams = sample.where(~held_back).select("language", "text").mapInArrow(
        _count_grams, "language string, gram string, number bigint"
    )
    grams = grams.groupBy("language", "gram").agg(F.sum("number").alias("number"))
    counted = grams.toArrow()
    if not counted.num_rows:
        return None
    letters = len(pc.unique(pc.utf8_slice_codeunits(counted["gram"], ORDER - 1))) + 1
    column = pc.index_in(counted["language"], pa.array(languages, pa.string())).to_numpy()
    order = np.argsort(column, kind="stable")
    ends = np.searchsorted(column[order], np.arange(len(languages) + 1))
    width = BLOCK if BLOCK * counted.num_rows <= CELLS else 1
    blocks = []
    for first in range(0, len(languages), width):
        number = min(width, len(languages) - first)
        own = order[ends[first] : ends[first + number]]
        rows = counted.take(pa.array(own))
        kinds, place = np.unique(np.array(rows["gram"].to_pylist(), f"<U{ORDER}"), return_inverse=True)
        counts = np.zeros((len(kinds), number), np.int64)
        counts[place, column[own] - first] = rows["number"].to_numpy()
        blocks.append(_tables(kinds.tolist(), counts, letters))
    model = _model(languages, blocks)
    _calibrate(model, sample.where(held_back).select("language", "text"))
    return model


def _calibrate(model: Model, sample: DataFrame) -> None:
    """Set the typical cross-entropy and the limit of excess of each language."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(0)
        for batch in batches:
            names, texts = (column.to_pylist() for column in batch.columns)
            texts = [text or "" for text in texts]
            sums, counts = shared.value.measure(texts)
            place = {name: i for i, name in enumerate(shared.value.languages)}
            own = [place[name] for name in names]
            mixed = ["".join(random.permutation(list(text))) for text in texts]
            mixed_sums, mixed_counts = shared.value.measure(mixed)
            columns = (own, -sums[np.arange(len(own)), own], counts, -mixed_sums.max(1), mixed_counts)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.record_batch(arrays, schema=schema)

    schema = pa.schema(
        [
            ("own", pa.int64()),
            ("loss", pa.float64()),
            ("letters", pa.int64()),
            ("mixed_loss", pa.float64()),
            ("mixed_letters", pa.int64()),
        ]
    )
    rows = sample.mapInArrow(
        measure, "own bigint, loss double, letters bigint, mixed_loss double, mixed_letters bigint"
    )
    sums = rows.where("letters > 0").groupBy("own").agg(
        *(F.sum(name).alias(name) for name in schema.names[1:])
    )
    found = sums.collect()
    by_language = {row.own: [row] for row in found}
    for i in range(len(model.languages)):
        # A language without texts to calibrate on takes the sums of all.
        mine = by_language.get(i, found)
        if mine:
            typical = sum(r.loss for r in mine) / sum(r.letters for r in mine)
            mixed = sum(r.mixed_loss for r in mine) / sum(r.mixed_letters for r in mine)
            model.typical[i] = typical / np.log(2)
            model.limit[i] = BEYOND * (mixed - typical) / np.log(2)


def _predictor(spark: SparkSession, model: Model | None):
    """An Arrow function from texts to languages."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(_RESULT)
    def predict(texts: pa.Array) -> pa.Array:
        model = shared.value
        if model is None:
            return pa.array([(UNKNOWN, 0.0, None, 0, True)] * len(texts), _arrow_result())
        values = [t or "" for t in texts.to_pylist()]
        sums, counts = model.measure(values)
        best = sums.argmax(1)
        top = sums[np.arange(len(best)), best]
        score = 1 / np.exp(sums - top[:, None]).sum(1)
        entropy = -top / np.log(2) / np.maximum(counts, 1)
        beyond = _excess(entropy, model.typical[best], np.maximum(counts, 1)) > model.limit[best]
        blank = counts == 0
        names = np.array(model.languages, object)[best]
        names[blank] = UNKNOWN
        return pa.StructArray.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array(np.where(blank, 0.0, score)),
                pa.array(entropy, pa.float64(), mask=blank),
                pa.array(counts, pa.int64()),
                pa.array(beyond | blank),
            ],
            fields=list(_arrow_result()),
        )

    return predict


def _arrow_result() -> pa.StructType:
    return pa.struct(
        [
            ("language", pa.string()),
            ("score", pa.float64()),
            ("cross_entropy", pa.float64()),
            ("letters", pa.int64()),
            ("rejected", pa.bool_()),
        ]
    )


def identify(docs: DataFrame, model: Model | None, text: str = "text", to: str = "language") -> DataFrame:
    """Add ``to``: language, score, cross-entropy in bits, characters, and whether rejected.

    NULL texts and texts without a letter are ``und`` with score 0, and rejected; so is
    every text if nothing was learned. The score is the probability of the language among
    all; equal languages go by name. A column of the same name is replaced.
    """
    return docs.withColumn(to, _predictor(docs.sparkSession, model)(F.col(text)))


def _fold(id: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(folds))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; every fourth fold of ids is held out from learning.

    A row without id is in no fold: it is not learned from and not held out.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.where(_fold("doc_id", 4) != 2))
    named = identify(docs.select("doc_id", "text"), model)
    return named.select(
        "doc_id",
        F.coalesce(_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.col("language.language").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.cross_entropy").alias("cross_entropy"),
        F.col("language.rejected").alias("rejected"),
    )


def keep_identified(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The documents, with all their columns, whose language is not rejected."""
    language = fresh(docs.columns, "_language")
    named = identify(docs, model, text, language)
    return named.where(~F.col(f"{language}.rejected")).drop(language)
