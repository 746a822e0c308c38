"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A text is described by a dozen statistics. Cosines of random projections of them
approximate a Gaussian kernel, so a linear fit in the cosines is a kernel fit. Each
partition sums its own normal equations; their sum, whose size depends on the number of
cosines alone, is solved on the driver. Two folds are summed apart: each is scored by the
fit of the other, and isotonic regression turns those scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from lexmeter.llm.common import fresh
from lexmeter.sources.scratch import new_folder, written

FEATURES = 12
COSINES = 256
BANDWIDTH = 3.0
RIDGE = 1e-3
SEED = 5
THRESHOLD = 0.3
#: Standardised statistics are cut here, and raw scores are binned in steps for calibration.
CUT = 6.0
STEP = 1e-3
LOW, HIGH = -1.0, 2.0

# Fixed values.
SYMBOLS = b"#*$%&|<>"

_TOTALS = "fold int, part int, i int, sums array<double>"


def _byte_classes() -> np.ndarray:
    """0 other ASCII, 1 capital, 2 small, 3 digit, 4 symbol, 5 ``!``, 6 space, 7 beyond ASCII."""
    classes = np.zeros(256, np.int64)
    classes[65:91], classes[97:123], classes[48:58], classes[128:] = 1, 2, 3, 7
    classes[list(SYMBOLS)], classes[33], classes[list(b" \t\n\x0b\x0c\r")] = 4, 5, 6
    return classes


_CLASSES = _byte_classes()


def statistics(text: bytes) -> list[float]:
    """Statistics of a whole text, all zero for an empty one."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    found = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    other, capital, small, digit, symbol, shout, _, beyond = np.bincount(
        _CLASSES, weights=found, minlength=8
    ).tolist()
    n, letters = max(len(words), 1), max(capital + small + beyond, 1)
    distinct = len(set(words))
    return [
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        capital / letters,
        symbol / n,
        shout / n,
        digit / max(len(text), 1),
        other / n,
        letters / max(len(text), 1),
        float(np.log1p(distinct) / np.log1p(n)),
        sum(map(eq, words, words[1:])) / n,
        (len(lines) - len(set(lines))) / max(len(lines), 1),
        len(lines) / n,
    ]


@F.arrow_udf(ArrayType(DoubleType()))
def text_statistics(texts: pa.Array) -> pa.Array:
    """The statistics of each text; NULL counts as empty."""
    rows = [statistics((t.as_py() or "").encode()) for t in texts]
    return pa.array(rows, pa.list_(pa.float64()))


@dataclass
class Scorer:
    """Standardisation, weights of the cosines, and the calibrated steps."""

    mean: np.ndarray
    spread: np.ndarray
    weights: dict[int, np.ndarray]
    raw: np.ndarray
    probability: np.ndarray

    def cosines(self, rows: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(SEED)
        directions = random.normal(0, 1 / BANDWIDTH, (FEATURES, COSINES))
        phases = random.uniform(0, 2 * np.pi, COSINES)
        standard = np.clip((rows - self.mean) / self.spread, -CUT, CUT)
        waves = np.cos(standard @ directions + phases) * np.sqrt(2 / COSINES)
        return np.concatenate([np.ones((len(rows), 1)), waves], 1)

    def raw_scores(self, rows: np.ndarray, fold: int) -> np.ndarray:
        return np.clip(self.cosines(rows) @ self.weights[fold], LOW, HIGH)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.raw_scores(rows, -1), self.raw, self.probability)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)


def _solve(sums: np.ndarray) -> np.ndarray:
    """Ridge weights from normal equations; their last column is the right-hand side."""
    rows = max(sums[0, 0], 1.0)
    return np.linalg.solve(sums[:, :-1] + RIDGE * rows * np.eye(len(sums)), sums[:, -1])


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values``, by pooling adjacent violators."""
    pools: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] > pools[-1][0]:
            value, weight, size = pools.pop()
            last = pools[-1]
            last[0] = (last[0] * last[1] + value * weight) / (last[1] + weight)
            last[1] += weight
            last[2] += size
    return np.repeat([pool[0] for pool in pools], [pool[2] for pool in pools])


def fit(
    described: DataFrame, labels: DataFrame, learns: str, id: str, label: str
) -> Scorer | None:
    """Fit to rows of ``described`` where ``learns`` holds and ``labels`` has a mark.

    None if there is no such row. Statistics are standardised over all rows. Several labels of an id are averaged; NULL labels and ids are passed over.
    """
    spark = described.sparkSession
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col(id).alias("_id"))
    marks = marks.agg(F.avg(label).alias("mark"))
    marked = described.where(learns).join(marks, F.col(id) == F.col("_id"))
    fold = F.pmod(F.xxhash64(F.lit(SEED), F.col("_id")), F.lit(2)).cast("int")
    marked = written(marked.select(fold.alias("fold"), "stats", "mark"), f"{new_folder(spark)}/marked")
    parts = [F.col("stats")[i] for i in range(FEATURES)]
    row = described.agg(*(f(part) for part in parts for f in (F.avg, F.stddev_pop))).first()
    mean, spread = np.array([[x or 0.0 for x in row[i::2]] for i in (0, 1)])
    scorer = Scorer(mean, np.where(spread > 1e-9, spread, 1.0), {}, np.empty(0), np.empty(0))
    shared = spark.sparkContext.broadcast(scorer)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, COSINES + 1, COSINES + 2))
        for batch in batches:
            folds, stats, marks = batch.columns
            waves = shared.value.cosines(_matrix(stats))
            both = np.concatenate([waves, marks.to_numpy()[:, None]], 1)
            for fold in (0, 1):
                mine = folds.to_numpy() == fold
                sums[fold] += waves[mine].T @ both[mine]
        size = COSINES + 1
        yield pa.record_batch(
            [
                pa.array(np.repeat([0, 1], size), pa.int32()),
                pa.array(np.full(2 * size, TaskContext.get().partitionId()), pa.int32()),
                pa.array(np.tile(np.arange(size), 2), pa.int32()),
                pa.array(list(sums.reshape(-1, COSINES + 2)), pa.list_(pa.float64())),
            ],
            ["fold", "part", "i", "sums"],
        )

    def total(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        sums = np.sum([np.array(row.as_py()) for row in rows["sums"]], 0)
        return rows.slice(0, 1).set_column(3, "sums", pa.array([sums], pa.list_(pa.float64())))

    partial = marked.mapInArrow(equations, _TOTALS)
    found = partial.groupBy("fold", "i").applyInArrow(total, _TOTALS).collect()
    sums = np.zeros((2, COSINES + 1, COSINES + 2))
    for row in found:
        sums[row.fold, row.i] = row.sums
    if not sums[:, 0, 0].sum():
        return None
    scorer.weights = {-1: _solve(sums[0] + sums[1]), 0: _solve(sums[1]), 1: _solve(sums[0])}
    _calibrate(scorer, marked)
    return scorer


def _calibrate(scorer: Scorer, marked: DataFrame) -> None:
    """Isotonic steps over the scores each fold gets from the other."""
    shared = marked.sparkSession.sparkContext.broadcast(scorer)

    @F.arrow_udf("double")
    def outside(folds: pa.Array, stats: pa.Array) -> pa.Array:
        rows, folds = _matrix(stats), folds.to_numpy()
        first, second = (shared.value.raw_scores(rows, fold) for fold in (0, 1))
        return pa.array(np.where(folds == 0, first, second))

    step = F.floor(outside("fold", "stats") / STEP).alias("step")
    bins = marked.select(step, "mark").groupBy("step")
    bins = bins.agg(F.count("mark").alias("n"), F.sum("mark").alias("marks")).orderBy("step").collect()
    n = np.array([row.n for row in bins], float)
    scorer.raw = (np.array([row.step for row in bins]) + 0.5) * STEP
    scorer.probability = isotonic(np.array([row.marks for row in bins]) / n, n)


def describe(docs: DataFrame, text: str = "text", to: str = "stats") -> DataFrame:
    """Replace the text by its statistics, a column named ``to``."""
    return docs.withColumn(to, text_statistics(F.col(text))).drop(text)


def score(described: DataFrame, scorer: Scorer | None, to: str = "score") -> DataFrame:
    """Add ``to``, the probability of a good text; 0.5 if nothing was learned."""
    shared = described.sparkSession.sparkContext.broadcast(scorer)

    @F.arrow_udf("double")
    def scores(stats: pa.Array) -> pa.Array:
        rows = _matrix(stats)
        return pa.array(shared.value.score(rows) if shared.value else np.full(len(rows), 0.5))

    return described.withColumn(to, scores("stats"))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """Ids with ``score``, learned from the labels of rows where ``learn_from`` holds.

    NULL texts count as empty, and get the score of an empty text. Rows without id are
    scored but not learned from. Repeated rows stay repeated.
    """
    learns = fresh([id, "stats"], "_learns")
    named = docs.select(id, F.col(text).alias("_text"), F.coalesce(learn_from, F.lit(False)).alias(learns))
    described = written(describe(named, "_text"), f"{new_folder(docs.sparkSession)}/described")
    scorer = fit(described, labels, learns, id, label)
    return score(described.select(id, "stats"), scorer).select(id, "score")


def op5_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; every fifth fold of ids is held out from learning."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    scored = score_quality(docs, labels, fold != 0)
    return scored.select(
        "doc_id",
        F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
