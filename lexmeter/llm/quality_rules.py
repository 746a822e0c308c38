"""Quality rules as weak supervision: votes, estimated accuracies, posterior probability.

Each rule looks at statistics of a text and votes good or bad, or abstains. How often a rule
votes what on good and on bad texts is not known; expectation-maximisation estimates it,
with the share of good texts, from which votes come together. It needs only the number
of texts for each pattern of votes, a table bounded by the rules. A text is kept if
it is more probably good than bad and passes the base rules.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmeter.llm.common import SPACES, fresh, word_list
from lexmeter.sources.scratch import new_folder, written

# Fixed values.
SYMBOL = r"[^#*$%&|<>]+"
ORDINARY = r"[\p{L}\p{N}\x20\x09-\x0D.,;:'\"()@+/?-]+"
BASE_WORDS = 10
BASE_REPEATED = 20
REPEAT = 5

GOOD, ABSTAIN, BAD = 1, 0, -1
ROUNDS = 30
CLOSE = 1e-6
#: No vote is taken to be rarer than this among good or bad texts.
FLOOR = 0.002

STATISTICS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_chars",
    "n_upper",
    "n_odd",
    "n_shouts",
    "n_stutters",
)


@dataclass(frozen=True)
class Rule:
    """Votes good up to a share of ``value`` in ``per`` and bad from another share on."""

    name: str
    value: str
    per: str
    good: float
    bad: float

    def vote(self) -> Column:
        """A rule abstains between its bounds, and where there is nothing to divide by."""
        value, per = F.col(self.value).cast("double"), F.col(self.per)
        return (
            F.when(per == 0, ABSTAIN)
            .when(value <= self.good * per, GOOD)
            .when(value >= self.bad * per, BAD)
            .otherwise(ABSTAIN)
        )


RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.05, 0.2),
    Rule("shouts", "n_shouts", "n_words", 0.05, 0.2),
    Rule("capitals", "n_upper", "word_chars", 0.15, 0.4),
    Rule("odd_signs", "n_odd", "n_chars", 0.01, 0.05),
    Rule("long_words", "word_chars", "n_words", 10, 16),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.1, 0.4),
    Rule("repeated_words", "n_repeat_words", "n_words", 0.05, 0.2),
    Rule("stutters", "n_stutters", "n_words", 0.05, 0.25),
)


def _without(text: Column, drop: str) -> Column:
    return F.length(F.regexp_replace(text, drop, ""))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts named in ``STATISTICS`` as a struct ``stats``; NULL counts as empty.

    A repeated word lies in a window of five words that occurs twice or more in the text;
    windows are compared by a hash of 64 bits, and only the texts that have two alike sort
    theirs to find which.
    """
    names = [fresh(docs.columns, f"_{name}") for name in ("words", "lines", "windows", "twice")]
    words, lines, windows, twice = names
    value = F.coalesce(F.col(text), F.lit(""))
    with_word = F.filter(F.split(value, "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0)
    staged = docs.withColumns({words: word_list(value), lines: with_word})
    starts = F.sequence(F.lit(0), F.size(words) - REPEAT)
    window = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, REPEAT)))
    none = F.array().cast("array<bigint>")
    staged = staged.withColumn(windows, F.when(F.size(words) > REPEAT, window).otherwise(none))
    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    some = F.size(F.array_distinct(windows)) < F.size(windows)
    no_pairs = F.array().cast("array<struct<h:bigint,i:int>>")
    staged = staged.withColumn(twice, F.when(some, F.array_sort(pairs)).otherwise(no_pairs))

    def alike(pair: Column, k: Column) -> Column:
        after = F.get(twice, k + 1)["h"].eqNullSafe(pair["h"])
        return after | (F.when(k > 0, F.get(twice, k - 1)["h"]).eqNullSafe(pair["h"]))

    covered = F.flatten(
        F.transform(
            F.filter(twice, alike), lambda pair: F.sequence(pair["i"], pair["i"] + (REPEAT - 1))
        )
    )
    repeated = F.when(F.size(twice) > 0, F.size(F.array_distinct(covered))).otherwise(0)
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": _without(value, SYMBOL),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated,
        "n_lines": F.size(lines),
        "n_chars": F.length(value),
        "n_upper": _without(value, r"[^\p{Lu}]+"),
        "n_odd": _without(value, ORDINARY),
        "n_shouts": F.length(value) - F.length(F.replace(value, F.lit("!"), F.lit(""))),
        "n_stutters": F.size(F.filter(words, lambda word, i: word == F.get(words, i + 1))),
    }
    stats = F.struct(*(column.cast("long").alias(name) for name, column in counts.items()))
    return staged.withColumn("stats", stats).drop(*names)


@dataclass
class Accuracies:
    """Share of good texts, and how often each rule votes what, given good or bad."""

    good: float
    given_good: dict[tuple[str, int], float]
    given_bad: dict[tuple[str, int], float]

    def probability(self) -> Column:
        """Posterior probability that a text is good, from its votes."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for rule in RULES:
            weights = {
                vote: math.log(self.given_good[rule.name, vote] / self.given_bad[rule.name, vote])
                for vote in (GOOD, BAD)
            }
            vote = F.col(f"_{rule.name}")
            odds = odds + F.when(vote == GOOD, weights[GOOD]).when(vote == BAD, weights[BAD]).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def _shares(good: float, bad: float) -> dict[int, float]:
    """Shares of good and bad among votes cast, none below the floor."""
    total = good + bad
    share = good / total if total > 0 else 0.5
    share = min(max(share, FLOOR), 1 - FLOOR)
    return {GOOD: share, BAD: 1 - share}


def estimate(patterns: DataFrame) -> Accuracies:
    """Expectation-maximisation over ``texts`` per pattern of votes.

    It starts from texts without a bad vote being good. A rule that abstains says
    nothing. The bad class stays the one in which rules vote bad more often.
    """
    any_bad = F.lit(False)
    for rule in RULES:
        any_bad = any_bad | (F.col(f"_{rule.name}") == BAD)
    probability = F.when(any_bad, 0.1).otherwise(0.99)
    found = None
    for _ in range(ROUNDS):
        sums = [F.sum(F.col("texts") * probability).alias("good"), F.sum("texts").alias("all")]
        for rule in RULES:
            for vote in (GOOD, BAD):
                cast = F.when(F.col(f"_{rule.name}") == vote, F.col("texts")).otherwise(0)
                sums.append(F.sum(cast * probability).alias(f"{rule.name}{vote}good"))
                sums.append(F.sum(cast).alias(f"{rule.name}{vote}all"))
        row = patterns.agg(*sums).first()
        if not row["all"]:
            good = 0.5
        else:
            good = min(max(row["good"] / row["all"], FLOOR), 1 - FLOOR)
        given_good, given_bad = {}, {}
        for rule in RULES:
            yes = {vote: row[f"{rule.name}{vote}good"] or 0.0 for vote in (GOOD, BAD)}
            no = {vote: (row[f"{rule.name}{vote}all"] or 0) - yes[vote] for vote in (GOOD, BAD)}
            own, other = _shares(yes[GOOD], yes[BAD]), _shares(no[GOOD], no[BAD])
            if other[BAD] < own[BAD]:
                other = own
            for vote in (GOOD, BAD):
                given_good[rule.name, vote] = own[vote]
                given_bad[rule.name, vote] = other[vote]
        before, found = found, Accuracies(good, given_good, given_bad)
        probability = found.probability()
        if before and all(
            abs(x - y) < CLOSE
            for x, y in zip(
                [found.good, *given_good.values(), *given_bad.values()],
                [before.good, *before.given_good.values(), *before.given_bad.values()],
                strict=True,
            )
        ):
            break
    return found


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``stats``, ``base_failed``, ``quality_probability`` and ``kept``.

    The statistics are written once, as they are read for the estimate and for the
    verdict; ``docs`` should hold only the columns wanted. Equal texts get equal verdicts.
    NULL, empty and blank texts have no words and fail the base rules. Columns with the
    added names are replaced.
    """
    added = ("stats", "base_failed", "quality_probability", "kept")
    kept = [c for c in docs.columns if c.lower() not in added and c != text]
    folder = new_folder(docs.sparkSession)
    row = docs.select(text, F.struct(F.lit(0).alias("_"), *kept).alias("_row"))
    measured = written(statistics(row, text).select("_row", "stats"), f"{folder}/stats")
    wide = measured.select("_row", "stats", "stats.*")
    votes = wide.select(
        "_row",
        "stats",
        *(rule.vote().alias(f"_{rule.name}") for rule in RULES),
        (
            (F.col("n_words") < BASE_WORDS)
            | (100 * F.col("n_repeat_words") > BASE_REPEATED * F.col("n_words"))
        ).alias("base_failed"),
    )
    names = [f"_{rule.name}" for rule in RULES]
    patterns = votes.groupBy(*names).agg(F.count(F.lit(1)).alias("texts"))
    accuracies = estimate(written(patterns, f"{folder}/patterns"))
    judged = votes.withColumn("quality_probability", accuracies.probability())
    verdict = ~F.col("base_failed") & (F.col("quality_probability") >= 0.5)
    return judged.withColumn("kept", verdict).select(
        *(F.col(f"_row.{c}").alias(c) for c in kept), "stats", "base_failed", "quality_probability", "kept"
    )


def op7_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rules and verdict for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    judged = judge(docs)
    return judged.select(
        "doc_id",
        *(F.col(f"stats.{name}").alias(name) for name in STATISTICS[:5]),
        "base_failed",
        "kept",
        F.round("quality_probability", 6).alias("quality_probability"),
    )
