"""Licence scans: a trained classifier of paragraphs, confirmed by templates.

A paragraph is a line of a text, or a run of lines without a blank one between them, joined, as
licences are often wrapped; comment markers are no words. Its words and word pairs are sparse features of a logistic
regression over licence families and one class for all else. It learns the families from
templates with words left out, put in and swapped, and the other class from paragraphs
sampled from the corpus, and from templates whose family is replaced by other words, as of a licence
outside the families. A share of these is kept to calibrate a probability below which
a paragraph counts as unknown.

A family is confirmed where a stretch of a paragraph holds most of one of its templates, with
the same marks (``nc``, ``affero``) and no negation that the template lacks, and the model prefers the
family to none there. So one paragraph may have several families. Each expression of an
``SPDX-License-Identifier`` counts as a paragraph for each of its identifiers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmeter.llm.decontamination import TABLE

# Fixed values.
TEMPLATES = {
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the AGPL, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Licensed under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-ND": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-SA": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GPL, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the LGPL, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        'The Software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.',
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "Proprietary": ("All rights reserved.", "Copyright. All rights reserved."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
IDENTIFIERS = {
    "AGPL": "AGPL",
    "Apache-2.0": "Apache-2.0",
    "BSD": "BSD",
    "CC-BY": "CC-BY-4.0",
    "CC-BY-NC": "CC-BY-NC-4.0",
    "CC-BY-NC-ND": "CC-BY-NC-ND-4.0",
    "CC-BY-NC-SA": "CC-BY-NC-SA-4.0",
    "CC-BY-ND": "CC-BY-ND-4.0",
    "CC-BY-SA": "CC-BY-SA-4.0",
    "CC0": "CC0-1.0",
    "EPL-2.0": "EPL-2.0",
    "GPL": "GPL",
    "ISC": "ISC",
    "LGPL": "LGPL",
    "MIT": "MIT",
    "MPL-2.0": "MPL-2.0",
    "Unlicense": "Unlicense",
}
#: Words that tell relatives apart, and words that turn a grant into its opposite.
MARKS = frozenset(b"affero lesser nc nd sa noncommercial noderivatives sharealike".split())
NEGATIONS = frozenset(b"no not never isn aren wasn cannot".split())
FAMILIES = tuple(TEMPLATES)
NONE = len(FAMILIES)

#: Varied copies of each template, documents sampled for the other class, paragraphs taken of them.
VARIANTS = 60
DOCUMENTS = 2000
OTHERS = 8000
CALIBRATION = 5
#: Share of other paragraphs that may pass the calibrated probability, and of a template to be found.
FALSE = 0.0005
FOUND = 0.8
#: Share of licences outside the families that must stay below the calibrated probability.
UNKNOWN = 0.99
STEPS = 200
SEED = 13

_RESULT = "array<struct<paragraph:int,family:string,probability:double,confirmed:boolean,version:string>>"


#: Comment markers of letters; all others are no words.
_MARKER = re.compile(rb"^\s*(?:rem|dnl)\s", re.IGNORECASE)
_SPDX = b"SPDX-License-Identifier: "
_EXPRESSION = re.compile(rb"SPDX-License-Identifier:([^\r]*)", re.IGNORECASE)
_IDENTIFIER = re.compile(rb"[A-Za-z0-9][A-Za-z0-9.+-]*")

Words = list[bytes]
#: Paragraph, family, probability, confirmed or not, version.
Finding = tuple[int, str, float, bool, str]


def words(paragraph: bytes) -> list[bytes]:
    """Words by the rule of the search: runs of digits, letters and all beyond ASCII."""
    return paragraph.translate(TABLE).split()


def _held(template: list[bytes], paragraph: list[bytes]) -> float:
    """Share of a template's word pairs that the paragraph has; of its words if it has one."""
    size = min(2, len(template))
    own = {tuple(template[i : i + size]) for i in range(len(template) - size + 1)}
    other = {tuple(paragraph[i : i + size]) for i in range(len(paragraph) - size + 1)}
    return len(own & other) / max(len(own), 1)


def _version(found: Words) -> str:
    """The first number of a stretch, with a digit after the point if there is one; mostly empty."""
    for i, word in enumerate(found):
        after = found[i + 1] if i + 1 < len(found) else b""
        if word.isdigit() and len(word) < 3 and after != b"clause":
            return (word + b"." + after if after.isdigit() and len(after) == 1 else word).decode()
    return ""


class Template:
    """Words of a licence, its word pairs, and what a stretch of text must hold of them."""

    def __init__(self, family: int, text: Words):
        self.family, self.text = family, text
        self.pairs = frozenset(zip(text, text[1:], strict=False))
        self.least = FOUND * len(self.pairs)
        self.longest = len(text) * 5 // 4 + 8
        self.marks = MARKS.intersection(text)
        self.negations = sum(word in NEGATIONS for word in text)

    def stretches(self, joined: Words, pairs: list[tuple[bytes, bytes]]) -> Iterator[tuple[int, int]]:
        """First and last word of the stretches that hold most of the template, apart from each other."""
        places, low, free = [i for i, p in enumerate(pairs) if p in self.pairs], 0, 0
        for high, place in enumerate(places):
            if place < free:
                continue
            while place - places[low] >= self.longest or places[low] < free:
                low += 1
            held = {pairs[i] for i in places[low : high + 1]}
            if len(held) < self.least:
                continue
            if high + 1 < len(places) and places[high + 1] - places[low] < self.longest and pairs[places[high + 1]] not in held:
                continue
            start = low
            while pairs[places[start]] in {pairs[i] for i in places[start + 1 : high + 1]}:
                start += 1
            if self.alike(joined, places[start], place + 1):
                yield places[start], place + 1
            free = place + 2

    def alike(self, joined: Words, first: int, last: int) -> bool:
        """Whether a stretch has the template's marks, and no more negations, two words before it included."""
        negations = sum(word in NEGATIONS for word in joined[max(first - 2, 0) : last + 1])
        return MARKS.intersection(joined[first : last + 1]) == self.marks and negations <= self.negations


@dataclass
class Classifier:
    """Numbers of words and word pairs, their weights, and the calibrated probability."""

    singles: dict[bytes, int]
    pairs: dict[tuple[bytes, bytes], int]
    weights: np.ndarray
    bias: np.ndarray
    least: float = 0.5
    templates: list[Template] = field(default_factory=list)

    def features(self, paragraph: Words) -> set[int]:
        """Numbers of the words and word pairs of a paragraph; unknown ones are left out."""
        found = {self.singles[word] for word in paragraph if word in self.singles}
        if len(found) > 1:
            pairs = self.pairs
            found.update(pairs[p] for p in zip(paragraph, paragraph[1:], strict=False) if p in pairs)
        return found

    def probabilities(self, paragraphs: list[Words]) -> np.ndarray:
        """Probability of each family, and last of none, for each paragraph."""
        odds = np.repeat(self.bias[None], len(paragraphs), 0)
        for row, paragraph in enumerate(paragraphs):
            if found := self.features(paragraph):
                odds[row] += self.weights[list(found)].sum(0)
        odds = np.exp(odds - odds.max(1, keepdims=True))
        return odds / odds.sum(1, keepdims=True)

    def limits(self) -> tuple[list[float], float]:
        """The most each feature can add to a family's odds against none, and what is needed."""
        gains = (self.weights[:, :NONE] - self.weights[:, NONE:]).max(1)
        gap = (self.bias[:NONE] - self.bias[NONE]).max()
        return np.maximum(gains, 0).tolist(), float(np.log(self.least / (1 - self.least)) - gap)

    def scan(self, texts: Iterator[bytes], prune: bool = True) -> Iterator[list[Finding]]:
        """The licences in each text, in order: confirmed stretches, and other lines like a family.

        With ``prune``, only lines whose features could lift a family to the calibrated
        probability are evaluated; the result is the same without.
        """
        gains, needed = self.limits()
        for text in texts:
            raw = text.split(b"\n")
            lines = [words(_MARKER.sub(b"", line)) for line in raw]
            confirmed = {(c[0], c[2]): c for c in (*self._confirmed(lines), *self._identified(raw))}.values()
            inside = {i for first, last, *_ in confirmed for i in range(first, last + 1)}
            numbers = [
                i
                for i, own in enumerate(lines)
                if own and i not in inside and (not prune or sum(gains[f] for f in self.features(own)) >= needed)
            ]
            chances = self.probabilities([lines[i] for i in numbers])
            found = [(first, FAMILIES[family], chance, True, version) for first, _, family, chance, version in confirmed]
            for number, chance in zip(numbers, chances, strict=True):
                family = int(chance.argmax())
                if family != NONE and chance[family] >= self.least:
                    found.append((number, FAMILIES[family], float(chance[family]), False, _version(lines[number])))
            yield sorted(found)

    def _confirmed(self, lines: list[Words]) -> Iterator[tuple[int, int, int, float, str]]:
        """First and last line, family, probability and version of confirmed stretches; one a family and first line."""
        start = 0
        for end in range(len(lines) + 1):
            if end < len(lines) and lines[end]:
                continue
            best = {}
            for first, last, family, chance, version in self._stretches(lines[start:end]):
                key = (start + first, family)
                best[key] = max(best.get(key, (0, 0.0, "")), (start + last, chance, version))
            for (first, family), (last, chance, version) in best.items():
                yield first, last, family, chance, version
            start = end + 1

    def _stretches(self, lines: list[Words]) -> Iterator[tuple[int, int, int, float, str]]:
        joined = [word for line in lines for word in line]
        pairs = list(zip(joined, joined[1:], strict=False))
        there = self.pairs.keys() & pairs
        fitting = [t for t in self.templates if len(there) >= t.least and len(t.pairs & there) >= t.least]
        line_of = [i for i, line in enumerate(lines) for _ in line] if fitting else []
        for template in fitting:
            for first, last in template.stretches(joined, pairs):
                [chances] = self.probabilities([joined[first : last + 1]])
                own, none = float(chances[template.family]), float(chances[NONE])
                if own >= self.least * (own + none):
                    version = _version(joined[first : last + 3])
                    yield line_of[first], line_of[last], template.family, own / (own + none), version

    def _identified(self, raw: list[bytes]) -> Iterator[tuple[int, int, int, float, str]]:
        """The same of the identifiers in SPDX expressions, each by itself."""
        for number, line in enumerate(raw):
            # A cheap test first, as nearly all lines have none.
            expression = _EXPRESSION.search(line) if b"-" in line else None
            for identifier in sorted(set(_IDENTIFIER.findall(expression[1]))) if expression else ():
                for _, _, *rest in self._stretches([words(_SPDX + identifier)]):
                    yield number, number, *rest


def _vary(template: list[bytes], filler: list[bytes], random: np.random.Generator) -> list[bytes]:
    """A template with some words left out and others put in, inside a longer paragraph."""
    pick = lambda n: [filler[i] for i in random.integers(0, len(filler), n)]
    varied = []
    for word in template:
        if random.random() >= 0.04:
            varied.append(word)
        if random.random() < 0.04:
            varied += pick(1)
    return pick(random.integers(0, 12)) + varied + pick(random.integers(0, 12))


def _softmax_fit(rows: list[set[int]], kinds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by gradient steps with momentum; classes count alike."""
    x = np.zeros((len(rows), size + 1), np.float32)
    for i, row in enumerate(rows):
        x[i, list(row)] = 1
    x[:, size] = 1
    target = np.eye(NONE + 1, dtype=np.float32)[kinds]
    weight = 1 / np.maximum(np.bincount(kinds, minlength=NONE + 1), 1)[kinds]
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    fitted, speed = (np.zeros((size + 1, NONE + 1), np.float32) for _ in range(2))
    for _ in range(STEPS):
        odds = x @ fitted
        odds = np.exp(odds - odds.max(1, keepdims=True))
        error = (odds / odds.sum(1, keepdims=True) - target) * weight
        speed = 0.9 * speed - 2.0 * (x.T @ error + 1e-4 * fitted)
        fitted += speed
    return fitted[:size], fitted[size]


def train(others: list[bytes]) -> Classifier:
    """A classifier from the templates and sampled paragraphs that are no licence."""
    random = np.random.default_rng(SEED)
    templates = {i: [words(t.encode()) for t in TEMPLATES[f]] for i, f in enumerate(FAMILIES)}
    for i, family in enumerate(FAMILIES):
        if family in IDENTIFIERS:
            templates[i].append(words(_SPDX + IDENTIFIERS[family].encode()))
    own = sorted({word for family in templates.values() for t in family for word in t})
    pairs = sorted({p for family in templates.values() for t in family for p in zip(t, t[1:], strict=False)})
    singles = {word: i for i, word in enumerate(own)}
    numbers = {pair: len(own) + i for i, pair in enumerate(pairs)}
    plain = [p for p in map(words, others) if p]
    plain = [p for p in plain if all(_held(t, p) < 0.5 for f in templates.values() for t in f)]
    filler = sorted({word for p in plain for word in p} - set(own)) or [b"x"]
    examples = [(p, NONE) for p in plain]
    strangers = []
    for family, texts in templates.items():
        others_words = {word for f, other in templates.items() if f != family for t in other for word in t}
        for template in texts:
            examples += [(template, family)] * 5
            examples += [(_vary(template, filler, random), family) for _ in range(VARIANTS)]
            # The same words out of order, and few of them, are no licence.
            for _ in range(VARIANTS // 4):
                few = [template[i] for i in random.permutation(len(template))[: 2 + len(template) // 4]]
                examples.append((few + [filler[i] for i in random.integers(0, len(filler), 8)], NONE))
            # A licence of another name: the frame stays, the words of the family alone go.
            if set(template) - others_words:
                for _ in range(VARIANTS // 2):
                    named = [w if w in others_words else filler[random.integers(0, len(filler))] for w in template]
                    strangers.append(_vary(named, filler, random))
    examples[len(plain) : len(plain)] = [(p, NONE) for p in strangers]
    model = Classifier(singles, numbers, np.empty(0), np.empty(0), templates=[Template(f, t) for f, texts in templates.items() for t in texts])
    order = random.permutation(len(examples))
    held, learned = order[: len(order) // CALIBRATION], order[len(order) // CALIBRATION :]
    rows = [model.features(examples[i][0]) for i in learned]
    kinds = np.array([examples[i][1] for i in learned])
    model.weights, model.bias = _softmax_fit(rows, kinds, len(own) + len(pairs))
    for low, high, share in ((0, len(plain), 1 - FALSE), (len(plain), len(plain) + len(strangers), UNKNOWN)):
        outside = [examples[i][0] for i in held if low <= i < high]
        if outside:
            wrong = model.probabilities(outside)
            wrong = (wrong[:, :NONE].max(1) / (wrong[:, :NONE].max(1) + wrong[:, NONE]))
            model.least = max(model.least, min(float(np.quantile(wrong, share)), 0.9))
    return model


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = {line for text in batch.column(0).to_pylist() for line in (text or "").split("\n")}
        yield pa.record_batch([pa.array([x for x in lines if len(x.split()) > 2], pa.string())], ["line"])


def learn(docs: DataFrame, id: str = "doc_id", text: str = "text") -> Classifier:
    """Train against paragraphs of about ``DOCUMENTS`` documents, ``OTHERS`` at most.

    Documents and paragraphs are picked by hashes, so reruns agree.
    """
    rows = docs.agg(F.count(F.lit(1))).first()[0]
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col(id)), F.lit(2**30)) / float(2**30)
    sample = docs.where(draw < DOCUMENTS / max(rows, 1)).select(text)
    lines = sample.mapInArrow(_paragraphs, "line string").distinct()
    picked = lines.orderBy(F.xxhash64("line"), "line").limit(OTHERS).collect()
    return train([row.line.encode() for row in picked])


def scan_licenses(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """Add ``licenses``: paragraph, family, probability, confirmation and version of each licence.

    Paragraphs are lines, counted from 0; a wrapped licence counts at its first. They are in order;
    findings of one paragraph go by family. NULL and empty texts have none. Every row is scanned by itself, so
    repeated rows have equal results. A column of the same name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(
        pa.struct(
            [
                ("paragraph", pa.int32()),
                ("family", pa.string()),
                ("probability", pa.float64()),
                ("confirmed", pa.bool_()),
                ("version", pa.string()),
            ]
        )
    )

    @F.arrow_udf(_RESULT)
    def scan(texts: pa.Array) -> pa.Array:
        encoded = ((t.as_py() or "").encode() for t in texts)
        return pa.array(list(shared.value.scan(encoded)), kind)

    return docs.withColumn("licenses", scan(F.col(text)))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document: confirmed families, and the spans they come from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan_licenses(docs, learn(docs))
    sure = F.filter("licenses", lambda x: x["confirmed"])
    families = F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"])))
    spans = F.transform(
        "licenses", lambda x: F.concat_ws(":", x["paragraph"], x["family"], x["version"], x["confirmed"])
    )
    return found.select(
        "doc_id",
        F.array_join(families, ",").alias("families"),
        F.size(sure).cast("long").alias("n_confirmed"),
        (F.size("licenses") - F.size(sure)).cast("long").alias("n_unconfirmed"),
        F.array_join(spans, ",").alias("spans"),
    )
