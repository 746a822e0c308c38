"""Licence lines that were put into texts, and texts without any."""

import random

import pytest
from llm_tables import plain_columns
from pyspark.sql import functions as F

from lexmeter.llm import license_scan as ls

PLANTED = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "All rights reserved.": "Proprietary",
}


@pytest.fixture(scope="module")
def model(documents):
    return ls.learn(documents)


def test_planted_lines_are_found_in_all_documents(spark, documents):
    rows = {r.doc_id: r for r in ls.op9_license_scan(spark, "/root/testdata/sf0.01").collect()}
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert len(rows) == len(texts)
    found = 0
    for r in texts:
        wanted = sorted({family for line, family in PLANTED.items() if line in r.text})
        assert rows[r.doc_id].families == ",".join(wanted)
        found += bool(wanted)
    assert found > 30


def test_varied_templates_are_recognised(model):
    rng = random.Random(0)
    for family, texts in ls.TEMPLATES.items():
        for template in texts:
            words = template.split()
            # What is left must hold enough of the template still, and what tells it from its relatives.
            whole = ls.words(template.encode())
            rests = [ls.words(" ".join(words[:i] + words[i + 1 :]).encode()) for i in range(len(words))]
            spare = [
                i
                for i, rest in enumerate(rests)
                if ls._held(whole, rest) >= ls.FOUND and ls.MARKS.intersection(rest) == ls.MARKS.intersection(whole)
            ]
            if len(words) > 8:
                del words[rng.choice(spare)]
            line = " ".join(["Acme", "2020", *words, "thank", "readers"]).upper().encode()
            [found] = model.scan([b"first\n" + line + b"\nlast"])
            assert [(f[0], f[1], f[3]) for f in found] == [(1, family, True)], template


@pytest.mark.parametrize("text", ["", "the version of the work is free", "public software terms", "license", "you may use any file\nall copyright"])
def test_words_of_licences_are_no_licence(model, text):
    assert not [f for f in next(model.scan([text.encode()])) if f[3]]


RELATIVES = [
    ("This work is licensed under the GNU Affero General Public License, version 3.", [("AGPL", "3")]),
    ("Licensed under CC BY-ND 4.0.", [("CC-BY-ND", "4.0")]),
    ("Licensed under CC BY-NC-ND 4.0.", [("CC-BY-NC-ND", "4.0")]),
    ("Licensed under CC BY-NC-SA 4.0.", [("CC-BY-NC-SA", "4.0")]),
    ("Licensed under CC BY-SA 4.0.", [("CC-BY-SA", "4.0")]),
    ("Licensed under CC BY 4.0.", [("CC-BY", "4.0")]),
    ("Not licensed under the MIT License.", []),
    ("This is no longer released under the MIT License.", []),
    ("Licensed under the MIT License or the Apache License, Version 2.0.", [("Apache-2.0", "2.0"), ("MIT", "")]),
    ("Licensed under the Apache License, Version 2.0 or the MIT License.", [("Apache-2.0", "2.0"), ("MIT", "2.0")]),
    ("Licensed under the GPL, version 2.", [("GPL", "2")]),
    ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991", [("GPL", "2")]),
    ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", [("LGPL", "2.1")]),
    ("SPDX-License-Identifier: MIT", [("MIT", "")]),
    ("// SPDX-License-Identifier: (MIT OR GPL-2.0-only)", [("GPL", "2.0"), ("MIT", "")]),
    ("# SPDX-License-Identifier: CC-BY-NC-4.0", [("CC-BY-NC", "4.0")]),
    ("This is free and unencumbered software released into the public domain.", [("Unlicense", "")]),
    (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        [("MIT", "")],
    ),
    ("Licensed under the ISC License.", [("ISC", "")]),
    ("Licensed under the Eclipse Public License, version 2.0.", [("EPL-2.0", "2.0")]),
]


@pytest.mark.parametrize(("line", "wanted"), RELATIVES)
def test_relatives_negations_and_several_families(model, line, wanted):
    [found] = model.scan([b"first\n\n" + line.encode() + b"\n\nlast"])
    sure = [(f[0], f[1]) for f in found if f[3]]
    assert sure == [(2, family) for family, _ in wanted]
    if wanted and len({v for _, v in wanted}) == 1:
        assert {f[4] for f in found if f[3]} == {wanted[0][1]}


@pytest.mark.parametrize("name", ["Sleepycat", "Zlib", "Artistic", "Boost Software", "Open Font", "Academic Free"])
@pytest.mark.parametrize("frame", ["Licensed under the {} License.", "Released under the {} License, version 2.0.", "SPDX-License-Identifier: {}"])
def test_licences_outside_the_families_are_unknown(model, name, frame):
    assert list(model.scan([frame.format(name).encode()])) == [[]]


def test_repeated_lines_are_found_each(model):
    [found] = model.scan([b"Released under the MIT License.\n" * 3])
    assert [(f[0], f[1], f[3]) for f in found] == [(i, "MIT", True) for i in range(3)]


def test_pruning_changes_nothing(spark, model):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    texts = [r.text.encode() for r in rows]
    texts += [line.encode() for line, _ in RELATIVES] + [b"mit license of the public", b"gnu bsd", b"under the"]
    assert list(model.scan(texts)) == list(model.scan(texts, prune=False))


def test_awkward_rows(spark, awkward, empty, folder_of):
    folder = folder_of(documents=plain_columns(awkward))
    assert ls.op9_license_scan(spark, folder).where("n_confirmed = 0").count() == awkward.count()
    model = ls.learn(empty)
    got = ls.scan_licenses(awkward.withColumn("text", F.lit("x\nReleased under the MIT License.")), model)
    assert {(r.licenses[0].paragraph, r.licenses[0].family) for r in got.collect()} == {(1, "MIT")}
    assert ls.scan_licenses(empty, model).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute copies of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""


@pytest.mark.parametrize("marker", ["", "# ", " * ", "// ", "dnl ", "REM "])
@pytest.mark.parametrize(("family", "text"), [("MIT", MIT), ("BSD", BSD), ("GPL", GPL)])
def test_wrapped_licences_are_confirmed(model, marker, family, text):
    lines = ["Copyright 2020 Acme", "", *text.split("\n"), "", "import os"]
    [found] = model.scan(["\r\n".join(marker + line for line in lines).encode()])
    assert [(f[0], f[1]) for f in found if f[3]] == [(2, family)]


def test_blank_lines_keep_paragraphs_apart(model):
    [found] = model.scan([MIT.replace("\n", "\n\n").encode()])
    assert not [f for f in found if f[3]]
