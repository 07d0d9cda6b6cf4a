"""License scans against a search word by word and against all rules run without gate or order."""

import random
import re

import pytest

from ledgerline.llm import licenses
from ledgerline.llm.registry import QUERIES
from tests.llm.test_against_sql import SF_DIR
from tests.llm.test_documents import low

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
SAMPLES = [
    "Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Released under the MIT License.",
    "All rights reserved.",
    "ALL\nrights -- Reserved",
    "cc by cc by sa",
    "SPDX-License-Identifier: (MIT OR Apache-2.0)",
    "see https://opensource.org/licenses/BSD-3-Clause.",
    "Copyright (c) 2019-2020 Éa",
    "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "dedicated to the public domain",
    "distributed under the terms of the Mozilla Public License v2.0 or the Boost Software License",
]


def base(text):
    words = WORD.findall(low(text or ""))
    found = [(k, label) for phrase, label in PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    return len(words), len(found), min((k for k, _ in found), default=None), max((k for k, _ in found), default=None), ",".join(sorted({label for _, label in found}))


def survivors(body):
    """Every rule without its gate; every pair of detections compared."""
    forms = list(licenses.FORMS)
    found = []
    for nth, rule in enumerate(licenses.RULES):
        pattern = re.compile(rule.signature.encode("latin-1"))
        found += [(*m.span(pattern.groups), nth) for m in pattern.finditer(body)]
    before = lambda x: (forms.index(licenses.RULES[x[2]].form), x[0] - x[1], x[2], x[0])
    inside = lambda x, y: y[0] <= x[0] and x[1] <= y[1]
    return sorted(x for x in found if not any(inside(x, y) and before(y) < before(x) for y in found))


def mixture(rng):
    return rng.choice([" ", "\n", ". "]).join(rng.choice([*SAMPLES, "ordinary words", "under", "license", "mit", "Ünder"]) for _ in range(rng.randint(0, 8)))


def test_rules_are_ordered_and_many():
    assert len(licenses.RULES) > 200
    forms = [list(licenses.FORMS).index(r.form) for r in licenses.RULES]
    assert forms == sorted(forms)


def test_gate_and_order_lose_nothing():
    rng = random.Random(3)
    for _ in range(150):
        body = mixture(rng).encode().lower()
        got = licenses.unsuppressed(licenses.raw_detections(body, licenses.RULES), licenses.RULES)
        assert got == survivors(body)


@pytest.mark.parametrize(
    ("text", "label", "form"),
    [
        ("SPDX-License-Identifier: MIT", "mit", "tag"),
        ("SPDX-License-Identifier: GPL-2.0 WITH exception", "gpl-2.0", "tag"),
        ("http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0", "address"),
        ("this is released under a BSD-style license", "bsd", "notice"),
        ("the Eclipse Public License 2.0 says", "epl-2.0", "mention"),
        ("Creative Commons Attribution-ShareAlike license", "cc-by-sa", "mention"),
        ("Redistribution and use in source and binary forms, with or without\n modification, are permitted", "bsd", "text"),
    ],
)
def test_a_declaration_is_found_once(text, label, form):
    body = text.encode().lower()
    assert [(licenses.RULES[n].label, licenses.RULES[n].form) for _, _, n in licenses.unsuppressed(licenses.raw_detections(body, licenses.RULES), licenses.RULES)] == [(label, form)]


def test_all_members_of_a_tag_stay():
    body = b"spdx-license-identifier: (mit or apache-2.0)"
    assert {licenses.RULES[n].label for _, _, n in licenses.unsuppressed(licenses.raw_detections(body, licenses.RULES), licenses.RULES)} == {"mit", "apache-2.0"}


def test_rows(spark):
    rng = random.Random(4)
    texts = [mixture(rng) for _ in range(60)] + [None, "", " \n", "ÉÉ all rights reserved É", "long " * 100_000 + "All rights reserved"]
    rows = [(k if k % 7 else None, t, "r", k, f"l{k}") for k, t in enumerate(texts)] + [(5, texts[5], "r", 5, "l5")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, word long, detections string")
    got = licenses.detect(docs).collect()
    assert len(got) == len(rows)
    by_word = {r.row.word: r for r in got}
    for _, text, _, k, _ in rows:
        r = by_word[k]
        n_words, n_base, first, last, labels = base(text)
        own = [d for d in r.detections if d.form == "base"]
        assert (r.n_words, len(own), min((d.word for d in own), default=None), max((d.word for d in own), default=None)) == (n_words, n_base, first, last)
        assert ",".join(sorted({d.label for d in own})) == labels
        for d in own:
            assert " ".join(WORD.findall(low(text[d.start : d.end]))) in PHRASES
        body = (text or "").encode().lower()
        expected = sorted((body[s:e].decode(), licenses.RULES[n].label) for s, e, n in (survivors(body) if len(body) < 5_000 else []))
        if len(body) < 5_000:
            assert sorted((low(text[d.start : d.end]), d.label) for d in r.detections if d.form != "base") == expected
    assert licenses.detect(docs.limit(0)).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    df = QUERIES["op11_license_scan"](spark, SF_DIR)
    got = {r.doc_id: r for r in df.collect()}
    assert set(got) == set(texts)
    for k, text in texts.items():
        r = got[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text)
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(labels) >= set(r.base_labels.split(",") if r.base_labels else [])
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)
    assert any(r.n_base for r in got.values())
