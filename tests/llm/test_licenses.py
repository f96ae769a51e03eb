from __future__ import annotations

import re

import pyarrow as pa
import pytest
from lectern.llm import licenses as L
from lectern.llm import queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SNIPPETS = [
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "SPDX-License-Identifier: MIT", "MIT License", "the CC BY-NC 4.0",
    "This work is licensed under the GNU General Public License, version 3.", "https://www.gnu.org/licenses/gpl-3.0.html",
    "released under CC BY-SA 4.0", "https://creativecommons.org/licenses/by-nc-sa/4.0/", "GPLv2", "gnu lgpl", "Mozilla Public License 2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "3-Clause BSD License", "the Unlicense",
    "To the extent possible under law, the author has waived all copyright to CC0", "mit mit license license", "apache", "gnu", "cc", "by",
    "license", "General Public License", "Redistribution and use in source and binary forms, with or without modification, are permitted",
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text):
    """Every rule over the text, every pair of detections compared; base phrases word by word."""
    w = words(text)
    s = " " + "".join(x + " " for x in w)
    found = [(m.start(), m.end(), k) for k, r in enumerate(L.rules()) for m in r.pattern.finditer(s)]
    rank = lambda x: (L.rules()[x[2]].priority, x[1] - x[0], -x[2])
    kept = [x for x in found if not any(
        y != x and y[0] <= x[0] and x[1] <= y[1] and L.rules()[y[2]].priority >= L.rules()[x[2]].priority
        and (L.rules()[y[2]].priority > L.rules()[x[2]].priority or rank(y) > rank(x)) for y in found)]
    out = {(L.rules()[k].label, L.rules()[k].kind, s.count(" ", 0, a) - 1, s.count(" ", 0, b), False) for a, b, k in kept}
    for phrase, label in L.BASE:
        p = phrase.split()
        out |= {(label, "base", i, i + len(p), True) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p}
    return len(w), out


def texts(rng, n=150):
    fill = ["word", "é", "and", "x1", "--", "\n"]
    return [" ".join(rng.choice(SNIPPETS if rng.random() < 0.4 else fill) for _ in range(rng.randint(0, 25))) for _ in range(n)]


ODD = ["", None, "...", "MIT License", "mit\x00license", "émit license", "mit licenses", "CC-BY-CC-BY", "cc by " * 3000]


def test_scans_equal_all_rules_over_all_texts(spark, rng):
    rows = list(enumerate(texts(rng) + ODD))
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], "doc_id long, text string, score string, Detections string")
    got = L.find_licenses(df.repartition(4))
    assert got.columns == ["doc_id", *L.RESULTS]
    for r in got.collect():
        n, want = brute(dict(rows)[r.doc_id])
        assert (r.n_words, {tuple(d) for d in r.detections}) == (n, want), dict(rows)[r.doc_id]
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(want)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op11_licenses"](spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        n, found = brute(rows[r.doc_id])
        base = [x for x in found if x[4]]
        assert (r.n_words, r.n_base) == (n, len(base))
        assert (r.first_word, r.last_word) == ((min(x[2] for x in base), max(x[2] for x in base)) if base else (None, None))
        assert r.base_labels == ",".join(sorted({x[0] for x in base})) and r.labels == ",".join(sorted({x[0] for x in found}))


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0", {"apache-2.0", "apache"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0", "gpl"}),
    ("available under CC BY-NC", {"cc-by-nc", "cc-by"}),
    ("// SPDX-License-Identifier: BSD-3-Clause", {"bsd-3-clause"}),
    ("see https://creativecommons.org/licenses/by-sa/4.0/", {"cc-by-sa-4.0"}),
    ("under the MIT License.", {"mit"}),
    ("an apache helicopter, a gnu in the zoo and a licence to drive", set()),
])
def test_labels(text, labels):
    _, rows, _ = L.Scanner().batch(pa.array([text]))
    assert {r[1] for r in rows} == labels


def test_rules_are_many_and_hold_their_keywords():
    assert len(L.rules()) > 200
    for r in L.rules():
        assert all(f" {w} " in " " + re.sub(r"[^a-z0-9 ]", " ", r.pattern.pattern) + " " for w in r.keyword.split()), r


def test_an_empty_table(spark):
    assert L.find_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []
