from __future__ import annotations

import hashlib

import numpy as np
import pytest
import xxhash
from lectern.llm import fingerprints as P

from .conftest import prose


def names_of(text):
    raw = text.encode()
    return P.signatures(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]


def test_equal_substrings_share_interior_names(rng):
    body = prose(rng, 400)
    a, b = set(names_of("abc " + body).tolist()), set(names_of("Some other words, " + body + " end").tolist())
    assert len(a & b) > 0.9 * min(len(a), len(b))
    assert len(a & set(names_of(prose(rng, 400)).tolist())) < 0.2 * len(a)  # of words made of ten syllables


def test_tosses_keep_neighbours_different(rng):
    data = np.array(rng.choices(range(256), k=5000), np.uint8)
    data = data[np.concatenate([[True], data[1:] != data[:-1]])]
    label = P._toss(data, np.array([0]), 8)
    for bits, below in ((4, 8), (3, 6)):
        assert (label[1:] != label[:-1]).all()
        label = P._toss(label, np.array([0]), bits)
        assert label.max() < below
    cuts = P._cuts(data, np.array([0]))
    assert np.diff(cuts)[1:].min() >= 2 and np.diff(cuts).max() <= 12


def test_a_text_is_parsed_alike_in_any_company(rng):
    texts = ["", "a", "aaaa", "ab", "é😀"] + [prose(rng, rng.randint(1, 300)) for _ in range(40)]
    together = P._sketches_of(texts)
    assert all(np.array_equal(s, P._sketches_of([t])[0]) for s, t in zip(together, texts))


def test_likeness_estimates_overlap(rng):
    a, b = prose(rng, 600), prose(rng, 600)
    half = a[:len(a) // 2] + b[:len(b) // 2]
    s = P._sketches_of([a, b, half, a])
    assert P.likeness(s[0], s[3]) == 1 and P.likeness(s[0], s[1]) < 0.1
    assert 0.1 < P.likeness(s[0], s[2]) < 0.6


@pytest.mark.parametrize("parts", ["1", "7"])
def test_query_equals_brute_force(spark, rng, parts):
    texts = [None, "", "a", "é😀x", "tie", "tie"] + [prose(rng, rng.choice([1, 40, 3000])) for _ in range(40)]
    ids = [3, 3, None, None, 0, 0] + rng.sample(range(100), 40)
    df = spark.createDataFrame([(d, t, 1, "q") for d, t in zip(ids, texts)], "doc_id long, text string, n_chars int, other string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = P.fingerprint(df.repartition(3), columns=["doc_id", "text", "other"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    signed = lambda t: np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42)).astype(np.int64)
    order = sorted(zip(ids, texts), key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1])))
    want = []
    for i, (d, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        changed = P.edited(t, after)
        s = P._sketches_of([t, changed, after])
        want.append((d, len(t), hashlib.sha256(changed.encode()).hexdigest(), *[x.astype(">u4").tobytes().hex() for x in s[:2]],
                     P.likeness(s[0], s[1]), P.likeness(s[0], s[2])))
    fields = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=repr) == sorted(want, key=repr)


def test_edited_text_and_empty_or_single_tables(spark):
    assert P.edited("abcde", "XYZ") == "abcXY" and P.edited("abcdef", "X") == "abcX" and P.edited("", "X") == ""
    df = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    row = P.fingerprint(df).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1.0
    assert P.fingerprint(df.limit(0)).count() == 0
