from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest
from lectern.llm import ppm
from lectern.llm.common import fold
from pyspark.sql import functions as F

from .conftest import prose


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def contexts(texts, share):
    """Counts of symbols after each kept context (bytes, nearest last)."""
    counts = defaultdict(Counter)
    for t in texts:
        raw = [*(t or "").encode(), ppm.END]
        for i, symbol in enumerate(raw):
            for k in range(min(i, ppm.ORDER) + 1):
                counts[bytes(raw[i - k:i])][symbol] += 1
    total = sum(counts[b""].values())
    return {c: n for c, n in counts.items() if not c or sum(n.values()) * share >= total}


def slow_score(text, model):
    raw, total = (text or "").encode(), 0.0
    for i in range(len(raw) + 1):
        symbol = raw[i] if i < len(raw) else ppm.END
        context = raw[max(0, i - ppm.ORDER):i]
        while context and context not in model:
            context = context[1:]
        p, seen = 1.0, set()
        while True:
            left = {s: n for s, n in model.get(context, {}).items() if s not in seen}
            kinds = 0 if len(seen) + len(left) == 257 else len(left)
            if symbol in left:
                p *= left[symbol] / (sum(left.values()) + kinds)
                break
            if left:
                p *= kinds / (sum(left.values()) + kinds)
            seen |= set(left)
            if not context:
                p /= 257 - len(seen)
                break
            context = context[1:]
        total += math.log10(p)
    return total


def slow_base(text, counts):
    tokens, n, v = [*(text or "").encode().lower().split(), None], sum(counts.values()), len(counts)
    return len(tokens), sum(counts[t] > 0 for t in tokens), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)


@pytest.mark.parametrize("share,common", [(10 ** 9, 10 ** 9), (60, 20)])
def test_scores_equal_brute_force(spark, rng, monkeypatch, share, common):
    monkeypatch.setattr(ppm, "SHARE", share)
    monkeypatch.setattr(ppm, "COMMON", common)
    texts = [None, "", " \t", "The  the\vTHE\x85 é É", "é" * 300] + [prose(rng, rng.randint(1, 60)) for _ in range(40)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "the", "x"), (3, texts[3], "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = ppm.score_texts(df, fold("doc_id", 2, 7), columns=["doc_id", "text", "score"])
    training = [t for d, t, _ in rows if not held(d)]
    model = contexts(training, share)
    counts = Counter(w for t in training for w in [*(t or "").encode().lower().split(), None])
    out = got.collect()
    assert len(out) == len(rows) and got.columns == ["doc_id", "text", "held_out", "n_tokens", "n_known", "train_tokens",
                                                     "base_score", "score"]
    for r in out:
        tokens, known, n, base = slow_base(r["text"], counts)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (tokens, known, n, held(r["doc_id"]))
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(slow_score(r["text"], model), rel=1e-5)


def test_blocks_of_a_long_text_make_no_difference(spark, rng, monkeypatch):
    df = spark.createDataFrame([(i, prose(rng, 400)) for i in range(6)], "doc_id long, text string")
    model = contexts([r["text"] for r in df.collect()], ppm.SHARE)
    monkeypatch.setattr(ppm, "BLOCK", 50)
    for r in ppm.score_texts(df, F.lit(False), columns=["text"]).collect():
        assert r["score"] == pytest.approx(slow_score(r["text"], model), rel=1e-5)


def test_probabilities_of_a_state_sum_to_one(rng):
    import numpy as np
    import pyarrow as pa
    from lectern.llm.common import text_buffer
    codes = ppm.context_codes(*text_buffer(pa.array([prose(rng, 100), None, "é"])))
    rows = [(k, (c >> 9) & 0xFFFFFFFF & ((1 << 8 * k) - 1), c & 511) for c in codes.tolist() for k in range((c >> 41) + 1)]
    n = Counter(rows)
    trie = ppm.Trie(*np.array([(*r, n[r]) for r in n], np.int64).T)
    assert (10.0 ** trie.logp.astype(float)).sum(axis=1) == pytest.approx(1, abs=1e-4)


def test_nothing_to_learn_from_and_empty_table(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in ppm.score_texts(df, F.lit(True)).collect()}
    assert out[1]["score"] == pytest.approx(-3 * math.log10(257)) and out[2]["score"] == pytest.approx(-math.log10(257))
    assert (out[1]["n_tokens"], out[1]["n_known"], out[1]["train_tokens"], out[1]["base_score"]) == (2, 0, 0, 0)
    assert ppm.score_texts(df.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("at_once", [1 << 20, 300, 0])
def test_contexts_seen_once_in_a_large_table_count(spark, rng, monkeypatch, at_once):
    """More training symbols than any share of them allows a rare context; held codes and joined ones."""
    monkeypatch.setattr(ppm, "HELD", at_once, raising=False)
    texts = [prose(rng, 60) for _ in range(120)] + ["rare words: zyzzyva qoph", "\u4e2d\u6587 rare", None, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(500 + i, t) for i, t in enumerate(texts[-6:])]
    training = [t for d, t in rows if not held(d)]
    assert sum(len((t or "").encode()) + 1 for t in training) > 2 * 16_384
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model, got = contexts(training, math.inf), ppm.score_texts(df, fold("doc_id", 2, 7), columns=["doc_id", "text"])
    out = got.filter("doc_id >= 110").collect()
    assert any(r["held_out"] for r in out) and len(out) == 20
    for r in out:
        assert r["score"] == pytest.approx(slow_score(r["text"], model), rel=1e-6)


def test_long_words_are_not_collected(spark, monkeypatch):
    """Unspaced texts: their words go through the join, with the same scores."""
    broadcast, real = [], ppm._score
    monkeypatch.setattr(ppm, "_score", lambda ids, text, model, common: broadcast.append(common.value[0]) or real(
        ids, text, model, common))
    edge, over = "e" * 64, "\u4e2d" * 22  # 64 and 66 bytes
    texts = ["a " + edge, over, "x" * 5000, f"{over} {over} a", "y" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = ppm.score_texts(df, F.col("doc_id") == 4, columns=["doc_id", "text"]).collect()
    assert sorted(map(str, broadcast[0])) == ["a", edge]
    counts = Counter(w for t in texts[:4] for w in [*t.encode().split(), None])
    for r in out:
        tokens, known, _, base = slow_base(r["text"], counts)
        assert (r["n_tokens"], r["n_known"]) == (tokens, known) and r["base_score"] == pytest.approx(base, rel=1e-9)
