from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from lectern.llm import packing

from .conftest import prose

TRICKY = ["Hello, World!  it's 42 <|endoftext|> x", "ÉCOLE école ÇA's\t foo bar.. ab., ab. ß. İSTANBUL ΣΑΣ éa ́x 日本語。", "",
          None, "the. the, the", "\x1c\x85a\xa0b　c", "A" * 3000 + " b " * 3000, "<|x <|ENDOFTEXT|> <|startoftext|>", "😀 'll"]


def test_ids_equal_the_tokenizer(rng):
    of = packing.tokens(packing.VOCABULARY)
    texts = TRICKY + [prose(rng, n) for n in (1, 30, 500)]
    for _ in range(2):  # the second time from what is remembered
        ids, counts = of.batch(pa.array(texts))
        ends = np.cumsum(counts)
        for text, end, n in zip(texts, ends, counts):
            assert ids[end - n:end].tolist() == of.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_forgetting_words_changes_nothing(rng, monkeypatch):
    of = packing.WordTokens(__import__("public_tokenizers").path(packing.VOCABULARY))
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    for _ in range(4):
        texts = [prose(rng, 40)]
        assert of.batch(pa.array(texts))[0].tolist() == of.tokenizer.encode(texts[0], add_special_tokens=False).ids


def best_fill(room, counts):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
    return max(sums)


def test_subset_sum_is_the_fullest(rng):
    for _ in range(200):
        counts = {k: rng.randint(1, 4) for k in sorted(rng.sample(range(1, 60), rng.randint(0, 8)), reverse=True)}
        room = rng.randint(0, 120)
        used = packing.fullest(room, counts)
        assert sum(k * n for k, n in used.items()) == best_fill(room, counts)
        assert all(n <= counts[k] for k, n in used.items())


def test_plan_places_every_piece_once(rng):
    counts = {rng.randint(1, 100): rng.randint(1, 500) for _ in range(60)}
    plan = packing.plan(counts, 100)
    total = defaultdict(int)
    for used, bins in plan:
        assert sum(k * n for k, n in used.items()) <= 100
        for k, n in used.items():
            total[k] += n * bins
    assert total == counts
    # Bins that no packing can do without: all room, or one for each piece of over half a bin.
    least = max(sum(k * n for k, n in counts.items()) / 100, sum(n for k, n in counts.items() if k > 50))
    assert sum(b for _, b in plan) <= 1.04 * least + 2
    assert packing.plan({}) == []


@pytest.fixture(scope="module")
def packed(spark):
    import random
    rng = random.Random(4)
    texts = TRICKY + [prose(rng, rng.choice([0, 1, 10, 200, 900])) for _ in range(80)] + ["twice", "twice"]
    rows = [(i if i % 17 else None, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `offset` string").repartition(5)
    return rows, packing.pack(df, capacity=2048).collect()


def test_pieces_hold_the_whole_text(packed):
    rows, out = packed
    of = packing.tokens(packing.VOCABULARY).tokenizer
    want = []
    for d, t, _ in rows:
        ids = [*of.encode(t or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start:start + 2048], "<u4")
            want.append((d, k, start, len(part), zlib.crc32(part.tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_sequences_are_gapless_and_few(packed):
    _, out = packed
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(r["length"] for r in out) // 2048) + 1


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
