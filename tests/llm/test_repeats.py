from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from lectern.llm import repeats

from .conftest import as_rows, prose


def brute(texts, length):
    raws, seen = [(t or "").encode() for t in texts], Counter()
    for raw in raws:
        seen.update(raw[i:i + length] for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        covered = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                covered[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(raw)) if covered[i] and not (i and covered[i - 1]))
        rest = bytes(b for b, c in zip(raw, covered) if not c)
        out.append((len(raw), sum(covered), runs, hashlib.sha256(rest).hexdigest()))
    return out


def passages(rng):
    shared, line = [prose(rng, 40) for _ in range(4)], prose(rng, 22)
    texts = [None, "", "ab" * 500, "a" * 900, "a" * 100, prose(rng, 30)]
    for _ in range(60):
        text = prose(rng, rng.randint(0, 120))
        if rng.random() < 0.5:
            text += " " + rng.choice(shared) + " " + prose(rng, rng.randint(0, 30))
        texts.append(line + " " + text if rng.random() < 0.5 else text)
    for _ in range(25):
        text = rng.choice(texts[6:])
        k = rng.randint(0, len(text))
        texts.append(text[:k] + rng.choice(["", "Q", "zz "]) + text[k + rng.randint(0, 3):])
    return texts + rng.choices(texts, k=15)


@pytest.mark.parametrize("length,together", [(160, 4096), (160, 2), (400, 4096)])
def test_equals_brute_force(spark, rng, monkeypatch, length, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)  # 2: nearly all anchors are dealt out
    texts = passages(rng)
    df = spark.createDataFrame([(i if i % 9 else None, t, 7) for i, t in enumerate(texts)],
                               "doc_id long, text string, N_Bytes int")
    got = as_rows(repeats.remove_repeats(df, length=length, keep_bytes=False), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(got) == sorted(brute(texts, length))


def test_kept_bytes_and_spans(spark, rng):
    texts = passages(rng)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in repeats.remove_repeats(df, length=200).collect():
        raw, at, rest = (r["text"] or "").encode(), 0, b""
        for s in r["spans"]:
            rest, at = rest + raw[at:s["start"]], s["end"]
        assert bytes(r["kept"]) == rest + raw[at:] and r["n_removed"] == len(raw) - len(r["kept"])


def test_anchors_do_not_depend_on_chunks_or_place(rng, monkeypatch):
    text = prose(rng, 900).encode()
    data, ends = np.frombuffer(b"some other words " + text, np.uint8), np.array([0, 17, 17 + len(text)])
    whole = np.stack(repeats.anchors(data, ends, 400))
    alone = np.stack(repeats.anchors(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 400))
    assert (whole - 17 == alone).all()
    monkeypatch.setattr(repeats, "CHUNK", 333)
    assert (np.stack(repeats.anchors(data, ends, 400)) == whole).all()
    covered = np.concatenate([np.arange(a, b + 1) for _, a, b in whole.T])
    assert covered.tolist() == list(range(17, 17 + len(text) - 399))


def test_short_and_empty_tables(spark):
    df = spark.createDataFrame([("x",), (None,), ("x",)], "text string")
    assert {(r["n_removed"], r["n_spans"]) for r in repeats.remove_repeats(df).collect()} == {(0, 0)}
    assert repeats.remove_repeats(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(df, length=100)
