from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from lectern.llm import phrases as P

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows):
    """f of all phrases of up to three words: {(lang, words): f}."""
    f = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f.update((lang or "und", tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return f


def brute(rows, least, cover, limit):
    f = counts(rows)
    n, found = Counter(), {}
    for (lang, w), c in f.items():
        if len(w) == 1:
            n[lang] += c
    for (lang, w), a in f.items():
        if len(w) > 1 and a >= least:
            cuts = [(10 ** 6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                    for k in range(1, len(w))]
            found[lang, w] = (a, *min(cuts))
    out = []
    for lang in n:
        kept = []
        for (x, w), (a, score, _, l, r) in found.items():
            inside = [b for (y, v), (b, *_) in found.items() if x == y == lang and len(v) > len(w)
                      and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))]
            if x == lang and not any(100 * b >= cover * a for b in inside):
                kept.append((-score, -a, " ".join(w).encode(), " ".join(w), a, l, r))
        out += [(lang, k + 1, p, a, l, r, n[lang], -s) for k, (s, _, _, p, a, l, r) in enumerate(sorted(kept)[:limit])]
    return sorted(out)


def sentences(rng, n=300):
    words = ["the", "New", "york", "city", "é", "ß\x01", "a", "😀", "x", " of"]
    return [(rng.choice(["en", "de", None, "und"]),
             "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ", "]) for _ in range(rng.randint(0, 40))))
            for _ in range(n)]


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("entries", [P.ENTRIES, 40])
def test_query_equals_brute_force(spark, rng, entries):
    rows = sentences(rng) + [("en", None), ("en", ""), (None, "...")] + [("en", "new york city " * 400)]
    df = spark.createDataFrame([(l, t, "x", 1) for l, t in rows], "lang string, text string, phrase string, n int").repartition(5)
    got = P.top_collocations(df, least=10, cover=50, limit=15, entries=entries)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute(rows, 10, 50, 15)


def test_products_beyond_64_bits_are_exact(spark):
    """Counts are made up: 1,000,000 a a passes 2^63 from a = 3,037,001 on."""
    a, l, r = 4_000_000_007, 4_000_000_009, 4_000_000_019
    exact = "cast({} as decimal(15,0))"
    got = spark.sql(f"SELECT (cast(1000000 as decimal(7,0)) * ({exact.format(a)} * {exact.format(a)})) "
                    f"div ({exact.format(l)} * {exact.format(r)}) AS s").first().s
    assert got == 10 ** 6 * a * a // (l * r)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("en", "")], [("en", "one word")]])
def test_empty_tables_and_texts(spark, rows):
    assert P.top_collocations(spark.createDataFrame(rows, "lang string, text string")).collect() == []


def trie_counts(width, seed, burst, monkeypatch):
    monkeypatch.setattr(P, "BURST", burst)
    rng = random.Random(seed)
    trie, want, got = P.HatTrie("en", width), Counter(), Counter()
    for _ in range(30):
        phrases = Counter(tuple(rng.choice(["a", "b", "c", "d\x00", "é"]) for _ in range(width)) for _ in range(40))
        want.update(phrases)
        ids = [[int(trie.number([w.encode()])[0]) for w in p] for p in phrases]
        first = np.array([i[0] for i in ids])
        rest = np.array([i[1] if width == 2 else (i[1] << 32 | i[2]) if width == 3 else 0 for i in ids], np.int64)
        order = np.lexsort((rest, first))
        trie.add(first[order], rest[order], np.array(list(phrases.values()))[order])
        if rng.random() < 0.3:
            got.update(spilled(trie, rng.choice([0, 5, 20])))
    got.update(spilled(trie, 0))
    return want, got, trie


def spilled(trie, least):
    first, rest, counts = trie.spill(least)
    assert trie.entries <= least or trie.width == 1
    if not len(first):
        return Counter()
    return Counter({tuple(p.decode().split(" ")): int(c) for p, c in zip(trie.phrases(first, rest)[1].to_pylist(), counts)
                    if c})


@pytest.mark.parametrize("width", [1, 2, 3])
@pytest.mark.parametrize("burst", [2, 4096])
def test_trie_counts_whatever_bursts_or_spills(width, burst, monkeypatch):
    want, _, trie = trie_counts(width, 5, burst, monkeypatch)
    total = Counter()
    rng = random.Random(5)
    trie = P.HatTrie("en", width)
    words = ["a", "b", "c", "d\x00", "é"]
    reference = Counter()
    for _ in range(40):
        p = tuple(rng.choice(words) for _ in range(width))
        reference[p] += 2
        ids = trie.number([w.encode() for w in p])
        rest = 0 if width == 1 else int(ids[1]) if width == 2 else int(ids[1]) << 32 | int(ids[2])
        trie.add(ids[:1], np.array([rest]), np.array([2]))
        if rng.random() < 0.2:
            total.update(spilled(trie, 3 if width > 1 else 0))
    total.update(spilled(trie, 0))
    assert total == reference and trie.entries == 0 and sum(want.values()) == 1200


def test_runs_merge_in_small_steps(monkeypatch):
    """Blocks of a few phrases, merged a few at a time: sums are those of all runs, in order."""
    monkeypatch.setattr(P, "BLOCK", 3)
    monkeypatch.setattr(P, "MERGED", 5)
    rng, want, rows = random.Random(3), Counter(), []
    for _ in range(12):
        trie = P.HatTrie("en", 2)
        for _ in range(30):
            p = [rng.choice("abcdefgh").encode(), rng.choice("abc").encode()]
            ids = trie.number(p)
            trie.add(ids[:1], ids[1:].copy(), np.array([1]))
            want[b" ".join(p).decode()] += 1
        rows += [r for b in P._blocks(trie, 0, 4, np.zeros(0, np.uint64)) for r in b.to_pylist()]
    rows.sort(key=lambda r: (r["part"], r["first"]))
    schema = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("first", pa.binary()), ("block", pa.binary())])
    found = [r for b in P._merge(2)(iter([pa.RecordBatch.from_pylist(rows, schema)])) for r in b.to_pylist()]
    assert {r["phrase"]: r["f"] for r in found if r["phrase"]} == {p: c for p, c in want.items() if c >= 2}
    assert sum(r["f"] for r in found if r["phrase"] is None) == sum(want.values())
    hashes = {r["phrase"]: r["h"] for r in found if r["phrase"]}
    assert hashes["a b"] == int(P.phrase_hashes("en", [b"a b"]).view(np.int64)[0]) if "a b" in hashes else True


def test_hot_prefixes_are_dealt_by_whole_phrases():
    trie = P.HatTrie("en", 3)
    trie_words = [b"the", b"of"] + [f"w{i}".encode() for i in range(500)]
    ids = trie.number(trie_words)
    trie.add(np.zeros(500, np.int64), (np.int64(1) << 32) | ids[2:], np.ones(500, np.int64))
    hot = P.phrase_hashes("en", [b"the of"])
    parts = {r["part"] for b in P._blocks(trie, 0, 16, hot) for r in b.to_pylist()}
    assert len(parts) == 16
    trie.add(np.zeros(500, np.int64), (np.int64(1) << 32) | ids[2:], np.ones(500, np.int64))
    assert len({r["part"] for b in P._blocks(trie, 0, 16, np.zeros(0, np.uint64)) for r in b.to_pylist()}) == 1


def test_merge_sums_what_it_holds_only_after_it_doubled(monkeypatch):
    """All blocks of all runs begin alike, so nothing is final before the last: rows looked at grow with rows, not their square."""
    monkeypatch.setattr(P, "MERGED", 50)
    looked, less = [], P.pc.less
    monkeypatch.setattr(P.pc, "less", lambda a, b: looked.append(len(a)) or less(a, b))
    rows = []
    for k in range(100):
        trie = P.HatTrie("en", 2)
        for w in ["a", *[f"w{k}x{i}" for i in range(40)]]:
            ids = trie.number([w.encode(), b"z"])
            trie.add(ids[:1], ids[1:].copy(), np.array([1]))
        rows += [r for b in P._blocks(trie, 0, 1, np.zeros(0, np.uint64)) for r in b.to_pylist()]
    schema = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("first", pa.binary()), ("block", pa.binary())])
    found = [r for b in P._merge(2)(iter([pa.RecordBatch.from_pylist(rows, schema)])) for r in b.to_pylist()]
    assert [(r["phrase"], r["f"]) for r in found] == [("a z", 100), (None, 4100)]
    assert sum(looked) < 3 * 4100


def test_phrases_are_ordered_by_their_bytes():
    """Also where a word holds bytes below the blank, or is the start of another."""
    trie = P.HatTrie("en", 3)
    words = [b"a", b"a\x00", b"a\x01b", b"ab", "é".encode(), b"b" * 70, b"b" * 71]
    ids = trie.number(words)
    first, second, third = (x.ravel() for x in np.meshgrid(ids, ids, ids, indexing="ij"))
    trie.add(first, second << 32 | third, np.ones(len(first), np.int64))
    first, rest, _ = trie.spill(0)
    found = trie.phrases(first, rest)[1].take(pa.array(trie.order(trie.ids(first, rest)))).to_pylist()
    assert found == sorted(found) and len(found) == len(words) ** 3
