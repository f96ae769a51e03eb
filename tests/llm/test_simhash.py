from __future__ import annotations

import numpy as np
import pytest
import xxhash
from lectern.llm import simhash
from lectern.llm.common import Scratch
from lectern.llm.components import components

from .conftest import as_rows, prose


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(rows, radius=3):
    """Fingerprints, and the component of each row, by comparing all pairs."""
    prints = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return prints, [find(i) for i in range(len(rows))]


def brute(rows, radius=3):
    """doc_id, fingerprint, component_id."""
    prints, root = roots(rows, radius)
    ids = {}
    for r, (d, _) in zip(root, rows):
        if d is not None:
            ids[r] = min(ids.get(r, d), d)
    return sorted([(d, f"{p:016x}", ids.get(r)) for r, (d, _), p in zip(root, rows, prints)], key=repr)


def near_copies(rng):
    rows = [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one two"), (None, "one TWO"), (None, "lonely text here")]
    for g in range(6):
        words = prose(rng, rng.choice([30, 200, 900])).split()
        for _ in range(rng.choice([1, 2, 25])):
            edit = list(words)
            for _ in range(rng.randint(0, 3)):
                edit[rng.randrange(len(edit))] = prose(rng, 1)
            rows.append((rng.randrange(800), " ".join(edit)))
    return rows + rows[:12]


def test_fingerprint_in_steps_equals_the_definition(rng):
    for n in (0, 1, 2, 3, 4, 50, 700):
        text = prose(rng, n) + "\t\v\f\r\nÀ\x85b \xa0c"
        assert simhash.fingerprint(text.encode(), step=64) == simhash.fingerprint(text.encode()) == slow_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_bit_sliced_comparison_equals_counting_bits(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2 ** 64, 40, dtype=np.uint64)
    rows = base[rng.integers(0, 40, 333)]
    for _ in range(4):
        flip = np.uint64(1) << rng.integers(0, 64, len(rows)).astype(np.uint64)
        rows = np.where(rng.random(len(rows)) < 0.5, rows ^ flip, rows)
    rows = np.unique(rows)
    alive, reach = simhash.within(rows, rows, radius)
    got = np.zeros((len(rows), len(rows)), bool)
    got[alive] = np.unpackbits(reach.view(np.uint8), axis=1, bitorder="little")[:, :len(rows)]
    want = np.bitwise_count(rows[:, None] ^ rows[None, :]) <= radius
    np.fill_diagonal(want, False)
    assert (got == want).all()


@pytest.mark.parametrize("block", [2048, 4])
def test_components_equal_all_pairs(spark, rng, monkeypatch, block):
    rows = near_copies(rng)
    df = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, fingerprint string")
    if block == 4:  # every larger bucket is dealt over pairs of parts
        real = simhash.links
        monkeypatch.setattr(simhash, "links", lambda p, radius: real(p, radius, block=4))
    got = as_rows(simhash.near_duplicates(df), "doc_id", "fingerprint", "component_id")
    assert sorted(got, key=repr) == brute(rows)


def test_one_of_each_group_stays(spark, rng):
    rows = near_copies(rng)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, component_id string")
    kept = simhash.drop_near_duplicates(df)
    # Two components can have the same smallest id (ids repeat), so components are counted by their roots.
    assert kept.columns == df.columns and kept.count() == len(set(roots(rows)[1]))
    assert {r["doc_id"] for r in kept.collect()} == {c for *_, c in brute(rows)}


def close_copies(rng, n):
    """Texts with different fingerprints, all at most 3 bits from the first."""
    words, found = prose(rng, 900).split(), {}
    first = slow_fingerprint(" ".join(words))
    found[first] = " ".join(words)
    while len(found) < n:
        edit = list(words)
        edit[rng.randrange(len(edit))] = prose(rng, 1)
        p = slow_fingerprint(" ".join(edit))
        if (p ^ first).bit_count() <= 3:
            found[p] = " ".join(edit)
    return list(found.values())


def test_rows_that_share_an_id_are_no_group(spark, rng):
    alone, near = [prose(rng, 80) for _ in range(6)], close_copies(rng, 4)
    rows = [(0, t) for t in alone] + [(0, near[0]), (5, near[1]), (0, near[2]), (7, near[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = as_rows(simhash.drop_near_duplicates(df), "doc_id", "text")
    assert {d for d, _ in kept} == {0} and {t for _, t in kept} >= set(alone)
    assert len(kept) == 7 and len({t for _, t in kept} & {near[0], near[2]}) == 1


def test_near_texts_without_ids_are_one_group(spark, rng):
    near, alone = close_copies(rng, 4), prose(rng, 80)
    df = spark.createDataFrame([(None, t) for t in [*near, alone]], "doc_id long, text string")
    kept = [t for _, t in as_rows(simhash.drop_near_duplicates(df), "doc_id", "text")]
    assert len(kept) == 2 and alone in kept and len(set(kept) & set(near)) == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0 and simhash.drop_near_duplicates(df).count() == 0


def test_connected_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1001 + i) for i in range(50)] + [(5000, 5000), (7, 3), (3, 7)]
    got = dict(as_rows(components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")), "node", "root"))
    assert {got[i] for i in range(1, 61)} == {0} and {got[1001 + i] for i in range(50)} == {1000}
    assert 5000 not in got
    assert components(spark.createDataFrame([], "u long, v long"), Scratch(spark, "t")).count() == 0
