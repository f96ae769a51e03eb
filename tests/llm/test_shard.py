from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from lectern.llm import shard

from .conftest import table


def brute(names, size, weights):
    """Every shard's whole permutation, claimed slot by slot in turns."""
    digest = lambda role, n: int(hashlib.md5(f"{role}:{n}".encode()).hexdigest()[:15], 16)
    orders = []
    for n in names:
        offset, skip = digest("offset", n) % size, digest("skip", n) % (size - 1) + 1 if size > 2 else 1
        orders.append(iter([(offset + j * skip) % size for j in range(size)]))
    owner = {}
    while len(owner) < size:
        for i, w in enumerate(weights):
            for _ in range(w):
                slot = next((s for s in orders[i] if s not in owner), None)
                if slot is not None:
                    owner[slot] = i
    return [owner[s] for s in range(size)]


@pytest.mark.parametrize("n,size", [(1, 2), (3, 7), (5, 101), (16, 1021)])
def test_table_equals_brute_force_and_is_even(n, size):
    names = [f"s{i}" for i in range(n)]
    owner = shard.lookup_table(names, size)
    assert owner == brute(names, size, [1] * n)
    counts = Counter(owner)
    assert max(counts.values()) - min(counts.values()) <= 1


def test_weights_give_shares_in_proportion():
    owner = Counter(shard.lookup_table(["a", "b", "c"], 601, [1, 2, 3]))
    assert [owner[i] for i in range(3)] == pytest.approx([100, 200, 300], abs=3)
    assert shard.lookup_table(["a", "b", "c"], 601, [1, 2, 3]) == brute(["a", "b", "c"], 601, [1, 2, 3])


def test_losing_a_shard_moves_little_else():
    names = [f"s{i}" for i in range(20)]
    before, after = shard.lookup_table(names, 4999), shard.lookup_table(names[:-1], 4999)
    moved = sum(a != b for a, b in zip(before, after) if a != 19)
    assert moved < 0.1 * 4999


def test_bad_tables_are_refused():
    for names, size in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2), (["a"], 1_048_583)):
        with pytest.raises(ValueError):
            shard.lookup_table(names, size)


def test_rows_nulls_repeats_clashes_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (None, "a", "z"), (None, None, "q"), (2, "", "w")],
                               "doc_id long, k string, Slot string")
    placed = shard.assign_shards(df, ["doc_id", "k"], ["p", "q", "r"], 101)
    rows = placed.collect()
    assert placed.columns == ["doc_id", "k", "slot", "shard"] and len(rows) == 5
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1
    assert shard.assign_shards(df.limit(0), ["doc_id"], ["p"], 2).count() == 0
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_write_shards(spark, tmp_path):
    df = table(spark, [(i, "t", "en", "s") for i in range(50)])
    placed = shard.assign_shards(df, ["source"], ["p", "q"], 11)  # one hot key
    shard.write_shards(placed, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and back.select("shard").distinct().count() == 1
