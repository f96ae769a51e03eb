"""Op 1. Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size: it starts at
``offset`` and walks by ``skip`` (both from a digest of its name), which visits each slot once.  The
shards take turns; in its turn a shard claims the first free slot of its order.  A row goes to the
shard that owns slot ``hash(key) mod size``.  Tables that differ by one shard agree on nearly all
slots, so adding or losing a shard moves little more than that shard's share.

The table has ``size`` entries whatever the data (``MAX_SLOTS`` is the bound), so it is broadcast and
a placement costs one hash and one lookup.  No row is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import names_free

#: The largest table that is broadcast (the largest prime below 2 ** 20).
MAX_SLOTS = 1_048_573


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _digest(role: str, name: str) -> int:
    return int(hashlib.md5(f"{role}:{name}".encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], size: int, weights: Sequence[int] | None = None) -> list[int]:
    """The shard number of each slot.  ``weights``: claims of a shard in one round (default 1)."""
    shards, weights = list(shards), list(weights or [1] * len(shards))
    if not shards or len(set(shards)) != len(shards) or len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("shards must be distinct names, each with a weight of at least 1")
    if not is_prime(size) or not len(shards) <= size <= MAX_SLOTS:
        raise ValueError(f"size must be a prime from the number of shards to {MAX_SLOTS}")
    offsets = [_digest("offset", s) % size for s in shards]
    skips = [_digest("skip", s) % (size - 1) + 1 if size > 2 else 1 for s in shards]
    tried, owner, free = [0] * len(shards), [-1] * size, size
    while free:
        for i, claims in enumerate(weights):
            for _ in range(min(claims, free)):
                slot = (offsets[i] + tried[i] * skips[i]) % size
                while owner[slot] >= 0:
                    tried[i] += 1
                    slot = (offsets[i] + tried[i] * skips[i]) % size
                owner[slot] = i
                tried[i] += 1
                free -= 1
    return owner


def slot_of(keys: Sequence[str], size: int) -> Column:
    """Slot of a row: 60 bits of the MD5 of its keys as text, joined by a unit separator (null: a NUL)."""
    joined = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long") % size


def assign_shards(df: DataFrame, keys: Sequence[str], shards: Sequence[str], size: int = 65_537,
                  weights: Sequence[int] | None = None) -> DataFrame:
    """``df`` with ``slot`` and ``shard``; columns of these names are replaced.

    Rows with equal keys share a shard; a null key is a key like any other, so no row is left out.
    An empty table gives an empty result.
    """
    owner = lookup_table(shards, size, weights)
    table = df.sparkSession.createDataFrame([(slot, shards[i]) for slot, i in enumerate(owner)],
                                            "slot long, shard string")
    placed = names_free(df, "slot", "shard").withColumn("slot", slot_of(keys, size))
    return placed.join(F.broadcast(table), "slot").select(*placed.columns, "shard")


def write_shards(df: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """Write an assigned table as one folder per shard.

    A shard that holds most rows (a hot key lands whole in one) is dealt over ``files_per_shard``
    tasks by a salt of the row, not gathered in one.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c != "shard"]), F.lit(files_per_shard))
    df.repartition(F.col("shard"), salt).write.mode("overwrite").partitionBy("shard").parquet(path)
