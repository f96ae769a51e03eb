"""Op 2. SimHash near-duplicates with bit-sliced comparison.

Fingerprints: a text's shingles of words are hashed (XXH64); bit b of the 64-bit fingerprint is set where
over half of the hashes have it.

Candidates: the 64 bits are cut into ``radius + 2`` blocks.  Two fingerprints at most ``radius`` bits apart
agree in at least two whole blocks, so every pair of blocks gives one table keyed by the bits of both;
all links are found inside the buckets of these tables.  Only distinct fingerprints take part, so copies
cost nothing.  Buckets of one row are dropped before any comparison.

Comparison: rows of a bucket are compared in blocks.  A block's fingerprints are stored as 64 bit planes
(plane b holds bit b of all rows).  For each query the planes, inverted where the query has the bit, are
added up in carry-save counters of a few words per 64 rows: one pass of bitwise operations updates
64 distances at once.  Rows of which all distances exceed the radius are abandoned every few planes,
and the block ends when none is left.

A bucket of any size is compared whole and exactly: one with more than ``BLOCK`` rows is dealt by hash into
parts of about that size, and each pair of parts is one bounded unit of work on its own task.  A unit
returns the links of a spanning forest (at most one per row), which connects all it found.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, names_free, sliced, text_buffer
from .components import components

#: Rows of a part of a large bucket; a unit of comparison has two parts at most.
BLOCK = 2048
#: Small buckets are compared together, about this many rows at a time.
TOGETHER = 256
#: Planes between two looks at which rows can be abandoned.
LOOK = 8
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints ------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = 3, step: int = 65_536) -> int:
    """SimHash of a UTF-8 text: A-Z lower-cased, words split at ASCII white space, ``shingle`` words each.

    Fewer words make one shingle of all; no word gives 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    n, total = len(words) - shingle + 1, np.zeros(64, np.int64)
    columns = [words[i:i + n] for i in range(shingle)]
    joined = map(b" ".join, zip(*columns, strict=True))
    for first in range(0, n, step):
        part = itertools.islice(joined, min(step, n - first))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in part), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for k in range(0, len(bits), 255):
            total += np.add.reduce(bits[k:k + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(text_col: str, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col, 4 << 20):
            data, ends = text_buffer(batch.column(text_col))
            raw = data.tobytes()
            found = np.fromiter((fingerprint(raw[ends[i]:ends[i + 1]], shingle) for i in range(len(ends) - 1)),
                                np.uint64, len(ends) - 1)
            others = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != text_col]
            names = [f.name for f in batch.schema if f.name != text_col]
            yield pa.RecordBatch.from_arrays([*others, pa.array(found.view(np.int64))], [*names, "__fp"])
    return run


def with_fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """The other columns of ``docs`` and ``__fp`` (the fingerprint as a signed long)."""
    other = [f for f in docs.schema.fields if f.name != text_col]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in other], "__fp long"])
    return docs.mapInArrow(_fingerprints(text_col, shingle), schema)


# --- comparison of a block ---------------------------------------------------

def bit_planes(rows: np.ndarray) -> np.ndarray:
    """64 planes of uint64 words: bit r of plane b is bit b of row r (rows padded to a multiple of 64)."""
    padded = np.zeros(-(-len(rows) // 64) * 64, np.uint64)
    padded[:len(rows)] = rows
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(queries: np.ndarray, rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Which queries have a row in reach, and per such query the bit set of rows within ``radius`` bits.

    If both are the same array, a row isn't held against itself.  A distance is counted in
    ``radius.bit_length()`` counter words that start so high that the carry out of the last one says
    "beyond the radius".
    """
    planes, alive = bit_planes(rows), np.arange(len(queries))
    beyond = np.zeros((len(queries), planes.shape[1]), np.uint64)
    if len(rows) % 64:
        beyond[:, -1] = FULL << np.uint64(len(rows) % 64)
    if queries is rows:
        beyond[alive, alive // 64] |= np.uint64(1) << (alive % 64).astype(np.uint64)
    start = (1 << radius.bit_length()) - 1 - radius
    counters = [np.full_like(beyond, FULL if start >> i & 1 else 0) for i in range(radius.bit_length())]
    for plane in range(64):
        has = (queries[alive] >> np.uint64(plane)) & np.uint64(1)
        carry = planes[plane] ^ (np.uint64(0) - has)[:, None]
        for c in counters:
            carry, c[...] = c & carry, c ^ carry
        beyond |= carry
        if plane % LOOK == LOOK - 1:
            keep = (beyond != FULL).any(axis=1)
            if not keep.all():
                alive, beyond = alive[keep], beyond[keep]
                counters = [c[keep] for c in counters]
            if not len(alive):
                break
    return alive, ~beyond


def forest(rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) of a spanning forest of the rows that lie within ``radius`` bits of each other."""
    linked, reach = within(rows, rows, radius)
    place = np.full(len(rows), -1)
    place[linked] = np.arange(len(linked))
    label, a, b = np.full(len(rows), -1), [], []
    open_ = np.zeros(reach.shape[1] if len(reach) else 0, np.uint64)
    for i in linked:
        open_[i // 64] |= np.uint64(1) << np.uint64(i % 64)
    for i in linked:
        if label[i] >= 0:
            continue
        label[i], stack = i, [i]
        open_[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
        while stack:
            new = reach[place[stack.pop()]] & open_
            if new.any():
                open_ &= ~new
                found = np.flatnonzero(np.unpackbits(new.view(np.uint8), bitorder="little"))
                label[found] = i
                stack.extend(found)
                a.extend(rows[found])
                b.extend([rows[i]] * len(found))
    return np.array(a, np.uint64), np.array(b, np.uint64)


# --- candidate search --------------------------------------------------------

def bucket_masks(radius: int) -> list[int]:
    """Bit masks of all pairs of ``radius + 2`` blocks: close fingerprints agree under one of them."""
    blocks = np.array_split(np.arange(64), radius + 2)
    masks = [sum(1 << int(b) for b in block) for block in blocks]
    return [masks[i] | masks[j] for i, j in itertools.combinations(range(len(masks)), 2)]


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows (unit, __fp): whole units, small ones together."""
        kept_unit, kept_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def links(fps: np.ndarray) -> pa.RecordBatch:
            a, b = forest(np.unique(fps), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"])

        def units(unit: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.append(np.flatnonzero(np.diff(unit)) + 1, len(unit))
            first = 0
            while first < len(unit):
                last = max(int(cuts[np.searchsorted(cuts, first, "right")]),
                           int(cuts[max(0, np.searchsorted(cuts, first + TOGETHER, "right") - 1)]))
                yield links(fps[first:last])
                first = last

        for batch in batches:
            unit = np.concatenate([kept_unit, batch.column("__unit").to_numpy(zero_copy_only=False)])
            fps = np.concatenate([kept_fp, batch.column("__fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(unit):
                continue
            whole = int(np.searchsorted(unit, unit[-1], "left"))
            yield from units(unit[:whole], fps[:whole])
            kept_unit, kept_fp = unit[whole:], fps[whole:]
        if len(kept_unit):
            yield links(kept_fp)
    return run


def links(prints: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints ``__fp`` at most ``radius`` bits apart.

    The links connect exactly what lies within reach: every pair within the radius is joined by a path of links,
    and every link is such a pair or joins two that share a partner chain inside one unit.
    """
    masks = bucket_masks(radius)
    tables = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.lit(_signed(m)).alias("m"))
                                 for i, m in enumerate(masks)]))
    rows = prints.select("__fp").distinct().select("__fp", tables.alias("k"))
    rows = rows.select("__fp", F.xxhash64(F.col("k.t"), F.col("__fp").bitwiseAND(F.col("k.m"))).alias("__key"))
    sizes = rows.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    rows = rows.join(sizes.withColumnRenamed("__key", "__k"), F.col("__key") == F.col("__k")).drop("__k")
    # Parts of a large bucket, and the pairs of parts that a row's part is in.
    parts = F.ceil(F.col("__n") / F.lit(block)).cast("int")
    part = F.pmod(F.xxhash64(F.lit(7), "__fp"), F.col("__parts")).cast("int")
    rows = rows.withColumn("__parts", parts).withColumn("__part", part)
    other = F.explode(F.when(F.col("__parts") == 1, F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col("__parts") - 1)))
    rows = rows.select("__fp", "__key", "__part", other.alias("__other"))
    unit = F.xxhash64("__key", F.least("__part", "__other"), F.greatest("__part", "__other"))
    rows = rows.select("__fp", unit.alias("__unit"))
    dealt = rows.repartition("__unit").sortWithinPartitions("__unit")
    return dealt.mapInArrow(_compare(radius), "u long, v long")


def _linked(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    """As ``near_duplicates``, with ``__root``: the fingerprint that names the component."""
    work = Scratch(docs.sparkSession, "simhash")
    prints = work.write(with_fingerprints(names_free(docs, "fingerprint", "component_id"), text_col, shingle), "prints")
    per = prints.groupBy("__fp").agg(F.min(id_col).alias("__id"))
    roots = components(links(per, radius), work)
    grouped = per.join(roots, F.col("__fp") == F.col("node"), "left").select(
        "__fp", "__id", F.coalesce("root", "__fp").alias("__root"))
    grouped = work.write(grouped, "groups")
    smallest = grouped.groupBy("__root").agg(F.min("__id").alias("component_id"))
    classes = grouped.select("__fp", "__root").join(smallest, "__root")
    return prints.join(classes, "__fp").select(
        *[c for c in prints.columns if c != "__fp"],
        F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id", "__root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """``docs`` without its text, with ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id among the documents that links reach, the own one included; null
    only if all their ids are null.  Null and empty texts have fingerprint 0 and are linked like any
    other.  Input columns of the two result names are replaced; repeated rows stay repeated; an empty
    table gives an empty result.
    """
    return _linked(docs, id_col, text_col, shingle, radius).drop("__root")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         radius: int = 3) -> DataFrame:
    """``docs`` with one row left of each group of linked documents, the one with the smallest id.

    Ids that tie are told apart by a hash of the text; of rows equal in both one stays.
    """
    body = F.xxhash64(F.coalesce(text_col, F.lit("")))
    found = _linked(docs.select(F.col(id_col).alias("__row_id"), F.col(text_col).alias("__text"), body.alias("__body")),
                    "__row_id", "__text", shingle, radius)
    # Ids need not be unique or there: a group is what links connect, whatever its ids.  Null ids come last.
    first = F.min(F.struct(F.col("__row_id").isNull().alias("none"), F.col("__row_id").alias("id"),
                           F.col("__body").alias("body")))
    stays = found.groupBy("__root").agg(first.alias("k")).select(
        F.col("k.id").alias("__id"), F.col("k.body").alias("__body"))
    rows = docs.withColumns({"__body": body})
    kept = rows.join(stays, rows["__body"].eqNullSafe(stays["__body"]) & rows[id_col].eqNullSafe(stays["__id"]), "left_semi")
    return kept.dropDuplicates([id_col, "__body"]).drop("__body")
