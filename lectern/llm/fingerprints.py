"""Op 9. Document fingerprints by locally consistent parsing.

A text is a string of byte names.  A level of the parse collapses runs of one name, tosses coins
deterministically (each name is reduced, with its left neighbour, to the position and value of the lowest bit
in which the two differ, until few values are left; neighbours stay different) and cuts in front of every local
minimum of the result.  A phrase is named by a hash of the names in it, and the phrases are the string of
the next level.  Where to cut is decided by a few neighbours, so equal substrings are parsed into equal phrases,
wherever they stand, but for their ends.

The names of all phrases from level ``FIRST_LEVEL`` on, and the name of the whole text, are the text's signature.  Its
fingerprint holds the ``KEPT`` smallest of their hashes (bottom-k sketch); the likeness of two
fingerprints estimates the share of names that two signatures have in common, and is exact for
signatures that fit in whole.

All texts of a batch are parsed together: a level is a few dozen numpy operations, and shrinks by about three.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, names_free, sliced

FIRST_LEVEL = 2
KEPT = 32
SLICE = 1 << 20
M1, M2, M3 = (np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15))
RESULTS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each number (a bijection)."""
    x = (x ^ (x >> np.uint64(33))) * M1
    x = (x ^ (x >> np.uint64(33))) * M2
    return x ^ (x >> np.uint64(33))


def _toss_table(bits: int) -> np.ndarray:
    """A toss for each pair of names of so many bits, at ``left << bits | own``: place and value of the lowest bit of
    ``own`` that differs (equal names, which don't occur: 0)."""
    left, own = np.divmod(np.arange(1 << 2 * bits), 1 << bits)
    differ = left ^ own
    lowest = differ & -differ
    place = np.bitwise_count(np.maximum(lowest, 1) - 1)
    return (place << 1 | (own & lowest != 0)).astype(np.uint8)


#: Tosses of 8-bit names (below 16), of 7-bit names (below 14), 4-bit names (below 8) and 3-bit names (below 6).
TOSS = {bits: _toss_table(bits) for bits in (8, 7, 4, 3)}


def _toss(names: np.ndarray, begins: np.ndarray, bits: int) -> np.ndarray:
    """One toss for all names.  A text's first name tosses as if its left neighbour differed in the lowest bit."""
    pair = names.astype(np.uint16)
    pair[1:] |= pair[:-1] << bits
    pair[begins] = names[begins] | (names[begins] ^ 1).astype(np.uint16) << bits
    return TOSS[bits][pair]


def _cuts(names: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where phrases begin: at the starts of the texts and in front of each local minimum of the tosses.

    ``names``: bytes, or 64-bit names; neighbours of one text differ.
    """
    if names.dtype == np.uint8:
        label = _toss(names, begins, 8)
    else:
        other = np.empty_like(names)
        other[1:] = names[:-1]
        other[begins] = names[begins] ^ np.uint64(1)
        differ = names ^ other
        lowest = differ & (np.uint64(0) - differ)
        label = np.bitwise_count(lowest - np.uint64(1)) << 1 | (names & lowest != 0)
        label = _toss(label & 127, begins, 7)
    label = _toss(_toss(label, begins, 4), begins, 3)
    start = np.zeros(len(names) + 1, bool)
    lower = label[1:] < label[:-1]
    start[1:-2] = lower[:-1] & ~lower[1:]
    start[begins] = False
    start[begins[1:] - 1] = False  # a text's last name begins no phrase of its own
    start[begins] = True
    return np.flatnonzero(start[:-1])


def signatures(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of all phrases that count, and the text that each is in (a text without bytes has one name)."""
    which = np.flatnonzero(np.diff(ends) > 0)
    empty = np.flatnonzero(np.diff(ends) == 0)
    out, of = [np.zeros(len(empty), np.uint64)], [empty]
    names, begins, level = data, ends[which], 0
    while len(names):
        # Runs of one name become one name.
        keep = np.ones(len(names), bool)
        keep[1:] = names[1:] != names[:-1]
        keep[begins] = True
        first = np.flatnonzero(keep)
        runs = np.diff(np.append(first, len(names))).astype(np.uint64)
        begins, names = np.searchsorted(first, begins), names[first]
        if names.dtype == np.uint8:
            full = names.astype(np.uint64) | runs << np.uint64(8)
        else:
            full = names = np.where(runs > 1, mixed(names + runs * M3), names)
        # A text that is one name is done: the name is its root.
        counts = np.diff(np.append(begins, len(names)))
        whole = counts == 1
        if whole.any():
            out.append(mixed(full[begins[whole]] ^ M1))
            of.append(which[whole])
            left = np.repeat(~whole, counts)
            names, full, which, counts = names[left], full[left], which[~whole], counts[~whole]
            begins = np.cumsum(counts) - counts
            if not len(names):
                break
        cut = _cuts(names, begins)
        size = np.diff(np.append(cut, len(names)))
        value, more = full[cut] * M3, np.arange(len(cut))
        for k in range(1, int(size.max())):
            more = more[size[more] > k]
            v = (value[more] ^ full[cut[more] + k]) * M1
            value[more] = v ^ (v >> np.uint64(29))
        level += 1
        names = mixed(value + size.astype(np.uint64) + np.uint64(level << 32))
        begins = np.searchsorted(cut, begins)
        if level >= FIRST_LEVEL:
            out.append(names)
            of.append(np.repeat(which, np.diff(np.append(begins, len(names)))))
    return np.concatenate(out), np.concatenate(of)


def sketches(data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """The ``KEPT`` smallest 32-bit hashes of each text's signature, in order."""
    names, text = signatures(data, ends)
    hashed = (mixed(names) >> np.uint64(32)).astype(np.int64)
    both = np.unique(text.astype(np.int64) << 32 | hashed)
    text, hashed = both >> 32, both & 0xFFFFFFFF
    begins = np.searchsorted(text, np.arange(len(ends)))
    return [hashed[a:min(b, a + KEPT)] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of names in common: of the smallest hashes of both together, those that are in both."""
    x, y = set(a.tolist()), set(b.tolist())
    smallest = sorted(x | y)[:KEPT]
    return sum(1 for h in smallest if h in x and h in y) / len(smallest)


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) characters replaced by the first as many (or all) of ``following``."""
    n = len(text) // 2
    return text[:len(text) - n] + following[:n]


# --- a document and the next ---------------------------------------------------------

def _sketches_of(texts: list[str]) -> list[np.ndarray]:
    out, part, size = [], [], 0
    for text in texts:
        part.append(text.encode())
        size += len(part[-1])
        if size > SLICE:
            out += _sketches_of_bytes(part)
            part, size = [], 0
    return out + _sketches_of_bytes(part) if part else out


def _sketches_of_bytes(texts: list[bytes]) -> list[np.ndarray]:
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return sketches(np.frombuffer(b"".join(texts), np.uint8), ends)


def _results(texts: list[str], following: list[str]) -> list[pa.Array]:
    """Result columns of each text with the text that follows it."""
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    own, new = _sketches_of(texts), _sketches_of(changed)
    # Mostly the next text is also the next of the list.
    after = [own[i + 1] if i + 1 < len(own) and following[i] is texts[i + 1] else _sketches_of([f])[0]
             for i, f in enumerate(following)]
    return [pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(c.encode()).digest() for c in changed], pa.binary()),
            pa.array([s.astype(">u4").tobytes() for s in own], pa.binary()),
            pa.array([s.astype(">u4").tobytes() for s in new], pa.binary()),
            pa.array([likeness(a, b) for a, b in zip(own, new, strict=True)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(own, after, strict=True)], pa.float64())]


MADE = ["n_chars", "__sha", "__own", "__new", "near_edited", "near_next"]
MADE_SQL = "n_chars long, __sha binary, __own binary, __new binary, near_edited double, near_next double"


def _in_order(columns: list[str]):
    """Rows of one part in order.  Its first text and its last row are passed on (``__role`` 1 and 2): the last row's
    next text is in another part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        names = [*columns, "__role", "__part", "__text", *MADE]

        def passed_on(row: pa.RecordBatch, role: int) -> pa.RecordBatch:
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([*[row.column(c) for c in columns], pa.array([role], pa.int32()),
                                               pa.array([part], pa.int32()), row.column("__text"), *empty], names)

        for batch in sliced(batches, "__text", SLICE):
            if held is None:
                yield passed_on(batch.slice(0, 1), 1)
            else:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            n = batch.num_rows - 1
            if n:
                texts = batch.column("__text").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(0, n) for c in columns], pa.array(np.zeros(n, np.int32)),
                     pa.array(np.full(n, part, np.int32)), pa.nulls(n, pa.string()), *_results(texts[:-1], texts[1:])], names)
            held = batch.slice(n, 1)
        if held is not None:
            yield passed_on(held, 2)
    return run


def _last_rows(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = _results(batch.column("__text").to_pylist(), batch.column("__following").to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *results], [*columns, *MADE])
    return run


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` (default: all but the text) with the fingerprints of each text and of its edited text.

    ``n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``: see the module and ``edited``; the next
    document is the one with the next smaller id, after the last comes the first (alone, a document follows
    itself).  Rows that share an id follow each other by a hash of their texts; null ids come last.  Null texts count
    as empty.  Input columns of the result names are replaced; an empty table gives an empty result.

    The rows are range-partitioned by id and sorted, which moves each text once; a part that has no room is
    spilled.  Only the first text and the last row of each part meet those of other parts.
    """
    work = Scratch(docs.sparkSession, "fingerprints")
    columns = columns if columns is not None else [c for c in docs.columns if c != text_col]
    columns = names_free(docs.select(*columns), *RESULTS).columns
    rows = docs.select(*columns, F.col(id_col).alias("__id"), F.coalesce(text_col, F.lit("")).alias("__text"))
    rows = rows.withColumn("__hash", F.xxhash64("__text"))
    order = [F.col("__id").desc_nulls_last(), F.col("__hash")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema.fields]
    parsed = work.write(rows.select(*columns, "__text").mapInArrow(
        _in_order(columns), ", ".join([*types, "__role int, __part int, __text string", MADE_SQL])), "parsed")

    ends = parsed.filter(F.col("__role") > 0)
    parts = sorted(r["__part"] for r in ends.filter(F.col("__role") == 1).select("__part").collect())
    follows = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "__part int, __next int")
    heads = ends.filter(F.col("__role") == 1).select(F.col("__part").alias("__next"), F.col("__text").alias("__following"))
    last = ends.filter(F.col("__role") == 2).join(F.broadcast(follows), "__part").join(heads, "__next").select(
        *columns, "__text", "__following")
    last = last.mapInArrow(_last_rows(columns), ", ".join([*types, MADE_SQL]))
    out = parsed.filter(F.col("__role") == 0).select(*columns, *MADE).unionByName(last)
    return out.select(*columns, "n_chars", F.lower(F.hex("__sha")).alias("edited_sha256"),
                      F.lower(F.hex("__own")).alias("fingerprint"), F.lower(F.hex("__new")).alias("edited_fingerprint"),
                      "near_edited", "near_next")
