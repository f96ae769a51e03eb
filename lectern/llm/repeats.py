"""Op 6. Removing repeated passages by depth-limited radix sort of suffixes.

A window is the ``length`` bytes from some position; it is repeated if equal bytes start anywhere else.  Windows are
suffixes compared to a limited depth, and are told apart by passes over their digits, most significant
first; what is alone after a pass is dropped, and what is still equal after the last is repeated.

Sampling: not every suffix takes part in the passes that move data.  Each window has an anchor, its smallest run of ``DIGIT``
bytes by a hash; equal windows have equal anchors at equal distances, so one suffix in about
``(length - DIGIT) / 2`` stands for all windows around it.  A unit is an anchor with the bytes of all
its windows.

Passes over units: (1) the digit at the anchor, counted over all texts; units whose digit is alone are dropped.  (2) The
whole unit: copies meet here, all their windows are repeated, and one copy goes on for them.  (3) Units with
an equal anchor but different bytes: their windows are sorted by digits of 256, 128 and 16 bytes (a power of
two each, ``length`` in sum) inside one task, which holds the bytes of one anchor's units.  An anchor with more
than ``TOGETHER`` different units (a short passage that very many texts share) is not gathered: its windows are
dealt out as rows and counted, with partial counts before the shuffle, which gives the same windows.

Digits are compared by 64-bit codes; a window is told apart by the codes of its anchor and of all its digits.
Texts are told apart by 120 bits of SHA-256, and equal texts are read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, names_free, sliced, text_buffer

#: Bytes of the first digit; a power of two.
DIGIT = 128
#: Windows looked at side by side.
CHUNK = 1 << 20
#: Different units of one anchor that a task may gather.
TOGETHER = 4096
#: Bytes of units sorted together.
SORT_BYTES = 4 << 20
#: Bits of the filter that thins the texts before they move (4 MB in all), a multiple of 32768.
FILTER_BITS = 1 << 25
RESULTS = ("n_bytes", "n_removed", "n_spans", "spans", "kept", "kept_sha256")
MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)
BYTE_CODES = np.random.default_rng(20).integers(0, 2 ** 64, 256, dtype=np.uint64)


def _codes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit code of the ``width`` bytes (a power of two) from each position, by doubling."""
    h, reach, power = BYTE_CODES[data], 1, int(BASE)
    while reach < width:
        h = h[:-reach] * np.uint64(power) + h[reach:]
        power, reach = power * power % 2 ** 64, 2 * reach
    h ^= h >> np.uint64(29)
    return h * MIX


def _window_minima(v: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        v = np.minimum(v[:-reach], v[reach:])
        reach *= 2
    return np.minimum(v[:len(v) - (width - reach)], v[width - reach:]) if width > reach else v


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sampled suffixes: ``(place, first, last)`` of each.

    Every window of ``length`` bytes inside one text has the position of its smallest digit as anchor (the leftmost of
    equals); ``first`` to ``last`` are the starts of the windows whose anchor ``place`` is.  Equal windows
    have their anchors at the same distance.
    """
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3
    width, bits = length - DIGIT + 1, np.uint64(21)
    mask, found = (np.uint64(1) << bits) - np.uint64(1), []
    change = np.zeros(len(data) + 1, np.int8)
    long_enough = np.diff(ends) >= length
    np.add.at(change, ends[:-1][long_enough], 1)
    np.add.at(change, ends[1:][long_enough] - length + 1, -1)
    valid = np.cumsum(change, dtype=np.int8).astype(bool)
    for begin in range(0, len(data) - length + 1, CHUNK):
        starts = np.flatnonzero(valid[begin:begin + CHUNK])
        if not len(starts):
            continue
        part = data[begin:begin + CHUNK + length - 1]
        ranks = _codes(part, DIGIT) & ~mask | np.arange(len(part) - DIGIT + 1, dtype=np.uint64)
        place = (_window_minima(ranks, width)[starts] & mask).astype(np.int64)
        cuts = np.flatnonzero(np.diff(place)) + 1
        first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(place)]]) - 1
        runs = np.stack([place[first], starts[first], starts[last]]) + begin
        if found and found[-1][0, -1] == runs[0, 0]:
            found[-1][2, -1] = runs[2, 0]
            runs = runs[:, 1:]
        found.append(runs)
    whole = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    return whole[0], whole[1], whole[2]


def _units(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "__text", 8 << 20):
            data, ends = text_buffer(batch.column("__text"))
            place, first, last = anchors(data, ends, length)
            raw, text = memoryview(data), np.searchsorted(ends, first, "right") - 1
            gram = np.fromiter((xxhash.xxh3_64_intdigest(raw[p:p + DIGIT]) for p in place.tolist()), np.uint64, len(place))
            unit = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b + length], d) for a, b, d in
                                zip(first.tolist(), last.tolist(), (place - first).tolist())), np.uint64, len(place))
            keys = [pa.array(batch.column(k).to_numpy()[text]) for k in ("__k1", "__k2")]
            where = [pa.array(x.astype(np.int64)) for x in (first - ends[text], last - ends[text], place - ends[text])]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(gram.view(np.int64)), pa.array(unit.view(np.int64)), *where],
                                             ["__k1", "__k2", "gram", "unit", "first", "last", "place"])
    return run


UNITS = "__k1 long, __k2 long, gram long, unit long, first long, last long, place long"


def digits_of(length: int) -> list[int]:
    """Widths of the digits of a window: powers of two, the widest first."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


def equal_windows(data: np.ndarray, begin: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which windows (starts ``begin`` in ``data``, inside one ``group``) have an equal: passes over the digits."""
    left, depth = np.arange(len(begin)), 0
    for width in digits_of(length):
        code = _codes(data, width)[begin[left] + depth] if len(left) else np.zeros(0, np.uint64)
        order = np.lexsort((code, group))
        new = np.ones(len(left), bool)
        new[1:] = (np.diff(group[order]) != 0) | (code[order][1:] != code[order][:-1])
        number = np.cumsum(new) - 1
        many = (np.bincount(number) > 1)[number] if len(left) else np.zeros(0, bool)
        left, group = left[order][many], number[many]
        depth += width
    return left


def _sort_units(length: int):
    """Units of whole anchors (sorted by ``gram``): the runs of repeated windows of those that are alone in pass 2."""
    def runs(rows: list[dict]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8)
        sizes = np.array([len(r["bytes"]) for r in rows], np.int64)
        windows, starts = sizes - length + 1, np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(rows)), windows)
        at = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        _, gram = np.unique(np.array([r["gram"] for r in rows], np.int64), return_inverse=True)
        distance = np.array([r["place"] - r["first"] for r in rows], np.int64)[of] - at
        alone = np.array([r["m"] == 1 for r in rows])
        equal = np.sort(equal_windows(data, starts[of] + at, gram[of] * length + distance, length))
        equal = equal[alone[of[equal]]]
        cuts = np.flatnonzero((np.diff(equal) != 1) | (np.diff(of[equal]) != 0)) + 1
        begin, end = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(equal)]]) - 1
        if not len(equal):
            begin = end = np.zeros(0, np.int64)
        row = of[equal[begin]]
        first = np.array([r["first"] for r in rows], np.int64)
        keys = [pa.array([rows[i][k] for i in row], pa.int64()) for k in ("__k1", "__k2")]
        return pa.RecordBatch.from_arrays([*keys, pa.array(first[row] + at[equal[begin]]),
                                           pa.array(first[row] + at[equal[end]] + length)],
                                          ["__k1", "__k2", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if size > SORT_BYTES and row["gram"] != held[-1]["gram"]:
                    yield runs(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
        if held:
            yield runs(held)
    return run


def _deal_windows(length: int):
    """Each window of the units as a row of its own, with a 128-bit code."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw, n = memoryview(row["bytes"]), len(row["bytes"]) - length + 1
                codes = [xxhash.xxh3_128_intdigest(raw[i:i + length]) for i in range(n)]
                cut = [pa.array([c >> shift & (2 ** 63 - 1) for c in codes], pa.int64()) for shift in (0, 64)]
                same = [pa.array(np.full(n, row[k], np.int64)) for k in ("__k1", "__k2", "m")]
                yield pa.RecordBatch.from_arrays([*same, pa.array(row["first"] + np.arange(n)), *cut],
                                                 ["__k1", "__k2", "m", "start", "c1", "c2"])
    return run


def _extract(length: int):
    """Bytes of the wanted units of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_buffer(batch.column("__text"))
            raw = data.tobytes()
            rows = [(k1, k2, e, w) for k1, k2, e, units in zip(*(batch.column(c).to_pylist() for c in ("__k1", "__k2")),
                                                               ends[:-1].tolist(), batch.column("units").to_pylist())
                    for w in units]
            for i in range(0, len(rows), 4000):
                part = rows[i:i + 4000]
                fields = [pa.array([w[f] for *_, w in part], pa.int64()) for f in ("gram", "first", "place", "m", "kinds")]
                cut = pa.array([raw[e + w["first"]:e + w["last"] + length] for _, _, e, w in part], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()), *fields, cut],
                    ["__k1", "__k2", "gram", "first", "place", "m", "kinds", "bytes"])
    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the spans cover."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def _cut_out(keep_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "__text", 8 << 20):
            data, ends = text_buffer(batch.column("__text"))
            raw, spans, kept = data.tobytes(), [], []
            for i, found in enumerate(batch.column("found").to_pylist()):
                runs = merged([(s["start"], s["end"]) for s in found])
                edges = [0, *[x for run_ in runs for x in run_], int(ends[i + 1] - ends[i])]
                rest = b"".join(raw[ends[i] + a:ends[i] + b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(rest if keep_bytes else hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__k1"), batch.column("__k2"), pa.array(spans, SPANS), pa.array(kept)],
                ["__r1", "__r2", "spans", "__kept"])
    return run


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def thinned(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` (``__k1``) without most of those whose key isn't in ``wanted``; none that is in it is lost.

    A bit set of ``FILTER_BITS`` is made by grouped aggregation and broadcast; its size doesn't depend on the data.
    Where it is too full to say no, more rows pass, and the join that follows drops them.
    """
    bit = lambda: F.pmod("__k1", F.lit(FILTER_BITS))
    bits = wanted.select(bit().alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("__bits"))
    rows = rows.withColumn("__bit", bit()).withColumn("__of", F.bitmap_bucket_number("__bit"))
    rows = rows.join(F.broadcast(bits), F.col("__of") == F.col("__bucket"))
    at = F.bitmap_bit_position("__bit")
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return rows.filter(F.getbit(byte, (at % 8).cast("int")) == 1).drop("__bit", "__of", "__bucket", "__bits")


def keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``__k1, __k2``: 120 bits of SHA-256 of the text (null: empty)."""
    sha = F.sha2(F.encode(F.coalesce(text_col, F.lit("")), "UTF-8"), 256)
    part = lambda i: F.conv(F.substring(sha, i, 15), 16, 10).cast("long")
    return docs.withColumns({"__k1": part(1), "__k2": part(16)})


def repeated_spans(docs: DataFrame, work: Scratch, text_col: str = "text", length: int = 400) -> tuple[DataFrame, DataFrame]:
    """Spans of repeated windows (``__k1, __k2, start, end``, overlapping), and the texts they may be in."""
    texts = keyed(docs, text_col).select("__k1", "__k2", F.coalesce(text_col, F.lit("")).alias("__text"))
    units = texts.filter(F.octet_length("__text") >= length).mapInArrow(_units(length), UNITS)
    # Written first, so that the join's sides are both plain shuffles, which AQE can split at a common anchor.
    again = work.write(units.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("gram"), "again")
    tied = work.write(units.join(again, "gram"), "tied")

    member = F.struct("__k1", "__k2", "first", "last", "place")
    classes = work.write(tied.groupBy("gram", "unit").agg(F.count(F.lit(1)).alias("m"), F.min(member).alias("one")),
                         "classes")
    copied = tied.join(classes.filter(F.col("m") > 1).select("gram", "unit"), ["gram", "unit"]).select(
        "__k1", "__k2", F.col("first").alias("start"), (F.col("last") + length).alias("end")).distinct()

    kinds = work.write(classes.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).filter(F.col("kinds") > 1), "kinds")
    wanted = classes.join(kinds, "gram").select("one.*", "gram", "m", "kinds")
    wanted = wanted.groupBy("__k1", "__k2").agg(
        F.collect_list(F.struct("gram", "first", "last", "place", "m", "kinds")).alias("units"))
    found_in = tied.select("__k1", "__k2").distinct()
    bodies = work.write(thinned(texts, found_in).dropDuplicates(["__k1", "__k2"]), "bodies")
    cut = work.write(bodies.join(wanted, ["__k1", "__k2"]).mapInArrow(
        _extract(length), "__k1 long, __k2 long, gram long, first long, place long, m long, kinds long, bytes binary"), "units")
    span = "__k1 long, __k2 long, start long, end long"
    few = cut.filter(F.col("kinds") <= TOGETHER).repartition("gram").sortWithinPartitions("gram")
    sorted_ = few.mapInArrow(_sort_units(length), span)
    rows = cut.filter(F.col("kinds") > TOGETHER).mapInArrow(
        _deal_windows(length), "__k1 long, __k2 long, m long, start long, c1 long, c2 long")
    equal = rows.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    dealt = rows.filter(F.col("m") == 1).join(equal, ["c1", "c2"]).select(
        "__k1", "__k2", "start", (F.col("start") + length).alias("end"))
    spans = work.write(copied.unionByName(sorted_).unionByName(dealt), "spans")
    work.drop("again", "tied", "classes", "kinds", "units")
    return spans, bodies


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = 400, keep_bytes: bool = True) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans, spans`` and what is left of each text.

    Texts are read as UTF-8 bytes (null: empty); matches never cross texts; every byte is removed that a ``length``-byte
    string covers which also starts anywhere else, in the same text too.  ``spans``: the maximal removed runs (byte
    offsets, end exclusive).  The rest is ``kept`` (binary), or only ``kept_sha256`` if not ``keep_bytes``.  Input columns of
    the result names are replaced; repeated rows have everything removed that is long enough; an empty
    table gives an empty result.
    """
    if length <= DIGIT:
        raise ValueError(f"length must be over {DIGIT}")
    work = Scratch(docs.sparkSession, "repeats")
    docs = names_free(docs, *RESULTS)
    spans, bodies = repeated_spans(docs, work, text_col, length)
    found = spans.groupBy("__k1", "__k2").agg(F.collect_set(F.struct("start", "end")).alias("found"))
    type_ = "binary" if keep_bytes else "string"
    cut = bodies.join(found, ["__k1", "__k2"]).mapInArrow(
        _cut_out(keep_bytes), f"__r1 long, __r2 long, spans array<struct<start:bigint,end:bigint>>, __kept {type_}")
    cut = work.write(cut, "cut")
    work.drop("bodies", "spans")
    text = F.encode(F.coalesce(text_col, F.lit("")), "UTF-8")
    name, whole = ("kept", text) if keep_bytes else ("kept_sha256", F.sha2(text, 256))
    rows = keyed(docs, text_col).withColumns({"n_bytes": F.octet_length(text).cast("long"), "__whole": whole})
    if not keep_bytes:
        rows = rows.drop(text_col)
    rows = rows.join(cut, (F.col("__k1") == F.col("__r1")) & (F.col("__k2") == F.col("__r2")), "left")
    runs = F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>"))
    removed = F.aggregate(runs, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.withColumns({"spans": runs, "n_removed": removed, "n_spans": F.size(runs).cast("long"),
                             name: F.coalesce("__kept", "__whole")}).drop(
        "__k1", "__k2", "__r1", "__r2", "__kept", "__whole")
