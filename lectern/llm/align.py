"""Op 12. Two tokenizers aligned byte by byte, and counts of the pairs of ids that they put on the same bytes.

Tokens.  A text is cut into units before a blank that follows a printable ASCII character (but for its last).  Neither
vocabulary has a token across such a place (checked for B when it is loaded; A's pre-tokens end there), so tokens, groups
and links of a text are those of its units in order.  A unit is encoded and aligned once and remembered.  Texts
in which a tokenizer changes bytes have no tokens.  Short units are encoded by A's merges as ranks, many at once; that this
gives what the merges give is checked for the whole vocabulary when it is loaded, else the merges are used.

Counting by external spills.  A run is what a few MB of text hold: records (pair of ids, document, links), radix-partitioned
by B id and ordered by B id, A id and document, compressed with zstd.  The pairs of each partition's runs are
counted by k-way heap merges of at most ``FAN_IN`` runs, in as many rounds as it takes.  The last merge goes through the
pairs by B id, so the highest count of an id is known when its pairs end.  Counts then stream back: each run is
walked through in the same order beside the counts of its partition, which gives every document's contributions.

A pair that is in every text is one record per document in a run and one per run in a merge; no partition's
runs are ever together in one task.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import math
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, names_free, sliced, text_buffer

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Text bytes of a run, radix partitions, and runs of a partition that are merged at once.
RUN, RADIX, FAN_IN = 4 << 20, 16, 64
#: Units that a Python worker remembers, and the bytes of units from which one is not remembered.
REMEMBERED, LONG = 200_000, 64
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


# --- vocabularies ------------------------------------------------------------------

def place(vocabulary: str) -> str:
    """A vocabulary file: a path, or the name of one of the public tokenizers."""
    if os.path.isabs(vocabulary):
        return vocabulary
    import public_tokenizers
    return public_tokenizers.path(vocabulary)


def byte_of_char() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Ids by a vocabulary, and the bytes of each id."""

    def __init__(self, token_bytes: dict[int, bytes]):
        table = [token_bytes.get(i, b"") for i in range(max(token_bytes) + 1)]
        self.bytes = pa.array(table, pa.large_binary())
        self.length = np.array([len(b) for b in table], np.int64)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all tokens, one after the other."""
        found = self.bytes.take(pa.array(ids))
        return np.frombuffer(found.buffers()[2], np.uint8)[:int(self.length[ids].sum())] if len(ids) else np.zeros(0, np.uint8)


class ByteLevel(Encoder):
    """A: byte-level BPE; the text with a blank before it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        to_byte = byte_of_char()
        added = self.tokenizer.get_added_tokens_decoder()
        vocabulary = {token: i for token, i in self.tokenizer.get_vocab().items() if i not in added}
        spelled = {i: bytes(to_byte[c] for c in token) for token, i in vocabulary.items()}
        super().__init__(spelled | {i: token.content.encode() for i, token in added.items()})
        self.ranked = self._ranked(vocabulary, spelled)

    def _ranked(self, vocabulary: dict[str, int], spelled: dict[int, bytes]):
        """The merges as ranks of tokens, or None where that could differ.

        By ranks, two neighbours merge if together they are a token, whatever pair it was made of.  That changes nothing if
        ids follow the order of merges and each token's own bytes merge into it: within a token's bytes, merges go
        as in the token alone, and those end in its own pair.
        """
        import json

        import public_tokenizers
        import tiktoken
        model = json.loads(self.tokenizer.to_str())
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        in_order = [vocabulary.get("".join(p), -1) for p in pairs]
        singles = sorted(set(vocabulary.values()) - set(in_order))
        usual = model["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                                           "use_regex": True} and model["normalizer"] is None
        whole = all([t.id for t in self.tokenizer.model.tokenize(token)] == [i] for token, i in vocabulary.items())
        if not (usual and whole and in_order == sorted(set(in_order)) and len(singles) == 256 and singles[-1] < in_order[0]):
            return None
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={b: i for i, b in spelled.items()})

    def encode(self, units: list[str], size: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray]:
        if not plain or self.ranked is None:
            return _flat([e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)])
        ids = np.array(self.ranked.encode_ordinary("".join(units)), np.int64)
        ends = np.searchsorted(np.cumsum(self.length[ids]), np.cumsum(size)) + 1
        return ids, np.diff(ends, prepend=0)


class Pieces(Encoder):
    """B: BPE of pieces, blanks as U+2581; adds the blank before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        super().__init__({i: bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                          for i, p in enumerate(pieces)})
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path}: a piece goes on behind a blank, so texts can't be cut at blanks")

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self.model.encode([u[1:] for u in units], num_threads=1))


# --- alignment ---------------------------------------------------------------------

def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts (of any size, also none)."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


class Aligned:
    """Units aligned: per unit the counts, the spelled groups and the linked pairs."""

    def __init__(self, a: Encoder, b: Encoder):
        self.a, self.b = a, b
        marks = [",", "|", ";"]
        self.spelled = pa.array([f"{i}{m}" for i in range(max(len(a.length), len(b.length))) for m in marks], pa.large_string())

    def units(self, units: list[str], plain: bool) -> list[tuple | None]:
        """Per unit ``(n_a, n_b, n_groups, groups, links)``; None where joined tokens aren't the unit.

        ``plain``: all are short, and each can be followed by any other as in a text.
        """
        raw = [u.encode() for u in units]
        whole, size = np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw))
        (a, n_a), (b, n_b) = self.a.encode(units, size, plain), self.b.encode(units)
        good = self._equal(self.a, a, n_a, whole, size) & self._equal(self.b, b, n_b, whole, size)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b = n_a[good], n_b[good]
        end_a, end_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        last_a = np.append(group_a[1:] != group_a[:-1], True)[:len(a)]
        last_b = np.append(group_b[1:] != group_b[:-1], True)[:len(b)]
        # Spelled tokens in order: a group's A tokens, then its B tokens.
        before_b = np.searchsorted(group_b, np.arange(len(both)))
        upto_a = np.searchsorted(group_a, np.arange(len(both)), "right")
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + before_b[group_a]] = 3 * a + last_a
        order[np.arange(len(b)) + upto_a[group_b]] = 3 * b + 2 * last_b
        texts = self.spelled.take(pa.array(order))
        at = np.frombuffer(texts.buffers()[1], np.int64)[:len(order) + 1]
        spelled = bytes(texts.buffers()[2] or b"")
        every = np.union1d(end_a, end_b)
        links = np.searchsorted(end_b, every), np.searchsorted(end_a, every)
        codes = b[links[0]] << 32 | a[links[1]]
        ends = np.cumsum(size[good])
        token_cut = at[np.cumsum(n_a + n_b)].tolist()
        group_cut = np.searchsorted(both, ends, "right").tolist()
        link_cut = np.searchsorted(every, ends, "right").tolist()
        found, k = [], 0
        for ok in good.tolist():
            if not ok:
                found.append(None)
                continue
            t, g, x = (token_cut[k - 1], group_cut[k - 1], link_cut[k - 1]) if k else (0, 0, 0)
            found.append((int(n_a[k]), int(n_b[k]), group_cut[k] - g, spelled[t:token_cut[k]], codes[x:link_cut[k]].tobytes()))
            k += 1
        return found

    @staticmethod
    def _equal(encoder: Encoder, ids: np.ndarray, n: np.ndarray, whole: np.ndarray, size: np.ndarray) -> np.ndarray:
        length = _sums(encoder.length[ids], n)
        joined, good = encoder.joined(ids), length == size
        if good.all():
            differ = np.concatenate([[0], np.cumsum(joined != whole)])
            ends = np.cumsum(size)
            return differ[ends] == differ[ends - size]
        at_joined, at_whole = np.cumsum(length) - length, np.cumsum(size) - size
        for i in np.flatnonzero(good).tolist():
            good[i] = np.array_equal(joined[at_joined[i]:at_joined[i] + size[i]], whole[at_whole[i]:at_whole[i] + size[i]])
        return good


class Texts:
    """Alignment of whole batches by way of their distinct units."""

    def __init__(self, vocabulary_a: str, vocabulary_b: str):
        self.aligned = Aligned(ByteLevel(place(vocabulary_a)), Pieces(place(vocabulary_b)))
        self.known: dict[str, tuple | None] = {}

    def look_up(self, units: list[str]) -> list[tuple | None]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        fresh, new = {}, ([], [])
        for u in units:
            if u not in self.known:
                new[len(u) < LONG and "!" <= u[-1] <= "~"].append(u)
        for plain, some in enumerate(new):
            for first in range(0, len(some), 20_000):
                part = some[first:first + 20_000]
                fresh.update(zip(part, self.aligned.units(part, bool(plain))))
        self.known.update((u, x) for u, x in fresh.items() if len(u) < LONG)
        return [fresh[u] if u in fresh else self.known[u] for u in units]

    def batch(self, column: pa.Array) -> tuple[dict[str, np.ndarray | list], np.ndarray, np.ndarray, np.ndarray]:
        """Per text its counts and digest; the distinct pairs, and all links as ``(number of the pair, text)``."""
        data, ends = text_buffer(column)
        size = np.diff(ends)
        there = np.flatnonzero(size > 0)
        begin = ends[there] + np.arange(len(there))                   # a blank is put before every text
        whole = np.full(len(data) + len(there), 32, np.uint8)
        inside = np.ones(len(whole), bool)
        inside[begin] = False
        whole[inside] = data
        cut = (whole == 32) & (np.concatenate([[0], whole[:-1]]) > 32) & (np.concatenate([[0], whole[:-1]]) < 127)
        if len(begin):
            cut[np.append(begin[1:], len(whole)) - 1] = False         # a blank alone at the end goes with the word before
        cut[begin] = True
        starts = np.flatnonzero(cut)
        offsets = np.append(starts, len(whole)).astype(np.int64)
        units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(whole)).dictionary_encode()
        index = units.indices.to_numpy().astype(np.int64)
        found = self.look_up(units.dictionary.to_pylist())
        first = np.searchsorted(starts, begin)
        n_units = np.diff(np.append(first, len(starts)))
        good = np.array([x is not None for x in found], bool)
        fine = _sums(good[index].astype(np.int64), n_units) == n_units
        index, n_units, text = index[np.repeat(fine, n_units)], n_units[fine], there[fine]
        blank = (0, 0, 0, b"", b"")
        found = [x or blank for x in found]
        result: dict = {}
        for k, name in enumerate(("n_a", "n_b", "n_groups")):
            result[name] = np.zeros(len(size), np.int64)
            result[name][text] = _sums(np.fromiter((x[k] for x in found), np.int64, len(found))[index], n_units)
        spelled, ends_of = [x[3] for x in found], np.cumsum(n_units).tolist()
        result["groups_sha256"] = [""] * len(size)
        order = index.tolist()
        for t, a, b in zip(text.tolist(), [0, *ends_of], ends_of):
            result["groups_sha256"][t] = hashlib.sha256(b"".join([spelled[i] for i in order[a:b]])[:-1]).hexdigest()
        pool = np.frombuffer(b"".join([x[4] for x in found]), np.int64)
        n_links = np.fromiter((len(x[4]) // 8 for x in found), np.int64, len(found))
        at = np.cumsum(n_links) - n_links
        per_unit = n_links[index]
        upto = np.cumsum(per_unit)
        where = np.repeat(at[index] - (upto - per_unit), per_unit) + np.arange(int(per_unit.sum()))
        of_text = np.repeat(np.repeat(text, n_units), per_unit)
        result["n_links"] = np.bincount(of_text, minlength=len(size)).astype(np.int64)
        pairs, number = np.unique(pool, return_inverse=True)
        return result, pairs, number[where], of_text


@functools.lru_cache(maxsize=1)
def texts(vocabulary_a: str, vocabulary_b: str) -> Texts:
    return Texts(vocabulary_a, vocabulary_b)


# --- runs ----------------------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of integers as one zstd block."""
    head = struct.pack(f"<B{len(arrays)}Q", len(arrays), *map(len, arrays))
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.astype("<i8").tobytes() for a in arrays))


def unpack(block: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    sizes = struct.unpack_from(f"<{raw[0]}Q", raw, 1)
    ends = 1 + 8 * raw[0] + 8 * np.cumsum((0, *sizes))
    return [np.frombuffer(raw, "<i8", n, at) for n, at in zip(sizes, ends.tolist())]


def runs_of(distinct: np.ndarray, which: np.ndarray, text: np.ndarray, radix: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Per partition: its pairs with their links, and per pair the documents and their links (as steps)."""
    n = int(text.max()) + 1 if len(text) else 1
    records = np.sort(which * n + text)
    first = np.flatnonzero(np.append(True, records[1:] != records[:-1])) if len(records) else np.zeros(0, np.int64)
    links = np.diff(first, append=len(records))
    pair, text = np.divmod(records[first], n)
    used = np.unique(pair)                                  # a unit of texts without tokens may have brought others
    distinct, pair = distinct[used], np.searchsorted(used, pair)
    part = (distinct >> 32) % radix
    for r in range(radix):
        mine = part == r
        if not mine.any():
            continue
        rows = mine[pair]
        sizes = np.bincount(pair[rows], minlength=len(distinct))[mine]
        total = np.bincount(pair[rows], weights=links[rows], minlength=len(distinct))[mine].astype(np.int64)
        steps = np.diff(text[rows], prepend=0)
        yield r, pack(np.diff(distinct[mine], prepend=0), total), pack(sizes, steps, links[rows])


def _encode(text_col: str, vocabulary_a: str, vocabulary_b: str, radix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, number = texts(vocabulary_a, vocabulary_b), 0
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        for batch in sliced(batches, text_col, RUN):
            result, pairs, which, text = of.batch(batch.column(text_col))
            n, others = batch.num_rows, [f.name for f in batch.schema if f.name != text_col]
            name = task << 32 | number
            number += 1
            made = ["n_a", "n_b", "n_groups", "n_links"]
            names = [*others, *made, "groups_sha256", "__run", "__at", "__radix", "__pairs", "__records"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], *[pa.array(result[m]) for m in made], pa.array(result["groups_sha256"]),
                 pa.array(np.full(n, name)), pa.array(np.arange(n, dtype=np.int32)), pa.nulls(n, pa.int32()),
                 pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names)
            blocks = list(runs_of(pairs, which, text, radix))
            m = len(blocks)
            if m:
                yield pa.RecordBatch.from_arrays(
                    [*[pa.nulls(m, batch.schema.field(c).type) for c in others], *[pa.nulls(m, pa.int64()) for _ in made],
                     pa.nulls(m, pa.string()), pa.array(np.full(m, name)), pa.nulls(m, pa.int32()),
                     pa.array([b[0] for b in blocks], pa.int32()), pa.array([b[1] for b in blocks], pa.binary()),
                     pa.array([b[2] for b in blocks], pa.binary())], names)
    return run


# --- counting -----------------------------------------------------------------------

def merge(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of several runs in order, each with the sum of its counts: a k-way heap merge."""
    streams = []
    for block in blocks:
        steps, counts = unpack(block)
        streams.append(zip(np.cumsum(steps).tolist(), counts.tolist()))
    pairs, sums, last = [], [], -1
    for pair, count in heapq.merge(*streams):
        if pair == last:
            sums[-1] += count
        else:
            pairs.append(pair)
            sums.append(count)
            last = pair
    return np.array(pairs, np.int64), np.array(sums, np.int64)


def _merge_round(table: pa.Table) -> pa.Table:
    """One block of the pairs of a group of blocks."""
    pairs, sums = merge(table["pairs"].to_pylist())
    return pa.table({"radix": table["radix"].slice(0, 1).cast(pa.int32()),
                     "run": pa.array([table["group"][0].as_py()], pa.int64()),
                     "pairs": pa.array([pack(np.diff(pairs, prepend=0), sums)], pa.binary())})


def _highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether a pair's count is the highest of its B id: pairs come by B id, so its pairs are neighbours."""
    for batch in batches:
        for radix, block in zip(batch.column("radix").to_pylist(), batch.column("pairs").to_pylist()):
            steps, counts = unpack(block)
            side = np.cumsum(steps) >> 32
            first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))[:len(side)]
            top = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(side))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([radix], pa.int32()), pa.array([pack(steps, counts, (counts == top).astype(np.int64))], pa.binary())],
                ["radix", "known"])


def contributions(run: tuple[bytes, bytes], known: bytes | list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document of a run (in order): links that are their B id's most frequent, and the sum of counts."""
    steps, counts, best = unpack(known) if isinstance(known, bytes) else known
    pairs = np.cumsum(unpack(run[0])[0])
    sizes, text_steps, links = unpack(run[1])
    row = np.searchsorted(np.cumsum(steps), pairs)
    text = np.cumsum(text_steps)
    distinct, which = np.unique(text, return_inverse=True)
    n_best, count_sum = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
    np.add.at(n_best, which, links * np.repeat(best[row], sizes))
    np.add.at(count_sum, which, links * np.repeat(counts[row], sizes))
    return distinct, n_best, count_sum


def _stream_back(key: tuple, runs: pa.Table, known: pa.Table) -> pa.Table:
    """What the records of some runs of one partition add to their documents."""
    out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]
    if len(runs) and len(known):
        table = unpack(known["known"][0].as_py())
        for name, *run in zip(*(runs[c].to_pylist() for c in ("run", "pairs", "records"))):
            found = contributions(tuple(run), table)
            for column, values in zip(out, [np.full(len(found[0]), name), *found]):
                column.append(values)
    run, at, n_best, count_sum = map(np.concatenate, out)
    return pa.table({"run": run, "at": at.astype(np.int32), "n_best": n_best, "count_sum": count_sum})


def align(docs: DataFrame, text_col: str = "text", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
          radix: int = RADIX, fan_in: int = FAN_IN) -> DataFrame:
    """The other columns of ``docs`` and ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row per row.

    Null and empty texts, and those of which a tokenizer changes bytes, have zeros and an empty digest.  Repeated rows
    count as often as they are there; ties for the highest count all count.  A text of any length is aligned whole
    (one over ``RUN`` bytes is a run of its own).  Input columns of the result names are replaced; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    work = Scratch(spark, "align")
    docs = names_free(docs, *RESULTS)
    kept = [f for f in docs.schema.fields if f.name != text_col]
    # Kept columns get names of their own, so none can clash with those of the run.
    inner = docs.select(F.col(f"`{text_col}`").alias("__text"), *[F.col(f"`{f.name}`").alias(f"c{k}") for k, f in enumerate(kept)])
    schema = ", ".join([*[f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(kept)],
                        "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, __run long, __at int, "
                        "__radix int, __pairs binary, __records binary"])
    encoded = work.write(inner.mapInArrow(_encode("__text", vocabulary_a, vocabulary_b, radix), schema), "encoded")
    runs = encoded.filter("__radix IS NOT NULL").select(
        F.col("__radix").alias("radix"), F.col("__run").alias("run"), F.col("__pairs").alias("pairs"),
        F.col("__records").alias("records"))
    many = runs.select("run").distinct().count()
    groups = max(1, math.ceil(many / fan_in))
    group = lambda n: F.pmod(F.xxhash64("run"), F.lit(n)).alias("group")
    pairs, left, step = runs.select("radix", "run", "pairs"), groups, 0
    while True:
        pairs = work.write(pairs.select("radix", group(left), "pairs").groupBy("radix", "group").applyInArrow(
            _merge_round, "radix int, run long, pairs binary"), f"pairs{step}")
        if left == 1:
            break
        left, step = math.ceil(left / fan_in), step + 1
    known = work.write(pairs.select("radix", "pairs").mapInArrow(_highest, "radix int, known binary"), "known")
    beside = known.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    back = runs.select("radix", "run", "pairs", "records", group(groups)).groupBy("radix", "group").cogroup(
        beside.groupBy("radix", "group")).applyInArrow(_stream_back, "run long, at int, n_best long, count_sum long")
    sums = back.groupBy(F.col("run").alias("__run"), F.col("at").alias("__at")).agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    rows = encoded.filter("__radix IS NULL").drop("__radix", "__pairs", "__records")
    none = F.lit(0).cast("long")
    return rows.join(sums, ["__run", "__at"], "left").select(
        *[F.col(f"c{k}").alias(f.name) for k, f in enumerate(kept)], "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
