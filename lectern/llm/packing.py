"""Op 4. Best-fit packing of tokenised documents by minimum bin slack.

Documents become token ids and an end id; only those longer than a sequence are cut.  What fits together depends
on lengths alone, and there are at most ``capacity`` of them, so the packing is planned on the histogram of
all lengths, which is exact and as large for 100 TB as for a page.

Plan: per bin, the largest length left is placed; a subset-sum dynamic programme over the lengths still available
(one bit set of reachable sums, grown by shifts) finds the fullest feasible filling; the combination is
removed.  As the same combination stays the fullest while its lengths last, it is removed as often as the
counts allow in one go: a plan has a few combinations per length, not one per bin.

Assignment: a piece's rank among all pieces of its length says which bin it is in.  Ranks are made without a sort:
a task counts the pieces of each length as it writes them, and the counts of the tasks before it are added.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, names_free, sliced, split_words

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
#: Words of which a Python worker remembers the ids, in each of two generations.
REMEMBERED = 250_000
SLICE = 4 << 20
RESULTS = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")


# --- tokens ----------------------------------------------------------------------

class WordTokens:
    """Ids of whole batches by way of their distinct words.

    The vocabulary's normaliser turns white space into blanks and its pre-tokeniser cuts at blanks, so the ids of a text
    are those of its blank-separated words in order; a word is encoded once and remembered.  Texts that
    may hold a special token are encoded as they are, before any change of case.
    """

    #: A word that is one pre-token, and one that is such a word and a mark.
    PLAIN, MARKED = re.compile(r"[a-zß-öø-ÿ]+"), re.compile(r"[a-zß-öø-ÿ]+[.,]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        ends = [i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.is_end = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.is_end[ends] = True
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, words: list[str]) -> None:
        """Remember the ids of ``words`` (no blanks inside)."""
        for first in range(0, len(words), 2000):
            part = words[first:first + 2000]
            code = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(code.ids, np.uint32)
            cuts = np.flatnonzero(self.is_end[ids]) + 1
            if len(cuts) != len(part) or not all(map(self.PLAIN.fullmatch, part)):
                begins = np.cumsum([0] + [len(w) + 1 for w in part[:-1]])
                where = np.searchsorted(begins, [o[0] for o in code.offsets], "right") - 1
                cuts = np.searchsorted(where, np.arange(len(part)), "right")
            raw, before = ids.tobytes(), 0
            for word, cut in zip(part, (4 * cuts).tolist(), strict=True):
                self.new[word] = raw[before:cut]
                before = cut

    def words(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        if len(self.new) > REMEMBERED:
            self.new, self.old = {}, self.new
        new, old = self.new, self.old
        plain, other, marked = set(), set(), []
        for w in words:
            if w in new:
                continue
            if w in old:
                new[w] = old[w]
            elif self.PLAIN.fullmatch(w):
                plain.add(w)
            elif self.MARKED.fullmatch(w):
                marked.append(w)
                plain.add(w[:-1])
                other.add(w[-1])
            else:
                other.add(w)
        self._encode([w for w in plain if w not in new])
        self._encode([w for w in other if w not in new])
        for w in marked:
            new[w] = new[w[:-1]] + new[w[-1]]
        return [new[w] for w in words]

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has."""
        texts = texts.cast(pa.large_string()).fill_null("")
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        usual = pc.if_else(pa.array(special), "", texts) if special.any() else texts
        words, parent = split_words(usual)
        coded = words.dictionary_encode()
        index = coded.indices.to_numpy()
        found = self.words(coded.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(found), np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        per_word = sizes[index]
        upto = np.cumsum(per_word)
        place = np.repeat(begins[index] - (upto - per_word), per_word)
        ids = pool[place + np.arange(len(place))]
        counts = np.bincount(parent, weights=per_word, minlength=len(texts)).astype(np.int64)
        if special.any():
            ids, counts = self._with_special(texts, special, ids, counts)
        return ids, counts

    def _with_special(self, texts, special, ids, counts):
        ends, parts = np.cumsum(counts), []
        for i in range(len(texts)):
            if special[i]:
                code = self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False)
                parts.append(np.array(code.ids, np.uint32))
            else:
                parts.append(ids[ends[i] - counts[i]:ends[i]])
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


@functools.lru_cache(maxsize=2)
def tokens(vocabulary: str) -> WordTokens:
    """The tokens of a vocabulary file: a path, or the name of one of the public tokenizers."""
    if not os.path.isabs(vocabulary):
        import public_tokenizers
        vocabulary = public_tokenizers.path(vocabulary)
    return WordTokens(str(vocabulary))


def _pieces(text_col: str, vocabulary: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = tokens(vocabulary)
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        so_far = np.zeros(capacity + 1, np.int64)
        for batch in sliced(batches, text_col, SLICE):
            ids, counts = of.batch(batch.column(text_col))
            sizes = counts + 1
            whole = np.full(len(ids) + len(counts), end_id, np.uint32)
            ends = np.cumsum(sizes)
            inside = np.ones(len(whole), bool)
            inside[ends - 1] = False
            whole[inside] = ids
            raw = memoryview(whole).cast("B")
            per = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), per)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
            start = piece * capacity
            length = np.minimum(capacity, sizes[doc] - start)
            begin = ends[doc] - sizes[doc] + start
            crc = np.fromiter((zlib.crc32(raw[4 * b:4 * (b + n)]) for b, n in zip(begin.tolist(), length.tolist())),
                              np.int64, len(doc))
            # Rank of a piece among those of its length that this task has made.
            order = np.argsort(length, kind="stable")
            run_of = length[order]
            first = np.searchsorted(run_of, run_of, "left")
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.arange(len(doc)) - first + so_far[run_of]
            so_far += np.bincount(length, minlength=capacity + 1)
            take = pa.array(doc)
            kept = [(f.name, batch.column(i).take(take)) for i, f in enumerate(batch.schema) if f.name != text_col]
            yield pa.RecordBatch.from_arrays(
                [*[c for _, c in kept], pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc),
                 pa.array(np.full(len(doc), task, np.int32)), pa.array(rank)],
                [*[n for n, _ in kept], "piece", "start", "length", "ids_crc32", "__task", "__rank"])
    return run


# --- plan ------------------------------------------------------------------------

def fullest(room: int, counts: dict[int, int]) -> dict[int, int]:
    """How many of each length fill ``room`` best (``counts``: available, longest first)."""
    reach, steps, mask = 1, [], (1 << room + 1) - 1
    for length, available in counts.items():
        left = min(available, room // length)
        if not left:
            continue
        steps.append((length, left, reach))
        times = 1
        while left:
            times = min(times, left)
            reach |= reach << times * length & mask
            left -= times
            times *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, available, before in reversed(steps):
        times = 0
        while not before >> total & 1:
            total -= length
            times += 1
        if times:
            used[length] = times
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Combinations (how many of each length) and how many bins take each."""
    left, found = {k: counts[k] for k in sorted(counts, reverse=True) if counts[k]}, []
    while left:
        longest = next(iter(left))
        rest = dict(left)
        rest[longest] -= 1
        used = fullest(capacity - longest, rest)
        used[longest] = used.get(longest, 0) + 1
        bins = min(left[k] // n for k, n in used.items())
        for k, n in used.items():
            left[k] -= bins * n
            if not left[k]:
                del left[k]
        found.append((used, bins))
    return found


class Places:
    """Bin and offset of a piece by its length and its rank among all pieces of that length."""

    def __init__(self, combinations: list[tuple[dict[int, int], int]]):
        rank, first_bin, rows = {}, 0, []
        for used, bins in combinations:
            offset = 0
            for length in sorted(used, reverse=True):
                n = used[length]
                rows.append((length, rank.get(length, 0), n, first_bin, offset))
                rank[length] = rank.get(length, 0) + bins * n
                offset += n * length
            first_bin += bins
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.key = table[:, 0] << 44 | table[:, 1]
        _, self.rank, self.per_bin, self.first_bin, self.offset = table.T
        self.bins = first_bin

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.key, length << 44 | rank, "right") - 1
        k = rank - self.rank[row]
        return self.first_bin[row] + k // self.per_bin[row], self.offset[row] + k % self.per_bin[row] * length


def _assign(places: Places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            rank = columns.pop("__rank").to_numpy() + columns.pop("__before").to_numpy()
            bins, offsets = places.of(columns["length"].to_numpy(), rank)
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(bins), pa.array(offsets)],
                                             [*columns, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
         end_id: int = 0) -> DataFrame:
    """One row per piece: the other columns of ``docs`` and ``piece, start, length, ids_crc32, sequence_id, offset``.

    Input columns of the result names are replaced.  Null texts count as empty: one piece, the end id.  Repeated
    rows are packed as often as they are there.  An empty table gives an empty result.
    """
    work = Scratch(docs.sparkSession, "packing")
    docs = names_free(docs, *RESULTS)
    kept = [f for f in docs.schema.fields if f.name != text_col]
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    made = ["piece int", "start long", "length long", "ids_crc32 long"]
    pieces = work.write(docs.mapInArrow(_pieces(text_col, vocabulary, capacity, end_id),
                                        ", ".join([*types, *made, "__task int", "__rank long"])), "pieces")
    counts = work.write(pieces.groupBy("__task", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(plan(histogram, capacity))
    upto = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, 0)
    before = counts.select("__task", "length", (F.sum("n").over(upto) - F.col("n")).alias("__before"))
    ranked = pieces.join(before, ["__task", "length"]).select(
        *[f.name for f in kept], "piece", "start", "length", "ids_crc32", "__rank", "__before")
    return ranked.mapInArrow(_assign(places), ", ".join([*types, *made, "sequence_id long", "offset long"]))
