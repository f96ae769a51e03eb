"""Op 13. Collocations: phrases whose words occur together far more often than apart.

Counting is by a trie in arrays.  A task numbers the words it meets; a trie's containers hold the suffixes of a first
word in order, side by side, and phrases that are met wait beside them until one sort takes them in.  When the tries
hold too much, their largest subtrees leave them whole, as runs sorted by phrase.  Runs are cut by prefix
partition (the first words of a phrase) and into blocks; Spark's external sort brings the blocks of a partition in
order of their first phrase, and a phrase is final as soon as a block starts behind it.  Final counts are summed by a
hash of the phrase first; only phrases whose hash is frequent enough are told apart.  What isn't final is summed again only
after it has doubled.

Phrases of k words are counted after those of k - 1 words: a phrase can be frequent only if both its parts of k - 1
words are.  Which those are is known from a bit set of fixed size; a bit that is set wrongly costs a count that
comes to nothing, never a result.  A prefix that holds more than a partition's share of all phrases is dealt out by
whole phrases instead (there are fewer such prefixes than partitions).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, release_memory, sliced, text_buffer

LONGEST = 3
#: Phrases that wait beside a trie's containers at least, and entries of a task's tries before subtrees are spilled.
BURST, ENTRIES = 4096, 2_000_000
#: Words that a trie numbers before it is emptied and starts anew.
NUMBERED = 400_000
#: Phrases of a block of a run, and of blocks that are merged at once.
BLOCK, MERGED = 8192, 1_000_000
#: Bits of the set of frequent phrases: 4 MB, whatever the input.
BITS = 1 << 25
SLICE = 8 << 20
#: Lower-case letters; blanks as 32; piece ends as 10.
PIECES = np.arange(256, dtype=np.uint8)
PIECES[65:91] += 32
PIECES[9] = 32
PIECES[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 10
#: Bytes of the longest word that is hashed in steps of 8; masks of so many first bytes of 8.
LONG_WORD = 64
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


# --- text ------------------------------------------------------------------------

def split_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, and for each the number of its piece (words of one piece are neighbours)."""
    data, ends = text_buffer(texts)
    sizes = np.diff(ends)
    text = np.ones(len(data) + len(sizes), bool)
    text[ends[1:] + np.arange(len(sizes))] = False
    whole = np.full(len(text), 10, np.uint8)                  # every text ends with a piece end
    whole[text] = PIECES[data]
    inside = np.zeros(len(whole) + 2, bool)
    inside[1:-1] = (whole != 32) & (whole != 10)
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    inside = inside[1:-1]
    begin, end = edge[::2], edge[1::2]
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin),
                                             [None, pa.py_buffer(offsets), pa.py_buffer(whole[inside])])
    return words, np.searchsorted(np.flatnonzero(whole == 10), begin)


def word_codes(words: pa.Array, seed: int) -> np.ndarray:
    """A hash of each word: by 8 bytes at a time, or (longer words) by crc32."""
    if not len(words):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.zeros(int(ends[-1] - ends[0]) + 8, np.uint8)
    data[:-8] = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    begin, size = ends[:-1] - ends[0], np.diff(ends)
    eights = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1), writeable=False)

    def step(h: np.ndarray, more: np.ndarray) -> np.ndarray:
        h = (h ^ more) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ h >> np.uint64(29)

    codes = step(np.full(len(words), seed, np.uint64), size.astype(np.uint64))
    left = np.flatnonzero(size <= LONG_WORD)
    for at in range(0, LONG_WORD, 8):
        left = left[size[left] > at]
        if not len(left):
            break
        eight = eights[begin[left] + at].view("<u8").ravel() & FIRST_BYTES[np.minimum(size[left] - at, 8)]
        codes[left] = step(codes[left], eight)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        codes[i] = step(codes[i:i + 1], np.array([zlib.crc32(data[begin[i]:begin[i] + size[i]], seed)], np.uint64))[0]
    return step(codes, codes >> np.uint64(32))


# --- trie ------------------------------------------------------------------------

class HatTrie:
    """Counts of phrases of ``width`` words of one language.

    The containers of suffixes lie side by side in arrays, ordered by first word and suffix.  Phrases that are added wait
    beside them; when more wait than a container may hold and than are held, one sort takes them all in.
    """

    def __init__(self, lang: str, width: int):
        self.lang, self.width = lang, width
        self.seed = zlib.crc32(lang.encode())
        self.clear()

    def clear(self) -> None:
        self.names = pa.array([], pa.large_binary())
        self.codes = np.zeros(0, np.uint64)   # a hash of each word
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []    # first words, other words, counts
        self.settled = 0                      # of the entries, those in order
        self.leaves = np.zeros(0, np.int64)   # phrases of one word: a leaf is a count beside the word
        self.entries = 0

    def number(self, words: list[bytes]) -> np.ndarray:
        coded = pa.array(words, pa.large_binary()).dictionary_encode()
        return self.number_distinct(coded.dictionary)[coded.indices.to_numpy()]

    def number_distinct(self, words: pa.Array) -> np.ndarray:
        at = pc.index_in(words, value_set=self.names)
        found, new = at.fill_null(0).to_numpy().astype(np.int64), at.is_null().to_numpy(zero_copy_only=False)
        if new.any():
            fresh = words.filter(pa.array(new))
            found[new] = len(self.names) + np.arange(len(fresh))
            self.names = pa.concat_arrays([self.names, fresh])
            self.codes = np.append(self.codes, word_codes(fresh, self.seed))
        return found

    def add(self, first: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> None:
        """Count phrases: first word, the other words (32 bits each), how often; ordered by first word."""
        if not len(first):
            return
        if self.width == 1:
            self.leaves = np.concatenate([self.leaves, np.zeros(len(self.names) - len(self.leaves), np.int64)])
            self.leaves[first] += counts
            self.entries = len(self.names)
            return
        self.held.append((first, rest, counts))
        self.entries += len(first)
        if self.entries - self.settled > max(BURST, self.settled):
            self.settle()

    def settle(self) -> None:
        """Take the phrases that wait into the containers."""
        if self.settled == self.entries or self.width == 1:
            return
        first, rest, counts = (np.concatenate(x) for x in zip(*self.held))
        order = np.argsort(first << 32 | rest, kind="stable") if self.width == 2 else np.lexsort((rest, first))
        first, rest, counts = first[order], rest[order], counts[order]
        begins = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])))
        self.held = [(first[begins], rest[begins], np.add.reduceat(counts, begins))]
        self.entries = self.settled = len(begins)

    def spill(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Take out whole subtrees, the largest first, until at most ``least`` entries stay."""
        if self.width == 1:
            first = np.flatnonzero(self.leaves)
            counts, self.leaves, self.entries = self.leaves[first], np.zeros(len(self.leaves), np.int64), 0
            return first, np.zeros(len(first), np.int64), counts
        self.settle()
        if self.entries <= least:
            return (np.zeros(0, np.int64),) * 3
        first, rest, counts = self.held[0]
        sizes = np.diff(np.concatenate([[0], np.flatnonzero(np.diff(first)) + 1, [len(first)]]))
        largest = np.argsort(-sizes, kind="stable")
        out = np.zeros(len(sizes), bool)
        out[largest[:np.searchsorted(np.cumsum(sizes[largest]), self.entries - least) + 1]] = True
        out = np.repeat(out, sizes)
        self.held = [(first[~out], rest[~out], counts[~out])]
        self.entries = self.settled = len(self.held[0][0])
        return first[out], rest[out], counts[out]

    def ids(self, first: np.ndarray, rest: np.ndarray) -> list[np.ndarray]:
        """Word ids by place."""
        return [first, rest >> 32, rest & 0xFFFFFFFF] if self.width == 3 else [first, rest][:self.width]

    def phrases(self, first: np.ndarray, rest: np.ndarray) -> tuple[list[np.ndarray], pa.Array]:
        """Word ids by place, and the phrases as bytes."""
        ids = self.ids(first, rest)
        return ids, _joined([self.names] * self.width, ids)

    def order(self, ids: list[np.ndarray]) -> np.ndarray:
        """Places of phrases in order of their bytes: ranks of words, all but the last with the blank that follows."""
        ranks = []
        for names in [_with_end(self.names, b" ")] * (self.width - 1) + [self.names]:
            if not ranks or names is self.names:
                rank = np.empty(len(names), np.int64)
                rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
            ranks.append(rank)
        keys = [rank[i] for rank, i in zip(ranks, ids)]
        if len(keys) > 1:
            keys[-2:] = [keys[-2] << 32 | keys[-1]]
        return np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")


def _with_end(names: pa.Array, end: bytes) -> pa.Array:
    empty = pa.scalar(b"", pa.large_binary())
    return pc.binary_join_element_wise(names, empty, pa.scalar(end, pa.large_binary()))


def _joined(names: list[pa.Array], ids: list[np.ndarray]) -> pa.Array:
    words = [n.take(pa.array(i)) for n, i in zip(names, ids)]
    return words[0] if len(words) == 1 else pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary()))


def mixed(codes: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
    """A hash of phrases by the codes of their words; the same in every task."""
    h = codes[ids[0]]
    for i in ids[1:]:
        h = (h ^ h >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + codes[i]
    return h ^ h >> np.uint64(31)


def phrase_hashes(lang: str, phrases: list[bytes]) -> np.ndarray:
    """``mixed`` of phrases of equally many words."""
    seed, width = zlib.crc32(lang.encode()), phrases[0].count(b" ") + 1 if phrases else 1
    codes = word_codes(pa.array([w for p in phrases for w in p.split(b" ")], pa.large_binary()), seed)
    return mixed(codes, [np.arange(k, len(codes), width) for k in range(width)])


# --- counting and spilling ---------------------------------------------------------

RUNS = "lang string, part int, first binary, block binary"


def _blocks(trie: HatTrie, least: int, parts: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Spilled subtrees as a run: sorted by phrase, cut by prefix partition and into blocks."""
    first, rest, counts = trie.spill(least)
    if not len(first):
        return
    ids, codes = trie.ids(first, rest), trie.codes
    prefix = mixed(codes, ids[:2])
    if trie.width > 2 and len(hot):
        prefix = np.where(np.isin(prefix, hot), mixed(codes, ids), prefix)
    part = (prefix % np.uint64(parts)).astype(np.int32)
    order = trie.order(ids)
    order = order[np.argsort(part[order].astype(np.uint16) if parts <= 1 << 16 else part[order], kind="stable")]
    counts, part = counts[order].astype("<i8"), part[order]
    lines = _joined([trie.names] * (trie.width - 1) + [_with_end(trie.names, b"\n")], [i[order] for i in ids])
    at = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + len(lines) + 1]
    raw = memoryview(lines.buffers()[2])
    cuts = np.flatnonzero(np.diff(part)) + 1
    begins = np.concatenate([np.arange(a, b, BLOCK) for a, b in
                             zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(part)]]))])
    stops = np.append(begins[1:], len(part))
    pack = zstandard.ZstdCompressor(level=1)
    blocks = [pack.compress(struct.pack("<Q", b - a) + counts[a:b].tobytes() + bytes(raw[at[a]:at[b]]))
              for a, b in zip(begins.tolist(), stops.tolist())]
    heads = [bytes(raw[at[a]:at[a + 1] - 1]) for a in begins.tolist()]
    for a in range(0, len(blocks), 1000):
        n = len(blocks[a:a + 1000])
        yield pa.RecordBatch.from_arrays(
            [pa.array([trie.lang] * n), pa.array(part[begins[a:a + n]]), pa.array(heads[a:a + n], pa.binary()),
             pa.array(blocks[a:a + n], pa.binary())], ["lang", "part", "first", "block"])


def open_block(block: bytes) -> tuple[pa.Array, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = struct.unpack_from("<Q", raw)[0]
    text = np.frombuffer(raw, np.uint8, offset=8 + 8 * n)
    ends = np.flatnonzero(text == 10)
    offsets = np.zeros(n + 1, np.int64)
    offsets[1:] = ends + 1 - np.arange(1, n + 1)
    phrases = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n,
                                               [None, pa.py_buffer(offsets), pa.py_buffer(text[text != 10])])
    return phrases, np.frombuffer(raw, "<i8", n, 8)


def grams(words: pa.Array, piece: np.ndarray, trie: HatTrie, frequent: np.ndarray | None) -> tuple:
    """Distinct phrases of ``trie.width`` words whose shorter parts may be frequent: first word, other words, count."""
    if trie.width == 1:
        coded = words.dictionary_encode()
        return (trie.number_distinct(coded.dictionary), np.zeros(0, np.int64),
                np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)))

    def bit(h: np.ndarray) -> np.ndarray:
        at = h % np.uint64(BITS)
        return (frequent[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    ok = bit(mixed(word_codes(words, trie.seed), [np.arange(len(words))]))
    coded = words.filter(pa.array(ok)).dictionary_encode()
    word = np.zeros(len(words), np.int64)
    word[ok] = trie.number_distinct(coded.dictionary)[coded.indices.to_numpy()]
    codes = trie.codes
    pair = np.flatnonzero((piece[1:] == piece[:-1]) & ok[1:] & ok[:-1])
    two = word[pair] << 32 | word[pair + 1]
    if trie.width == 2:
        found, counts = np.unique(two, return_counts=True)
        return found >> 32, found & 0xFFFFFFFF, counts
    pairs, which = np.unique(two, return_inverse=True)
    often = bit(mixed(codes, [pairs >> 32, pairs & 0xFFFFFFFF]))[which]
    triple = np.flatnonzero((np.diff(pair) == 1) & often[1:] & often[:-1])
    found, counts = np.unique(which[triple] << 32 | word[pair[triple] + 2], return_counts=True)
    pairs = pairs[found >> 32]
    return pairs >> 32, (pairs & 0xFFFFFFFF) << 32 | found & 0xFFFFFFFF, counts


def _count(text_col: str, lang_col: str, width: int, parts: int, sets, entries: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, hot = sets.value if sets is not None else (None, np.zeros(0, np.uint64))
        tries: dict[str, HatTrie] = {}
        for batch in sliced(batches, text_col, SLICE):
            texts, coded = batch.column(text_col), batch.column(lang_col).dictionary_encode()
            of = coded.indices.to_numpy()
            for k, lang in enumerate(coded.dictionary.to_pylist()):
                trie = tries.setdefault(lang, HatTrie(lang, width))
                trie.add(*grams(*split_pieces(texts.filter(pa.array(of == k))), trie, frequent))
                if len(trie.names) > NUMBERED:
                    yield from _blocks(trie, 0, parts, hot)
                    trie.clear()
                elif sum(t.entries for t in tries.values()) > entries:
                    for t in tries.values():
                        t.settle()
                    if sum(t.entries for t in tries.values()) > entries // 2:
                        for t in tries.values():
                            yield from _blocks(t, t.entries // 2, parts, hot)
        for trie in tries.values():
            yield from _blocks(trie, 0, parts, hot)
        release_memory()
    return run


# --- merging -----------------------------------------------------------------------

COUNTS = "lang string, phrase string, f long, h long"


def _summed(phrases: pa.Array, counts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Distinct phrases and the sums of their counts."""
    table = pa.table({"p": phrases, "n": counts}).group_by("p", use_threads=False).aggregate([("n", "sum")]).combine_chunks()
    return pa.concat_arrays(table["p"].chunks or [phrases]), table["n_sum"].to_numpy()


def _often(phrases: pa.Array, counts: np.ndarray, least: int) -> np.ndarray:
    """Which phrases may occur ``least`` times: those whose hash does (no others can, and telling hashes is cheaper)."""
    codes = word_codes(phrases, 0)
    order = np.argsort(codes)
    begins = np.flatnonzero(np.append(True, np.diff(codes[order]) != 0)[:len(codes)])
    some = np.zeros(len(codes), bool)
    if len(begins):
        some[order] = np.repeat(np.add.reduceat(counts[order], begins) >= least, np.diff(np.append(begins, len(codes))))
    return some


def _merge(least: int):
    """Sum the runs; rows come by partition, in order of each block's first phrase.

    Gives the phrases counted ``least`` times, and per partition one row without phrase: the sum of all counts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, most, key, total = [], 0, MERGED, None, 0

        def settle(before):
            """Rows of all phrases that come before ``before`` (None: of all); the others are held on."""
            nonlocal held, size, most, total
            phrases, counts = pa.concat_arrays([p for p, _ in held]), np.concatenate([n for _, n in held])
            held, size = [], 0
            if before is not None:
                final = pc.less(phrases, pa.scalar(before, pa.large_binary())).to_numpy(zero_copy_only=False)
                held = [_summed(phrases.filter(pa.array(~final)), counts[~final])]
                size = len(held[0][1])
                phrases, counts = phrases.filter(pa.array(final)), counts[final]
            most = max(MERGED, 2 * size)      # what stays isn't summed again before it has doubled
            total += int(counts.sum())
            some = _often(phrases, counts, least)
            phrases, counts = _summed(phrases.filter(pa.array(some)), counts[some])
            final = counts >= least
            return phrases.filter(pa.array(final)).to_pylist(), counts[final].tolist()

        def rows(found):
            phrases, counts = found
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(phrases), pa.string()), pa.array([p.decode() for p in phrases], pa.string()),
                 pa.array(counts, pa.int64()), pa.array(phrase_hashes(key[0], phrases).view(np.int64))],
                ["lang", "phrase", "f", "h"])

        def sums():
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([None], pa.string()), pa.array([total]),
                                               pa.array([0], pa.int64())], ["lang", "phrase", "f", "h"])

        for batch in batches:
            for row in batch.to_pylist():
                if (row["lang"], row["part"]) != key:
                    if key is not None:
                        yield rows(settle(None))
                        yield sums()
                    key, total = (row["lang"], row["part"]), 0
                elif size > most:
                    yield rows(settle(row["first"]))
                phrases, counts = open_block(row["block"])
                held.append((phrases, counts))
                size += len(counts)
        if key is not None:
            yield rows(settle(None))
            yield sums()
        release_memory()
    return run


def bit_set(counts: DataFrame) -> np.ndarray:
    """The frequent phrases as ``BITS`` bits: at most ``BITS / 32`` rows reach the driver, however many phrases there are."""
    at = F.pmod(F.col("h"), F.lit(BITS))
    rows = (counts.filter("phrase IS NOT NULL").select(F.shiftright(at, 5).cast("int").alias("at"),
                                                       F.expr("shiftleft(1L, cast(pmod(h, 32) as int))").alias("bit"))
            .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    found = np.zeros(BITS // 32, "<u4")
    found[rows["at"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return found.view(np.uint8)


def count_phrases(docs: DataFrame, text_col: str, lang_col: str, least: int, work: Scratch, longest: int = LONGEST,
                  entries: int = ENTRIES) -> list[DataFrame]:
    """Per number of words (from 1): ``lang, phrase, f`` of the phrases that occur ``least`` times or more.

    The first table also has rows without phrase, whose ``f`` add up to all occurrences of words of the language.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
                       F.coalesce(F.col(lang_col), F.lit("und")).alias("__lang"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    tables, sets = [], None
    for width in range(1, longest + 1):
        runs = work.write(docs.mapInArrow(_count("__text", "__lang", width, parts, sets, entries), RUNS), f"runs{width}")
        dealt = runs.repartition(parts, "lang", "part").sortWithinPartitions("lang", "part", "first")
        tables.append(work.write(dealt.mapInArrow(_merge(least), COUNTS), f"counts{width}"))
        work.drop(f"runs{width}")
        if width < longest:
            bits = bit_set(tables[-1]) if sets is None else bit_set(tables[-1]) | sets.value[0]
            sets = spark.sparkContext.broadcast((bits, hot_prefixes(tables[-1], parts)))
    return tables


def hot_prefixes(counts: DataFrame, parts: int) -> np.ndarray:
    """Hashes of the phrases that make up more than a partition's share of all: fewer than ``parts``."""
    total = counts.filter("phrase IS NULL").agg(F.sum("f").alias("n")).first()["n"] or 0
    rows = counts.filter("phrase IS NOT NULL").filter(F.col("f") * F.lit(parts) > F.lit(total)).select("h").toArrow()
    return rows["h"].to_numpy().view(np.uint64) if len(rows) else np.zeros(0, np.uint64)


# --- collocations ------------------------------------------------------------------

def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, cover: int = 50,
                 entries: int = ENTRIES) -> DataFrame:
    """All phrases of two or three words that occur ``least`` times, scored: ``lang, phrase, a, l, r, n, score, covered``.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut (the first of equals), ``n`` all words of the
    language; ``score`` is the exact floor of 1,000,000 a a / (l r).  ``covered``: a longer phrase has the words
    and at least ``cover`` % of the occurrences.  A null language counts as ``und``, a null text as empty; repeated rows
    count as often as they are there; an empty table, or one without a word, gives no row.  A text of any length is
    read whole.  Columns of other names have no influence.
    """
    work = Scratch(docs.sparkSession, "phrases")
    one, two, three = count_phrases(docs, text_col, lang_col, least, work, entries=entries)
    n = one.filter("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    one, two, three = (t.filter("phrase IS NOT NULL").select("lang", "phrase", "f") for t in (one, two, three))
    w = F.split("phrase", " ")
    join = lambda *i: F.concat_ws(" ", *[w[k] for k in i])
    parts = [("l1", join(0)), ("r1", F.when(F.size(w) == 2, join(1)).otherwise(join(1, 2))),
             ("l2", F.when(F.size(w) == 3, join(0, 1))), ("r2", F.when(F.size(w) == 3, join(2)))]
    candidates = two.unionByName(three).withColumnRenamed("f", "a")
    needed = candidates.select("lang", "phrase", "a", F.explode(F.array(*[
        F.struct(F.lit(name).alias("side"), value.alias("part")) for name, value in parts])).alias("x"))
    needed = work.write(needed.select("lang", "phrase", "a", "x.side", "x.part").filter("part IS NOT NULL"), "parts")
    known = work.write(one.unionByName(two).withColumnRenamed("phrase", "part"), "known")
    sides = needed.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(
        *[F.max(F.when(F.col("side") == name, F.col("f"))).alias(name) for name, _ in parts])
    exact = "cast({} as decimal(15,0))"
    score = lambda k: F.expr(
        f"(cast(1000000 as decimal(7,0)) * ({exact.format('a')} * {exact.format('a')})) "
        f"div ({exact.format('l' + k)} * {exact.format('r' + k)})")
    cut = F.least(F.struct(score("1").alias("score"), F.lit(1).alias("k"), F.col("l1").alias("l"), F.col("r1").alias("r")),
                  F.when(F.col("l2").isNotNull(), F.struct(score("2").alias("score"), F.lit(2).alias("k"),
                                                           F.col("l2").alias("l"), F.col("r2").alias("r"))))
    longer = three.select("lang", F.explode(F.array_distinct(F.array(join(0, 1), join(1, 2)))).alias("phrase"), "f").groupBy(
        "lang", "phrase").agg(F.max("f").alias("longer"))
    scored = sides.withColumn("cut", cut).join(longer, ["lang", "phrase"], "left")
    return scored.join(F.broadcast(n) if _few(n) else n, "lang").select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score",
        F.coalesce(F.lit(100) * F.col("longer") >= F.lit(cover) * F.col("a"), F.lit(False)).alias("covered"))


def _few(n: DataFrame, most: int = 10_000) -> bool:
    """Whether a table has few enough rows to be broadcast."""
    return n.limit(most + 1).count() <= most


def top_collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, cover: int = 50,
                     limit: int = 2000, entries: int = ENTRIES) -> DataFrame:
    """The best ``limit`` uncovered collocations of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    found = collocations(docs, text_col, lang_col, least, cover, entries).filter(~F.col("covered"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= limit).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

