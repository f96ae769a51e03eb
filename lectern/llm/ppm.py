"""Op 7. Scoring by prediction by partial matching (PPM).

Model: the contexts of up to ``ORDER`` preceding bytes.  A context has counts of the bytes that follow it (and
of the text's end); it predicts those by ``n / (T + q)`` (T: their sum, q: their number) and keeps
``q / (T + q)`` for an escape to the context that is one byte shorter, in which the symbols already seen are
excluded.  Below order 0 the symbols never seen share evenly.  The model is pretrained: it is counted over
all training texts and then fixed, so the probability of a byte depends on its context alone.

Size: every context of the training texts is kept (``SHARE`` can limit that, and doesn't by default), so the model grows
with them; it is a Spark table.  One code is a context and a symbol.  All codes of all texts are counted and dealt by
the ``TAIL`` nearest bytes, and a task works out their log-probabilities group by group: a group has all contexts
that share those bytes and thus all counts of orders 3 and 4 that its codes need (at most 257 * 257 codes), and the
counts of orders 0 to 2 (at most 257 * 65,793, whatever the input) are broadcast.

Scoring: the ``HELD`` codes most frequent in all texts are broadcast with their log-probabilities and looked up where a
text is read; the others go, counted per document, through a join on the code.  No code that is joined stands at
more than about one in ``HELD`` of all symbols, so no key of the join is hot.

Base: the add-one unigram score over words.  Words of at most ``SHORT`` bytes that make up at least one in ``COMMON`` of all training tokens (at
most ``COMMON`` of them) are looked up where a text is read; the others go through a join on the word, so
every count is exact and no vocabulary is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, names_free, release_memory, sliced, split_words, text_buffer

ORDER = 4
TAIL = 3
SHARE = float("inf")
HELD = 1 << 20
COMMON = 1 << 20
#: Bytes of the longest word that is collected and broadcast.
SHORT = 64
#: Symbols looked at together (some hundred bytes each), codes of whole groups together.
BLOCK, TOGETHER = 1 << 20, 1 << 19
END = 256
SYMBOLS = 257
#: Bytes of text read together.
SLICE, COUNT_SLICE = 4 << 20, 1 << 20
#: Set in a code that is counted for a held-out text.
ASIDE = 1 << 45
RESULTS = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


# --- counting ------------------------------------------------------------------

def _codes(data: np.ndarray, ends: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and code of the symbols ``first`` to ``last`` of all texts, each with its end, in a row."""
    starts = ends[:-1] + np.arange(len(ends) - 1)
    low = max(0, first - ORDER)
    from_, to = np.searchsorted(starts, [low, last - 1], "right") - [1, 0]
    stops = np.minimum(np.append(starts, ends[-1] + len(ends) - 1)[from_ + 1:to + 1], last)
    text = np.repeat(np.arange(from_, to), stops - np.maximum(starts[from_:to], low))
    place = np.arange(low, last)
    at = place - starts[text]
    inner = at < np.diff(ends)[text]
    symbol = np.full(len(text), END, np.int64)
    symbol[inner] = data[low - from_:low - from_ + np.count_nonzero(inner)]
    context = np.zeros(len(text), np.int64)
    for k in range(1, ORDER + 1):
        context[k:] |= symbol[:-k] << (8 * (k - 1))
    length = np.minimum(at, ORDER)
    codes = length << 41 | (context & ((1 << 8 * length) - 1)) << 9 | symbol
    return text[first - low:], codes[first - low:]


def _pieces(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts and codes of all symbols, ``BLOCK`` symbols at a time."""
    symbols = int(ends[-1]) + len(ends) - 1
    for first in range(0, symbols, BLOCK):
        yield _codes(data, ends, first, min(first + BLOCK, symbols))


def context_codes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One code per byte and per end of text: ``length << 41 | context << 9 | symbol``.

    The context holds up to ``ORDER`` preceding bytes of the same text, the nearest lowest.
    """
    return np.concatenate([np.zeros(0, np.int64), *(codes for _, codes in _pieces(data, ends))])


def _merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(np.concatenate(codes), return_inverse=True)
    return unique, np.bincount(place, np.concatenate(counts), len(unique)).astype(np.int64)


def _count_contexts(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = [], []
        emit = lambda: pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(codes, counts)], ["code", "n"])
        for batch in sliced(batches, text_col, COUNT_SLICE):
            aside = batch.column("aside").to_numpy(zero_copy_only=False) * ASIDE
            for text, code in _pieces(*text_buffer(batch.column(text_col))):
                unique, n = np.unique(code + aside[text], return_counts=True)
                codes.append(unique)
                counts.append(n)
                if sum(map(len, codes)) > 1_000_000:
                    merged = _merged(codes, counts)
                    codes, counts = [merged[0]], [merged[1]]
                    if len(merged[0]) > 500_000:
                        yield emit()
                        codes, counts = [], []
        if codes:
            yield emit()
    return run


def _count_words(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col, SLICE):
            words, _ = split_words(batch.column(text_col))
            found = words.value_counts()
            yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])
    return run


# --- model -----------------------------------------------------------------------

class Trie:
    """The definition in memory: log-probabilities of all symbols after each of some contexts."""

    def __init__(self, length: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray):
        """Rows of (context length, context, symbol, count); a kept context's shorter ones are kept too."""
        key = length.astype(np.int64) << 33 | context.astype(np.int64)
        self.nodes = nodes = np.union1d(key, [0])  # shorter contexts first; the empty one is state 0
        size, short = nodes >> 33, nodes & (2 ** 33 - 1)
        counts = np.zeros((len(nodes), SYMBOLS))
        np.add.at(counts, (np.searchsorted(nodes, key), symbol), n)
        # One byte shorter: without the byte that is furthest back.
        cut = np.maximum(size - 1, 0)
        suffix = np.searchsorted(nodes, cut << 33 | short & ((1 << 8 * cut) - 1))
        self.logp = np.concatenate([self._log_probabilities(counts, suffix, part) for part in
                                    np.array_split(np.arange(len(nodes)), -(-len(nodes) // 2048))]).astype(np.float32)

    @staticmethod
    def _log_probabilities(counts: np.ndarray, suffix: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Rows ``part``: escape from context to shorter context, excluding what was seen before."""
        found, escape = np.zeros((len(part), SYMBOLS)), np.ones(len(part))
        seen, node, open_ = np.zeros((len(part), SYMBOLS), bool), part.copy(), np.ones(len(part), bool)
        while open_.any():
            here = np.where(seen | ~open_[:, None], 0, counts[node])
            total, kinds = here.sum(axis=1), (here > 0).sum(axis=1)
            seen_all = (seen | (here > 0)).all(axis=1)
            kinds = np.where(seen_all, 0, kinds)  # nothing is left to escape to
            weight = np.maximum(total + kinds, 1)
            found += here * (escape / weight)[:, None]
            escape *= np.where(total > 0, kinds / weight, 1.0)
            seen |= here > 0
            open_ &= node > 0
            node = suffix[node]
        rest = np.maximum((~seen).sum(axis=1), 1)
        return np.log10(np.where(seen, found, (escape / rest)[:, None]))


def _cut(key: np.ndarray, k: int) -> np.ndarray:
    """Keys ``context << 9 | symbol`` with the ``k`` nearest bytes of the context."""
    return key & ((1 << 8 * k + 9) - 1)


class Level:
    """Counts of the symbols after contexts of ``k`` bytes."""

    def __init__(self, k: int, key: np.ndarray, n: np.ndarray, shorter: Level | None = None):
        self.key, place = np.unique(key, return_inverse=True)
        self.n = np.bincount(place, n, len(self.key))
        self.node, at = np.unique(self.key >> 9, return_inverse=True)
        add = lambda x: np.bincount(at, x, len(self.node))
        self.total, self.kinds = add(self.n), add(self.n > 0)
        #: What the symbols seen here count in the context that is one byte shorter.
        self.below = add(np.where(self.n > 0, shorter.count(_cut(self.key, k - 1)), 0)) if k else add(0 * self.n)

    def count(self, key: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[place] == key, self.n[place], 0) if len(self.key) else np.zeros(len(key))

    def context(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``total``, ``kinds`` and ``below`` of the contexts of ``key``; zeros for one never seen."""
        if not len(self.node):
            return (np.zeros(len(key)),) * 3
        place = np.minimum(np.searchsorted(self.node, key >> 9), len(self.node) - 1)
        there = self.node[place] == key >> 9
        return tuple(np.where(there, x[place], 0) for x in (self.total, self.kinds, self.below))


def low_levels(code: np.ndarray, n: np.ndarray) -> list[Level]:
    """Orders 0 to ``TAIL - 1`` of all training symbols."""
    levels = []
    for k in range(TAIL):
        here = code >> 41 >= k
        levels.append(Level(k, _cut(code[here], k), n[here], levels[-1] if k else None))
    return levels


def log_chances(code: np.ndarray, n: np.ndarray, low: list[Level], share: float) -> np.ndarray:
    """log10 probability of the symbol of each code after its context.

    ``code`` has all codes of the groups it has any of, ``n`` how often they stand in training texts (or 0).  The symbols
    seen after a context were seen after the shorter one too, so what is excluded there is known from their counts.
    """
    length, levels = code >> 41, list(low)
    for k in range(TAIL, ORDER + 1):
        here = length >= k
        levels.append(Level(k, _cut(code[here], k), n[here], levels[-1]))
    least = (low[0].total.sum()) / share
    p, open_, below, kinds = np.ones(len(code)), np.ones(len(code), bool), np.zeros(len(code)), np.zeros(len(code))
    for k in range(ORDER, -1, -1):
        rows = np.flatnonzero(open_ & (length >= k))
        total, seen, shorter = levels[k].context(_cut(code[rows], k))
        if k:
            kept = (total > 0) & (total >= least)
            rows, total, seen, shorter = rows[kept], total[kept], seen[kept], shorter[kept]
        count = levels[k].count(_cut(code[rows], k))
        left = np.where(seen == SYMBOLS, 0, seen - kinds[rows])  # nothing is left to escape to
        rest = total - below[rows]
        weight = np.maximum(rest + left, 1)
        p[rows] *= np.where(count > 0, count, np.where(rest > 0, left, weight)) / weight
        open_[rows[count > 0]] = False
        below[rows], kinds[rows] = shorter, seen
    p[open_] /= max(SYMBOLS - low[0].kinds.sum(), 1)
    return np.log10(p)


def collected(df: DataFrame) -> list[pa.Array]:
    """The columns of a small table."""
    table = df.toArrow()
    return [pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in table.columns]


def _chances(low, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (tail, code, n, m) sorted by tail: whole groups, many together."""
        levels, kept, size = low.value, [], 0

        def scored(rows: list[np.ndarray]) -> pa.RecordBatch:
            _, code, n, m = rows
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (code, m, log_chances(code, n, levels, share))],
                                              ["code", "m", "logp"])

        for batch in batches:
            kept.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
            size += batch.num_rows
            if size < TOGETHER:
                continue
            rows = [np.concatenate(x) for x in zip(*kept, strict=True)]
            whole = int(np.searchsorted(rows[0], rows[0][-1], "left"))
            if whole:
                yield scored([x[:whole] for x in rows])
            kept = [[x[whole:] for x in rows]]
            size -= whole
        if size:
            yield scored([np.concatenate(x) for x in zip(*kept, strict=True)])
        release_memory()
    return run


def train(texts: DataFrame, text_col: str, work: Scratch) -> DataFrame:
    """``code, m, logp`` of all codes in ``texts`` (``m``: how often), by the model of those that aren't ``aside``."""
    counted = texts.mapInArrow(_count_contexts(text_col), "code long, n long").groupBy(
        F.col("code").bitwiseAND(ASIDE - 1).alias("code")).agg(
        F.sum(F.when(F.col("code") < ASIDE, F.col("n")).otherwise(0)).alias("n"), F.sum("n").alias("m"))
    counted = work.write(counted, "contexts")
    length, context = F.shiftright("code", 41), F.shiftright("code", 9).bitwiseAND((1 << 32) - 1)
    short = F.least(length, F.lit(TAIL - 1).cast("long"))
    near = F.col("code").bitwiseAND((1 << 8 * (TAIL - 1) + 9) - 1)
    few = counted.filter("n > 0").groupBy(F.shiftleft(short, 41).bitwiseOR(near).alias("code")).agg(
        F.sum("n").alias("n"))
    low = texts.sparkSession.sparkContext.broadcast(low_levels(*[c.to_numpy() for c in collected(few)]))
    dealt = counted.select(context.bitwiseAND((1 << 8 * TAIL) - 1).alias("tail"), "code", "n", "m")
    dealt = dealt.repartition("tail").sortWithinPartitions("tail")
    model = work.write(dealt.mapInArrow(_chances(low, SHARE), "code long, m long, logp double"), "model")
    work.drop("contexts")
    low.destroy()
    return model


def split_model(model: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], DataFrame]:
    """The at most ``HELD`` most frequent codes (sorted) with their log-probabilities, and the table of all others."""
    step = F.floor(F.log2("m") * 8)
    found = sorted(model.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    sizes = np.cumsum([n for _, n in found])
    steps = [int(s) for (s, _), size in zip(found, sizes, strict=True) if size <= HELD]
    least = min(steps, default=1 << 30)
    code, logp = (c.to_numpy() for c in collected(model.filter(step >= least).select("code", "logp")))
    order = np.argsort(code)
    return (code[order], logp[order]), model.filter(step < least).drop("m")


# --- scoring ---------------------------------------------------------------------

def look_up(data: np.ndarray, ends: np.ndarray, held: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Sum of the held log-probabilities per text; and text, code and number of what isn't held, in order of the texts."""
    total, texts, codes, counts = np.zeros(len(ends) - 1), [], [], []
    for text, code in _pieces(data, ends):
        unique, place = np.unique(code, return_inverse=True)
        at = np.minimum(np.searchsorted(held[0], unique), max(len(held[0]) - 1, 0))
        there = held[0][at] == unique if len(held[0]) else np.zeros(len(unique), bool)
        logp = np.zeros(len(unique))
        logp[there] = held[1][at[there]]
        total += np.bincount(text, logp[place], len(total))
        far = ~there[place]
        pairs, n = np.unique(text[far] * len(unique) + place[far], return_counts=True)
        texts.append(pairs // len(unique))
        codes.append(unique[pairs % len(unique)])
        counts.append(n)
    return total, *(np.concatenate([np.zeros(0, np.int64), *x]) for x in (texts, codes, counts))


def _score(id_cols: list[str], text_col: str, model, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, (words_known, counts) = model.value, common.value
        rid = (TaskContext.get().partitionId() << 40) if TaskContext.get() else 0
        gain = np.log10(counts + 1.0)
        known_words = words_known.cast(pa.large_string())
        for batch in sliced(batches, text_col, SLICE):
            column = batch.column(text_col)
            n = len(column)
            words, parent = split_words(column)
            coded = words.dictionary_encode()
            place = pc.index_in(coded.dictionary, value_set=known_words).fill_null(-1).to_numpy()[coded.indices.to_numpy()]
            hit = place >= 0
            tokens = np.bincount(parent, minlength=n) + 1
            known = np.bincount(parent[hit], minlength=n)
            sums = np.bincount(parent[hit], weights=gain[place[hit]], minlength=n).astype(float)
            rare = words.filter(pa.array(~hit))
            cuts = np.concatenate([[0], np.cumsum(np.bincount(parent[~hit], minlength=n))]).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(cuts), rare.cast(pa.string()))
            score, text, code, times = look_up(*text_buffer(column), held)
            far = pa.StructArray.from_arrays([pa.array(code), pa.array(times)], ["code", "times"])
            ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))]).astype(np.int32)
            far = pa.ListArray.from_arrays(pa.array(ends), far)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid + np.arange(n)), *[batch.column(c) for c in id_cols], pa.array(tokens), pa.array(known),
                 pa.array(sums), rare, pa.array(score), far],
                ["__rid", *id_cols, "n_tokens", "__known", "__sum", "__rare", "__score", "__far"])
            rid += n
    return run


def score_texts(docs: DataFrame, held_out: Column, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default: all but the text) with the scores of the whole texts.

    Learns from the rows where ``held_out`` is false.  Tokens are words and one end per text.  Null texts count as
    empty: one token.  ``base_score`` is the add-one unigram log10 probability, ``score`` the PPM model's log10
    probability of bytes and end; both are given for training rows too.  With no training row every base count is 0.
    Input columns of the result names are replaced; an empty table gives an empty result.
    """
    spark, work = docs.sparkSession, Scratch(docs.sparkSession, "ppm")
    columns = columns if columns is not None else [c for c in docs.columns if c != text_col]
    rows = docs.withColumn("__held", held_out)
    columns = names_free(rows.select(*columns), *RESULTS).columns
    rows = rows.select(*columns, F.coalesce(text_col, F.lit("")).alias("__text"), F.col("__held").alias("held_out"))
    training = rows.filter(~F.col("held_out"))

    counts = work.write(training.select("__text").mapInArrow(_count_words("__text"), "word string, n long")
                        .groupBy("word").agg(F.sum("n").alias("n")), "words")
    texts = training.count()
    of = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("kinds")).first()
    tokens, kinds = of["n"] + texts, of["kinds"] + (texts > 0)
    common = collected(counts.filter((F.col("n") * COMMON >= tokens) & (F.octet_length("word") <= SHORT)).select("word", "n"))
    common = spark.sparkContext.broadcast((common[0], common[1].to_numpy()))
    aside = F.coalesce("held_out", F.lit(True)).cast("long").alias("aside")
    held, others = split_model(train(rows.select("__text", aside), "__text", work))
    model = spark.sparkContext.broadcast(held)
    release_memory()

    id_cols = [*columns, "held_out"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*id_cols).schema.fields)
    scored = work.write(rows.select(*id_cols, "__text").mapInArrow(
        _score(id_cols, "__text", model, common), f"__rid long, {types}, n_tokens long, __known long, __sum double, "
        "__rare array<string>, __score double, __far array<struct<code: long, times: long>>"), "scored")
    rare = scored.select("__rid", F.explode("__rare").alias("word"))
    rare = rare.join(counts, "word").select("__rid", F.lit(1).alias("more"), F.log10(F.col("n") + 1).alias("plus"),
                                            F.lit(0.0).alias("far"))
    far = scored.select("__rid", F.inline("__far")).join(others, "code").select(
        "__rid", F.lit(0).alias("more"), F.lit(0.0).alias("plus"), (F.col("times") * F.col("logp")).alias("far"))
    found = rare.union(far).groupBy("__rid").agg(
        F.sum("more").alias("__more"), F.sum("plus").alias("__plus"), F.sum("far").alias("__more_score"))
    end = float(np.log10(texts + 1.0))
    out = scored.drop("__rare", "__far").join(found, "__rid", "left")
    unit = float(np.log10(tokens + kinds + 1.0))
    return out.select(
        *id_cols, "n_tokens",
        (F.col("__known") + F.coalesce("__more", F.lit(0)) + F.lit(int(texts > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("__sum") + F.coalesce("__plus", F.lit(0.0)) + F.lit(end) - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("__score") + F.coalesce("__more_score", F.lit(0.0))).alias("score"))
