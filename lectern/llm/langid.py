"""Op 3. Language identification by cross-parsing entropy.

Per language a reference is put together from labelled texts, and its suffix automaton is built: it
accepts exactly the substrings of the reference.  Reading a text with the automaton gives the longest
match at each point; where a match can't be extended, a phrase ends and the next begins.  The text costs
``phrases * log2(reference length)`` bits in that language; the language with the fewest bits wins.
Letters are compared without case (ASCII and Latin-1), and a run of ASCII characters other than letters counts as one
space, so layout and junk say nothing about a language.

Texts are read in blocks of ``BLOCK`` bytes (phrases don't cross a block's end, in any language), which
lets one automaton step advance thousands of blocks; every byte of every text is read.

The references are a bounded sample of labelled rows: of the ``MOST_LANGUAGES`` most frequent labels ``SAMPLE_ROWS`` rows at
most, the ones with the smallest draw from the MD5 of their id and text, each with an equal share of
``REFERENCE_BYTES`` bytes, in windows spread over its whole text.  That bounds the model whatever the input: what is
sent to the tasks are the references, and a task's tables have about ``2 * REFERENCE_BYTES * CLASSES`` entries per language.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, names_free, sliced, text_buffer
from .lanes import Lanes

#: The bounded sample of labelled rows: the most frequent languages, rows of each, bytes of each language's reference (every
#: row has an equal share of it, in windows spread over its whole text).
MOST_LANGUAGES = 256
SAMPLE_ROWS = 64
REFERENCE_BYTES = 32_768
WINDOWS = 4
BLOCK = 4096
#: Byte classes of the automata: the commonest bytes of the references, and one for all others.
CLASSES = 64
RESULTS = ("lang_pred", "score")


class SuffixAutomaton:
    """Automaton of all substrings of a sequence of classes, as a table ``next[state, class]`` (-1: none)."""

    def __init__(self, symbols: bytes, classes: int = CLASSES):
        room = 2 * len(symbols) + 2
        step = np.full((room, classes), -1, np.int32)
        link, length, last, states = [-1] * room, [0] * room, 0, 1
        for c in symbols:
            new, states = states, states + 1
            length[new] = length[last] + 1
            p = last
            while p >= 0 and step[p, c] < 0:
                step[p, c] = new
                p = link[p]
            if p < 0:
                link[new] = 0
            else:
                q = int(step[p, c])
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    clone, states = states, states + 1
                    step[clone], length[clone], link[clone] = step[q], length[p] + 1, link[q]
                    while p >= 0 and step[p, c] == q:
                        step[p, c] = clone
                        p = link[p]
                    link[q] = link[new] = clone
            last = new
        self.next = step[:states].copy()

    def parser(self) -> np.ndarray:
        """Flat table of the cross-parser: ``[state * classes + class]`` gives ``4 * (next state * classes)``
        plus the phrases that end there (0 to 2: a byte the reference lacks is a phrase of its own)."""
        classes, table = self.next.shape[1], self.next.astype(np.int64)
        absent = table < 0
        root = np.where(table[0] < 0, 0, table[0])
        ends = absent.astype(np.int64) + (absent & (self.next[0] < 0)[None, :])
        ends[0] = absent[0]
        return (np.where(absent, root[None, :], table) * classes * 4 + ends).ravel().astype(np.int32)


def _fold_table() -> np.ndarray:
    """Lower case of each ASCII letter, a space for other ASCII, bytes above as they are."""
    fold = np.arange(256, dtype=np.uint8)
    fold[:128] = 32
    fold[97:123] = fold[65:91] = np.arange(97, 123)
    return fold


FOLD = _fold_table()


def normalised(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes without the second and later spaces of a run, and the new ends of the texts."""
    folded, space, starts = FOLD[data], np.uint8(32), np.zeros(len(data) + 1, bool)
    starts[ends[:-1]] = True
    latin = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3) & (data[1:] != 0x97)) + 1
    folded[latin] += 32
    keep = folded != space
    keep[1:] |= folded[:-1] != space
    keep |= starts[:-1]
    return folded[keep], np.concatenate([[0], np.cumsum(keep, dtype=np.int32)])[ends].astype(np.int64)


def byte_classes(references: list[np.ndarray]) -> np.ndarray:
    """Class of each normalised byte: the commonest of all references, the rest together."""
    seen = sum((np.bincount(r, minlength=256) for r in references), np.zeros(256, np.int64))
    common = sorted(np.flatnonzero(seen), key=lambda b: (-seen[b], b))[:CLASSES - 1]
    table = np.full(256, CLASSES - 1, np.uint8)
    table[common] = np.arange(len(common))
    return table


@functools.lru_cache(maxsize=1)
def _model(references: tuple[tuple[str, bytes], ...]):
    """Byte classes and one parser table per language; built once per Python worker."""
    texts = [normalised(np.frombuffer(ref, np.uint8), np.array([0, len(ref)]))[0] for _, ref in references]
    classes = byte_classes(texts)
    parsers = [SuffixAutomaton(classes[t].tobytes()).parser() for t in texts]
    return classes, parsers, [math.log2(max(2, len(t))) for t in texts]


def phrases(data: np.ndarray, ends: np.ndarray, parser: np.ndarray) -> np.ndarray:
    """Phrases of each text (its classes in ``data``, cut at ``ends``) in one language."""
    lanes = Lanes(ends, BLOCK)
    state, count = np.zeros(len(lanes), np.int32), np.zeros(len(lanes), np.int64)
    for n, c in lanes.steps(data):
        found = parser[state[:n] + c]
        count[:n] += found & 3
        state[:n] = found >> 2
    count += state > 0
    return np.bincount(lanes.text, weights=count, minlength=len(ends) - 1).astype(float)


def _has_letter(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    upto = np.concatenate([[0], np.cumsum(ascii_letter, dtype=np.int32)])
    found = upto[ends[1:]] > upto[ends[:-1]]
    for i in np.flatnonzero(~found & (np.diff(ends) > 0)):
        found[i] = any(map(str.isalpha, data[ends[i]:ends[i + 1]].tobytes().decode()))
    return found


def _predict(text_col: str, references: tuple[tuple[str, bytes], ...], keep_text: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [name for name, _ in references]
        for batch in sliced(batches, text_col, 4 << 20):
            data, ends = text_buffer(batch.column(text_col))
            known = _has_letter(data, ends)
            lang, score = np.full(len(known), "und", object), np.zeros(len(known))
            if names:
                classes, parsers, cost = _model(references)
                folded, cuts = normalised(data, ends)
                found = [phrases(classes[folded], cuts, p) for p in parsers]
                bits = np.stack([n * c for n, c in zip(found, cost, strict=True)])
                best = bits.argmin(axis=0)
                gap = (bits - bits.min(axis=0)) / np.sqrt(np.maximum(1, np.stack(found).min(axis=0)))
                odds = np.exp2(-np.minimum(gap, 1000)).sum(axis=0)
                lang[known] = np.array(names, object)[best[known]]
                score[known] = 1 / odds[known]
            kept = [(f.name, batch.column(i)) for i, f in enumerate(batch.schema) if keep_text or f.name != text_col]
            yield pa.RecordBatch.from_arrays([*[c for _, c in kept], pa.array(lang, pa.string()), pa.array(score)],
                                             [*[n for n, _ in kept], *RESULTS])
    return run


def lettered(text_col: str) -> Column:
    """Whether a text has a letter (null: no)."""
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def _spread(text: Column, share: Column) -> Column:
    """``share`` bytes (about) of a text: all of a short one, else windows at even distances from its start to its end."""
    chars = F.length(text)
    size = F.greatest(F.floor(share * chars / F.octet_length(text) / WINDOWS).cast("int"), F.lit(1))
    at = lambda k: F.floor(k * (chars - size) / (WINDOWS - 1)).cast("int") + 1
    parts = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda k: text.substr(at(k), size))
    return F.when(F.octet_length(text) <= share, text).otherwise(F.concat_ws(" ", parts))


def references(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang") -> tuple[tuple[str, bytes], ...]:
    """The reference of each language, in order of names, from the bounded sample of labelled rows.

    Rows with a null label or a text without a letter teach nothing; of more than ``MOST_LANGUAGES`` labels the most
    frequent are learned (of equals the first names).  Rows are drawn by their id and text.  Two steps, so that no
    language is sorted as one group: rows are thinned by their draw to a few times the sample, then ranked.
    """
    key = F.concat(F.lit("reference:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.col(text_col))
    draw = (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(2 ** 52)
    rows = labelled.filter(F.col(lang_col).isNotNull() & lettered(text_col))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), draw.alias("draw"))
    work = Scratch(labelled.sparkSession, "langid")
    counts = work.write(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
                        .limit(MOST_LANGUAGES), "counts")
    thin = rows.join(F.broadcast(counts), "lang").filter(F.col("draw") < 4 * SAMPLE_ROWS / F.col("n"))
    per = Window.partitionBy("lang")
    sample = thin.withColumn("rank", F.row_number().over(per.orderBy("draw", "text"))).filter(F.col("rank") <= SAMPLE_ROWS)
    share = F.floor(F.lit(REFERENCE_BYTES) / F.count(F.lit(1)).over(per)).cast("int")
    sample = sample.withColumn("share", share).select("lang", "rank", _spread(F.col("text"), F.col("share")).alias("text"))
    joined: dict[str, bytes] = {}
    for row in sample.orderBy("lang", "rank").collect():
        joined[row["lang"]] = joined.get(row["lang"], b"") + row["text"].encode() + b"\n"
    return tuple(sorted(joined.items()))


def identify(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced.

    Only rows where ``learn_from`` holds are learned from; a prediction reads the text alone.  ``score`` is the
    winner's share when code lengths are read as probabilities, their gaps divided by the square root of the
    fewest phrases (phrases of one text aren't independent).  Null texts and texts without a
    letter are ``und`` with score 0, and so is everything if no row can be learned from.  Languages that
    tie go by name.  A text of any length is parsed whole; repeated rows are predicted each.  Without ``keep_text`` the
    text is left out.  An empty table gives an empty result.
    """
    model = references(docs.filter(learn_from), id_col, text_col, lang_col)
    docs = names_free(docs, *RESULTS)
    kept = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "lang_pred string, score double"])
    return docs.mapInArrow(_predict(text_col, model, keep_text), schema)
