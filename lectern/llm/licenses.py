"""Op 11. Licence scans by ordered signature rules.

A text becomes its words in lower case with one blank between two.  One pass of an Aho-Corasick automaton finds the
keywords; only the rules of keywords that are there are searched for.  Of the detections, one that lies inside another of
the same or a higher priority is suppressed, so "gpl 2 0" says nothing beside the whole notice it is part of.  Base
phrases are found by the same automaton at every place; they are never suppressed and suppress nothing.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import names_free, sliced, text_buffer
from .license_rules import MACROS, RULES

#: Kinds of rules: priority, and how sure a detection is.
KINDS = {"notice": (6, 0.99), "tag": (5, 0.98), "grant": (4, 0.95), "url": (3, 0.9), "name": (2, 0.85), "mention": (1, 0.6)}
#: Base phrases and how sure one is.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
BASE_SURE = 0.7
SLICE = 4 << 20
RESULTS = ("n_words", "detections", "score")

#: Letters (in lower case), digits and bytes of other characters; anything else as a blank.
WORDS = np.full(256, 32, np.uint8)
WORDS[48:58], WORDS[97:123], WORDS[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
WORDS[65:91] = WORDS[97:123]


@dataclass(frozen=True)
class Rule:
    label: str
    kind: str
    keyword: str
    pattern: re.Pattern

    @property
    def priority(self) -> int:
        return KINDS[self.kind][0]


@functools.lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, the highest priority first, then as they are written."""
    found = []
    for line in RULES.strip().splitlines():
        label, kind, keyword, pattern = line.split(" | ")
        for macro, value in MACROS.items():
            pattern = pattern.replace(macro, value)
        found.append(Rule(label, kind, keyword, re.compile(f"(?<= )(?:{pattern})(?= )")))
    return tuple(sorted(found, key=lambda r: -r.priority))


def normalise(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts, each with a blank on either side (a text without words: one blank); n + 1 offsets."""
    data, ends = text_buffer(column)
    size = np.diff(ends)
    whole = np.full(len(data) + 2 * len(size), 32, np.uint8)
    whole[np.arange(len(data)) + np.repeat(2 * np.arange(len(size)) + 1, size)] = WORDS[data]
    begin = ends[:-1] + 2 * np.arange(len(size))
    keep = np.ones(len(whole), bool)
    keep[1:] = (whole[1:] != 32) | (whole[:-1] != 32)
    keep[begin] = True
    upto = np.concatenate([[0], np.cumsum(keep)])
    return whole[keep], np.append(upto[begin], upto[-1])


def matches(text: str, tried: list[int] | range) -> list[tuple[int, int, int]]:
    """``(begin, end, rule)`` of the given rules in one normalised text."""
    return [(m.start(), m.end(), r) for r in tried for m in rules()[r].pattern.finditer(text)]


def unsuppressed(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Detections that don't lie inside another one of the same or a higher priority (of equals: the first rule's).

    One pass by begin, the longest first: whatever a detection lies in comes before it, and lies around it
    exactly if it ends no earlier.
    """
    kept, furthest = [], [-1] * (max(p for p, _ in KINDS.values()) + 1)
    for begin, end, rule in sorted(found, key=lambda x: (x[0], -x[1], x[2])):
        priority = rules()[rule].priority
        if furthest[priority] < end:
            kept.append((begin, end, rule))
            for p in range(priority + 1):            # it suppresses those of its priority and below
                furthest[p] = max(furthest[p], end)
    return kept


class Scanner:
    def __init__(self, base: tuple[tuple[str, str], ...] = BASE):
        import ahocorasick
        self.base, self.automaton = base, ahocorasick.Automaton()
        self.of_keyword: dict[str, list[int]] = {}
        for k, rule in enumerate(rules()):
            self.of_keyword.setdefault(rule.keyword, []).append(k)
        words = {phrase: (phrase, label) for phrase, label in base}
        for phrase in {*self.of_keyword, *words}:
            self.automaton.add_word(f" {phrase} ", (phrase, words.get(phrase, (None, None))[1]))
        self.automaton.make_automaton()

    def batch(self, column: pa.Array) -> tuple[np.ndarray, list[tuple[int, str, str, int, int, bool]], np.ndarray]:
        """Words of each text; ``(text, label, kind, first word, end word, base)``; how sure each text is."""
        whole, ends = normalise(column)
        blanks = np.flatnonzero(whole == 32)
        blanks_before = np.searchsorted(blanks, ends)
        n_words = np.diff(blanks_before) - 1
        joined = whole.tobytes().decode("latin-1")        # a character per byte; rules are plain ASCII
        tried: dict[int, set[int]] = {}
        rows, sure = [], np.zeros(len(column))
        hits = list(self.automaton.iter(joined))
        texts = np.searchsorted(ends, [end for end, _ in hits], "right") - 1

        def add(text: int, label: str, kind: str, begin: int, end: int, base: bool) -> None:
            first = int(np.searchsorted(blanks, begin) - blanks_before[text] - 1)
            rows.append((text, label, kind, first, first + joined.count(" ", begin, end) + 1, base))
            sure[text] = max(sure[text], BASE_SURE if base else KINDS[kind][1])

        for (end, (phrase, label)), text in zip(hits, texts.tolist()):
            if label is not None:
                add(text, label, "base", end - len(phrase), end, True)
            tried.setdefault(text, set()).update(self.of_keyword.get(phrase, ()))
        for text, some in tried.items():
            begin = int(ends[text])
            for a, b, r in unsuppressed(matches(joined[begin:int(ends[text + 1])], sorted(some))):
                add(text, rules()[r].label, rules()[r].kind, begin + a, begin + b, False)
        return n_words, rows, sure


@functools.lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


DETECTIONS = pa.struct([("label", pa.string()), ("kind", pa.string()), ("first", pa.int64()), ("end", pa.int64()),
                        ("base", pa.bool_())])


def _scan(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col, SLICE):
            n_words, rows, sure = scanner().batch(batch.column(text_col))
            rows.sort(key=lambda r: (r[0], r[3], r[4], r[1]))
            columns = [pa.array([r[k + 1] for r in rows], f.type) for k, f in enumerate(DETECTIONS)]
            offsets = np.searchsorted([r[0] for r in rows], np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, fields=list(DETECTIONS)))
            kept = [(f.name, batch.column(i)) for i, f in enumerate(batch.schema) if f.name != text_col]
            yield pa.RecordBatch.from_arrays([*[c for _, c in kept], pa.array(n_words.astype(np.int64)), lists, pa.array(sure)],
                                             [*[n for n, _ in kept], *RESULTS])
    return run


def find_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The other columns of ``docs`` and ``n_words, detections, score``, one row per row.

    ``detections``: label, kind of rule (``base`` for the base phrases), first word and end word (exclusive, from 0) and
    whether it is a base phrase; by place.  ``score``: how sure the surest detection is, 0 without any.  A null or empty
    text has no words and no detections; a text of any length is scanned whole; repeated rows are scanned each;
    two rules that match the same words give the one of higher priority, then the first written.  Input columns of the
    result names are replaced; an empty table gives an empty result.
    """
    docs = names_free(docs, *RESULTS)
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text_col]
    made = ["n_words long", "detections array<struct<label:string,kind:string,first:bigint,end:bigint,base:boolean>>",
            "score double"]
    return docs.mapInArrow(_scan(text_col), ", ".join([*types, *made]))
