from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from lectern.llm import align as A
from lectern.llm import queries

from .conftest import prose

COLUMNS = ["doc_id", *A.RESULTS]


@pytest.fixture(scope="module")
def vocabularies():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A.place(A.VOCABULARY_A))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=A.place(A.VOCABULARY_B))


def char_bytes():
    """Byte-level characters written out from their public definition."""
    known = {chr(b): b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    rest = [b for b in range(256) if b not in known.values()]
    return known | {chr(256 + k): b for k, b in enumerate(rest)}


def tokens(text, vocabularies):
    a, b = vocabularies
    to_byte = char_bytes()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = []
    for i in ids_b:
        p = b.id_to_piece(i)
        bytes_b.append(bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode())
    return ids_a, bytes_a, ids_b, bytes_b


def brute(rows, vocabularies):
    """Whole texts, token by token; all pairs of tokens whose ranges overlap."""
    docs, links = [], Counter()
    for doc, text in rows:
        ids_a, bytes_a, ids_b, bytes_b = tokens(text, vocabularies) if text else ([], [], [], [])
        whole = (" " + text).encode() if text else b""
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            ids_a = ids_b = bytes_a = bytes_b = []
        ends = [np.cumsum([len(x) for x in s]).tolist() if s else [] for s in (bytes_a, bytes_b)]
        mine, groups, i, j = [], [], 0, 0
        for x, a in enumerate(ids_a):
            for y, b in enumerate(ids_b):
                if min(ends[0][x], ends[1][y]) > max(ends[0][x] - len(bytes_a[x]), ends[1][y] - len(bytes_b[y])):
                    mine.append((a, b))
        for end in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(map(str, ids_a[i:x])) + "|" + ",".join(map(str, ids_b[j:y])))
            i, j = x, y
        links.update(mine)
        docs.append((doc, len(ids_a), len(ids_b), groups, mine))
    top = {}
    for (_, b), n in links.items():
        top[b] = max(top.get(b, 0), n)
    return [(doc, n_a, n_b, len(groups), len(mine), sum(links[p] == top[p[1]] for p in mine), sum(links[p] for p in mine),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for doc, n_a, n_b, groups, mine in docs]


ODD = ["", None, " ", "  two  blanks ", "a\tb\n\nc", "x▁y", "naïve façade", "<|endoftext|> <s> </s> <unk>", "don't we'll",
       "  　 z", "日本語のテキスト 😀😀", "a\x00b", "A" * 300, "1234567 89", "!!! ... ???", "ﬁ ½ é", " \n ", "a   b",
       "x   y", "é  è"]


@pytest.mark.parametrize("radix, fan_in", [(A.RADIX, A.FAN_IN), (3, 2)])
def test_rows_equal_brute_force(spark, rng, vocabularies, radix, fan_in):
    texts = ODD + [prose(rng, rng.randint(0, 60)) for _ in range(40)] + ["the same text"] * 4
    rows = list(enumerate(texts)) + [(None, "the same text"), (3, "a b")]
    df = spark.createDataFrame([(d, t, "own", 5) for d, t in rows], "doc_id long, text string, n_a string, __run int").repartition(6)
    got = A.align(df, radix=radix, fan_in=fan_in)
    assert "__run" in got.columns                                 # a column of the input stays, whatever its name
    rows_got = [tuple(r[c] for c in COLUMNS) for r in got.collect()]
    assert sorted(rows_got, key=repr) == sorted(brute(rows, vocabularies), key=repr)


def test_query_equals_brute_force(spark, vocabularies):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    small = [(d, t) for d, t in rows if len(t or "") < 4000]
    docs = spark.createDataFrame(small, "doc_id long, text string")
    got = [tuple(r[c] for c in COLUMNS) for r in A.align(docs).select(*COLUMNS).collect()]
    assert sorted(got, key=repr) == sorted(brute(small, vocabularies), key=repr)
    assert queries.QUERIES["op12_align"](spark, sf).count() == len(rows)


def test_an_empty_table(spark):
    assert A.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    none = A.align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert {(r.n_links, r.count_sum, r.groups_sha256) for r in none} == {(0, 0, "")}


def test_units_are_remembered_within_bounds(monkeypatch, rng):
    monkeypatch.setattr(A, "REMEMBERED", 10)
    import pyarrow as pa
    of = A.Texts(A.VOCABULARY_A, A.VOCABULARY_B)
    texts = [prose(rng, 30) for _ in range(10)]
    one = of.batch(pa.array(texts))
    again = of.batch(pa.array(texts))
    assert one[0]["groups_sha256"] == again[0]["groups_sha256"]
    assert (one[1][one[2]] == again[1][again[2]]).all() and (one[3] == again[3]).all()
    assert len(of.known) <= 10 + len({u for t in texts for u in t.split(" ")})


def test_ranks_give_what_merges_give(rng):
    a = A.ByteLevel(A.place(A.VOCABULARY_A))
    assert a.ranked is not None
    letters = "etaoinshrdlucmfwypvbgkqjxz'0159éß.,-"
    units = [" " + "".join(rng.choice(letters) for _ in range(rng.randint(0, 20))) + rng.choice("abc.,!") for _ in range(5000)]
    size = np.array([len(u.encode()) for u in units])
    ids, counts = a.encode(units, size, True)
    slow, slow_counts = a.encode(units, size, False)
    assert (ids == slow).all() and (counts == slow_counts).all()


def test_heap_merge_and_blocks():
    rng = np.random.default_rng(1)
    runs = [np.unique(rng.integers(0, 1 << 45, 50)) for _ in range(7)]
    runs.append(runs[0])
    blocks = [A.pack(np.diff(r, prepend=0), np.full(len(r), k + 1)) for k, r in enumerate(runs)]
    want = Counter()
    for k, r in enumerate(runs):
        for x in r.tolist():
            want[x] += k + 1
    pairs, sums = A.merge(blocks)
    assert pairs.tolist() == sorted(want) and sums.tolist() == [want[p] for p in sorted(want)]
