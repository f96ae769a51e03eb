"""Op 8. Secret scan: patterns, and Markov models of characters (DataFrame functions only).

Patterns find assignments, access keys and hex strings.  The method adds spans: strings of ``CANDIDATE`` characters, what the
patterns found cut out of them, are read by two Markov models of characters, one of random strings and one of
ordinary identifiers.  Their best-scoring stretch is reported if its log-likelihood ratio is high, in sum and per
character; a few characters up to the next ``/`` or ``=`` (or the end) belong to it.  Plain numbers are no keys.

The models are trained from labelled samples.  By default the table labels itself: what the patterns found is random; the
words that documents share outside of them are ordinary, and so are the identifiers that are made of such words
(snake, kebab and camel case, constants, paths, dated names).  The samples are bounded (``SAMPLE_VALUES`` distinct
values with the smallest MD5, the words of about ``SAMPLE_DOCS`` documents with the smallest draw from id and text);
everything else covers all rows.
A model is a table of ``len(ALPHABET) + 1`` squared transitions, whatever the input.

Every text is scanned once: the spans with their strings are written to the shared folder, and the sample, the models and
the decision read those.  Positions come from splitting at the matches: a match starts after all gaps and
matches before it.  No row is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, names_free

#: Patterns and the least length of the deciding group (fixed values of the contract).
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]{32,})"
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: Strings that the models read, and words that they learn from.
CANDIDATE = r"([A-Za-z0-9+/=_-]{16,})"
ORDINARY = r"([A-Za-z][A-Za-z0-9_-]{5,})"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/=_-"
WIDTH = len(ALPHABET) + 1
BACKOFF = 8.0
SAMPLE_VALUES = 20_000
SAMPLE_DOCS = 2_000
#: Least log-likelihood ratio in nats, in sum and per transition.
LEAST_SUM, LEAST_MEAN = 33.0, 1.5
#: Least characters of a candidate and of its stretch, and most characters by which a stretch is rounded up to its token.
LEAST_CHARS, LEAST_STRETCH, ROUNDED = 16, 14, 4
SPANS = "array<struct<kind:int,start:bigint,end:bigint>>"
RESULTS = ("spans",)
BLOCK = 512


def before(lengths: Column) -> Column:
    """Sum of all elements before each one (two levels of blocks, so long arrays stay cheap)."""
    add = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, x: n + x)
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: add(F.slice(lengths, b * BLOCK + 1, BLOCK)))
    bases = F.transform(sums, lambda _, i: add(F.slice(sums, F.lit(1), i)))
    within = lambda i: add(F.slice(lengths, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK))
    return F.transform(lengths, lambda _, i: F.get(bases, F.floor(i / BLOCK).cast("int")) + within(i))


def found(rows: DataFrame, text: str, pattern: str, into: str) -> DataFrame:
    """``rows`` with ``into``: the matches of ``pattern`` as (start, end, value); its group 1 is the value."""
    match, value, gap = f"__{into}_m", f"__{into}_v", f"__{into}_g"
    p = F.lit(pattern)
    rows = rows.withColumn(match, F.regexp_extract_all(text, p, F.lit(0)))
    some = F.size(match) > 0
    rows = rows.withColumns({value: F.when(some, F.regexp_extract_all(text, p, F.lit(1))),
                             gap: F.when(some, F.split(text, pattern, -1))})
    steps = F.zip_with(match, gap, lambda m, g: F.coalesce(F.length(g), F.lit(0)) + F.coalesce(F.length(m), F.lit(0)))
    rows = rows.withColumn(f"{gap}n", F.when(some, F.slice(steps, F.lit(1), F.size(match))))
    rows = rows.withColumn(f"{gap}s", F.when(some, before(F.col(f"{gap}n"))))
    spans = F.transform(F.sequence(F.lit(0), F.size(match) - 1), lambda i: F.struct(
        (F.get(f"{gap}s", i) + F.length(F.get(gap, i))).cast("long").alias("start"),
        (F.get(f"{gap}s", i) + F.get(f"{gap}n", i)).cast("long").alias("end"), F.get(value, i).alias("value")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return rows.withColumn(into, F.when(some, spans).otherwise(none)).drop(match, value, gap, f"{gap}n", f"{gap}s")


def _at_least(spans: str, n: int) -> Column:
    return F.filter(spans, lambda s: F.length(s["value"]) >= n)


def _of_kind(spans: str, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def scan(docs: DataFrame, text_col: str) -> DataFrame:
    """The columns of ``docs`` without its text, with the spans of each kind and the candidates outside them."""
    rows = docs.withColumn("__text", F.coalesce(text_col, F.lit(""))).drop(*({text_col} - {"__text"}))
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("cand", CANDIDATE)):
        rows = found(rows, "__text", pattern, f"__{kind}")
        if kind in LEAST:
            rows = rows.withColumn(f"__{kind}", _at_least(f"__{kind}", LEAST[kind]))
    base = F.concat("__assign", "__access", "__hex")
    whole = F.transform("__cand", lambda c: outside(c, base))
    rows = rows.withColumn("__cand", F.when(F.size("__cand") > 0, F.filter(
        F.flatten(whole), lambda c: F.length(c["value"]) >= LEAST_CHARS)).otherwise(F.col("__cand")))
    return rows.drop("__text")


def outside(c: Column, base: Column) -> Column:
    """The pieces of a candidate that no base span touches."""
    hit = F.array_sort(F.filter(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    upto = F.transform(hit, lambda _, i: F.array_max(F.transform(F.slice(hit, F.lit(1), i + 1), lambda b: b["end"])))
    starts = F.concat(F.array(c["start"]), F.transform(upto, lambda e: F.greatest(e, c["start"])))
    stops = F.concat(F.transform(hit, lambda b: F.least(b["start"], c["end"])), F.array(c["end"]))
    piece = lambda a, b: F.struct(a.alias("start"), b.alias("end"), c["value"].substr(
        (a - c["start"] + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int")).alias("value"))
    return F.zip_with(starts, stops, piece)


def labelled_sample(docs: DataFrame, scanned: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``value, random``: distinct strings that the patterns found, and distinct words that documents share."""
    known = scanned.select(F.explode(F.concat("__assign", "__access", "__hex")).alias("s")).select(
        F.col("s.value").alias("value")).distinct().orderBy(F.md5("value")).limit(SAMPLE_VALUES)
    n = max(1, docs.count())
    text = F.coalesce(text_col, F.lit(""))
    key = F.concat(F.lit("ordinary:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text)
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long").cast("double") / float(2 ** 52)
    some = docs.select(text.alias("t"), draw.alias("draw")).filter(F.col("draw") < SAMPLE_DOCS / n)
    plain = some
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = plain.withColumn("t", F.regexp_replace("t", pattern, " "))
    # An identifier is ordinary if two documents of the sample have it (a secret is in one, as a rule).
    usual = plain.select(F.explode(F.array_distinct(F.regexp_extract_all("t", F.lit(ORDINARY), F.lit(1)))).alias("value"))
    usual = usual.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("value")
    usual = usual.orderBy(F.md5("value")).limit(SAMPLE_VALUES)
    usual = usual.unionByName(identifiers(usual))
    return known.withColumn("random", F.lit(True)).unionByName(usual.withColumn("random", F.lit(False)))


def identifiers(words: DataFrame) -> DataFrame:
    """An identifier of each of (at most ``SAMPLE_VALUES``) words, made of it and the two words that follow in MD5 order."""
    order = Window.partitionBy().orderBy(F.md5("value"))
    rows = words.select(F.col("value").alias("a"), F.lead("value", 1, "").over(order).alias("b"),
                        F.lead("value", 2, "").over(order).alias("c"))
    day = F.date_format(F.date_add(F.lit("2000-01-01"), F.pmod(F.xxhash64("a", "b"), F.lit(10_000)).cast("int")), "yyyy-MM-dd")
    joined = lambda mark, how: F.concat_ws(mark, *[how(F.col(k)) for k in "abc"])
    forms = [joined("_", F.lower), joined("-", F.lower), joined("_", F.upper), joined("/", F.lower), joined("", F.initcap),
             joined("-", F.upper), F.concat_ws("-", day, F.lower("a")), F.concat_ws("/", F.lower("a"), day, F.lower("b"))]
    return rows.select(F.get(F.array(*forms), F.pmod(F.xxhash64("a"), F.lit(len(forms))).cast("int")).alias("value"))


def codes(value: Column) -> Column:
    """Number of each character in ``ALPHABET`` from 1, 0 for others."""
    return F.transform(F.sequence(F.lit(1), F.length(value)),
                       lambda i: F.instr(F.lit(ALPHABET), F.substring(value, i, F.lit(1))))


def transitions(value: Column) -> Column:
    """Numbers of the transitions in a string of two characters or more."""
    c = codes(value)
    return F.zip_with(F.slice(c, F.lit(1), F.length(value) - 1), F.slice(c, F.lit(2), F.length(value) - 1),
                      lambda a, b: a * WIDTH + b)


def _model(counts: dict[int, int], spread: float) -> list[float]:
    """Probability of each transition.  A character's successors are smoothed by ``BACKOFF`` observations of how often
    characters are successors at all; that by one half of each, mixed with the uniform distribution by ``spread``."""
    total, follows, starts = sum(counts.values()), [0.5] * WIDTH, [0] * WIDTH
    for t, n in counts.items():
        starts[t // WIDTH] += n
        follows[t % WIDTH] += n
    follows = [(1 - spread) * f / (total + WIDTH / 2) + spread / WIDTH for f in follows]
    return [(counts.get(a * WIDTH + b, 0) + BACKOFF * follows[b]) / (starts[a] + BACKOFF)
            for a in range(WIDTH) for b in range(WIDTH)]


def train(sample: DataFrame) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of each transition, from ``value, random``.  Without an ordinary string
    there is nothing to tell random ones from, and every ratio is 0.

    The random model is spread half way to the uniform distribution, as random strings of the sample may use fewer
    characters than random strings do; without any it is uniform.
    """
    rows = sample.filter(F.length("value") > 1).select("random", F.explode(transitions(F.col("value"))).alias("t"))
    counts: dict[bool, dict[int, int]] = {True: {}, False: {}}
    for r in rows.groupBy("random", "t").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["random"]][r["t"]] = r["n"]
    if not counts[False]:
        return [0.0] * (WIDTH * WIDTH)
    return [math.log(p) - math.log(q) for p, q in zip(_model(counts[True], 0.5), _model(counts[False], 0.0), strict=True)]


def best_stretch(value: Column, ratio: list[float]) -> Column:
    """The stretch of a string with the largest sum of log-likelihood ratios: ``score, first, last`` (its first and last
    transition, from 0; the earliest of equals)."""
    table = F.split(F.lit(",".join(map(repr, ratio))), ",").cast("array<double>")
    start = F.struct(F.lit(float("-inf")).alias("score"), F.lit(0).alias("first"), F.lit(0).alias("last"),
                     F.lit(0.0).alias("sum"), F.lit(0).alias("begin"), F.lit(0).alias("at"))

    def step(x: Column, t: Column) -> Column:
        s, on = F.get(table, t), x["sum"] > 0
        now, begin = F.when(on, x["sum"] + s).otherwise(s), F.when(on, x["begin"]).otherwise(x["at"])
        better = now > x["score"]
        return F.struct(F.when(better, now).otherwise(x["score"]).alias("score"),
                        F.when(better, begin).otherwise(x["first"]).alias("first"),
                        F.when(better, x["at"]).otherwise(x["last"]).alias("last"),
                        now.alias("sum"), begin.alias("begin"), (x["at"] + 1).alias("at"))
    return F.aggregate(transitions(value), start, step, lambda x: F.struct(x["score"], x["first"], x["last"]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: DataFrame | None = None) -> DataFrame:
    """The other columns of ``docs`` and ``spans``, an array of (kind, start, end) in order of start, then kind.

    ``kind`` counts in ``KINDS``; positions are code points, the end exclusive.  Base kinds are leftmost non-overlapping
    matches each; ``random`` spans overlap none of them.  A text of any length is scanned whole, repeated rows each.  ``sample`` (``value, random``): labelled strings to learn
    from instead of the table's own.  Null and empty texts have no spans; an input column ``spans`` is
    replaced; an empty table gives an empty result.
    """
    work = Scratch(docs.sparkSession, "secrets")
    docs = names_free(docs, *RESULTS)
    scanned = work.write(scan(docs, text_col), "scanned")
    ratio = train(labelled_sample(docs, scanned, id_col, text_col) if sample is None else sample)

    def scored(c: Column) -> Column:
        return F.struct(c["start"].alias("start"), c["value"].alias("value"), best_stretch(c["value"], ratio).alias("best"))

    def secret(c: Column) -> Column:
        steps = c["best"]["last"] - c["best"]["first"] + 1
        inside = c["value"].substr(c["best"]["first"] + 1, steps + 1)
        return (inside.rlike("[A-Za-z]") & (steps + 1 >= LEAST_STRETCH)
                & (c["best"]["score"] >= F.greatest(F.lit(LEAST_SUM), LEAST_MEAN * steps)))

    def span(c: Column) -> Column:
        first, end = c["best"]["first"], c["best"]["last"] + 2          # characters of the stretch
        size = F.length(c["value"])
        left = F.length(F.regexp_extract(c["value"].substr(F.lit(1), first), "([^/=]*)$", 1))
        right = F.length(F.regexp_extract(c["value"].substr(end + 1, size), "^([^/=]*(?:=+$)?)", 1))
        rounded = lambda n: F.when(n <= ROUNDED, n).otherwise(0)
        return F.struct((c["start"] + first - rounded(left)).cast("long").alias("start"),
                        (c["start"] + end + rounded(right)).cast("long").alias("end"), c["value"].alias("value"))

    found_ = F.transform(F.filter(F.transform("__cand", scored), secret), span)
    rows = scanned.withColumn("__random", F.when(F.size("__cand") > 0, found_).otherwise(F.col("__cand")))
    spans = F.concat(*[_of_kind(f"__{kind}", n) for n, kind in enumerate(KINDS)])
    spans = F.transform(F.array_sort(spans), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                                s["end"].alias("end")))
    return rows.withColumn("spans", spans.cast(SPANS)).drop(*[f"__{k}" for k in (*KINDS, "cand")])


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
