from __future__ import annotations

import re

from lectern.llm import secret_scan as S
from lectern.llm.common import documents
from pyspark.sql import functions as F

from .conftest import as_rows

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|(?i:passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ALNUM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text or "") if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
    return sorted(found)


def draw(rng, n, letters=ALNUM):
    return "".join(rng.choices(letters, k=n))


def texts_with_secrets(rng):
    parts = ["password=", "PASSWD :'", 'token = "', "api_key:", "apikey=secret=", "AKIA" + draw(rng, 16, "ABCZ09"), "AKIA12",
             "ñandú", "é", "the ", "\n", draw(rng, 40, "0123456789abcdef"), draw(rng, 31, "0123456789abcdef"), draw(rng, 12), "😀", " ",
             "secret", "=", "token=secret:abcdefghij", 'token="secret":password'] + [draw(rng, 9) for _ in range(3)]
    out = [None, "", "😀" * 5 + "token=abcdefghij"] + ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(150)]
    return out + [("é token=" + draw(rng, 9) + " ") * 1300] * 2


def test_base_spans_equal_regular_expressions(spark, rng):
    texts = texts_with_secrets(rng)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = S.find_secrets(df)
    assert got.columns == ["doc_id", "spans"]
    for r in got.collect():
        spans = [(s["start"], s["kind"], s["end"]) for s in r["spans"]]
        assert [s for s in spans if s[1] < 3] == brute(texts[r["doc_id"]])
        assert spans == sorted(spans)
        for a, k, b in spans:
            assert k < 3 or all(b <= x or y <= a for x, j, y in spans if j < 3)


def test_markov_models_find_keys_without_a_pattern(spark, rng):
    """Trained by the driver's documents, on keys planted in some of them."""
    docs = documents(spark, "/root/testdata/sf0.01").select("doc_id", "text")
    planted = {i: rng.choice([f"ghp_{draw(rng, 36)}", draw(rng, 43), f"sk-{draw(rng, 48)}"]) for i in range(0, 1000, 20)}
    known = spark.createDataFrame([(5000 + i, f"password={draw(rng, 20)} x AKIA{draw(rng, 16, ALNUM[26:])}") for i in range(60)],
                                  docs.schema)
    keys = spark.createDataFrame(list(planted.items()), "doc_id long, key string")
    rows = docs.join(keys, "doc_id", "left").withColumn("text", F.concat_ws(" ", "text", "key")).drop("key").union(known)
    texts = dict(as_rows(rows, "doc_id", "text"))
    found = {}
    for r in S.find_secrets(rows).collect():
        found[r["doc_id"]] = [texts[r["doc_id"]][s["start"]:s["end"]] for s in r["spans"] if s["kind"] == 3]
    assert sum(planted[i] in found[i] for i in planted) >= 0.95 * len(planted)
    clean = [i for i in found if i not in planted]
    assert sum(bool(found[i]) for i in clean) <= 0.005 * len(clean)


def test_labelled_sample_may_be_given(spark, rng):
    words = documents(spark, "/root/testdata/sf0.01").select(F.explode(F.split("text", "[^A-Za-z]+")).alias("value")).distinct()
    sample = words.withColumn("random", F.lit(False)).union(spark.createDataFrame(
        [(draw(rng, 30), True) for _ in range(300)] + [("a", True), ("", False)], "value string, random boolean"))
    df = spark.createDataFrame([(1, "see " + draw(rng, 40) + " there"), (2, "see " + "thering" * 4)], "doc_id long, text string")
    kinds = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in S.find_secrets(df, sample=sample).collect()}
    assert kinds == {1: [3], 2: []}
    untaught = S.find_secrets(df, sample=sample.filter("random"))
    assert not any(r["spans"] for r in untaught.collect())


IDENTIFIERS = ["HTTP_STATUS_INTERNAL_SERVER_ERROR", "2024-01-15-backup-production-server", "com/example/project/src/main/java/org",
               "get_user_account_by_identifier", "ApplicationContextFactoryBuilder", "my-very-long-kebab-case-name",
               "articles/2021-07-03/the-history-of-tea", "MAX_CONNECTION_TIMEOUT_SECONDS", "internationalization", "test_empty_table_and_null_rows",
               "UserAuthenticationServiceImpl", "lib/python/site-packages/numpy/core"]


def test_keys_inside_longer_runs(spark, rng):
    """Keys joined to an AKIA key or inside a path are found, within two characters; identifiers aren't."""
    docs = documents(spark, "/root/testdata/sf0.01").select("doc_id", "text")
    known = [(5000 + i, f"password={draw(rng, 20)} x AKIA{draw(rng, 16, ALNUM[26:])}") for i in range(60)]
    joined = {10_000 + i: draw(rng, 24) for i in range(50)}
    paths = {20_000 + i: draw(rng, 24) for i in range(50)}
    rows = ([(i, f"see AKIA{draw(rng, 16, 'ABCDEFGHXYZ0123456789')}-{k} there") for i, k in joined.items()]
            + [(i, f"get https://example.com/articles/about/{k}/index now") for i, k in paths.items()]
            + [(30_000 + i, f"the {name} here") for i, name in enumerate(IDENTIFIERS)])
    df = docs.union(spark.createDataFrame(known + rows, docs.schema))
    texts = dict(rows)
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == 3]
             for r in S.find_secrets(df).filter("doc_id >= 10000").collect()}
    for keys, least in ((joined, 50), (paths, 48)):
        hits = 0
        for i, key in keys.items():
            at = texts[i].index(key)
            hits += any(abs(a - at) <= 2 and abs(b - at - len(key)) <= 2 for a, b in found[i])
        assert hits >= least, hits
    flagged = [IDENTIFIERS[i - 30_000] for i, spans in found.items() if i >= 30_000 and spans]
    assert len(flagged) <= 1, flagged


def test_best_stretch_equals_brute_force(spark, rng):
    ratio = [rng.uniform(-1, 1) for _ in range(S.WIDTH ** 2)]
    values = ["".join(rng.choices(S.ALPHABET, k=rng.randint(2, 40))) for _ in range(60)] + ["aé", "ab"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", S.best_stretch(F.col("v"), ratio).alias("b"))
    for r in df.collect():
        c = [S.ALPHABET.find(x) + 1 for x in r["v"]]
        t = [ratio[a * S.WIDTH + b] for a, b in zip(c, c[1:])]
        best = max(sum(t[i:j + 1]) for i in range(len(t)) for j in range(i, len(t)))
        assert abs(r["b"]["score"] - best) < 1e-9
        assert abs(sum(t[r["b"]["first"]:r["b"]["last"] + 1]) - best) < 1e-9


def test_candidates_are_what_base_spans_leave(spark, rng):
    rows = [(i, "".join(rng.choice(["token=", draw(rng, 20), "AKIA" + draw(rng, 16, "ABC123"), "-", " ", draw(rng, 40, "0123456789abcdef")])
                        for _ in range(8))) for i in range(80)]
    got = S.scan(spark.createDataFrame(rows, "doc_id long, text string"), "text").select("doc_id", "__cand").collect()
    for r in got:
        text = dict(rows)[r["doc_id"]]
        taken = {i for a, _, b in brute(text) for i in range(a, b)}
        want = []
        for m in re.finditer(S.CANDIDATE, text):
            free = "".join("." if i in taken else text[i] for i in range(*m.span()))
            want += [(m.start() + x.start(), m.start() + x.end()) for x in re.finditer(r"[^.]+", free) if len(x[0]) >= 16]
        assert [(c["start"], c["end"]) for c in r["__cand"]] == want
        assert all(c["value"] == text[c["start"]:c["end"]] for c in r["__cand"])


def test_spelling_empty_table_and_no_python(spark):
    spans = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(5).alias("start"), F.lit(9).alias("end")) for k in (0, 3)])
    assert spark.range(1).select(S.spelled(spans)).first()[0] == "assign:5:9,random:5:9"
    df = spark.createDataFrame([(1, "token=abcdefghij")], "doc_id long, text string")
    found = S.find_secrets(df)
    assert not any(w in found._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Pandas", "Arrow"))
    assert as_rows(S.find_secrets(df.limit(0)), "spans") == []


def test_running_sums_of_long_arrays(spark):
    got = spark.range(1).select(S.before(F.transform(F.sequence(F.lit(1), F.lit(1500)), lambda x: x.cast("long")))).first()[0]
    assert got == [i * (i + 1) // 2 for i in range(1500)]
