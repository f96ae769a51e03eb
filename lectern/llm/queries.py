"""Registered queries ``opN_<name>`` and their DuckDB twins, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, exact, fingerprints, langid, licenses, mixing, packing, phrases, ppm, repeats, secret_scan, shard, simhash
from .common import Scratch, documents, fold, words

#: Production parameters of op 1.
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
SLOTS = 65_537


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placement of every document: ``doc_id, slot, shard``."""
    return shard.assign_shards(documents(spark, sf_dir).select("doc_id"), ["doc_id"], SHARDS, SLOTS)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, at most 3 differing bits."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=3, radius=3).select("doc_id", "fingerprint", "component_id")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that aren't held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", fold("doc_id", 2, 4))
    return langid.identify(docs, ~F.col("held_out")).select("doc_id", "held_out", "lang_pred", "score")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(documents(spark, sf_dir).select("doc_id", "text"), vocabulary="word_bpe_49k.json", capacity=2048)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical texts over all documents."""
    docs = documents(spark, sf_dir)
    return exact.exact_dedup(docs, folder=f"{sf_dir}/documents.parquet", columns=["doc_id"]).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of strings of 400 bytes that occur more than once."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return repeats.remove_repeats(docs, length=400, keep_bytes=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a PPM model and by a unigram model of the training documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return ppm.score_texts(docs, fold("doc_id", 2, 7), columns=["doc_id"])


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = secret_scan.find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda n: F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")
    base = secret_scan.spelled(F.filter("spans", lambda s: s["kind"] < 3))
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(F.encode(base, "UTF-8"), 256).alias("base_sha256"),
                        secret_scan.spelled(F.col("spans")).alias("spans"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.fingerprint(documents(spark, sf_dir).select("doc_id", "text"), columns=["doc_id"])


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all sources: words taken of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "source", words(F.col("text")).alias("size"))
    docs = Scratch(spark, "mix").write(docs, "sizes")
    return mixing.mix(docs, F.col("size")).select("doc_id", "size", "source_size", "target", "copies", "taken")


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that all documents name, state or hold."""
    found = licenses.find_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("detections", lambda d: d["base"])
    labels = lambda some: F.array_join(F.sort_array(F.array_distinct(F.transform(some, lambda d: d["label"]))), ",")
    place = F.transform(base, lambda d: d["first"])
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                        F.array_min(place).alias("first_word"), F.array_max(place).alias("last_word"),
                        labels(base).alias("base_labels"), labels(F.col("detections")).alias("labels"), "score")


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents by two vocabularies, aligned, and how frequent their linked pairs are."""
    found = align.align(documents(spark, sf_dir).select("doc_id", "text"), vocabulary_a="byte_bpe_50k.json",
                        vocabulary_b="piece_bpe_32k.model")
    return found.select("doc_id", *align.RESULTS)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of two or three words of each language."""
    return phrases.top_collocations(documents(spark, sf_dir).select("lang", "text"), least=10, cover=50, limit=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_shard, op2_simhash, op3_language, op4_pack, op5_exact_dedup, op6_repeats, op7_ppm, op8_secrets,
        op9_fingerprints, op10_mix, op11_licenses, op12_align, op13_collocations)}


def _sql_op1() -> str:
    owner = shard.lookup_table(SHARDS, SLOTS)
    return f"""
    WITH placed AS (
      SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, chr(0))), 1, 15))::BIGINT % {SLOTS} AS slot
      FROM documents),
    owner AS (SELECT {owner} AS shards)
    SELECT doc_id, slot, format('shard-{{:03d}}', shards[slot + 1]) AS shard FROM placed, owner"""


SQL_OP5 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

SQL_OP10 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::BIGINT AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / w AS ratio,
         sum(source_size) OVER ()::DOUBLE AS total FROM per),
levels AS (
  SELECT *, (total - (sum(cap) OVER (ORDER BY ratio, source IS NULL, source ROWS UNBOUNDED PRECEDING) - cap)::DOUBLE)
            / sum(w) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE
            AS level
  FROM filled),
targets AS (
  SELECT source, source_size, w,
         least(cap::DOUBLE, coalesce(max(CASE WHEN level <= ratio THEN level END) OVER () * w, cap::DOUBLE)) AS target
  FROM levels),
rated AS (
  SELECT s.*, t.source_size, t.target, least(CASE WHEN t.source_size > 0 THEN t.target / t.source_size * 1.0::DOUBLE
                                                  ELSE 0.0::DOUBLE END, 3.0::DOUBLE) AS hope
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, floor(hope)::BIGINT AS whole, hope - floor(hope)::BIGINT AS p,
         CASE WHEN hope - floor(hope)::BIGINT > 0
              THEN (u / (1 - u)) / ((hope - floor(hope)::BIGINT) / (1 - (hope - floor(hope)::BIGINT))) END AS q
  FROM rated),
running AS (
  SELECT *, target - sum(whole * size) OVER (PARTITION BY source)::DOUBLE AS rest,
         coalesce(sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (
           PARTITION BY source ORDER BY coalesce(q / (1 + q), 1.0), doc_id NULLS FIRST, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before
  FROM ranked),
cut AS (SELECT *, (whole + CASE WHEN p > 0 AND before + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END)::INTEGER AS copies
        FROM running)
SELECT doc_id, size, source_size, target, copies, (copies * size)::BIGINT AS taken FROM cut"""

SQL_OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
worded AS (SELECT lang, id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM numbered),
next AS (SELECT lang, x, lead(x) OVER run AS y, lead(x, 2) OVER run AS z FROM worded WINDOW run AS (PARTITION BY id ORDER BY i)),
grams AS (
  SELECT lang, 1 AS k, x AS phrase FROM next
  UNION ALL SELECT lang, 2, x || ' ' || y FROM next WHERE y IS NOT NULL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM next WHERE z IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT *, 1 AS cut, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM candidates
  UNION ALL SELECT *, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE k = 3),
rated AS (
  SELECT c.*, l.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.x AND l.k = c.cut
  JOIN f r ON r.lang = c.lang AND r.phrase = c.y AND r.k = c.k - c.cut),
lowest AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, part, max(a) AS f FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM candidates WHERE k = 3)
  GROUP BY ALL),
kept AS (
  SELECT b.* FROM lowest b LEFT JOIN inside i ON b.lang = i.lang AND b.phrase = i.part
  WHERE i.f IS NULL OR 100 * i.f < 50 * b.a)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang) WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000"""

SQL: dict[str, str] = {"op1_shard": _sql_op1(), "op5_exact_dedup": SQL_OP5, "op10_mix": SQL_OP10,
                       "op13_collocations": SQL_OP13}
