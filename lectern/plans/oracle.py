"""DuckDB twins of the registered queries (the correctness oracle).

Each query is plain SQL over the driver's pre-registered views.  The star
mapping is written once as CTEs (``_CTE``) and each query selects from them.
Rules (SURVEY §5): every column aliased, doubles stay DOUBLE, no
``current_*`` columns, total tie-breaks in ``ROW_NUMBER``/``LIMIT``, ranks as
INTEGER, sums cast to BIGINT (DuckDB widens them to HUGEINT).
"""

from __future__ import annotations

import hashlib

def R(expr: str, digits: int) -> str:
    """Spark's ``round`` on a double: HALF_UP on its shortest decimal text.

    DuckDB's ``round(double)`` scales in binary, so 0.15385 (stored just
    below) gives 0.1538 where Spark, and the reference's decimal arithmetic,
    give 0.1539.  Rounding the decimal text reproduces Spark exactly.
    """
    return (f"CAST(round(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), "
            f"{digits}) AS DOUBLE)")


SEGMENTS = ("automobile", "building", "furniture", "household", "machinery")
GENRE_COLS = [f"genre_{s}" for s in SEGMENTS]

# The page bands of SURVEY §1.5-1 (the first match wins), as length_score and length_category.
_BANDS = ((200, 400, 1.0, "ideal"), (400, 600, 0.8, "good"), (100, 200, 0.6, "short"), (600, 800, 0.4, "long"))


def _banded(unknown: str, values: list[str], other: str) -> str:
    whens = " ".join(f"WHEN num_pages BETWEEN {lo} AND {hi} THEN {v}" for (lo, hi, *_), v in zip(_BANDS, values))
    return f"CASE WHEN num_pages IS NULL THEN {unknown} {whens} ELSE {other} END"


LENGTH_BANDS = (
    _banded("CAST(0.5 AS DOUBLE)", [f"CAST({b[2]} AS DOUBLE)" for b in _BANDS], "CAST(0.2 AS DOUBLE)") + " AS length_score, "
    + _banded("'unknown'", [f"'{b[3]}'" for b in _BANDS], "'very_long'") + " AS length_category")

_BASE = {
    "line_agg": """
        SELECT l_partkey, l_suppkey, false AS newest, sum(l_quantity) AS sum_q, count(*) AS n_lines
        FROM lineitem GROUP BY l_partkey, l_suppkey
        UNION ALL
        SELECT l_partkey, min(l_suppkey), true, sum(l_quantity), count(*) FROM lineitem GROUP BY l_partkey""",
    "item_versions": """
        SELECT part.*, l_suppkey, coalesce(newest, true) AS newest, sum_q, n_lines
        FROM part LEFT JOIN line_agg ON p_partkey = l_partkey""",
    "raw_items": """
        SELECT CAST(p_partkey AS VARCHAR) AS book_id,
               CASE WHEN newest AND p_partkey % 17 = 0 THEN NULL ELSE p_name END AS title,
               CASE WHEN l_suppkey IS NULL OR (newest AND p_partkey % 29 = 0) THEN []
                    ELSE [{'author_id': CAST(l_suppkey AS VARCHAR)}] END AS authors,
               CASE WHEN p_partkey % 49 <> 0 THEN lower(p_type) END AS shelf,
               CASE WHEN newest AND p_partkey % 19 = 0 THEN '0'
                    WHEN newest AND p_partkey % 23 = 0 THEN 'not rated'
                    ELSE CAST(least(CAST(5.0 AS DOUBLE), sum_q / n_lines / CAST(6.0 AS DOUBLE)) AS VARCHAR)
               END AS average_rating,
               CAST(CAST(sum_q AS BIGINT) AS VARCHAR) AS ratings_count,
               CAST(n_lines AS VARCHAR) AS text_reviews_count,
               CASE WHEN p_size % 13 <> 0 THEN CAST(p_size * 20 AS VARCHAR)
                    WHEN p_partkey % 2 = 0 THEN 'n/a' END AS num_pages,
               CASE WHEN newest AND p_partkey % 5 <> 0 THEN DATE '2024-01-01' ELSE DATE '2023-06-01' END AS ingested,
               CASE WHEN newest THEN 0 ELSE l_suppkey END AS row_hash
        FROM item_versions""",
    "typed_items": """
        SELECT book_id, title, CASE WHEN len(authors) > 0 THEN authors[1].author_id END AS primary_author_id,
               TRY_CAST(average_rating AS DOUBLE) AS average_rating,
               TRY_CAST(ratings_count AS BIGINT) AS ratings_count,
               TRY_CAST(text_reviews_count AS BIGINT) AS text_reviews_count,
               TRY_CAST(num_pages AS INTEGER) AS num_pages, shelf AS shelf_genre, ingested, row_hash,
               CASE WHEN TRY_CAST(ratings_count AS BIGINT) >= 900 THEN 'high_confidence'
                    WHEN TRY_CAST(ratings_count AS BIGINT) >= 600 THEN 'medium_confidence'
                    ELSE 'low_confidence' END AS data_quality_flag
        FROM raw_items""",
    "latest_items": """
        SELECT * FROM typed_items QUALIFY row_number() OVER (
            PARTITION BY book_id ORDER BY ingested DESC NULLS LAST, ratings_count DESC NULLS LAST, row_hash) = 1""",
    "silver_items": """
        SELECT * EXCLUDE (ingested, row_hash) FROM latest_items
        WHERE title IS NOT NULL AND average_rating > 0""",
    "raw_reviews": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS review_id,
               CASE WHEN l_partkey % 10 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS book_id,
               CAST(o_custkey AS VARCHAR) AS user_id,
               CAST(CASE WHEN l_linenumber = 7 THEN 0
                         ELSE CAST(ceil(l_quantity / 10) AS INTEGER) END AS BIGINT) AS rating,
               CASE WHEN l_suppkey % 11 = 0 THEN 'n/a'
                    ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date_added,
               l_shipdate AS shipped_at, l_partkey AS o_part, l_suppkey AS o_supp,
               l_quantity AS o_qty, l_extendedprice AS o_price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "silver_reviews": """
        SELECT review_id, book_id, sha256(user_id) AS user_id_hashed,
               CAST(rating AS INTEGER) AS rating,
               CASE WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral'
                    ELSE 'negative' END AS sentiment,
               CAST(try_strptime(date_added, '%Y-%m-%d') AS DATE) AS review_date,
               CAST(year(CAST(try_strptime(date_added, '%Y-%m-%d') AS DATE)) AS INTEGER)
                   AS review_year
        FROM raw_reviews
        WHERE review_id IS NOT NULL AND book_id IS NOT NULL AND rating BETWEEN 1 AND 5""",
    "review_metrics": """
        SELECT book_id,
               count(review_id) AS total_reviews,
               """ + R("avg(CAST(rating AS DOUBLE))", 2) + """ AS avg_review_rating,
               """ + ",\n               ".join(
        R(f"CAST(sum(CASE WHEN sentiment = '{s}' THEN 1 ELSE 0 END) AS DOUBLE)"
          " * CAST(100.0 AS DOUBLE) / count(review_id)", 2) + f" AS {s}_review_pct"
        for s in ("positive", "neutral", "negative")) + """,
               min(review_date) AS first_review_date,
               max(review_date) AS latest_review_date
        FROM silver_reviews GROUP BY book_id""",
    "seg_counts": """
        SELECT l_partkey,
               """ + ",\n               ".join(
        f"count_if(c_mktsegment = '{s.upper()}') AS n_{s}" for s in SEGMENTS) + """
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                      JOIN customer ON o_custkey = c_custkey
        GROUP BY l_partkey""",
    "raw_genres": """
        SELECT CAST(p_partkey AS VARCHAR) AS book_id,
               """ + ",\n               ".join(
        f"CAST(CASE WHEN p_partkey % 7 <> 0 THEN nullif(n_{s}, 0) END AS BIGINT) AS genre_{s}"
        for s in SEGMENTS) + """
        FROM part LEFT JOIN seg_counts ON p_partkey = l_partkey""",
    "genre_long": """
        SELECT book_id, genre_name, genre_count
        FROM raw_genres UNPIVOT INCLUDE NULLS
             (genre_count FOR genre_name IN (""" + ", ".join(GENRE_COLS) + """))""",
    "primary_genre": """
        SELECT book_id, regexp_replace(genre_name, '^genre_', '') AS primary_genre
        FROM (SELECT book_id, genre_name,
                     row_number() OVER (PARTITION BY book_id
                                        ORDER BY genre_count DESC, genre_name ASC) AS rn
              FROM genre_long WHERE genre_count IS NOT NULL AND genre_count > 0)
        WHERE rn = 1""",
    "enriched": """
        SELECT b.book_id, b.title, b.primary_author_id, b.average_rating, b.ratings_count,
               b.text_reviews_count, b.num_pages, b.data_quality_flag,
               coalesce(g.primary_genre, b.shelf_genre, 'Uncategorised') AS primary_genre,
               coalesce(r.total_reviews, 0) AS total_reviews,
               coalesce(r.avg_review_rating, 0) AS avg_review_rating,
               coalesce(r.positive_review_pct, 0) AS positive_review_pct,
               coalesce(r.neutral_review_pct, 0) AS neutral_review_pct,
               coalesce(r.negative_review_pct, 0) AS negative_review_pct,
               r.first_review_date, r.latest_review_date
        FROM silver_items b
        LEFT JOIN primary_genre g ON b.book_id = g.book_id
        LEFT JOIN review_metrics r ON b.book_id = r.book_id""",
    "eligible": """
        SELECT * FROM enriched
        WHERE data_quality_flag IN ('high_confidence', 'medium_confidence')
          AND primary_genre NOT IN ('household', 'Uncategorised')""",
    "scored": """
        SELECT *,
               ln(ratings_count + 1) / ln(5000001) AS popularity_score,
               CASE WHEN positive_review_pct IS NOT NULL AND total_reviews > 0
                        THEN positive_review_pct / CAST(100.0 AS DOUBLE)
                    WHEN average_rating >= 4.0 THEN CAST(1.0 AS DOUBLE)
                    WHEN average_rating >= 3.0 THEN CAST(0.5 AS DOUBLE)
                    ELSE CAST(0.0 AS DOUBLE) END AS sentiment_score,
               """ + LENGTH_BANDS + """
        FROM eligible""",
    "weighted": """
        SELECT *,
               """ + R("average_rating / CAST(5.0 AS DOUBLE) * CAST(0.35 AS DOUBLE)"
                       " + popularity_score * CAST(0.25 AS DOUBLE)"
                       " + sentiment_score * CAST(0.25 AS DOUBLE)"
                       " + length_score * CAST(0.15 AS DOUBLE)", 4) + """ AS weighted_score
        FROM scored""",
    "candidates": """
        SELECT CAST(rank() OVER (ORDER BY weighted_score DESC) AS INTEGER) AS audiobook_rank,
               CAST(rank() OVER (PARTITION BY primary_genre ORDER BY weighted_score DESC)
                    AS INTEGER) AS genre_rank,
               book_id, title, primary_author_id, primary_genre, average_rating,
               ratings_count, num_pages, length_category, total_reviews,
               positive_review_pct, negative_review_pct, weighted_score,
               """ + R("average_rating / CAST(5.0 AS DOUBLE) * CAST(0.35 AS DOUBLE)", 4)
    + """ AS rating_contribution,
               """ + R("popularity_score * CAST(0.25 AS DOUBLE)", 4) + """ AS popularity_contribution,
               """ + R("sentiment_score * CAST(0.25 AS DOUBLE)", 4) + """ AS sentiment_contribution,
               """ + R("length_score * CAST(0.15 AS DOUBLE)", 4) + """ AS length_contribution,
               data_quality_flag
        FROM weighted""",
    "genre_metrics": """
        SELECT primary_genre AS genre, count(DISTINCT book_id) AS total_books,
               """ + R("avg(average_rating)", 2) + """ AS avg_rating,
               CAST(sum(ratings_count) AS BIGINT) AS total_ratings,
               """ + R("avg(positive_review_pct)", 1) + """ AS avg_positive_pct,
               """ + R("avg(negative_review_pct)", 1) + """ AS avg_negative_pct,
               """ + R("avg(average_rating / CAST(5.0 AS DOUBLE) * CAST(0.35 AS DOUBLE)"
                       " + popularity_score * CAST(0.25 AS DOUBLE)"
                       " + sentiment_score * CAST(0.25 AS DOUBLE))", 4) + """ AS avg_weighted_score
        FROM scored GROUP BY primary_genre""",
    "genre_mart": """
        SELECT CAST(rank() OVER (ORDER BY avg_weighted_score DESC) AS INTEGER) AS genre_rank,
               genre, total_books, avg_rating, total_ratings, avg_positive_pct,
               avg_negative_pct, avg_weighted_score
        FROM genre_metrics""",
    "legacy_scored": """
        SELECT *,
               CASE WHEN average_rating >= 4.0 THEN CAST(1.0 AS DOUBLE)
                    WHEN average_rating >= 3.0 THEN CAST(0.5 AS DOUBLE)
                    ELSE CAST(0.0 AS DOUBLE) END AS proxy,
               """ + R("average_rating / CAST(5.0 AS DOUBLE) * CAST(0.4 AS DOUBLE)"
                       " + ln(ratings_count + 1) / ln(5000001) * CAST(0.3 AS DOUBLE)"
                       " + (CASE WHEN average_rating >= 4.0 THEN CAST(1.0 AS DOUBLE)"
                       " WHEN average_rating >= 3.0 THEN CAST(0.5 AS DOUBLE)"
                       " ELSE CAST(0.0 AS DOUBLE) END) * CAST(0.3 AS DOUBLE)", 4) + """
                   AS weighted_score
        FROM enriched
        WHERE data_quality_flag IN ('high_confidence', 'medium_confidence')""",
    "presets": """
        SELECT strategy, CAST(w_rating AS DOUBLE) AS w_rating,
               CAST(w_popularity AS DOUBLE) AS w_popularity,
               CAST(w_sentiment AS DOUBLE) AS w_sentiment, CAST(w_length AS DOUBLE) AS w_length
        FROM (VALUES ('default', 0.35, 0.25, 0.25, 0.15),
                     ('conservative', 0.50, 0.35, 0.10, 0.05),
                     ('discovery', 0.60, 0.10, 0.25, 0.05),
                     ('sentiment_first', 0.25, 0.20, 0.50, 0.05))
             AS t(strategy, w_rating, w_popularity, w_sentiment, w_length)""",
}

_ORDER = list(_BASE)


def with_ctes(body: str, *needed: str) -> str:
    """Prefix ``body`` with the CTEs it needs (and their dependencies, in order)."""
    want: set[str] = set()

    def visit(name: str):
        if name in want:
            return
        want.add(name)
        sql = _BASE[name]
        for other in _ORDER:
            if other != name and _mentions(sql, other):
                visit(other)

    for n in needed:
        visit(n)
    parts = [f"{n} AS ({_BASE[n]})" for n in _ORDER if n in want]
    return "WITH " + ",\n".join(parts) + "\n" + body if parts else body


def _mentions(sql: str, name: str) -> bool:
    import re
    return re.search(rf"\b(FROM|JOIN|UNPIVOT)\s+{name}\b", sql) is not None


def cte(name: str) -> str:
    return _BASE[name]


SQL: dict[str, str] = {}


def _q(name: str, body: str, *needed: str) -> None:
    SQL[name] = with_ctes(body, *needed)


_q("candidates", "SELECT * FROM candidates", "candidates")

_FLAGS = "('high_confidence', 'medium_confidence')"
_EXCLUDED = "('household', 'Uncategorised')"

_q("typed_items", """SELECT book_id, average_rating, ratings_count, text_reviews_count, num_pages
FROM typed_items""", "typed_items")
_q("primary_contributor", "SELECT book_id, primary_author_id, shelf_genre FROM typed_items", "typed_items")
_q("quality_flag", "SELECT book_id, ratings_count, data_quality_flag FROM typed_items", "typed_items")
_q("valid_items", """SELECT book_id, title, average_rating FROM typed_items
WHERE book_id IS NOT NULL AND title IS NOT NULL AND average_rating > 0""", "typed_items")
_q("valid_reviews", """SELECT review_id, book_id, rating, date_added FROM raw_reviews
WHERE review_id IS NOT NULL AND book_id IS NOT NULL AND rating BETWEEN 1 AND 5""",
   "raw_reviews")
_q("eligible_items", "SELECT book_id, primary_genre, data_quality_flag FROM eligible", "eligible")
_q("long_texts", """SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS text_length
FROM documents WHERE text IS NOT NULL AND length(text) > 50""")
_q("critical_nulls", """
SELECT 'bronze_books' AS layer,
       CAST(count_if(book_id IS NULL OR average_rating IS NULL) AS BIGINT) AS null_rows
FROM typed_items
UNION ALL
SELECT 'silver_books' AS layer,
       CAST(count_if(book_id IS NULL OR average_rating IS NULL) AS BIGINT) AS null_rows
FROM silver_items
UNION ALL
SELECT 'enriched' AS layer,
       CAST(count_if(book_id IS NULL OR average_rating IS NULL) AS BIGINT) AS null_rows
FROM enriched""",
   "typed_items", "silver_items", "enriched")
_q("silver_reviews", """SELECT review_id, book_id, user_id_hashed, rating, sentiment,
       review_date, review_year, CAST(NULL AS VARCHAR) AS review_text
FROM silver_reviews""", "silver_reviews")

_q("genre_long", "SELECT book_id, genre_name, genre_count FROM genre_long", "genre_long")
_q("genre_unpivot", """SELECT book_id, genre_name, genre_count FROM genre_long
WHERE genre_count IS NOT NULL AND genre_count > 0""", "genre_long")
_q("primary_genre", "SELECT book_id, primary_genre FROM primary_genre", "primary_genre")

_q("items_with_genre", """
SELECT b.book_id, coalesce(g.primary_genre, b.shelf_genre, 'Uncategorised') AS primary_genre,
       b.shelf_genre
FROM silver_items b LEFT JOIN primary_genre g ON b.book_id = g.book_id""",
   "silver_items", "primary_genre")
_q("items_with_metrics", """
SELECT b.book_id,
       coalesce(r.total_reviews, 0) AS total_reviews,
       coalesce(r.avg_review_rating, 0) AS avg_review_rating,
       coalesce(r.positive_review_pct, 0) AS positive_review_pct,
       coalesce(r.neutral_review_pct, 0) AS neutral_review_pct,
       coalesce(r.negative_review_pct, 0) AS negative_review_pct,
       r.first_review_date, r.latest_review_date
FROM silver_items b LEFT JOIN review_metrics r ON b.book_id = r.book_id""",
   "silver_items", "review_metrics")


def _signal(pattern: str) -> str:
    return f"coalesce(regexp_matches(text, '(?i){pattern}'), false)"


_q("fused_sentiment", f"""
SELECT l.doc_id,
       CASE WHEN l.toxic = 1 THEN 'neg' WHEN l.quality = 1 THEN 'pos'
            ELSE 'neutral' END AS nlp_sentiment,
       {_signal('ment|ness')} AS audiobook_risk,
       CASE WHEN {_signal('ment|ness')} THEN 'negative'
            WHEN l.toxic = 1 THEN 'negative'
            WHEN l.quality = 1 THEN 'positive'
            ELSE 'neutral' END AS final_sentiment
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
_q("enriched_items", """SELECT book_id, title, primary_author_id, average_rating, ratings_count,
       text_reviews_count, num_pages, data_quality_flag, primary_genre, total_reviews,
       avg_review_rating, positive_review_pct, neutral_review_pct, negative_review_pct,
       first_review_date, latest_review_date
FROM enriched""", "enriched")
_q("orphan_reviews", """
SELECT r.review_id, r.book_id FROM silver_reviews r
WHERE r.book_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM silver_items b WHERE b.book_id = r.book_id)""",
   "silver_reviews", "silver_items")

_q("review_metrics", "SELECT * FROM review_metrics", "review_metrics")
_q("genre_performance", "SELECT * FROM genre_mart", "genre_mart")
_q("quality_distribution", """SELECT data_quality_flag, count(*) AS books
FROM silver_items GROUP BY data_quality_flag""", "silver_items")
_q("top_genres", f"""SELECT primary_genre, count(*) AS books FROM enriched
WHERE data_quality_flag IN {_FLAGS}
GROUP BY primary_genre ORDER BY books DESC, primary_genre ASC LIMIT 10""", "enriched")
_q("genre_coverage", """SELECT CAST(count_if(primary_genre <> 'Uncategorised') AS BIGINT)
           AS books_with_genre,
       count(*) AS total_books FROM enriched""", "enriched")
_q("reviewed_items", """SELECT CAST(count_if(total_reviews > 0) AS BIGINT) AS reviewed_books,
       count(*) AS total_books FROM enriched""", "enriched")

_REVIEW_ORDER = ("shipped_at DESC NULLS LAST, o_part ASC NULLS FIRST, o_supp ASC NULLS FIRST, "
                 "o_qty ASC NULLS FIRST, o_price ASC NULLS FIRST")
_q("dedup_latest", f"""
SELECT review_id, book_id, user_id, rating, date_added FROM (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY {_REVIEW_ORDER}) AS rn
  FROM raw_reviews) WHERE rn = 1""", "raw_reviews")
_q("dedup_items", """SELECT book_id, title, ratings_count, average_rating FROM latest_items""", "latest_items")
_q("dedup_by_metric", f"""
SELECT review_id, book_id, user_id, rating, date_added FROM (
  SELECT *, row_number() OVER (PARTITION BY review_id
                               ORDER BY rating DESC NULLS LAST, {_REVIEW_ORDER}) AS rn
  FROM raw_reviews) WHERE rn = 1""", "raw_reviews")
_q("global_rank", """SELECT book_id, weighted_score,
       CAST(rank() OVER (ORDER BY weighted_score DESC) AS INTEGER) AS audiobook_rank
FROM weighted""", "weighted")
_q("genre_rank", """SELECT book_id, primary_genre, weighted_score,
       CAST(rank() OVER (PARTITION BY primary_genre ORDER BY weighted_score DESC) AS INTEGER)
           AS genre_rank
FROM weighted""", "weighted")
_q("best_per_genre", f"""
SELECT primary_genre AS genre, book_id, title, average_rating AS rating, weighted_score AS score
FROM (SELECT *, row_number() OVER (PARTITION BY primary_genre
                                   ORDER BY weighted_score DESC, book_id ASC) AS rn
      FROM candidates WHERE primary_genre NOT IN {_EXCLUDED})
WHERE rn = 1""", "candidates")

_q("top_candidates", """
SELECT audiobook_rank AS rank, book_id, title, primary_genre AS genre, average_rating AS rating,
       format('{:,}', ratings_count) AS total_ratings, num_pages, length_category,
       weighted_score AS score
FROM candidates ORDER BY audiobook_rank, book_id LIMIT 10""", "candidates")
_q("genre_strategy", """
SELECT genre_rank, genre, total_books, avg_rating,
       format('{:,}', total_ratings) AS total_ratings, avg_weighted_score AS avg_score
FROM genre_mart""", "genre_mart")
_q("recommendation", """
(SELECT 'top_item' AS kind, title AS name, primary_genre AS genre, weighted_score AS score,
        ratings_count AS ratings
 FROM candidates ORDER BY audiobook_rank, book_id LIMIT 1)
UNION ALL
(SELECT 'top_genre' AS kind, genre AS name, genre, avg_weighted_score AS score,
        total_ratings AS ratings
 FROM genre_mart ORDER BY genre_rank, genre LIMIT 1)""", "candidates", "genre_mart")
_q("layer_quality", """
SELECT 'bronze_books' AS layer, count(*) AS total_records,
       CAST(count_if(book_id IS NULL) AS BIGINT) AS null_ids FROM raw_items
UNION ALL
SELECT 'silver_books', count(*), CAST(count_if(book_id IS NULL) AS BIGINT) FROM silver_items
UNION ALL
SELECT 'gold_candidates', count(*), CAST(count_if(book_id IS NULL) AS BIGINT) FROM candidates""",
   "raw_items", "silver_items", "candidates")

_q("hashed_users", """SELECT DISTINCT user_id, sha256(user_id) AS user_id_hashed
FROM raw_reviews""", "raw_reviews")
_q("rating_sentiment", """SELECT review_id, book_id, rating,
       CASE WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral'
            ELSE 'negative' END AS sentiment
FROM raw_reviews""", "raw_reviews")
_q("review_dates", """SELECT review_id, book_id, date_added,
       CAST(try_strptime(date_added, '%Y-%m-%d') AS DATE) AS review_date,
       CAST(year(CAST(try_strptime(date_added, '%Y-%m-%d') AS DATE)) AS INTEGER) AS review_year
FROM raw_reviews""", "raw_reviews")
_q("popularity_score", "SELECT book_id, ratings_count, "
   + R("ln(ratings_count + 1) / ln(5000001)", 6) + " AS popularity_score FROM silver_items",
   "silver_items")
_q("sentiment_score", """SELECT book_id, total_reviews, positive_review_pct, average_rating,
       CASE WHEN positive_review_pct IS NOT NULL AND total_reviews > 0
                THEN positive_review_pct / CAST(100.0 AS DOUBLE)
            WHEN average_rating >= 4.0 THEN CAST(1.0 AS DOUBLE)
            WHEN average_rating >= 3.0 THEN CAST(0.5 AS DOUBLE)
            ELSE CAST(0.0 AS DOUBLE) END AS sentiment_score
FROM enriched""", "enriched")
_q("length_score", f"SELECT book_id, num_pages, {LENGTH_BANDS} FROM silver_items", "silver_items")
_q("weighted_score", "SELECT book_id, weighted_score FROM weighted", "weighted")
_q("score_breakdown", """SELECT book_id, weighted_score,
       """ + R("average_rating / CAST(5.0 AS DOUBLE) * CAST(0.35 AS DOUBLE)", 4)
   + """ AS rating_contribution,
       """ + R("popularity_score * CAST(0.25 AS DOUBLE)", 4) + """ AS popularity_contribution,
       """ + R("sentiment_score * CAST(0.25 AS DOUBLE)", 4) + """ AS sentiment_contribution,
       """ + R("length_score * CAST(0.15 AS DOUBLE)", 4) + """ AS length_contribution
FROM weighted""", "weighted")
_q("legacy_score", """
SELECT CAST(rank() OVER (ORDER BY weighted_score DESC) AS INTEGER) AS audiobook_rank,
       CAST(rank() OVER (PARTITION BY primary_genre ORDER BY weighted_score DESC) AS INTEGER)
           AS genre_rank,
       book_id, title, primary_author_id, primary_genre, average_rating, ratings_count,
       text_reviews_count, weighted_score, data_quality_flag
FROM legacy_scored""", "legacy_scored")
_q("legacy_genre_summary", """
SELECT primary_genre, total_books, avg_rating, total_ratings, positive_pct, avg_weighted_score,
       CAST(rank() OVER (ORDER BY avg_weighted_score DESC) AS INTEGER) AS genre_rank
FROM (SELECT primary_genre, count(book_id) AS total_books,
             """ + R("avg(average_rating)", 2) + """ AS avg_rating,
             CAST(sum(ratings_count) AS BIGINT) AS total_ratings,
             """ + R("avg(proxy) * 100", 1) + """ AS positive_pct,
             """ + R("avg(average_rating / CAST(5.0 AS DOUBLE) * CAST(0.4 AS DOUBLE)"
                     " + ln(ratings_count + 1) / ln(5000001) * CAST(0.3 AS DOUBLE)"
                     " + proxy * CAST(0.3 AS DOUBLE))", 4) + """ AS avg_weighted_score
      FROM legacy_scored WHERE primary_genre <> 'Uncategorised'
      GROUP BY primary_genre)""", "legacy_scored")
_q("masked_ids", """SELECT c_custkey, concat('***-**-', right(c_name, 4)) AS analyst_view,
       c_name AS engineer_view FROM customer""")
_q("text_signals", f"""SELECT doc_id, {_signal('the')} AS mentions_narrator,
       {_signal('tion')} AS mentions_pacing, {_signal('ment|ness')} AS audiobook_risk
FROM documents""")

_q("silver_items", """SELECT book_id, title, primary_author_id, average_rating, ratings_count,
       text_reviews_count, num_pages, shelf_genre, data_quality_flag FROM silver_items""",
   "silver_items")
_q("strategy_ranks", """
SELECT strategy, book_id, primary_genre, weighted_score,
       CAST(rank() OVER (PARTITION BY strategy ORDER BY weighted_score DESC) AS INTEGER)
           AS strategy_rank
FROM (SELECT p.strategy, s.book_id, s.primary_genre,
             """ + R("s.average_rating / CAST(5.0 AS DOUBLE) * p.w_rating"
                     " + s.popularity_score * p.w_popularity"
                     " + s.sentiment_score * p.w_sentiment"
                     " + s.length_score * p.w_length", 4) + """ AS weighted_score
      FROM scored s CROSS JOIN presets p)""", "scored", "presets")

# --- data tests: generated from the same declared list as the Spark side ----
_MODEL_CTE = {
    "bronze_books": "raw_items", "bronze_reviews": "raw_reviews", "bronze_genres": "raw_genres",
    "stg_books": "silver_items", "stg_reviews": "silver_reviews", "stg_genres": "primary_genre",
    "int_books_enriched": "enriched", "mart_audiobook_candidates": "candidates",
    "mart_genre_performance": "genre_mart",
}


def _dq_sql(kind: str) -> str:
    from ..operators import quality as Q
    rows = []
    for t in Q.declared_tests():
        if t.kind != kind:
            continue
        src = _MODEL_CTE[t.model]
        if kind == "not_null":
            fail = f"(SELECT count_if({t.column} IS NULL) FROM {src})"
        elif kind == "unique":
            fail = (f"(SELECT count(*) FROM (SELECT {t.column} FROM {src} "
                    f"WHERE {t.column} IS NOT NULL GROUP BY {t.column} HAVING count(*) > 1))")
        else:
            vals = ", ".join(f"'{v}'" for v in t.values)
            fail = (f"(SELECT count_if({t.column} IS NOT NULL AND {t.column} NOT IN ({vals})) "
                    f"FROM {src})")
        rows.append(f"SELECT '{t.name}' AS test, '{t.kind}' AS kind, '{t.model}' AS model, "
                    f"'{t.column}' AS column_name, '{t.severity}' AS severity, "
                    f"CAST({fail} AS BIGINT) AS failures")
    body = ("SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
            "ELSE 'fail' END AS status FROM (\n" + "\nUNION ALL\n".join(rows) + ")")
    return with_ctes(body, *{_MODEL_CTE[t.model] for t in Q.declared_tests() if t.kind == kind})


def _domain_sql() -> str:
    from .star_views import DOMAIN_TESTS
    rows = []
    for t in DOMAIN_TESTS:
        if t.kind == "accepted_values":
            vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in t.values)
            bad = f"{t.column} IS NOT NULL AND {t.column} NOT IN ({vals})"
        else:
            bad = f"{t.column} IS NOT NULL AND {t.column} NOT IN (SELECT {t.to_column} FROM {t.to_model})"
        rows.append(f"SELECT '{t.name}' AS test, '{t.kind}' AS kind, '{t.model}' AS model, '{t.column}' AS column_name, "
                    f"'{t.severity}' AS severity, (SELECT count(*) FROM {t.model} WHERE {bad}) AS failures")
    return ("SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status "
            "FROM (" + " UNION ALL ".join(rows) + ")")


SQL["dq_domains"] = _domain_sql()
_q("dq_relationships", """
SELECT 'relationships_stg_reviews_book_id' AS test, 'relationships' AS kind, 'stg_reviews' AS model,
       'book_id' AS column_name, 'warn' AS severity, failures,
       CASE WHEN failures = 0 THEN 'pass' ELSE 'warn' END AS status
FROM (SELECT count(*) AS failures FROM silver_reviews r
      WHERE NOT EXISTS (SELECT 1 FROM silver_items b WHERE b.book_id = r.book_id))""", "silver_reviews", "silver_items")
_q("genre_versions", """SELECT shelf_genre, count(DISTINCT book_id) AS books, count(*) AS versions
FROM typed_items GROUP BY shelf_genre""", "typed_items")
_q("audit_tables", """
SELECT user_id AS "user", ts AS event_time, event_type AS action_name,
       CAST(json_extract(props, '$.k') AS INTEGER) AS table_accessed, value
FROM events
WHERE starts_with(CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR), '1')
  AND ts > TIMESTAMP '2024-01-15 00:00:00'""")
SQL["dq_not_null"] = _dq_sql("not_null")
SQL["dq_unique"] = _dq_sql("unique")
SQL["dq_accepted_values"] = _dq_sql("accepted_values")

_SUBJECTS = "(" + ", ".join(f"'{h}'" for h in (hashlib.sha256(b"7").hexdigest(),
                                               hashlib.sha256(b"42").hexdigest())) + ")"
_q("subject_lookup", f"""SELECT review_id, book_id, user_id, rating FROM raw_reviews
WHERE sha256(user_id) IN {_SUBJECTS}""", "raw_reviews")
_q("subject_erasure", f"""SELECT review_id, book_id, user_id, rating FROM raw_reviews
WHERE sha256(user_id) IS NULL OR sha256(user_id) NOT IN {_SUBJECTS}""", "raw_reviews")
_q("audit_log", """
SELECT user_id AS "user", ts AS event_time, event_type AS action_name,
       CAST(json_extract(props, '$.k') AS INTEGER) AS table_accessed, value
FROM events
WHERE starts_with(event_type, 'c') AND ts > TIMESTAMP '2024-01-15 00:00:00'
ORDER BY event_time DESC, "user" ASC""")
_q("ingest_incremental", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
_q("ingest_compressed", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
_q("ingest_evolving", """SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE props END AS props FROM events""")
_q("ingest_rescue", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type IN ('view', 'click') AS conforms,
       CASE WHEN event_type NOT IN ('view', 'click') THEN user_id END AS rescued_user,
       CASE WHEN event_type NOT IN ('view', 'click') THEN value END AS rescued_value
FROM events""")
_q("rejected_lines", """
SELECT batch, reason, count(*) AS lines, of_lines
FROM (SELECT *, count(*) OVER (PARTITION BY batch) AS of_lines
      FROM (SELECT CASE WHEN event_type IN ('view', 'click') THEN 'batch_1' ELSE 'batch_2' END AS batch,
                   CASE event_id % 20 WHEN 3 THEN 'not_json' WHEN 7 THEN 'wrong_type' WHEN 11 THEN 'unknown_field' END AS reason
            FROM events))
WHERE reason IS NOT NULL GROUP BY batch, reason, of_lines""")
_q("global_rank_unrounded", """
SELECT l_orderkey, l_linenumber, revenue, CAST(rank() OVER (ORDER BY revenue DESC) AS INTEGER) AS revenue_rank
FROM (SELECT l_orderkey, l_linenumber,
             CAST(l_extendedprice AS DOUBLE) * (CAST(1.0 AS DOUBLE) - CAST(l_discount AS DOUBLE)) AS revenue FROM lineitem)""")
_q("subject_erasure_rebuild", f"""SELECT review_id, book_id, user_id_hashed, rating, sentiment,
       review_date, review_year, CAST(NULL AS VARCHAR) AS review_text
FROM silver_reviews WHERE user_id_hashed IS NULL OR user_id_hashed NOT IN {_SUBJECTS}""", "silver_reviews")
_q("snapshot_history", f"""
SELECT CAST(0 AS BIGINT) AS version, 'CREATE OR REPLACE' AS operation,
       (SELECT count(*) FROM candidates) AS "rows", 'gold_candidates' AS table_name
UNION ALL
SELECT CAST(1 AS BIGINT), 'WRITE', (SELECT count(*) FROM candidates), 'gold_candidates'
UNION ALL
SELECT CAST(0 AS BIGINT), 'WRITE', (SELECT count(*) FROM raw_reviews), 'bronze_reviews'
UNION ALL
SELECT CAST(1 AS BIGINT), 'DELETE',
       (SELECT count(*) FROM raw_reviews
        WHERE sha256(user_id) IS NULL OR sha256(user_id) NOT IN {_SUBJECTS}), 'bronze_reviews'
""", "candidates", "raw_reviews")

SQL["incremental_enriched"] = SQL["enriched_bucketed"] = SQL["enriched_items"]
SQL["incremental_metrics"] = SQL["review_metrics"]
SQL["incremental_tests"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT * FROM ({SQL[k]})" for k in ("dq_not_null", "dq_unique", "dq_accepted_values", "dq_relationships")
) + ") WHERE model NOT LIKE 'mart_%'"
SQL["layer_quality_files"] = SQL["layer_quality"]
