"""Column expressions (no Python UDFs: every function returns a JVM ``Column``).

Each function takes column names or ``Column`` objects and returns a ``Column``
that stays inside whole-stage codegen.  Malformed input becomes NULL rather
than failing, which matters because Spark 4 runs with ANSI mode on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, HIGH, LOW, MEDIUM, ScoringConfig

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Fixed values that must equal the reference for identical results.
# Page-count bands, tested in this order, first match wins (bounds inclusive):
#   NULL -> 0.5 unknown; 200-400 -> 1.0 ideal; 400-600 -> 0.8 good;
#   100-200 -> 0.6 short; 600-800 -> 0.4 long; anything else -> 0.2 very_long
# Rating proxy for sentiment: rating >= 4.0 -> 1.0, >= 3.0 -> 0.5, else 0.0
# Review sentiment from stars: >= 4 positive, = 3 neutral, otherwise negative
# Review date text format: yyyy-MM-dd
# Masked id: '***-**-' followed by the last 4 characters
LENGTH_BANDS = (
    (200, 400, 1.0, "ideal"),
    (400, 600, 0.8, "good"),
    (100, 200, 0.6, "short"),
    (600, 800, 0.4, "long"),
)
LENGTH_NULL = (0.5, "unknown")
LENGTH_OTHER = (0.2, "very_long")
DATE_FORMAT = "yyyy-MM-dd"
MASK_PREFIX = "***-**-"


# --- P1: typed casts ------------------------------------------------------

def clean_numeric(c, to: str) -> Column:
    """String (or any) → ``to`` type; unparseable text becomes NULL (``try_cast``)."""
    return _c(c).try_cast(to)


# --- P2: first element's field -------------------------------------------

def first_field(array_col, field: str) -> Column:
    """``arr[0].field`` that yields NULL for NULL or empty arrays (ANSI-safe)."""
    return F.get(_c(array_col), 0).getField(field)


# --- P3: confidence flag ---------------------------------------------------

def quality_flag(count_col, cfg: ScoringConfig = DEFAULT) -> Column:
    c = _c(count_col)
    return (F.when(c >= cfg.min_ratings_high, F.lit(HIGH))
            .when(c >= cfg.min_ratings_medium, F.lit(MEDIUM))
            .otherwise(F.lit(LOW)))


# --- F1: pseudonymous id ---------------------------------------------------

def hash_id(c, salt: str | None = None) -> Column:
    """SHA-256 hex of the id as text; an optional salt is prefixed."""
    s = _c(c).cast("string")
    if salt:
        s = F.concat(F.lit(salt), s)
    return F.sha2(s, 256)


# --- F2: star sentiment ----------------------------------------------------

def classify_rating(c) -> Column:
    r = _c(c)
    return (F.when(r >= 4, F.lit("positive"))
            .when(r == 3, F.lit("neutral"))
            .otherwise(F.lit("negative")))


# --- F3 / F4: dates --------------------------------------------------------

def parse_date(c, fmt: str = DATE_FORMAT) -> Column:
    """Text → date; text not in ``fmt`` becomes NULL (``try_to_date``)."""
    return F.try_to_date(_c(c), fmt)


def year_of(c) -> Column:
    return F.year(_c(c))


# --- F5: prefix strip ------------------------------------------------------

def strip_prefix(c, prefix: str) -> Column:
    return F.regexp_replace(_c(c), "^" + prefix, "")


# --- F8: popularity --------------------------------------------------------

def popularity(count_col, cfg: ScoringConfig = DEFAULT) -> Column:
    """ln(n + 1) / ln(ceiling + 1); the denominator is a folded literal."""
    return F.log(_c(count_col) + 1) / F.lit(cfg.max_log_ratings)


# --- F9 / F15: sentiment ---------------------------------------------------

def rating_proxy(rating_col) -> Column:
    r = _c(rating_col)
    return (F.when(r >= 4.0, F.lit(1.0))
            .when(r >= 3.0, F.lit(0.5))
            .otherwise(F.lit(0.0)))


def sentiment_score(positive_pct_col, total_reviews_col, rating_col,
                    cfg: ScoringConfig = DEFAULT) -> Column:
    """Share of positive reviews, or the rating proxy when there are none."""
    proxy = rating_proxy(rating_col)
    if not cfg.use_review_sentiment:
        return proxy
    pct = _c(positive_pct_col)
    return (F.when(pct.isNotNull() & (_c(total_reviews_col) > 0), pct / 100.0)
            .otherwise(proxy))


# --- F10 / F11: length bands ----------------------------------------------

def _bands(pages: Column, label: bool) -> Column:
    i = 1 if label else 0
    out = F.when(pages.isNull(), F.lit(LENGTH_NULL[i]))
    for lo, hi, score, name in LENGTH_BANDS:
        out = out.when(pages.between(lo, hi), F.lit(name if label else score))
    return out.otherwise(F.lit(LENGTH_OTHER[i]))


def length_score(pages_col) -> Column:
    return _bands(_c(pages_col), label=False)


def length_category(pages_col) -> Column:
    return _bands(_c(pages_col), label=True)


# --- F12 / F13: weighted score and its parts -------------------------------

def score_parts(rating_col, count_col, sentiment_col, length_col,
                cfg: ScoringConfig = DEFAULT) -> tuple[Column, Column, Column, Column]:
    """The four unrounded weighted parts, in the reference's summation order."""
    return (
        _c(rating_col) / 5.0 * cfg.rating_weight,
        popularity(count_col, cfg) * cfg.popularity_weight,
        _c(sentiment_col) * cfg.sentiment_weight,
        _c(length_col) * cfg.length_weight,
    )


def weighted_score(rating_col, count_col, sentiment_col, length_col,
                   cfg: ScoringConfig = DEFAULT, digits: int = 4,
                   include_length: bool = True) -> Column:
    r, p, s, ln = score_parts(rating_col, count_col, sentiment_col, length_col, cfg)
    total = r + p + s
    if include_length and cfg.length_weight:
        total = total + ln
    return F.round(total, digits)


# --- F14: thousands separators ---------------------------------------------

def thousands(c) -> Column:
    return F.format_number(_c(c), 0)


# --- F16: role-dependent masking -------------------------------------------

def mask_tail(c, masked: Column | bool = True, keep: int = 4) -> Column:
    """``***-**-`` + last ``keep`` characters where ``masked`` holds, else the value."""
    v = _c(c).cast("string")
    shown = F.concat(F.lit(MASK_PREFIX), F.right(v, F.lit(keep)))
    cond = masked if isinstance(masked, Column) else F.lit(bool(masked))
    return F.when(cond, shown).otherwise(v)


# --- F19: annotator output -------------------------------------------------

def first_result(array_col) -> Column:
    """``arr[0]`` with NULL for empty/NULL arrays."""
    return F.get(_c(array_col), 0)


def variant_field(variant_col, path: str, dtype: str) -> Column:
    """Typed field of a VARIANT (``$.a.b``); a missing or mistyped value is NULL."""
    return F.try_variant_get(_c(variant_col), path, dtype)


def map_value(map_col, key: str) -> Column:
    """``map[key]`` with NULL for a missing key (``try_element_at``)."""
    return F.try_element_at(_c(map_col), F.lit(key))
