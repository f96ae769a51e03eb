"""Review-text signals and their fusion with a label table.

Patterns are JVM regexes applied with ``rlike`` over the *whole* text of each
row, inside whole-stage codegen.  A sentiment model is not part of the engine:
its output arrives as a label table (one row per text id) and is joined on
the id.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The reference's documented audiobook signal patterns (case-insensitive).
NARRATOR = "narrator|voice|reading style|audio"
PACING = "slow|fast.paced|dense|dry|engaging"
RISK = "too slow|boring to listen|better to read|not for audio"
DEFAULT_PATTERNS = {"mentions_narrator": NARRATOR, "mentions_pacing": PACING,
                    "audiobook_risk": RISK}
MIN_TEXT_LENGTH = 50


def long_texts(df: DataFrame, text_col: str = "review_text",
               min_length: int = MIN_TEXT_LENGTH) -> DataFrame:
    """Texts present and longer than ``min_length`` characters."""
    return df.filter(F.col(text_col).isNotNull() & (F.length(text_col) > min_length))


def text_signals(df: DataFrame, text_col: str = "review_text",
                 patterns: Mapping[str, str] | None = None) -> DataFrame:
    """one boolean per pattern, matched case-insensitively anywhere in the text.

    A NULL text gives False (the reference's ``otherwise(False)`` form).
    """
    pats = dict(patterns or DEFAULT_PATTERNS)
    return df.withColumns({
        name: F.coalesce(F.col(text_col).rlike(f"(?i){p}"), F.lit(False))
        for name, p in pats.items()})


def label_sentiment(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Model-style label from a label table: toxic → neg, quality → pos, else neutral."""
    return labels.select(
        key,
        F.when(F.col("toxic") == 1, F.lit("neg"))
        .when(F.col("quality") == 1, F.lit("pos"))
        .otherwise(F.lit("neutral")).alias("nlp_sentiment"))


def fuse_sentiment(nlp: DataFrame, signals: DataFrame, key: str = "review_id",
                   risk_col: str = "audiobook_risk") -> DataFrame:
    """J3 + F18: risk overrides the model; pos/neg map through; anything else neutral."""
    j = nlp.join(signals, key)
    return j.withColumn(
        "final_sentiment",
        F.when(F.col(risk_col), F.lit("negative"))
        .when(F.col("nlp_sentiment") == "pos", F.lit("positive"))
        .when(F.col("nlp_sentiment") == "neg", F.lit("negative"))
        .otherwise(F.lit("neutral")))
