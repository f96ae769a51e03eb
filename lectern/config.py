"""Scoring parameters and named presets.

Every operator that depends on a threshold or weight takes a ``ScoringConfig``;
nothing reads module globals, so two configs can run side by side in one plan
(see ``operators.score.strategy_ranks``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

# Fixed values that must equal the reference for identical results.
# Score weights (rating, popularity, sentiment, length): 0.35, 0.25, 0.25, 0.15
# Confidence thresholds on ratings_count: high 100000, medium 10000
# Popularity ceiling: 5000000 ratings, normalised as ln(n + 1) / ln(5000001)
# Flags kept for candidates: high_confidence, medium_confidence
# Genres excluded from candidates: comics_graphic, Uncategorised
# Default genre label when neither a genre row nor a shelf exists: Uncategorised
# Strategy presets (rating, popularity, sentiment, length):
#   default 0.35 0.25 0.25 0.15
#   conservative 0.50 0.35 0.10 0.05
#   discovery 0.60 0.10 0.25 0.05
#   sentiment_first 0.25 0.20 0.50 0.05
# Older three-part model: rating 0.40, popularity 0.30, sentiment 0.30, no length
# part, sentiment from the rating proxy only, only Uncategorised dropped from the
# genre summary.

HIGH = "high_confidence"
MEDIUM = "medium_confidence"
LOW = "low_confidence"
UNCATEGORISED = "Uncategorised"


@dataclass(frozen=True)
class ScoringConfig:
    rating_weight: float = 0.35
    popularity_weight: float = 0.25
    sentiment_weight: float = 0.25
    length_weight: float = 0.15
    min_ratings_high: int = 100_000
    min_ratings_medium: int = 10_000
    popularity_ceiling: int = 5_000_000
    kept_flags: tuple[str, ...] = (HIGH, MEDIUM)
    excluded_genres: tuple[str, ...] = ("comics_graphic", UNCATEGORISED)
    # False = three-part model: sentiment is always the rating proxy.
    use_review_sentiment: bool = True
    name: str = "default"

    @property
    def max_log_ratings(self) -> float:
        return math.log(self.popularity_ceiling + 1)

    def with_(self, **kw) -> "ScoringConfig":
        return replace(self, **kw)


DEFAULT = ScoringConfig()

PRESETS: dict[str, ScoringConfig] = {
    "default": DEFAULT,
    "conservative": DEFAULT.with_(rating_weight=0.50, popularity_weight=0.35,
                                  sentiment_weight=0.10, length_weight=0.05,
                                  name="conservative"),
    "discovery": DEFAULT.with_(rating_weight=0.60, popularity_weight=0.10,
                               sentiment_weight=0.25, length_weight=0.05,
                               name="discovery"),
    "sentiment_first": DEFAULT.with_(rating_weight=0.25, popularity_weight=0.20,
                                     sentiment_weight=0.50, length_weight=0.05,
                                     name="sentiment_first"),
}

LEGACY3 = DEFAULT.with_(rating_weight=0.40, popularity_weight=0.30,
                        sentiment_weight=0.30, length_weight=0.0,
                        excluded_genres=(), use_review_sentiment=False,
                        name="legacy3")


def star_config(base: ScoringConfig = DEFAULT) -> ScoringConfig:
    """Thresholds rescaled to the driver's star tables (max ~1,500 ratings).

    Household stands in for comics as the excluded visual category.
    """
    return base.with_(min_ratings_high=900, min_ratings_medium=600,
                      excluded_genres=("household", UNCATEGORISED)
                      if base.excluded_genres else ())
