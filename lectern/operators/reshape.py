"""Wide → long reshapes and the primary category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S


def category_columns(wide: DataFrame, key: str = "book_id") -> list[str]:
    """Every data column: not the key, not an audit column (``_`` prefix)."""
    return [c for c in wide.columns if c != key and not c.startswith("_")]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stack_long(wide: DataFrame, key: str = "book_id", columns: Sequence[str] | None = None,
               name_col: str = "genre_name", value_col: str = "genre_count") -> DataFrame:
    """``stack`` generator; NULL counts are kept as rows."""
    cols = list(columns) if columns is not None else category_columns(wide, key)
    pairs = ", ".join(f"{_lit(c)}, {_q(c)}" for c in cols)
    return wide.selectExpr(_q(key), f"stack({len(cols)}, {pairs}) as ({name_col}, {value_col})")


def unpivot_long(wide: DataFrame, key: str = "book_id", columns: Sequence[str] | None = None,
                 name_col: str = "genre_name", value_col: str = "genre_count",
                 positive_only: bool = True) -> DataFrame:
    """``UNPIVOT`` semantics: NULL counts dropped, then (by default) ``> 0``."""
    cols = list(columns) if columns is not None else category_columns(wide, key)
    long = wide.unpivot([key], cols, name_col, value_col).filter(F.col(value_col).isNotNull())
    if positive_only:
        long = long.filter(F.col(value_col) > 0)
    return long


def primary_category(wide: DataFrame, key: str = "book_id", columns: Sequence[str] | None = None,
                     prefix: str = "genre_", out_col: str = "primary_genre") -> DataFrame:
    """The category with the largest positive count per key.

    Ties go to the smaller column name (the reference's tie is unordered).
    Instead of exploding every row into one row per category and windowing
    (rows × categories through a shuffle), each row picks its best category
    with ``array_max`` over ``struct(count, -name_rank, name)``; a per-key
    ``max`` then merges rows of the same key, with map-side partial
    aggregation, so a hot key never reaches one task whole.
    """
    cols = sorted(columns if columns is not None else category_columns(wide, key))
    cands = [
        F.when(F.col(_q(c)) > 0,
               F.struct(F.col(_q(c)).cast("bigint").alias("n"),
                        F.lit(-i).alias("tie"), F.lit(c).alias("name")))
        for i, c in enumerate(cols)
    ]
    best = F.array_max(F.array(*cands)) if len(cands) > 1 else cands[0]
    per_row = wide.select(F.col(_q(key)).alias(key), best.alias("_best")) \
        .filter(F.col("_best").isNotNull())
    return (per_row.groupBy(key).agg(F.max("_best").alias("_best"))
            .select(key, S.strip_prefix(F.col("_best.name"), prefix).alias(out_col)))
