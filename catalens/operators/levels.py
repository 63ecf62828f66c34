"""Frequency tables and the category levels a profile keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.functions.text import strip

# How many levels a profile keeps and the rows a level needs.
MAX_GENRES, MIN_GENRE_ROWS = 8, 5


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-blank value."""
    return df.filter(strip(F.col(column).cast("string")) != "").groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))


def top_values(df: DataFrame, column: str, limit: int = 3) -> DataFrame:
    """Most frequent values, ties by value: a bounded top-k of the frequency table."""
    return value_counts(df, column).orderBy(F.desc("rows"), "value").limit(limit)


def category_levels(df: DataFrame, max_genres: int = MAX_GENRES, min_rows: int = MIN_GENRE_ROWS) -> list[str]:
    """Levels with enough rows, most frequent first; the most frequent ones regardless if none has;
    ``Other`` at the end when rows remain. At most ``max_genres + 1`` values reach the driver."""
    counts = value_counts(df, "primary_genre")
    ranked = counts.orderBy(F.desc(F.col("rows") >= min_rows), F.desc("rows"), "value").limit(max_genres)
    kept = [(r.value, r.rows) for r in ranked.collect()]
    frequent = [v for v, n in kept if n >= min_rows]
    chosen = frequent or [v for v, _ in kept]
    if not chosen:
        return []
    rest = counts.filter(~F.col("value").isin(chosen)).limit(1)
    return chosen if rest.isEmpty() else [*chosen, "Other"]
