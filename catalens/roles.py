"""Canonical column names and the mapping from a user's columns onto them."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The cleaned table's columns, in output order.
CLEANED_COLUMNS = (
    "id", "source_id", "title", "original_title", "primary_genre", "budget", "budget_observed",
    "revenue", "revenue_observed", "release_date", "year", "runtime", "runtime_observed",
    "vote_average", "vote_count", "popularity", "language", "original_language", "country", "keyword",
)
# Columns an already cleaned input must bring along.
REQUIRED_CLEANED_COLUMNS = tuple(
    c for c in CLEANED_COLUMNS if c not in ("source_id", "original_title", "original_language")
)
# Typed groups of the cleaned table, fill defaults and the default last day.
MEASURES = ("budget", "revenue", "runtime", "vote_average", "vote_count", "popularity")
OBSERVED = {"budget": "budget_observed", "revenue": "revenue_observed", "runtime": "runtime_observed"}
TEXTS = ("title", "original_title", "primary_genre", "language", "original_language", "country", "keyword")
TEXT_DEFAULTS = {
    "primary_genre": "Unknown", "language": "unknown", "original_language": "unknown",
    "country": "Unknown", "keyword": "Unknown",
}
DEFAULT_CUTOFF = "2017-07-31"


@dataclass(frozen=True)
class Roles:
    """Which of the user's columns (names or Spark expressions) plays which canonical role.

    ``Roles(id="o_orderkey", title="c_name", ...).bind(df)`` yields a catalog every operator accepts;
    roles left out do not appear in it, and each operator says which ones it needs.
    """

    id: str | Column | None = None
    source_id: str | Column | None = None
    title: str | Column | None = None
    original_title: str | Column | None = None
    primary_genre: str | Column | None = None
    budget: str | Column | None = None
    budget_observed: str | Column | None = None
    revenue: str | Column | None = None
    revenue_observed: str | Column | None = None
    release_date: str | Column | None = None
    year: str | Column | None = None
    runtime: str | Column | None = None
    runtime_observed: str | Column | None = None
    vote_average: str | Column | None = None
    vote_count: str | Column | None = None
    popularity: str | Column | None = None
    language: str | Column | None = None
    original_language: str | Column | None = None
    country: str | Column | None = None
    keyword: str | Column | None = None

    def bind(self, df: DataFrame) -> DataFrame:
        bound = []
        for f in fields(self):
            source = getattr(self, f.name)
            if source is not None:
                bound.append((F.col(source) if isinstance(source, str) else source).alias(f.name))
        return df.select(*bound)


def require(df: DataFrame, *columns: str) -> None:
    """Plan-time schema contract: raise before any job when columns are missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {', '.join(missing)}")
