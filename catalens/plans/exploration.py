"""The exploration report of a selection and the comprehensive analysis of a catalog."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.functions.casting import number_column, year_column
from catalens.operators import selection, summaries, trends
from catalens.plans.profile import Profile, high_revenue_profile
from catalens.staging import stage


@dataclass
class Exploration:
    filtered: DataFrame
    genre_summary: DataFrame
    yearly_summary: DataFrame
    top_movies: DataFrame
    overview: DataFrame
    insights: DataFrame
    meta: DataFrame


def explore(df: DataFrame, filters: Mapping[str, object] | None = None, unicode: bool = True) -> Exploration:
    """Filter, summarise, rank. All parts are lazy; ``filtered`` is the plain selection, so a caller who
    takes many parts of an expensive one may persist it first and explore that."""
    filtered = selection.apply_filters(df, filters, unicode)
    categories = summaries.category_summary(filtered, ordered=False)
    years = summaries.yearly_summary(filtered, ordered=False)
    return Exploration(
        filtered,
        categories.orderBy(F.desc("movie_count"), F.desc_nulls_last("avg_rating"), "genre"),
        years.orderBy("year"),
        selection.top_titles(filtered),
        summaries.dataset_overview(filtered),
        summaries.insights(filtered, categories, years),
        summaries.selection_meta(df, filtered),
    )


def typed_catalog(df: DataFrame) -> DataFrame:
    """Year added where there is only a date; the analysed measures as numbers."""
    rows = df
    if "year" in df.columns or "release_date" in df.columns:
        rows = rows.withColumn("year", year_column(df))
    return rows.withColumns(
        {c: number_column(df, c) for c in ("budget", "revenue", "runtime", "vote_average") if c in df.columns}
    )


@dataclass
class Comprehensive:
    production_trend: DataFrame
    yearly_data: DataFrame
    time_series_summary: DataFrame
    yearly_series: DataFrame
    budget_revenue_correlation: DataFrame
    decade_statistics: DataFrame
    decade_leaders: DataFrame
    genre_performance: DataFrame
    high_revenue_profile: Profile


def comprehensive_analysis(
    df: DataFrame, unique_ids: bool = False, stored: bool = False, modelling: DataFrame | None = None
) -> Comprehensive:
    """``stored``: ``df`` lies in files with typed columns, so it needs no copy to be read several times.
    ``modelling``: its modelling table, staged, where there is one."""
    rows = typed_catalog(df) if stored else stage(typed_catalog(df))
    series = trends.yearly_series(rows)
    decades = summaries.decade_summary(rows)
    return Comprehensive(
        trends.production_trend(rows),
        series.select("year", "movie_count", "avg_rating").orderBy("year"),
        trends.time_series_summary(rows),
        trends.trend_columns(series).orderBy("year"),
        trends.budget_revenue_correlation(rows),
        decades,
        summaries.decade_leaders(decades),
        summaries.category_performance(rows),
        high_revenue_profile(rows, unique_ids=unique_ids) if modelling is None else high_revenue_profile(modelling, prepared=True, stored=True),
    )


def production_trend(df: DataFrame, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    return trends.production_trend(typed_catalog(df), start_year, end_year)


def budget_revenue_analysis(df: DataFrame, observed_only: bool = False) -> DataFrame:
    return trends.budget_revenue_correlation(typed_catalog(df), observed_only)
