"""Chart-ready tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.functions.scalars import fold_year_label
from catalens.operators import trends
from catalens.operators.scoring import best_model
from catalens.operators.selection import positive_pairs


def _leading(categories: DataFrame, top_n: int | None) -> DataFrame:
    kept = categories.filter(F.col("genre").isNotNull())
    return kept.orderBy(F.desc("movie_count"), F.desc_nulls_last("avg_rating"), "genre").limit(top_n) if top_n else kept


def category_bars(categories: DataFrame, top_n: int | None = 12) -> DataFrame:
    """Largest categories, smallest bar first."""
    return _leading(categories, top_n).select("genre", "movie_count").orderBy("movie_count", F.desc("genre"))


def category_comparison(categories: DataFrame, top_n: int = 12) -> DataFrame:
    return _leading(categories, top_n).select("genre", "movie_count", "avg_rating")


def yearly_trend(years: DataFrame) -> DataFrame:
    """Yearly points with the covered span."""
    span = years.agg(F.struct(F.min("year").alias("first_year"), F.max("year").alias("last_year"))).scalar()
    return years.filter(F.col("year").isNotNull()).select(
        "year", "movie_count", "avg_rating", span.getField("first_year").alias("first_year"), span.getField("last_year").alias("last_year")
    )


def budget_revenue_points(df: DataFrame, fraction: float | None = None, seed: int = 42) -> DataFrame:
    """All positive pairs; ``fraction`` thins them out for drawing when asked to."""
    points = positive_pairs(df).select(*[c for c in ("id", "title") if c in df.columns], "budget", "revenue")
    return points.sample(fraction=fraction, seed=seed) if fraction else points


def budget_revenue_line(df: DataFrame, points: int = 200) -> DataFrame:
    return trends.log_log_points(trends.log_log_line(df), points)


def holdout_comparison(summary: DataFrame, top_n: int = 10) -> DataFrame:
    """Categories with the largest actual totals, actual against predicted."""
    return (
        summary.filter("genre is not null and actual_total_revenue is not null and predicted_total_revenue is not null")
        .orderBy(F.desc("actual_total_revenue"), "genre")
        .limit(top_n)
        .select("genre", "actual_total_revenue", "predicted_total_revenue")
    )


def accuracy_trend(overview: DataFrame) -> DataFrame:
    return overview.select("validation_year", "overall_wape_percent", "overall_r_squared", "validation_rows").orderBy("validation_year")


def yearly_comparison(overview: DataFrame, summary: DataFrame, cutoff: str) -> DataFrame:
    """Yearly totals of the best model."""
    best = best_model(summary).select("model_name")
    return (
        overview.join(best, "model_name", "left_semi")
        .select(
            "validation_year", fold_year_label(F.col("validation_year"), cutoff).alias("label"), "model_name", "model_label",
            "actual_total_revenue", "predicted_total_revenue", "overall_wape_percent",
        )
        .orderBy("validation_year")
    )


def actual_by_year(overview: DataFrame) -> DataFrame:
    """One actual total per year: all models of a year were scored on the same rows."""
    return overview.groupBy("validation_year").agg(
        F.min_by("actual_total_revenue", "model_name").alias("actual_total_revenue")
    )


def model_lines(overview: DataFrame, summary: DataFrame) -> DataFrame:
    """A line per model (with its mean WAPE) and one for the actual totals."""
    lines = overview.join(summary.select("model_name", "average_wape_percent"), "model_name", "left").select(
        "validation_year", F.col("model_label").alias("series"), F.col("predicted_total_revenue").alias("total"), "average_wape_percent"
    )
    actual = actual_by_year(overview).select(
        "validation_year", F.lit("Actual Revenue").alias("series"), F.col("actual_total_revenue").alias("total"),
        F.lit(None).cast("double").alias("average_wape_percent"),
    )
    return lines.unionByName(actual)
