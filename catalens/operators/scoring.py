"""Error metrics, per-category holdout summaries and model comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.functions.scalars import absolute_percent_error, model_label, pearson, rounded

# Decimals of reported figures.
_DIGITS = {
    "mae": 2, "rmse": 2, "mape_percent": 2, "wape_percent": 2, "r_squared": 4,
    "actual_total_revenue": 2, "predicted_total_revenue": 2, "revenue_bias_percent": 2,
}


def error_metrics(actual: Column, predicted: Column) -> dict[str, Column]:
    """MAE, RMSE, MAPE over positive actuals, WAPE and R2 as aggregates."""
    error = F.abs(predicted - actual)
    total_square = F.var_pop(actual) * F.count(actual)
    return {
        "mae": F.avg(error),
        "rmse": F.sqrt(F.avg(error * error)),
        "mape_percent": F.coalesce(F.avg(F.when(actual > 0, error / actual * 100)), F.lit(0.0)),
        "wape_percent": F.coalesce(F.try_divide(F.sum(error), F.sum(actual)) * 100, F.lit(0.0)),
        "r_squared": F.when(total_square > 0, 1 - F.sum(error * error) / total_square).otherwise(0.0),
    }


def _rounded_all(df: DataFrame, digits: bool, prefix: str = "") -> DataFrame:
    if not digits:
        return df
    return df.withColumns({f"{prefix}{c}" if f"{prefix}{c}" in df.columns else c: rounded(F.col(f"{prefix}{c}" if f"{prefix}{c}" in df.columns else c), n)
                           for c, n in _DIGITS.items() if f"{prefix}{c}" in df.columns or c in df.columns})


def category_holdout_summary(scored: DataFrame, keys: list[str], digits: bool = True) -> DataFrame:
    """Metrics, totals, bias and date span per keys and category.

    ``scored`` has genre, model_type, train_samples, release_date, actual_revenue, predicted_revenue."""
    a, p = F.col("actual_revenue"), F.col("predicted_revenue")
    metrics = error_metrics(a, p)
    out = scored.groupBy(*keys, "genre", "model_type", "train_samples").agg(
        F.count("*").alias("validation_samples"),
        *[c.alias(n) for n, c in metrics.items()],
        F.sum(a).alias("actual_total_revenue"),
        F.sum(p).alias("predicted_total_revenue"),
        F.coalesce(F.try_divide(F.sum(p) - F.sum(a), F.sum(a)) * 100, F.lit(0.0)).alias("revenue_bias_percent"),
        F.min("release_date").alias("validation_start"),
        F.max("release_date").alias("validation_end"),
    )
    return _rounded_all(out, digits)


def fold_overview(scored: DataFrame, keys: list[str], training: DataFrame, digits: bool = True) -> DataFrame:
    """Overall metrics per keys (model_name, validation_year); ``training`` has the rows per fold."""
    a, p = F.col("actual_revenue"), F.col("predicted_revenue")
    by_genre = scored.select("model_name", "validation_year", "genre").distinct().groupBy("model_name", "validation_year").agg(
        F.count("genre").alias("genres_evaluated")
    )
    out = (
        scored.groupBy(*keys)
        .agg(
            F.count("*").alias("validation_rows"),
            *[c.alias(f"overall_{n}") for n, c in error_metrics(a, p).items()],
            F.sum(a).alias("actual_total_revenue"),
            F.sum(p).alias("predicted_total_revenue"),
            F.min("release_date").alias("validation_start"),
            F.max("release_date").alias("validation_end"),
        )
        .join(by_genre, ["model_name", "validation_year"])
        .join(training, "validation_year")
        .withColumn("model_label", model_label(F.col("model_name")))
    )
    out = _rounded_all(out, digits, "overall_")
    return out.select(
        "model_name", "model_label", "validation_year", "training_rows", "validation_rows", "genres_evaluated",
        "overall_mae", "overall_rmse", "overall_mape_percent", "overall_wape_percent", "overall_r_squared",
        "actual_total_revenue", "predicted_total_revenue", "validation_start", "validation_end",
    )


def row_errors(scored: DataFrame, digits: bool = True) -> DataFrame:
    """Absolute and percentage error per row."""
    a, p = F.col("actual_revenue"), F.col("predicted_revenue")
    out = scored.withColumns({"absolute_error": F.abs(p - a), "ape_percent": absolute_percent_error(a, p)})
    if digits:
        columns = ("budget", "runtime", "actual_revenue", "predicted_revenue", "absolute_error", "ape_percent")
        out = out.withColumns({c: rounded(F.col(c), 2) for c in columns if c in out.columns})
    return out


def model_comparison(overview: DataFrame, digits: int | None = 4, ordered: bool = True) -> DataFrame:
    """Per model: years, mean metrics, correlation of yearly totals; best model first."""
    a, p = F.col("actual_total_revenue"), F.col("predicted_total_revenue")
    years = overview.groupBy("model_name", "model_label")
    out = years.agg(
        F.count("validation_year").alias("years_evaluated"),
        F.avg("overall_wape_percent").alias("average_wape_percent"),
        F.avg("overall_r_squared").alias("average_r_squared"),
        F.avg("overall_mae").alias("average_mae"),
        F.avg("overall_rmse").alias("average_rmse"),
        pearson(a, p).alias("yearly_revenue_correlation"),
    )
    figures = ("average_wape_percent", "average_r_squared", "average_mae", "average_rmse", "yearly_revenue_correlation")
    out = out.withColumns({c: rounded(F.col(c), digits) for c in figures})
    return rank_models(out) if ordered else out


def rank_models(summary: DataFrame) -> DataFrame:
    return summary.orderBy(
        F.desc("yearly_revenue_correlation"), F.asc("average_wape_percent"), F.desc("average_r_squared"), F.asc("model_name")
    )


def best_model(summary: DataFrame) -> DataFrame:
    """The first row of the ranking, as a bounded top-k."""
    return rank_models(summary).limit(1)
