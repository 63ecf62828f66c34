"""Category ratio model: median revenue-to-budget ratio, else median revenue, with overall fallbacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.operators.quantiles import Cumulative, exact_quantiles
from catalens.staging import stage


def fit_ratio(train: DataFrame, folds: list[int]) -> DataFrame:
    """One row per (validation_year, category): ratio and median target with fallbacks applied, and
    the number of training rows.

    Rows count for every later fold, which only the counts meet. A category of a fold always has a median target; it lacks a ratio
    only without any budget, and only folds with such a category need the overall ratio.
    """
    grown = Cumulative("year", "validation_year", tuple(folds))
    rows = train.select(
        "year", "primary_genre", F.when(F.col("budget") > 0, F.col("revenue") / F.col("budget")).alias("ratio"), "revenue"
    )
    keys = ["validation_year", "primary_genre"]
    medians = exact_quantiles(rows, ["primary_genre"], {"ratio": "ratio", "revenue": "revenue"}, cumulative=grown)
    wide = stage(
        medians.groupBy(*keys).agg(
            F.max(F.when(F.col("measure") == "ratio", F.col("value"))).alias("ratio"),
            F.max(F.when(F.col("measure") == "revenue", F.col("value"))).alias("usual"),
            F.max(F.when(F.col("measure") == "revenue", F.col("n"))).alias("train_samples"),
        )
    )
    ratio = F.col("ratio")
    lacking = wide.filter(ratio.isNull()).select("validation_year").distinct()
    if not lacking.isEmpty():
        overall = exact_quantiles(rows, [], {"ratio": "ratio"}, cumulative=grown)
        wide = wide.join(overall.select("validation_year", F.col("value").alias("overall")), "validation_year", "left")
        ratio = F.coalesce(ratio, F.col("overall"))
    return wide.select(
        *keys,
        "train_samples",
        F.struct(F.coalesce(ratio, F.lit(1.0)).alias("ratio"), F.coalesce("usual", F.lit(0.0)).alias("usual")).alias(
            "genre_budget_ratio"
        ),
    )


def ratio_prediction():
    """Uncalibrated prediction of a prepared row joined with its (fold, category) ratios."""
    m = F.col("genre_budget_ratio")
    return F.greatest(F.when(F.col("budget") > 0, F.col("budget") * m["ratio"]).otherwise(m["usual"]), F.lit(0.0))
