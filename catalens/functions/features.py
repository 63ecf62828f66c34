"""Regressor expressions of the forecast and profile models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalens.functions.scalars import month_wave, quarter_label
from catalens.functions.text import is_english, is_us_production

# Numeric regressors in model order, ahead of the category columns.
BASE_FEATURES = (
    "log_budget", "log_budget_sq", "runtime", "runtime_sq", "year", "month_sin", "month_cos",
    "is_english", "is_us_production", "budget_observed", "runtime_observed",
)


def base_features() -> dict[str, Column]:
    """Unfilled regressors of a prepared row: nulls only in the budget and runtime terms."""
    wave = month_wave(F.col("month"))
    log_budget = F.log1p("budget")
    return {
        "log_budget": log_budget,
        "log_budget_sq": log_budget * log_budget,
        "runtime": F.col("runtime"),
        "runtime_sq": F.col("runtime") * F.col("runtime"),
        "year": F.col("year").cast("double"),
        "month_sin": wave[0],
        "month_cos": wave[1],
        "is_english": is_english(F.col("language")).cast("double"),
        "is_us_production": is_us_production(F.col("country")).cast("double"),
        "budget_observed": F.col("budget_observed").cast("double"),
        "runtime_observed": F.col("runtime_observed").cast("double"),
    }


def one_hot(value: Column, levels: list[str], prefix: str) -> dict[str, Column]:
    return {f"{prefix}::{level}": (value == level).cast("double") for level in levels}


def category_features(levels: list[str]) -> dict[str, Column]:
    """Indicator and log-budget interaction per level; the first (sorted) level is the base."""
    out: dict[str, Column] = {}
    spend = F.coalesce(F.log1p("budget"), F.lit(0.0))
    for level in sorted(levels)[1:]:
        flag = (F.col("primary_genre") == level).cast("double")
        out[f"genre::{level}"] = flag
        out[f"log_budget_x_genre::{level}"] = spend * flag
    return out


def grouped_category(levels: list[str]) -> Column:
    """Category with everything outside ``levels`` as ``Other`` where ``Other`` is a level."""
    value = F.coalesce(F.col("primary_genre"), F.lit("Unknown"))
    if "Other" not in levels:
        return value
    named = [x for x in levels if x != "Other"]
    return F.when(value.isin(named), value).otherwise("Other") if named else F.lit("Other")


def profile_features(levels: list[str], quarters: list[str]) -> dict[str, Column]:
    """Profile regressors: every given quarter and category level gets a column, none is dropped."""
    return {
        "log_budget": F.log1p("budget"),
        "runtime": F.col("runtime"),
        "is_english": is_english(F.col("language")).cast("double"),
        "is_us_production": is_us_production(F.col("country")).cast("double"),
        **one_hot(quarter_label(F.col("month")), quarters, "quarter"),
        **one_hot(grouped_category(levels), levels, "genre"),
    }
