"""Labels, arithmetic and guarded statistics as column expressions."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quarter labels in calendar order.
QUARTERS = ("Q1 (Jan-Mar)", "Q2 (Apr-Jun)", "Q3 (Jul-Sep)", "Q4 (Oct-Dec)")
# Forecast model names, their display labels and the prefixes of their type labels.
MODEL_LABELS = {
    "ridge": "Ridge Regression",
    "ols": "OLS Regression",
    "genre_budget_ratio": "Genre Budget Ratio",
    "random_forest": "Random Forest Regression",
}
MODEL_PREFIXES = {
    "ridge": "global_ridge",
    "ols": "global_ols",
    "genre_budget_ratio": "genre_budget_ratio",
    "random_forest": "random_forest",
}
# Display names of the profile features.
FEATURE_NAMES = {
    "log_budget": "Higher production budget",
    "runtime": "Longer runtime",
    "is_english": "English-language release",
    "is_us_production": "United States production",
}


def quarter_label(month: Column) -> Column:
    quarter = F.ceil(month / 3).cast("int")
    return F.coalesce(
        F.try_element_at(F.array(*[F.lit(q) for q in QUARTERS]), F.when(month.between(1, 12), quarter)), F.lit("Unknown")
    )


def month_wave(month: Column) -> tuple[Column, Column]:
    angle = month * (2 * pi / 12)
    return F.sin(angle), F.cos(angle)


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def return_percent(cost: Column, income: Column) -> Column:
    return F.try_divide(income - cost, cost) * 100


def clipped(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(c, F.lit(float(high))), F.lit(float(low)))


def strength_label(r: Column) -> Column:
    size = F.abs(r)
    return (
        F.when(size >= 0.7, "Strong correlation")
        .when(size >= 0.5, "Moderate correlation")
        .when(size >= 0.3, "Weak correlation")
        .otherwise("Very weak or no correlation")
    )


def direction_label(slope: Column) -> Column:
    return F.when(slope > 0, "increasing").when(slope < 0, "decreasing").otherwise("stable")


def model_type_label(model: Column, train_rows: Column, min_train_rows: int) -> Column:
    prefix = F.lower(F.trim(model))
    known = F.create_map(*[F.lit(x) for pair in MODEL_PREFIXES.items() for x in pair])[prefix]
    suffix = F.when(train_rows >= min_train_rows, "_calibrated").otherwise("_shared")
    return F.coalesce(F.concat(known, suffix), prefix)


def model_label(model: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in MODEL_LABELS.items() for x in pair])[model]
    return F.coalesce(known, model)


def feature_display_name(feature: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in FEATURE_NAMES.items() for x in pair])[feature]
    tail = F.regexp_replace(feature, r"^[^:]*::", "")
    return (
        F.when(known.isNotNull(), known)
        .when(feature.startswith("quarter::"), F.concat(F.lit("Release in "), tail))
        .when(feature.startswith("genre::"), F.concat(tail, F.lit(" genre")))
        .otherwise(F.initcap(F.replace(feature, F.lit("_"), F.lit(" "))))
    )


def fold_year_label(year: Column, cutoff: str) -> Column:
    """The year, marked as partial when the data ends inside it."""
    from datetime import date

    last = date.fromisoformat(cutoff)
    text = year.cast("string")
    if (last.month, last.day) == (12, 31):
        return text
    months = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
    return F.when(year == last.year, F.concat(text, F.lit(f" (Jan-{months[last.month - 1]} only)"))).otherwise(text)


def absolute_percent_error(actual: Column, predicted: Column) -> Column:
    return F.when(actual != 0, F.abs(predicted - actual) / actual * 100).otherwise(0.0)


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


# aggregates -----------------------------------------------------------------------------------


def line_slope(y: Column, x: Column) -> Column:
    """Least-squares slope; 0 when x does not vary."""
    return F.coalesce(F.try_divide(F.covar_pop(x, y), F.var_pop(x)), F.lit(0.0))


def pearson(x: Column, y: Column) -> Column:
    """Pearson r; 0 for fewer than two pairs or a constant side (a bare ``corr`` would divide by zero)."""
    return F.coalesce(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)), F.lit(0.0))


def best_key(value: Column, key: Column) -> Column:
    """Key of the largest value, the lowest key on ties (an ordinary ``max_by`` leaves ties open)."""
    return F.min(F.when(value.isNotNull(), F.struct((-value).alias("v"), key.alias("k"))))["k"]


def rounded(c: Column, digits: int | None) -> Column:
    """Half-even rounding to ``digits``; None keeps the value."""
    return c if digits is None else F.bround(c, digits)
