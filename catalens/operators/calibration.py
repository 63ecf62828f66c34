"""Linear calibration of predictions per fold, with category calibrations shrunk towards it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalens.functions.scalars import clipped

# Rows for an own category line, rows at which it fully replaces the overall one,
# slope bounds and the range below which predictions count as constant.
MIN_SAMPLES, BLEND_SAMPLES = 20, 250
SLOPE_BOUNDS = (0.05, 10.0)
FLAT = 1e-9


def _line(n: Column, mean_p: Column, mean_a: Column, var_p: Column, cov: Column, span: Column) -> tuple[Column, Column]:
    """(intercept, slope) of actual on predicted with the guards for flat or inverted fits."""
    scale = F.when(mean_p > 0, F.try_divide(mean_a, mean_p)).otherwise(1.0)
    ratio = F.greatest(scale, F.lit(0.0))
    slope = F.try_divide(cov, var_p)
    flat = (n < 2) | (span <= FLAT)
    usable = ~flat & (slope > 0)
    bounded = F.when(flat, ratio).otherwise(clipped(F.when(usable, slope).otherwise(ratio), *SLOPE_BOUNDS))
    return F.when(usable, mean_a - slope * mean_p).otherwise(0.0), bounded


def prediction_moments(scored: DataFrame, keys: list[str], predicted: str = "base_prediction", actual: str = "revenue") -> DataFrame:
    p, a = F.col(predicted), F.col(actual)
    return scored.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(p).alias("mp"), F.avg(a).alias("ma"), F.var_pop(p).alias("vp"),
        F.covar_pop(p, a).alias("cpa"), F.min(p).alias("low"), F.max(p).alias("high"),
    )


def linear_calibration(scored: DataFrame, keys: list[str], predicted: str = "base_prediction", actual: str = "revenue") -> DataFrame:
    """One line per keys: (intercept, slope)."""
    m = prediction_moments(scored, keys, predicted, actual)
    c = F.col
    intercept, slope = _line(c("n"), c("mp"), c("ma"), c("vp"), c("cpa"), c("high") - c("low"))
    return m.select(*keys, intercept.alias("intercept"), slope.alias("slope"))


def category_calibrations(scored: DataFrame, fold_keys: list[str], predicted: str = "base_prediction", actual: str = "revenue") -> DataFrame:
    """(intercept, slope) per fold and category, and the fold's own line next to it.

    The rows are aggregated once, by category; the fold's moments are combined from the categories'.
    """
    m = prediction_moments(scored, [*fold_keys, "primary_genre"], predicted, actual)
    fold = Window.partitionBy(*fold_keys)
    c = F.col
    m = m.withColumns({"all_n": F.sum("n").over(fold), "all_low": F.min("low").over(fold), "all_high": F.max("high").over(fold)})
    m = m.withColumns({"all_mp": F.sum(c("n") * c("mp")).over(fold) / c("all_n"), "all_ma": F.sum(c("n") * c("ma")).over(fold) / c("all_n")})
    dp, da = c("mp") - c("all_mp"), c("ma") - c("all_ma")
    m = m.withColumns(
        {
            "all_vp": F.sum(c("n") * (c("vp") + dp * dp)).over(fold) / c("all_n"),
            "all_cpa": F.sum(c("n") * (c("cpa") + dp * da)).over(fold) / c("all_n"),
        }
    )
    gi, gs = _line(c("all_n"), c("all_mp"), c("all_ma"), c("all_vp"), c("all_cpa"), c("all_high") - c("all_low"))
    m = m.withColumns({"all_intercept": gi, "all_slope": gs})
    own_i, own_s = _line(c("n"), c("mp"), c("ma"), c("vp"), c("cpa"), c("high") - c("low"))
    enough = (c("n") >= MIN_SAMPLES) & (c("high") - c("low") > FLAT)
    w_own = F.least(F.lit(1.0), c("n") / float(BLEND_SAMPLES))
    w_few = F.least(F.lit(1.0), c("n") / float(MIN_SAMPLES))
    scale = F.try_divide(c("ma"), c("mp"))
    intercept = (
        F.when(enough, c("all_intercept") * (1 - w_own) + own_i * w_own)
        .when(c("mp") > 0, c("all_intercept") * (1 - w_few))
        .otherwise(c("all_intercept"))
    )
    slope = (
        F.when(enough, c("all_slope") * (1 - w_own) + own_s * w_own)
        .when(c("mp") > 0, c("all_slope") * (1 - w_few) + scale * w_few)
        .otherwise(c("all_slope"))
    )
    return m.select(
        *fold_keys, "primary_genre", intercept.alias("intercept"), clipped(slope, *SLOPE_BOUNDS).alias("slope"),
        "all_intercept", "all_slope",
    )


def calibrated(base: Column, intercept: Column, slope: Column) -> Column:
    return F.greatest(intercept + slope * base, F.lit(0.0))
