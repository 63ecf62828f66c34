"""Yearly series, correlation and outliers.

Windows without a partition run only over yearly tables, which have one row per calendar year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalens.functions.casting import number_column, year_column
from catalens.functions.scalars import (
    best_key, direction_label, finite, line_slope, return_percent, rounded, strength_label,
)
from catalens.operators.quantiles import exact_quantiles
from catalens.operators.selection import positive_pairs
from catalens.roles import require


def yearly_series(df: DataFrame, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """Per year: titled rows, mean rating and (where there is one) total income."""
    columns = [year_column(df).alias("year"), F.col("title"), number_column(df, "vote_average").alias("rating")]
    parts = [F.count("title").alias("movie_count"), F.avg("rating").alias("avg_rating")]
    if "revenue" in df.columns:
        columns.append(number_column(df, "revenue").alias("revenue"))
        parts.append(F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("total_revenue"))
    rows = df.select(*columns).filter(F.col("year").isNotNull())
    if start_year is not None:
        rows = rows.filter(F.col("year") >= start_year)
    if end_year is not None:
        rows = rows.filter(F.col("year") <= end_year)
    return rows.groupBy("year").agg(*parts)


def trend_columns(series: DataFrame) -> DataFrame:
    """Trailing three-year means and year-over-year percentages over the years present.

    A change from a zero year is null (a ratio to nothing has no size to rank)."""
    order = Window.orderBy("year")
    trailing = order.rowsBetween(-2, 0)
    added = {}
    for c, change in (("movie_count", "movie_count_yoy_percent"), ("total_revenue", "revenue_yoy_percent")):
        if c in series.columns:
            before = F.lag(c).over(order)
            added[f"{c}_ma3"] = F.avg(c).over(trailing)
            added[change] = F.try_divide(F.col(c) - before, before) * 100
    return series.withColumns(added)


def production_trend(
    df: DataFrame, start_year: int | None = None, end_year: int | None = None, digits: bool = True
) -> DataFrame:
    """One row on volume over time (none when no year qualifies)."""
    series = yearly_series(df, start_year, end_year).select("year", "movie_count")
    order = Window.orderBy("year")
    before = F.lag("movie_count").over(order)
    grown = series.withColumn("growth", F.try_divide(F.col("movie_count") - before, before))
    year, count = F.col("year").cast("double"), F.col("movie_count").cast("double")
    slope = line_slope(count, year)
    out = grown.agg(
        F.count("*").alias("years"),
        F.min("year").alias("start_year"),
        F.max("year").alias("end_year"),
        F.sum("movie_count").alias("total_movies"),
        F.avg("movie_count").alias("average_movies_per_year"),
        best_key(F.col("movie_count"), F.col("year")).alias("peak_year"),
        F.max("movie_count").alias("peak_count"),
        slope.alias("trend_slope"),
        (F.coalesce(F.avg("growth"), F.lit(0.0)) * 100).alias("average_growth_rate"),
        (F.avg(count) - slope * (F.avg(year) - F.min(year))).alias("regression_intercept"),
    ).filter("years > 0")
    d = (lambda n: n) if digits else (lambda n: None)
    return out.select(
        F.format_string("%d-%d", "start_year", "end_year").alias("period"),
        "total_movies",
        rounded(F.col("average_movies_per_year"), d(2)).alias("average_movies_per_year"),
        "peak_year",
        "peak_count",
        direction_label(F.col("trend_slope")).alias("trend_direction"),
        rounded(F.col("trend_slope"), d(4)).alias("trend_slope"),
        rounded(F.col("average_growth_rate"), d(2)).alias("average_growth_rate"),
        rounded(F.col("regression_intercept"), d(4)).alias("regression_intercept"),
    )


def time_series_summary(df: DataFrame, digits: bool = True) -> DataFrame:
    """One row of peaks, slopes and latest trailing means over the yearly series."""
    series = trend_columns(yearly_series(df))
    year = F.col("year").cast("double")
    latest = F.max(F.struct("year", "movie_count_ma3", "total_revenue_ma3"))
    out = series.agg(
        F.count("*").alias("years"),
        F.min("year").alias("start_year"),
        F.max("year").alias("end_year"),
        best_key(F.col("movie_count"), F.col("year")).alias("peak_movie_count_year"),
        F.max("movie_count").alias("peak_movie_count"),
        best_key(F.col("total_revenue"), F.col("year")).alias("peak_revenue_year"),
        F.max("total_revenue").alias("peak_revenue"),
        best_key(F.col("avg_rating"), F.col("year")).alias("highest_rating_year"),
        F.max("avg_rating").alias("highest_rating"),
        line_slope(F.col("movie_count").cast("double"), year).alias("movie_count_trend_slope"),
        line_slope(F.col("total_revenue"), year).alias("revenue_trend_slope"),
        latest.alias("latest"),
        best_key(F.col("revenue_yoy_percent"), F.col("year")).alias("strongest_revenue_growth_year"),
    ).filter("years > 0")
    d = (lambda n: n) if digits else (lambda n: None)
    return out.select(
        F.format_string("%d-%d", "start_year", "end_year").alias("period"),
        "start_year", "end_year", "peak_movie_count_year", "peak_movie_count", "peak_revenue_year",
        rounded(F.col("peak_revenue"), d(2)).alias("peak_revenue"),
        "highest_rating_year",
        rounded(F.col("highest_rating"), d(2)).alias("highest_rating"),
        direction_label(F.col("movie_count_trend_slope")).alias("movie_count_trend"),
        direction_label(F.col("revenue_trend_slope")).alias("revenue_trend"),
        rounded(F.col("movie_count_trend_slope"), d(4)).alias("movie_count_trend_slope"),
        rounded(F.col("revenue_trend_slope"), d(2)).alias("revenue_trend_slope"),
        rounded(F.col("latest.movie_count_ma3"), d(2)).alias("latest_movie_count_ma3"),
        rounded(F.col("latest.total_revenue_ma3"), d(2)).alias("latest_revenue_ma3"),
        "strongest_revenue_growth_year",
    )


def budget_revenue_correlation(df: DataFrame, observed_only: bool = False, digits: bool = True) -> DataFrame:
    """One row on the line through (budget, revenue) and on returns; none for fewer than two pairs.

    ``observed_only`` leaves imputed values out where the catalog carries observed flags."""
    require(df, "budget", "revenue", "title")
    source = df.filter("budget_observed and revenue_observed") if observed_only else df
    pairs = positive_pairs(source).withColumn("roi", return_percent(F.col("budget"), F.col("revenue")))
    x, y = F.col("budget"), F.col("revenue")
    tie = F.col("id") if "id" in df.columns else F.col("title")
    stats = pairs.agg(
        F.count("*").alias("n"),
        F.avg(x).alias("mx"), F.avg(y).alias("my"), F.var_pop(x).alias("vx"), F.var_pop(y).alias("vy"),
        F.covar_pop(x, y).alias("cxy"), F.avg("roi").alias("roi"),
        F.min(F.struct((-F.col("roi")).alias("r"), tie.alias("k"), F.col("title").alias("t"))).alias("best"),
    ).filter("n >= 2")
    middle = exact_quantiles(pairs.select("roi"), [], {"roi": "roi"}).select("value").scalar()
    slope = F.coalesce(F.try_divide(F.col("cxy"), F.col("vx")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("cxy"), F.sqrt("vx") * F.sqrt("vy")), F.lit(0.0))
    d = (lambda k: k) if digits else (lambda k: None)
    return stats.select(
        F.col("n").alias("sample_size"),
        rounded(r, d(4)).alias("correlation"),
        strength_label(r).alias("correlation_strength"),
        rounded(r * r, d(4)).alias("r_squared"),
        rounded(slope, d(4)).alias("regression_slope"),
        rounded(F.col("my") - slope * F.col("mx"), d(2)).alias("regression_intercept"),
        rounded(F.col("roi"), d(2)).alias("average_roi"),
        rounded(middle, d(2)).alias("median_roi"),
        F.col("best.t").alias("best_roi_movie"),
        rounded(-F.col("best.r"), d(2)).alias("best_roi_value"),
    )


def outlier_bounds(df: DataFrame, column: str = "revenue") -> DataFrame:
    """One row: mean, population std, quartiles, IQR and fences of a measure."""
    require(df, column)
    values = df.select(number_column(df, column).alias("v"))
    quartiles = (
        exact_quantiles(values, [], {"v": "v"}, (0.25, 0.75))
        .agg(F.min("value").alias("q1"), F.max("value").alias("q3"))
        .select(F.struct("q1", "q3"))
        .scalar()
    )
    q1, q3 = F.col("quartiles.q1"), F.col("quartiles.q3")
    moments = values.agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std")).filter("mean is not null")
    return moments.withColumn("quartiles", quartiles).select(
        "mean", "std", q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"),
        (q1 - 1.5 * (q3 - q1)).alias("lower"), (q3 + 1.5 * (q3 - q1)).alias("upper"),
    )


def outlier_rows(df: DataFrame, column: str = "revenue") -> DataFrame:
    """Rows outside the IQR fences, with the fences applied as a scalar subquery (no join)."""
    fence = outlier_bounds(df, column).select(F.struct("lower", "upper")).scalar()
    v = number_column(df, column)
    return df.filter((v < fence.getField("lower")) | (v > fence.getField("upper")))


def outlier_summary(df: DataFrame, column: str = "revenue", examples: int = 10, digits: bool = True) -> DataFrame:
    """One row: location, spread, counts beyond 3 standard deviations and outside the IQR fences, and
    the titles of the first outliers by id."""
    bounds = outlier_bounds(df, column)
    b = bounds.select(F.struct("*")).scalar()
    v = number_column(df, column)
    marked = df.select(
        *[c for c in ("id", "title") if c in df.columns],
        v.alias("v"), ((v < b.getField("lower")) | (v > b.getField("upper"))).alias("outside"),
        (F.try_divide(F.abs(v - b.getField("mean")), b.getField("std")) > 3).alias("far"),
    )
    counts = marked.agg(F.count_if("far").alias("far"), F.count_if("outside").alias("outside"))
    d = (lambda n: n) if digits else (lambda n: None)
    found = F.array().cast("array<struct<k:string,t:string>>")
    if "title" in df.columns:
        key = "id" if "id" in df.columns else "title"
        first = marked.filter("outside").orderBy(key).limit(examples).select(F.struct(F.col(key).alias("k"), F.col("title").alias("t")).alias("e"))
        found = first.agg(F.array_sort(F.collect_list("e"))).scalar()
    return (
        counts.withColumn("b", b)
        .withColumn("found", found)
        .filter("b is not null")
        .select(
            F.lit(column).alias("column"),
            *[rounded(F.col(f"b.{c}"), d(2)).alias(c) for c in ("mean", "std", "q1", "q3", "iqr")],
            F.col("far").alias("z_score_outliers"),
            F.col("outside").alias("iqr_outliers"),
            F.transform("found", lambda e: e["t"].cast("string")).alias("example_titles"),
        )
    )


def log_log_line(df: DataFrame) -> DataFrame:
    """One row: least-squares line of log10(revenue) on log10(budget), with the range of budgets."""
    pairs = positive_pairs(df).select("budget", F.log10("budget").alias("x"), F.log10("revenue").alias("y"))
    slope = line_slope(F.col("y"), F.col("x"))
    return pairs.agg(
        F.count("*").alias("sample_size"), slope.alias("slope"), (F.avg("y") - slope * F.avg("x")).alias("intercept"),
        F.min("budget").alias("low"), F.max("budget").alias("high"),
    ).filter("sample_size >= 2")


def log_log_points(line: DataFrame, points: int = 200) -> DataFrame:
    """Geometrically spaced points of that line."""
    steps = line.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = F.log10("low") + (F.log10("high") - F.log10("low")) * F.col("point") / (points - 1)
    return steps.select("point", F.pow(F.lit(10.0), x).alias("budget"), F.pow(F.lit(10.0), F.col("slope") * x + F.col("intercept")).alias("revenue"))
