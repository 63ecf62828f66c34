"""Which traits go with high revenue: a ridge model on the log target and the rows it ranks high."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.functions.features import grouped_category, profile_features
from catalens.functions.scalars import QUARTERS, feature_display_name, quarter_label
from catalens.functions.text import is_english, is_us_production
from catalens.operators.levels import category_levels, top_values
from catalens.operators.modelling import eligible_rows, prepare_modelling
from catalens.operators.quantiles import exact_medians, exact_quantiles
from catalens.operators.scoring import error_metrics
from catalens.operators.sequence import latest_rows_flag
from catalens.roles import DEFAULT_CUTOFF
from catalens.staging import stage

# Profile defaults.
MIN_ROWS, MIN_TRAIN_ROWS, MIN_HOLDOUT_ROWS, HOLDOUT_FRACTION = 40, 24, 8, 0.2
THRESHOLD_QUANTILE, ALPHA, FEATURE_THRESHOLD = 0.75, 6.0, 0.03


@dataclass
class RidgeFit:
    """Standardised coefficients and what a prediction needs, by feature name."""

    levels: list[str]
    quarters: list[str]
    coefficients: dict[str, float]
    means: dict[str, float]
    scales: dict[str, float]
    fills: dict[str, float]
    intercept: float

    def prediction(self) -> Column:
        score = F.lit(self.intercept)
        for name, c in profile_features(self.levels, self.quarters).items():
            filled = F.coalesce(c, F.lit(self.fills[name]))
            score = score + (filled - self.means[name]) * (self.coefficients[name] / self.scales[name])
        return F.greatest(F.expm1(score), F.lit(0.0))


@dataclass
class Profile:
    overview: DataFrame | None = None
    top_positive_features: DataFrame | None = None
    top_negative_features: DataFrame | None = None
    high_revenue_profile: DataFrame | None = None
    selected: DataFrame | None = None
    error: str | None = None


def fit_log_ridge(rows: DataFrame, alpha: float = ALPHA, levels: list[str] | None = None) -> RidgeFit:
    """Ridge on log1p(revenue) from moment sums per (category level, quarter).

    At most (levels + 1) x 4 rows of sums come to the driver, whatever the size of the data; the system
    solved there has as many unknowns as the profile has features.
    """
    import numpy as np

    levels = levels or category_levels(rows)
    budget_gap, runtime_gap = F.col("budget").isNull().cast("double"), F.col("runtime").isNull().cast("double")
    middle = exact_quantiles(rows.select("budget", "runtime"), [], {"budget": "budget", "runtime": "runtime"})
    found = {r.measure: r for r in middle.collect()}
    b, r = found.get("budget"), found.get("runtime")
    fill_b = (np.log1p(b.lower) + np.log1p(b.upper)) / 2 if b else 0.0
    fill_r = r.value if r else 0.0
    parts = {
        "one": F.lit(1.0),
        "log_budget": F.coalesce(F.log1p("budget") - float(fill_b), F.lit(0.0)),  # measured from the fill: gaps are 0
        "runtime": F.coalesce(F.col("runtime") - float(fill_r), F.lit(0.0)),
        "is_english": is_english(F.col("language")).cast("double"),
        "is_us_production": is_us_production(F.col("country")).cast("double"),
        "y": F.log1p("revenue"),
    }
    names = list(parts)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    level = F.when(grouped_category(levels).isin(levels), grouped_category(levels))
    narrow = rows.select(level.alias("level"), quarter_label(F.col("month")).alias("quarter"), *[c.alias(n) for n, c in parts.items()])
    blocks = (
        narrow.groupBy("level", "quarter")
        .agg(*[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"s{k}") for k, (i, j) in enumerate(pairs)])
        .collect()
    )
    present = {x.quarter for x in blocks}
    quarters = [q for q in QUARTERS if q in present]
    features = list(profile_features(levels, quarters))
    size = len(features) + 2
    gram = np.zeros((size, size))  # one, features, y
    place = {n: i + 1 for i, n in enumerate(features)}
    for x in blocks:
        small = np.zeros((len(names), len(names)))
        for k, (i, j) in enumerate(pairs):
            small[i, j] = small[j, i] = x[f"s{k}"]
        lift = np.zeros((size, len(names)))
        lift[0, 0], lift[size - 1, len(names) - 1] = 1.0, 1.0
        for n in names[1:-1]:
            lift[place[n], names.index(n)] = 1.0
        for n in (f"quarter::{x.quarter}", f"genre::{x.level}"):
            if n in place:
                lift[place[n], 0] = 1.0
        gram += lift @ small @ lift.T
    n = gram[0, 0]
    mean = gram[0, :] / n
    centred = gram - n * np.outer(mean, mean)
    var = np.diag(centred)[1:-1] / n
    flat = var <= 1e-12 * np.maximum(np.diag(gram)[1:-1] / n, 1e-300)
    scale = np.where(flat, 1.0, np.sqrt(np.where(flat, 1.0, var)))
    inner, cross = centred[1:-1, 1:-1].copy(), centred[1:-1, -1].copy()
    inner[flat, :] = inner[:, flat] = 0.0
    cross[flat] = 0.0
    beta = np.linalg.solve(inner / np.outer(scale, scale) + alpha * np.eye(len(features)), cross / scale)
    means = dict(zip(features, mean[1:-1].tolist()))
    means["log_budget"] += float(fill_b)
    means["runtime"] += float(fill_r)
    fills = {f: 0.0 for f in features} | {"log_budget": float(fill_b), "runtime": float(fill_r)}
    return RidgeFit(
        levels, quarters, dict(zip(features, beta.tolist())), means, dict(zip(features, scale.tolist())), fills, float(mean[-1])
    )


def coefficient_table(spark, fit: RidgeFit) -> DataFrame:
    return spark.createDataFrame([(k, v) for k, v in fit.coefficients.items()], "feature string, coefficient double")


def top_features(coefficients: DataFrame, positive: bool, limit: int = 4) -> DataFrame:
    """Strongest coefficients of one sign; when none passes the threshold, the most extreme ones."""
    c = F.col("coefficient") if positive else -F.col("coefficient")
    over = coefficients.agg(F.count_if(c > FEATURE_THRESHOLD)).scalar()
    return (
        coefficients.filter((c > FEATURE_THRESHOLD) | (over == 0))
        .orderBy(c.desc(), "feature")
        .limit(limit)
        .select(feature_display_name(F.col("feature")).alias("feature"), F.bround("coefficient", 4).alias("coefficient"))
    )


def high_revenue_profile(
    df: DataFrame, min_rows: int = MIN_ROWS, holdout_fraction: float = HOLDOUT_FRACTION, min_train_rows: int = MIN_TRAIN_ROWS,
    min_holdout_rows: int = MIN_HOLDOUT_ROWS, threshold_quantile: float = THRESHOLD_QUANTILE, alpha: float = ALPHA,
    cutoff: str = DEFAULT_CUTOFF, prepared: bool = False, unique_ids: bool = False, stored: bool = False,
) -> Profile:
    """Evaluate the model on the latest rows, refit on all, and describe the rows predicted high.

    ``prepared``: ``df`` is a modelling table already; ``stored``: it lies in files and needs no copy."""
    rows = eligible_rows(df if prepared else prepare_modelling(df, cutoff, not unique_ids))
    rows = rows if stored else stage(rows)
    spark, n = rows.sparkSession, rows.count()
    if n < min_rows:
        return Profile(error=f"fewer than {min_rows} rows have a category and a revenue")
    held = max(round(n * holdout_fraction), min_holdout_rows)
    split = n - held >= min_train_rows and held < n
    if split:
        tie = [F.col(c) for c in ("title", "id") if c in rows.columns]
        flagged = stage(latest_rows_flag(rows, held, tie))
        train, evaluation = flagged.filter("not is_latest").drop("is_latest"), flagged.filter("is_latest").drop("is_latest")
    else:
        train = evaluation = rows
    trained = fit_log_ridge(train, alpha)
    checked = evaluation.select("revenue", trained.prediction().alias("predicted"))
    metrics = error_metrics(F.col("revenue"), F.col("predicted"))

    fit = fit_log_ridge(rows, alpha)
    scored = rows.withColumn("predicted", fit.prediction())
    cuts = exact_quantiles(scored, [], {"revenue": "revenue", "predicted": "predicted"}, (threshold_quantile,)).collect()
    cut = {r.measure: r.value for r in cuts}
    threshold, by_prediction = float(cut["revenue"]), float(cut["predicted"])
    chosen = F.col("predicted") >= threshold
    count = scored.agg(F.count_if(chosen), F.count_if(F.col("predicted") >= by_prediction)).first()
    if count[0] < max(5, int(n * 0.12)):
        chosen, high = F.col("predicted") >= by_prediction, count[1]
    else:
        high = count[0]
    if high == 0:
        chosen = F.col("revenue") >= threshold
    selected = scored.filter(chosen).withColumn("release_quarter", quarter_label(F.col("month")))

    overview = checked.agg(
        F.count("*").alias("evaluation_rows"), *[c.alias(k) for k, c in metrics.items()]
    ).select(
        F.lit("ridge_log_revenue_profile").alias("model_name"), F.lit("Ridge Revenue Profile").alias("model_label"),
        F.lit(n).cast("bigint").alias("sample_rows"), F.lit(n - held if split else n).cast("bigint").alias("training_rows"), "evaluation_rows",
        F.lit("latest holdout movies" if split else "full current selection").alias("evaluation_scope"),
        F.bround(F.lit(threshold), 2).alias("high_revenue_threshold"), F.lit(float(threshold_quantile)).alias("high_revenue_quantile"),
        F.bround("r_squared", 4).alias("r_squared"), F.bround("mae", 2).alias("mae"), F.bround("wape_percent", 2).alias("wape_percent"),
    ).withColumn("predicted_high_rows", selected.agg(F.count("*")).scalar())
    coefficients = coefficient_table(spark, fit)
    return Profile(
        overview, top_features(coefficients, True), top_features(coefficients, False), selection_traits(selected), selected
    )


def selection_traits(selected: DataFrame) -> DataFrame:
    """One row: medians, most frequent categories and quarters, language and country shares."""
    medians = exact_medians(selected.select("budget", "runtime"), [], {"budget": "budget", "runtime": "runtime"})
    m = medians.select(F.struct("budget", "runtime")).scalar()

    def listed(column: str, limit: int) -> Column:
        top = top_values(selected, column, limit).select(F.struct((-F.col("rows")).alias("rows"), "value").alias("e"))
        return top.agg(F.array_sort(F.collect_list("e"))).scalar()  # at most `limit` values

    shares = selected.agg(
        F.coalesce(F.avg(is_english(F.col("language")).cast("double")) * 100, F.lit(0.0)).alias("english"),
        F.coalesce(F.avg(is_us_production(F.col("country")).cast("double")) * 100, F.lit(0.0)).alias("us"),
    )
    return shares.withColumns({"m": m, "genres": listed("primary_genre", 3), "windows": listed("release_quarter", 2)}).select(
        F.bround(F.coalesce("m.budget", F.lit(0.0)), 2).alias("median_budget"),
        F.bround(F.coalesce("m.runtime", F.lit(0.0)), 2).alias("median_runtime"),
        F.transform("genres", lambda e: e["value"]).alias("top_genres"),
        F.transform("windows", lambda e: e["value"]).alias("top_release_windows"),
        F.bround("english", 2).alias("english_share_percent"),
        F.bround("us", 2).alias("us_production_share_percent"),
    )
