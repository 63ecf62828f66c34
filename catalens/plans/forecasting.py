"""Holdout evaluation and rolling backtests over all folds and models at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.functions.scalars import MODEL_LABELS, model_type_label
from catalens.operators import calibration, forest, linear, ratio, scoring
from catalens.operators.modelling import (
    Centre, candidate_years, eligible_rows, prepare_modelling, year_profile,
)
from catalens.roles import DEFAULT_CUTOFF
from catalens.staging import stage

# Forecast defaults.
ALPHA, MIN_TRAIN_ROWS, VALIDATION_YEAR, DEFAULT_MODEL = 8.0, 12, 2017, "ridge"
SUPPORTED_MODELS = tuple(MODEL_LABELS)


@dataclass
class Forecast:
    """Result tables; ``error`` says why there are none."""

    overview: DataFrame | None = None
    summary_by_genre: DataFrame | None = None
    predictions: DataFrame | None = None
    model_summary: DataFrame | None = None
    years: list[int] = field(default_factory=list)
    models: tuple[str, ...] = ()
    cutoff: str = DEFAULT_CUTOFF
    error: str | None = None

    def best(self) -> DataFrame:
        return scoring.best_model(self.model_summary)


def checked_models(names: Sequence[str]) -> tuple[str, ...]:
    models = tuple(dict.fromkeys(n.strip() for n in names if n.strip()))
    if not models:
        raise ValueError("no forecast models were selected")
    unknown = [m for m in models if m not in SUPPORTED_MODELS]
    if unknown:
        raise ValueError(f"unsupported forecast model(s): {', '.join(unknown)}")
    return models


def fit_models(rows: DataFrame, folds: list[int], models: Sequence[str], alpha: float, centre: Centre) -> DataFrame:
    """One small table of everything the closed-form models need, per (validation_year, category)."""
    tables = []
    alphas = {m: (float(alpha) if m == "ridge" else 0.0) for m in models if m in ("ridge", "ols")}
    if alphas:
        tables.append(linear.fit_linear(rows, folds, centre, alphas))
    if "genre_budget_ratio" in models:
        ratios = ratio.fit_ratio(rows, folds)
        tables.append(ratios.drop("train_samples") if tables else ratios)
    return stage(reduce(lambda a, b: a.join(b, ["validation_year", "primary_genre"]), tables))


def base_predictions(
    rows: DataFrame, folds: list[int], models: Sequence[str], alpha: float, centre: Centre, forest_options: dict | None = None
) -> DataFrame:
    """Uncalibrated predictions of every model for every fold's training and validation rows.

    A row meets the folds from its own year on; categories without history in a fold drop out. The
    model table has one row per fold and category, and Spark decides how to join it.
    """
    carried = [F.col(c) for c in rows.columns]
    parts: list[DataFrame] = []
    closed = [m for m in models if m != "random_forest"]
    if closed:
        fitted = fit_models(rows, folds, closed, alpha, centre).withColumnRenamed("primary_genre", "_genre")
        # regressors are worked out once per row, before the row meets its folds
        ready = linear.with_regressors(rows.filter(F.col("year") <= max(folds)))
        met = ready.join(
            fitted, (F.col("primary_genre") == F.col("_genre")) & (F.col("year") <= F.col("validation_year"))
        )
        scores: dict[str, Column] = {
            m: ratio.ratio_prediction() if m == "genre_budget_ratio" else linear.linear_prediction(m, centre) for m in closed
        }
        # the scores are computed per model only after the rows were multiplied, so each once
        choice = reduce(
            lambda rest, m: F.when(F.col("model_name") == m, scores[m]).otherwise(rest), closed[1:], scores[closed[0]]
        )
        parts.append(
            met.withColumn("model_name", F.explode(F.array(*[F.lit(m) for m in closed]))).select(
                "model_name", "validation_year", "train_samples", *carried, choice.alias("base_prediction")
            )
        )
    if "random_forest" in models:
        grown = forest.forest_predictions(rows, folds, **(forest_options or {}))
        parts.append(grown.select(F.lit("random_forest").alias("model_name"), "validation_year", "train_samples", *carried, "base_prediction"))
    return reduce(DataFrame.unionByName, parts)


def fold_predictions(
    rows: DataFrame, folds: list[int], models: Sequence[str], alpha: float, centre: Centre,
    min_train_rows: int = MIN_TRAIN_ROWS, forest_options: dict | None = None,
) -> DataFrame:
    """Calibrated predictions of the validation rows, one row per model, fold and entity."""
    base = base_predictions(rows, folds, models, alpha, centre, forest_options)
    lines = calibration.category_calibrations(
        base.filter(F.col("year") < F.col("validation_year")), ["model_name", "validation_year"]
    ).select("model_name", "validation_year", "primary_genre", "intercept", "slope")
    lines = stage(lines)  # a row per model, fold and category: its size is known when it is joined
    held = base.filter(F.col("year") == F.col("validation_year"))
    predicted = calibration.calibrated(F.col("base_prediction"), F.col("intercept"), F.col("slope"))
    return held.join(lines, ["model_name", "validation_year", "primary_genre"]).select(
        "model_name", "validation_year", F.col("primary_genre").alias("genre"), *[c for c in ("id", "title") if c in rows.columns],
        "release_date", "budget", "budget_observed", "runtime", "runtime_observed",
        F.col("revenue").alias("actual_revenue"), "revenue_observed", predicted.alias("predicted_revenue"),
        model_type_label(F.col("model_name"), F.col("train_samples"), min_train_rows).alias("model_type"), "train_samples",
    )


def _evaluate(
    prepared: DataFrame, profile: list, folds: list[int], models: tuple[str, ...], alpha: float, min_train_rows: int,
    cutoff: str, digits: bool, forest_options: dict | None,
) -> Forecast:
    spark = prepared.sparkSession
    rows = eligible_rows(prepared)
    scored = stage(fold_predictions(rows, folds, models, alpha, Centre.of(profile), min_train_rows, forest_options))
    counted = [(f, sum(r.rows for r in profile if r.year < f)) for f in folds]
    training = spark.createDataFrame(counted, "validation_year int, training_rows long")
    overview = scoring.fold_overview(scored, ["model_name", "validation_year"], training, digits)
    overview = overview.withColumn("cutoff_date", F.lit(cutoff))
    summary = scoring.category_holdout_summary(scored, ["model_name", "validation_year"], digits)
    columns = [
        "model_name", "validation_year", "genre", "title", "release_date", "budget", "budget_observed", "runtime",
        "runtime_observed", "actual_revenue", "revenue_observed", "predicted_revenue", "absolute_error", "ape_percent", "model_type",
    ]
    errors = scoring.row_errors(scored, digits)
    return Forecast(
        overview, summary, errors.select(*[c for c in columns if c in errors.columns]), None, folds, models, cutoff
    )


@dataclass
class ModellingTable:
    table: DataFrame
    metadata: DataFrame


def load_modelling_table(source: DataFrame, cutoff: str = DEFAULT_CUTOFF, unique_ids: bool = False) -> ModellingTable:
    """The modelling table of a cleaned one, and one row about it: rows loaded, rows kept, end of coverage."""
    table = prepare_modelling(source, cutoff, not unique_ids)
    kept = table.agg(F.count("*")).scalar()
    metadata = source.agg(F.count("*").alias("rows_loaded")).select(
        "rows_loaded", kept.alias("rows_after_preparation"), F.lit(cutoff).alias("coverage_end_date")
    )
    return ModellingTable(table, metadata)


def evaluate_holdout(
    df: DataFrame, validation_year: int = VALIDATION_YEAR, min_train_rows: int = MIN_TRAIN_ROWS, alpha: float = ALPHA,
    model_name: str = DEFAULT_MODEL, cutoff: str = DEFAULT_CUTOFF, digits: bool = True, forest_options: dict | None = None,
    prepared: bool = False, unique_ids: bool = False,
) -> Forecast:
    """Train on the years before ``validation_year`` and score the rows of that year per category.

    ``prepared`` says that ``df`` is a modelling table already (staged, it is read several times);
    ``unique_ids`` spares a catalog with unique ids the shuffle that would remove repeated ones."""
    models = checked_models([model_name])
    table = df if prepared else stage(prepare_modelling(df, cutoff, not unique_ids))
    profile = year_profile(table).collect()  # one row per calendar year
    if not any(r.year < validation_year for r in profile):
        return Forecast(error="nothing to train on: no eligible row is older than the validation year")
    if not any(r.year == validation_year for r in profile):
        return Forecast(error="nothing to validate: the year has no eligible row")
    result = _evaluate(table, profile, [validation_year], models, alpha, min_train_rows, cutoff, digits, forest_options)
    if result.predictions.isEmpty():
        return Forecast(error="no category of the validation year occurs in the years before")
    return result


def backtest(
    df: DataFrame, model_names: Sequence[str] = SUPPORTED_MODELS, start_year: int | None = None, end_year: int | None = None,
    min_validation_rows: int = 3, max_years: int = 15, min_train_rows: int = MIN_TRAIN_ROWS, alpha: float = ALPHA,
    cutoff: str = DEFAULT_CUTOFF, digits: bool = True, forest_options: dict | None = None, prepared: bool = False,
    unique_ids: bool = False,
) -> Forecast:
    """Rolling holdout validation of several models: every fold trains on all years before it.

    All folds come from one set of passes over the data, the forests of all folds from one job. The
    model summary compares models over the years, best first.
    """
    models = checked_models(model_names)
    table = df if prepared else stage(prepare_modelling(df, cutoff, not unique_ids))
    years = stage(year_profile(table))
    chosen = candidate_years(years, start_year, end_year, min_train_rows, min_validation_rows, max_years)
    folds = sorted(r.validation_year for r in chosen.collect())  # at most one per calendar year
    profile = years.collect()
    if not any(r.budget_rows for r in profile):
        return Forecast(error="no eligible row has a budget, so no fold can be chosen")
    if not folds:
        return Forecast(error="no year reaches the row limits of a fold")
    result = _evaluate(table, profile, folds, models, alpha, min_train_rows, cutoff, digits, forest_options)
    result.model_summary = scoring.model_comparison(result.overview, 4 if digits else None)
    return result
