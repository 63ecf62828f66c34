"""Jobs that write everything: chart tables, holdout forecast, the batch report and the log report."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.operators import charts, oplog, summaries
from catalens.operators.modelling import prepare_modelling
from catalens.plans.cleaning import prepare_catalog
from catalens.plans.exploration import comprehensive_analysis, explore
from catalens.plans.forecasting import (
    ALPHA, DEFAULT_MODEL, MIN_TRAIN_ROWS, SUPPORTED_MODELS, VALIDATION_YEAR, Forecast, backtest, evaluate_holdout,
)
from catalens.roles import DEFAULT_CUTOFF
from catalens.sources.events import read_events
from catalens.sources.results import content_key, read_forecast, read_frames, run_key, write_forecast, write_frames
from catalens.staging import stage

CHART_YEARS = (2003, 2017)  # fixed value: validation years of the forecast charts


@dataclass(frozen=True)
class Prepared:
    """What several steps need of one catalog: its staged modelling table and the key of its content."""

    modelling: DataFrame
    content: dict[str, str]


def saved_backtest(
    df: DataFrame, folder: str, models=SUPPORTED_MODELS, years: tuple[int, int] = CHART_YEARS, cutoff: str = DEFAULT_CUTOFF,
    forest_options: dict | None = None, unique_ids: bool = False, made: Prepared | None = None,
) -> dict[str, DataFrame] | Forecast:
    """Overview and model summary of the multi-model backtest over ``years``, read back when they were
    saved for the same content and parameters. ``made``: what other steps worked out of ``df`` for the same cutoff."""
    parameters = {"models": ",".join(models), "years": years, "cutoff": cutoff, "forest": sorted((forest_options or {}).items())}
    key = run_key(df, parameters, made and made.content)
    names = ["backtest_overview", "backtest_summary"]
    saved = read_frames(df.sparkSession, names, folder, key)
    if saved is None:
        result = backtest(
            made.modelling if made else df, models, years[0], years[1], max_years=0, cutoff=cutoff, forest_options=forest_options,
            prepared=made is not None, unique_ids=unique_ids,
        )
        if result.error:
            return result
        write_frames({names[0]: result.overview, names[1]: result.model_summary}, folder, key)
        saved = read_frames(df.sparkSession, names, folder, key)
    return saved


def write_chart_tables(
    selection: DataFrame, folder: str, catalog: DataFrame | None = None, include_forecast: bool = True, models=SUPPORTED_MODELS,
    years: tuple[int, int] = CHART_YEARS, cutoff: str = DEFAULT_CUTOFF, forest_options: dict | None = None, unique_ids: bool = False,
    made: Prepared | None = None,
) -> dict[str, str]:
    """Chart tables of a selection under ``chart=<name>``; the two forecast charts always cover the
    whole ``catalog``."""
    categories = summaries.category_summary(selection, ordered=False)
    tables = {
        "genre_distribution": charts.category_bars(categories),
        "genre_comparison": charts.category_comparison(categories),
        "yearly_rating_trend": charts.yearly_trend(summaries.yearly_summary(selection, ordered=False)),
    }
    if {"budget", "revenue"} <= set(selection.columns):
        tables["budget_revenue_scatter"] = charts.budget_revenue_points(selection)
        tables["budget_revenue_trend_line"] = charts.budget_revenue_line(selection)
    if include_forecast:
        saved = saved_backtest(catalog if catalog is not None else selection, folder, models, years, cutoff, forest_options, unique_ids, made)
        if isinstance(saved, dict):
            overview, summary = saved["backtest_overview"], saved["backtest_summary"]
            tables["forecast_backtest_yearly_comparison"] = charts.yearly_comparison(overview, summary, cutoff)
            tables["forecast_model_backtest_comparison"] = charts.model_lines(overview, summary)
    created = {}
    for name, table in tables.items():
        created[name] = f"{folder}/chart={name}"
        table.write.mode("overwrite").parquet(created[name])
    return created


def run_forecast(
    catalog: DataFrame, folder: str, validation_year: int = VALIDATION_YEAR, cutoff: str = DEFAULT_CUTOFF,
    min_train_rows: int = MIN_TRAIN_ROWS, alpha: float = ALPHA, model_name: str = DEFAULT_MODEL, forest_options: dict | None = None,
    unique_ids: bool = False, made: Prepared | None = None,
) -> Forecast:
    """Holdout forecast, saved; a saved one for the same content and parameters is returned as it is."""
    key = run_key(
        catalog,
        {"cutoff": cutoff, "year": validation_year, "min_train_rows": min_train_rows, "alpha": alpha, "model": model_name,
         "forest": sorted((forest_options or {}).items())},
        made and made.content,
    )
    saved = read_forecast(catalog.sparkSession, folder, validation_year, key)
    if saved.error is None:
        return saved
    result = evaluate_holdout(
        made.modelling if made else catalog, validation_year, min_train_rows, alpha, model_name, cutoff, forest_options=forest_options,
        prepared=made is not None, unique_ids=unique_ids,
    )
    if result.error:
        return result
    write_forecast(result, folder, validation_year, key)
    return read_forecast(catalog.sparkSession, folder, validation_year, key)


def run_report(
    spark: SparkSession, folder: str, path: str | None = None, raw_folder: str | None = None, cutoff: str = DEFAULT_CUTOFF,
    models=SUPPORTED_MODELS, years: tuple[int, int] = CHART_YEARS, validation_year: int = VALIDATION_YEAR, forest_options: dict | None = None,
) -> dict[str, str]:
    """The whole batch report as tables under ``folder``."""
    prepared = prepare_catalog(spark, path, raw_folder, f"{folder}/cleaned", cutoff, "parquet")
    catalog = spark.read.parquet(f"{folder}/cleaned")
    written = {"cleaned": f"{folder}/cleaned"}

    def save(name: str, table: DataFrame) -> None:
        written[name] = f"{folder}/{name}"
        table.write.mode("overwrite").parquet(written[name])

    save("cleaning_metrics", prepared.metrics)
    save("quality_report", prepared.report)
    found = explore(catalog)
    for f in fields(found):
        if f.name != "filtered":
            save(f"explore_{f.name}", getattr(found, f.name))
    # the profile, the backtest and the forecast share one modelling table; cleaned ids are 1..n
    made = Prepared(stage(prepare_modelling(catalog, cutoff, deduplicate=False)), content_key(catalog))
    profiled = made.modelling.filter(F.col("release_date") <= F.lit(DEFAULT_CUTOFF).cast("date"))
    deep = comprehensive_analysis(catalog, unique_ids=True, stored=True, modelling=profiled)
    for f in fields(deep):
        if f.name != "high_revenue_profile":
            save(f"analysis_{f.name}", getattr(deep, f.name))
    profile = deep.high_revenue_profile
    if profile.error is None:
        for name in ("overview", "top_positive_features", "top_negative_features", "high_revenue_profile"):
            save(f"profile_{name}", getattr(profile, name))
    written |= write_chart_tables(
        catalog, folder, models=models, years=years, cutoff=cutoff, forest_options=forest_options, unique_ids=True, made=made
    )
    forecast = run_forecast(catalog, folder, validation_year, cutoff, forest_options=forest_options, unique_ids=True, made=made)
    if forecast.error is None:
        written["forecast"] = f"{folder}/validation_year={validation_year}"
    return written


@dataclass
class LogReport:
    events: DataFrame
    counters: DataFrame
    durations: DataFrame
    causes: DataFrame
    recent: DataFrame
    total: DataFrame


def log_report(events: DataFrame, whole_history: bool = False) -> LogReport:
    rows = events if whole_history else oplog.latest_session(events)
    counted = oplog.counters(rows)
    return LogReport(
        rows, counted, oplog.mean_durations(rows), oplog.diagnosis(counted), oplog.recent_events(rows),
        rows.agg(F.count("*").alias("total_events")),
    )


def log_report_of(spark: SparkSession, path: str, whole_history: bool = False) -> LogReport:
    return log_report(read_events(spark, path), whole_history)
