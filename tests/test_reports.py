"""Log report, saved results, chart tables, profile and the whole batch report."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import catalens.plans.forecasting as forecasting
import catalens.plans.profile as profile
import catalens.plans.reports as reports
import catalens.sources.results as results
from catalens.operators.oplog import CAUSES, NO_CAUSE
from catalens.plans.profile import fit_log_ridge, high_revenue_profile, top_features
from catalens.plans.exploration import comprehensive_analysis, explore
from catalens.operators.modelling import prepare_modelling
from tests.test_forecasting import noisy, panel


@pytest.fixture(scope="module")
def log(tmp_path_factory):
    path = tmp_path_factory.mktemp("log") / "log.jsonl"
    t = "2026-01-01 10:00:{:02d}.000000"
    lines = [
        json.dumps({"timestamp": t.format(1), "event": "app_started"}),
        json.dumps({"timestamp": t.format(2), "event": "analysis_requested", "request_id": 1}),
        "{broken", "",
        json.dumps({"timestamp": t.format(3), "event": "analysis_worker_completed", "duration_ms": 100, "request_id": 1}),
        json.dumps({"timestamp": t.format(4), "event": "app_started"}),
        json.dumps({"timestamp": t.format(5), "event": "analysis_worker_completed", "duration_ms": 10.5, "analysis_request_id": 4}),
        json.dumps({"timestamp": t.format(6), "event": "analysis_worker_completed", "duration_ms": "77", "rows": [1, 2]}),
        json.dumps({"timestamp": t.format(7), "event": "chart_refresh_ignored_busy", "source": "button"}),
        json.dumps({"timestamp": t.format(8), "event": "chart_refresh_ignored_analysis_busy"}),
    ]
    path.write_text("\n".join(lines))
    return str(path)


def test_log_report(spark, log):
    r = reports.log_report_of(spark, log)
    assert r.total.first().total_events == 5
    counted = {x.counter: x.occurrences for x in r.counters.collect()}
    assert counted["chart_busy"] == 2 and counted["analysis_requested"] == 0
    assert {x.label: x.mean_ms for x in r.durations.collect()}["analyze worker"] == 10.5
    assert [x.cause for x in r.causes.collect()] == [CAUSES[7][1]]
    recent = r.recent.collect()
    assert len(recent) == 5 and recent[1].details == "source=button" and recent[3].request == "4"
    full = reports.log_report_of(spark, log, whole_history=True)
    assert full.total.first().total_events == 8
    assert {x.label: x.mean_ms for x in full.durations.collect()}["analyze worker"] == 55.25
    none = reports.log_report_of(spark, log + ".missing")
    assert none.total.first().total_events == 0 and none.causes.first().cause == NO_CAUSE


def test_forecast_is_saved_and_reused(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(panel())
    first = reports.run_forecast(df, str(tmp_path), 2017, min_train_rows=3, alpha=1.0)
    assert first.error is None
    monkeypatch.setattr(reports, "evaluate_holdout", lambda *a, **k: pytest.fail("must be reused"))
    second = reports.run_forecast(df.repartition(3), str(tmp_path), 2017, min_train_rows=3, alpha=1.0)
    assert second.overview.first().validation_year == 2017
    assert second.summary_by_genre.count() == first.summary_by_genre.count() == 3
    with pytest.raises(BaseException, match="reused"):
        reports.run_forecast(df, str(tmp_path), 2017, min_train_rows=3, alpha=2.0)
    assert "missing" in reports.read_forecast(spark, str(tmp_path), 1999).error


def test_report_steps_share_one_modelling_table(spark, tmp_path, monkeypatch):
    frame = panel()
    frame.to_csv(tmp_path / "in.csv", index=False)
    steps = [(reports, "prepare_modelling"), (forecasting, "prepare_modelling"), (profile, "prepare_modelling"), (results, "fingerprint")]
    calls = []
    for module, name in steps:
        known = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _known=known, _name=name, **k: calls.append(_name) or _known(*a, **k))
    made = reports.run_report(spark, str(tmp_path / "out"), str(tmp_path / "in.csv"), models=("genre_budget_ratio",), years=(2015, 2017))
    assert sorted(calls) == ["fingerprint", "prepare_modelling"] and "forecast" in made
    # the same forecast as from the catalog itself
    alone = reports.run_forecast(spark.read.parquet(made["cleaned"]), str(tmp_path / "alone"), unique_ids=True)
    shared = reports.read_forecast(spark, str(tmp_path / "out"), 2017)
    assert alone.overview.collect() == shared.overview.collect()


def test_chart_tables_and_reuse(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(panel())
    models = ("ridge", "ols", "genre_budget_ratio")
    made = reports.write_chart_tables(df.filter("year >= 2015"), str(tmp_path), df, models=models, years=(2015, 2017))
    assert {"forecast_backtest_yearly_comparison", "forecast_model_backtest_comparison", "genre_distribution"} <= set(made)
    yearly = spark.read.parquet(made["forecast_backtest_yearly_comparison"]).toPandas()
    best = spark.read.parquet(f"{tmp_path}/backtest_summary").orderBy(
        F.desc("yearly_revenue_correlation"), "average_wape_percent", F.desc("average_r_squared"), "model_name"
    ).first()
    assert set(yearly.model_name) == {best.model_name} and "2017 (Jan-Jul only)" in set(yearly.label)
    lines = spark.read.parquet(made["forecast_model_backtest_comparison"]).toPandas()
    assert lines.groupby("series").size().to_dict() == {
        "Actual Revenue": 2, "Ridge Regression": 2, "OLS Regression": 2, "Genre Budget Ratio": 2
    }
    monkeypatch.setattr(reports, "backtest", lambda *a, **k: pytest.fail("must be reused"))
    # another selection leaves the forecast charts as they are
    reports.write_chart_tables(df.filter("primary_genre = 'Kitchen'"), str(tmp_path), df, models=models, years=(2015, 2017))


def test_profile_fit_equals_closed_form(spark):
    frame = noisy(500, 3)
    rows = prepare_modelling(spark.createDataFrame(frame.drop(columns=["month"])))
    fit = fit_log_ridge(rows, 6.0)
    x = pd.DataFrame({"log_budget": np.log1p(frame.budget), "runtime": frame.runtime})
    x["is_english"] = frame.language.str.lower().str.split("|").map(lambda t: float("en" in t or "english" in t))
    x["is_us_production"] = (frame.country == "United States of America").astype(float)
    for q, label in enumerate(fit.quarters):
        x[f"quarter::{label}"] = ((frame.month - 1) // 3 == q).astype(float)
    for g in fit.levels:
        x[f"genre::{g}"] = (frame.primary_genre == g).astype(float)
    m = x.fillna(x.median()).to_numpy()
    z = np.c_[np.ones(len(m)), (m - m.mean(0)) / m.std(0)]
    pen = np.eye(z.shape[1]) * 6.0
    pen[0, 0] = 0
    beta = np.linalg.solve(z.T @ z + pen, z.T @ np.log1p(frame.revenue))
    assert np.allclose([fit.coefficients[c] for c in x.columns], beta[1:], atol=1e-9)
    predicted = rows.select("id", fit.prediction().alias("p")).toPandas().set_index("id").p
    assert np.allclose(predicted.loc[frame.id], np.expm1(z @ beta), rtol=1e-8)


def test_profile_report(spark):
    r = high_revenue_profile(spark.createDataFrame(panel()), min_rows=12, min_train_rows=6, min_holdout_rows=3)
    over = r.overview.first()
    assert (over.model_label, over.sample_rows, over.training_rows, over.evaluation_rows) == ("Ridge Revenue Profile", 18, 14, 4)
    traits = r.high_revenue_profile.first()
    assert set(traits.top_genres) <= {"Garden", "Kitchen", "Travel"} and traits.english_share_percent == 100.0
    assert r.top_positive_features.count() <= 4 and over.predicted_high_rows == r.selected.count() >= 5
    assert high_revenue_profile(spark.createDataFrame(panel())).error
    weak = spark.createDataFrame([("genre::A", 0.01), ("genre::B", 0.02)], "feature string, coefficient double")
    assert [x.feature for x in top_features(weak, True).collect()] == ["B genre", "A genre"]


def test_comprehensive_analysis(spark):
    frame = noisy(160, 5)
    frame["release_date"] = [f"{y}-{m:02d}-09" for y, m in zip(frame.year, frame.month)]
    frame["vote_average"] = np.random.default_rng(4).uniform(2, 9, len(frame)).round(1)
    df = spark.createDataFrame(frame.drop(columns=["month"]))
    r = comprehensive_analysis(df)
    assert r.high_revenue_profile.error is None and r.high_revenue_profile.top_positive_features.count() > 0
    counts = frame.year.value_counts()
    assert r.time_series_summary.first().peak_movie_count_year == min(counts[counts == counts.max()].index)
    shown = frame.primary_genre.value_counts()
    assert r.genre_performance.count() == (shown >= 5).sum()
    e = explore(df, {"genre": "drama", "year_from": 2012})
    want = ((frame.primary_genre == "Drama") & (frame.year >= 2012)).sum()
    assert e.meta.first().filtered_rows == e.filtered.count() == want and e.top_movies.count() == 10


def test_whole_report(spark, tmp_path):
    frame = panel()
    frame.to_csv(tmp_path / "in.csv", index=False)
    made = reports.run_report(
        spark, str(tmp_path / "out"), str(tmp_path / "in.csv"), models=("ridge", "genre_budget_ratio"), years=(2015, 2017)
    )
    assert spark.read.parquet(made["cleaned"]).count() == 18 and "forecast" in made
    assert spark.read.parquet(made["explore_genre_summary"]).count() == 3
