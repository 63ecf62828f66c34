"""Modelling, backtests, profile and forecast charts over the order catalog."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from catalens.operators import calibration, charts, linear, ratio, scoring
from catalens.operators.modelling import Centre, candidate_years, eligible_rows, prepare_modelling, year_profile
from catalens.plans import profile as profiles
from catalens.plans.forecasting import backtest, evaluate_holdout, load_modelling_table
from catalens.plans.reports import run_forecast, run_report, saved_backtest
from catalens.staging import shared_folder, stage
from catalog_queries import solved
from catalog_queries.analytics import YEARS_SQL
from catalog_queries.registry import query
from catalog_queries.views import CUTOFF, order_catalog, rounded, with_catalog

_COLUMNS = ("id", "title", "primary_genre", "budget", "revenue", "release_date", "runtime", "language", "country")
# means of squared waves fall exactly between two roundings at times; the small constant moves them off
FOLDS = [1996, 1997, 1998, 1999, 2000, 2001]  # every year of the order catalog with a year before it
CENTRE = Centre(10.0, 100.0, 1995)  # fixed shift for the moment sums, so that both sides sum the same products


def model_table(spark, sf):
    """Prepared rows. Order keys are unique, so the de-duplication by id is left out."""
    return prepare_modelling(order_catalog(spark, sf, *_COLUMNS), CUTOFF, deduplicate=False)


MODEL_SQL = """
m AS (SELECT *, coalesce(budget > 0, FALSE) AS budget_observed, coalesce(runtime > 0, FALSE) AS runtime_observed FROM catalog WHERE release_date <= DATE '2001-07-31')
"""


@query(
    "m1_t8_t9_modelling_table",
    with_catalog("""SELECT id, title, primary_genre, budget, budget_observed, revenue, revenue > 0 AS revenue_observed, runtime, runtime_observed, release_date, year, month, language, country FROM m""", MODEL_SQL),
)
def modelling_table(spark, sf):
    return prepare_modelling(order_catalog(spark, sf, *_COLUMNS), CUTOFF)


@query("m2_modelling_metadata", with_catalog("SELECT (SELECT count(*) FROM catalog) AS rows_loaded, count(*) AS rows_after_preparation, '2001-07-31' AS coverage_end_date FROM m", MODEL_SQL))
def modelling_metadata(spark, sf):
    return load_modelling_table(order_catalog(spark, sf, *_COLUMNS), CUTOFF).metadata


@query(
    "o10_candidate_years",
    with_catalog("""SELECT year AS validation_year, CAST(t AS BIGINT) AS train_rows, n AS validation_rows FROM
    (SELECT year, n, coalesce(sum(n) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS t FROM (SELECT year, count(budget) AS n FROM m GROUP BY year))
    WHERE t >= 12 AND n >= 3 ORDER BY year DESC LIMIT 4""", MODEL_SQL),
)
def fold_years(spark, sf):
    return candidate_years(year_profile(model_table(spark, sf)), max_years=4)


@query(
    "j10_j5_fold_rows",
    with_catalog("""SELECT CAST(f AS INTEGER) AS validation_year, primary_genre, count(*) AS train_samples FROM m, (VALUES (1996), (1997), (1998), (1999), (2000), (2001)) t(f) WHERE year < f GROUP BY ALL""", MODEL_SQL),
)
def fold_rows(spark, sf):
    rows = stage(eligible_rows(model_table(spark, sf)).select("year", "primary_genre", "budget", "revenue"))
    return ratio.fit_ratio(rows, FOLDS).select("validation_year", "primary_genre", "train_samples")


@query(
    "m3_fold_medians",
    with_catalog("""SELECT CAST(f AS INTEGER) AS validation_year, round(median(ln(1 + budget)), 6) AS fill_lb, round(median(ln(1 + budget) * ln(1 + budget)), 5) AS fill_lb2, median(runtime) AS fill_rt, median(runtime * runtime) AS fill_rt2
    FROM m, (VALUES (1996), (1997), (1998), (1999), (2000), (2001)) t(f) WHERE year < f GROUP BY f""", MODEL_SQL),
)
def fold_medians(spark, sf):
    out = linear.fold_medians(stage(eligible_rows(model_table(spark, sf))), FOLDS)
    return rounded(rounded(out, 6, "fill_lb"), 5, "fill_lb2")


_PART_SQL = {
    "one": "1.0", "no_budget": "(budget IS NULL)::INT", "u": "coalesce(ln(1 + budget) - 10, 0)", "uu": "pow(coalesce(ln(1 + budget) - 10, 0), 2)",
    "no_runtime": "(runtime IS NULL)::INT", "v": "coalesce(runtime - 100, 0)", "vv": "pow(coalesce(runtime - 100, 0), 2)", "t": "(year - 1995)",
    "ms": "sin(2 * pi() * month / 12)", "mc": "cos(2 * pi() * month / 12)", "en": "(language = 'en')::INT", "us": "(country = 'usa')::INT",
    "bo": "budget_observed::INT", "ro": "runtime_observed::INT", "y": "ln(1 + revenue)",
}


@query(
    "m4_moment_blocks",
    with_catalog(
        "SELECT year, primary_genre, "
        + ", ".join(
            f"round(sum(CAST({_PART_SQL[linear._SUMS[i]]} AS DOUBLE) * ({_PART_SQL[linear._SUMS[j]]})) / count(*) + 0.0000123, 4) + 0 AS s{k}" for k, (i, j) in enumerate(linear._PAIRS)
        )
        + " FROM m GROUP BY year, primary_genre", MODEL_SQL,
    ),
)
def moment_blocks(spark, sf):
    blocks = linear.moment_blocks(eligible_rows(model_table(spark, sf)), CENTRE)
    n = F.col("s0")
    return blocks.select("year", "primary_genre", *[(F.round(F.col(f"s{k}") / n + 0.0000123, 4) + 0).alias(f"s{k}") for k in range(len(linear._PAIRS))])


@query(
    "m4_ridge_and_least_squares",
    solved.recursive("""SELECT CAST(l.fold AS INTEGER) AS validation_year, l.primary_genre, train_samples, round(r.start + CASE WHEN k > 1 THEN r.b[10 + k] ELSE 0 END, 4) AS ridge_intercept, round(r.b[1], 4) AS ridge_log_budget,
    round(o.start + CASE WHEN k > 1 THEN o.b[10 + k] ELSE 0 END, 4) AS ols_intercept, round(o.b[1], 4) AS ols_log_budget
    FROM llev l JOIN lin_fit r ON r.fold = l.fold AND r.model = 'ridge' JOIN lin_fit o ON o.fold = l.fold AND o.model = 'ols'""", MODEL_SQL + "," + solved.LINEAR),
)
def ridge_and_least_squares(spark, sf):
    rows = stage(eligible_rows(model_table(spark, sf)))
    fitted = linear.fit_linear(rows, FOLDS, CENTRE, {"ridge": 8.0, "ols": 0.0})
    return fitted.select(
        "validation_year", "primary_genre", "train_samples", F.round("ridge.intercept", 4).alias("ridge_intercept"), F.round("ridge.c_lb", 4).alias("ridge_log_budget"),
        F.round("ols.intercept", 4).alias("ols_intercept"), F.round("ols.c_lb", 4).alias("ols_log_budget"),
    )


# category ratio model and calibration in SQL, per fold
RATIO_SQL = MODEL_SQL + """,
f AS (SELECT * FROM (VALUES (1996), (1997), (1998), (1999), (2000), (2001)) t(fold)),
tr AS (SELECT fold, m.*, CASE WHEN budget > 0 THEN revenue / budget END AS ratio FROM m, f WHERE year < fold),
gg AS (SELECT fold, median(ratio) AS all_ratio, median(revenue) AS all_usual FROM tr GROUP BY fold),
g AS (SELECT fold, primary_genre, coalesce(median(ratio), any_value(all_ratio), 1) AS ratio, coalesce(median(revenue), any_value(all_usual), 0) AS usual, count(*) AS train_samples
      FROM tr JOIN gg USING (fold) GROUP BY fold, primary_genre),
p AS (SELECT tr.fold, tr.primary_genre, revenue AS a, greatest(CASE WHEN budget > 0 THEN budget * g.ratio ELSE g.usual END, 0) AS p FROM tr JOIN g ON tr.fold = g.fold AND tr.primary_genre = g.primary_genre),
mom AS (SELECT fold, primary_genre, count(*) AS n, avg(p) AS mp, avg(a) AS ma, regr_slope(a, p) AS s, max(p) - min(p) AS span FROM p GROUP BY GROUPING SETS ((fold, primary_genre), (fold))),
raw AS (SELECT *, CASE WHEN n < 2 OR span <= 1e-9 OR s <= 0 OR s IS NULL THEN 0 ELSE ma - s * mp END AS i0, CASE WHEN n < 2 OR span <= 1e-9 THEN greatest(ma / mp, 0) WHEN s <= 0 THEN least(greatest(ma / mp, 0.05), 10) ELSE least(greatest(s, 0.05), 10) END AS s0 FROM mom),
cal AS (SELECT c.fold, c.primary_genre, w.i0 AS all_intercept, w.s0 AS all_slope,
    CASE WHEN c.n >= 20 AND c.span > 1e-9 THEN w.i0 * (1 - least(1, c.n / 250.0)) + c.i0 * least(1, c.n / 250.0) ELSE w.i0 * (1 - least(1, c.n / 20.0)) END AS intercept,
    least(greatest(CASE WHEN c.n >= 20 AND c.span > 1e-9 THEN w.s0 * (1 - least(1, c.n / 250.0)) + c.s0 * least(1, c.n / 250.0) ELSE w.s0 * (1 - least(1, c.n / 20.0)) + c.ma / c.mp * least(1, c.n / 20.0) END, 0.05), 10) AS slope
  FROM raw c JOIN raw w ON c.fold = w.fold AND w.primary_genre IS NULL AND c.primary_genre IS NOT NULL),
pr AS (SELECT m.year AS fold, m.primary_genre, m.id, m.release_date, m.revenue AS a, train_samples,
    greatest(intercept + slope * greatest(CASE WHEN m.budget > 0 THEN m.budget * g.ratio ELSE g.usual END, 0), 0) AS p
  FROM m JOIN g ON m.year = g.fold AND m.primary_genre = g.primary_genre JOIN cal ON m.year = cal.fold AND m.primary_genre = cal.primary_genre),
err AS (SELECT fold, primary_genre, train_samples, count(*) AS n, avg(abs(p - a)) AS mae, sqrt(avg((p - a) * (p - a))) AS rmse, avg(abs(p - a) / a) * 100 AS mape, sum(abs(p - a)) / sum(a) * 100 AS wape,
    1 - sum((p - a) * (p - a)) / (var_pop(a) * count(*)) AS r2, sum(a) AS actual, sum(p) AS predicted, min(release_date) AS d0, max(release_date) AS d1 FROM pr GROUP BY GROUPING SETS ((fold, primary_genre, train_samples), (fold)))
"""
_FOLDS = FOLDS


@query(
    "g13_j6_m6_ratio_model",
    with_catalog("SELECT CAST(fold AS INTEGER) AS validation_year, primary_genre, train_samples, round(ratio, 6) AS ratio, round(usual, 3) AS usual FROM g", RATIO_SQL),
)
def ratio_model(spark, sf):
    fitted = ratio.fit_ratio(stage(eligible_rows(model_table(spark, sf))), _FOLDS)
    return fitted.select(
        "validation_year", "primary_genre", "train_samples", F.round("genre_budget_ratio.ratio", 6).alias("ratio"), F.round("genre_budget_ratio.usual", 3).alias("usual")
    )


def _ratio_training(spark, sf):
    rows = stage(eligible_rows(model_table(spark, sf)))
    fitted = ratio.fit_ratio(rows, _FOLDS).withColumnRenamed("primary_genre", "_genre")
    met = rows.join(fitted, (F.col("primary_genre") == F.col("_genre")) & (F.col("year") < F.col("validation_year")))
    return met.select("validation_year", "primary_genre", "revenue", ratio.ratio_prediction().alias("base_prediction"))


@query(
    "m7_linear_calibration",
    with_catalog("SELECT CAST(fold AS INTEGER) AS validation_year, round(i0, 1) AS intercept, round(s0, 6) AS slope FROM raw WHERE primary_genre IS NULL", RATIO_SQL),
)
def linear_calibration(spark, sf):
    return rounded(rounded(calibration.linear_calibration(_ratio_training(spark, sf), ["validation_year"]), 1, "intercept"), 6, "slope")


@query(
    "m8_category_calibration",
    with_catalog("SELECT CAST(fold AS INTEGER) AS validation_year, primary_genre, round(intercept, 1) AS intercept, round(slope, 6) AS slope, round(all_intercept, 1) AS all_intercept, round(all_slope, 6) AS all_slope FROM cal", RATIO_SQL),
)
def category_calibration(spark, sf):
    out = calibration.category_calibrations(_ratio_training(spark, sf), ["validation_year"])
    return rounded(rounded(out, 1, "intercept", "all_intercept"), 6, "slope", "all_slope")


@query(
    "m11_p28_holdout_predictions",
    with_catalog("""SELECT c.id, pr.primary_genre AS genre, round(p, 0) AS predicted_revenue, round(abs(p - a), 0) AS absolute_error, round(abs(p - a) / a * 100, 2) AS ape_percent,
    CASE WHEN train_samples >= 12 THEN 'genre_budget_ratio_calibrated' ELSE 'genre_budget_ratio_shared' END AS model_type FROM pr JOIN catalog c USING (id) WHERE fold = 2001""", RATIO_SQL),
)
def holdout_predictions(spark, sf):
    rows = stage(model_table(spark, sf).withColumn("title", F.col("id").cast("string")))
    out = evaluate_holdout(rows, 2001, model_name="genre_budget_ratio", digits=False, prepared=True, cutoff=CUTOFF).predictions
    out = out.select(F.col("title").cast("bigint").alias("id"), "genre", "predicted_revenue", "absolute_error", "ape_percent", "model_type")
    return rounded(rounded(out, 0, "predicted_revenue", "absolute_error"), 2, "ape_percent")


@query(
    "m11_g22_holdout_summary",
    with_catalog("""SELECT primary_genre AS genre, train_samples, n AS validation_samples, round(mae, 0) AS mae, round(rmse, 0) AS rmse, round(mape, 2) AS mape_percent, round(wape, 4) AS wape_percent, round(r2, 4) AS r_squared,
    round((predicted - actual) / actual * 100, 4) AS revenue_bias_percent, d0 AS validation_start, d1 AS validation_end FROM err WHERE fold = 2001 AND primary_genre IS NOT NULL""", RATIO_SQL),
)
def holdout_summary(spark, sf):
    out = evaluate_holdout(stage(model_table(spark, sf)), 2001, model_name="genre_budget_ratio", digits=False, prepared=True, cutoff=CUTOFF).summary_by_genre
    out = out.select(
        "genre", "train_samples", "validation_samples", "mae", "rmse", "mape_percent", "wape_percent", "r_squared", "revenue_bias_percent", "validation_start", "validation_end"
    )
    return rounded(rounded(rounded(out, 0, "mae", "rmse"), 2, "mape_percent"), 4, "wape_percent", "r_squared", "revenue_bias_percent")


@query(
    "m12_g14_rolling_backtest",
    with_catalog("""SELECT CAST(fold AS INTEGER) AS validation_year, (SELECT count(*) FROM m WHERE year < fold) AS training_rows, n AS validation_rows, round(mae, 0) AS overall_mae, round(rmse, 0) AS overall_rmse,
    round(mape, 2) AS overall_mape_percent, round(wape, 4) AS overall_wape_percent, round(r2, 4) AS overall_r_squared FROM err WHERE primary_genre IS NULL""", RATIO_SQL),
)
def rolling_backtest(spark, sf):
    out = backtest(stage(model_table(spark, sf)), ["genre_budget_ratio"], digits=False, prepared=True, cutoff=CUTOFF).overview
    out = out.select("validation_year", "training_rows", "validation_rows", "overall_mae", "overall_rmse", "overall_mape_percent", "overall_wape_percent", "overall_r_squared")
    return rounded(rounded(rounded(out, 0, "overall_mae", "overall_rmse"), 2, "overall_mape_percent"), 4, "overall_wape_percent", "overall_r_squared")


@query(
    "m12_u2_yearly_category_summary",
    with_catalog("SELECT CAST(fold AS INTEGER) AS validation_year, primary_genre AS genre, n AS validation_samples, round(wape, 4) AS wape_percent FROM err WHERE primary_genre IS NOT NULL", RATIO_SQL),
)
def yearly_category_summary(spark, sf):
    out = backtest(stage(model_table(spark, sf)), ["genre_budget_ratio"], digits=False, prepared=True, cutoff=CUTOFF).summary_by_genre
    return rounded(out.select("validation_year", "genre", "validation_samples", "wape_percent"), 4, "wape_percent")


@query(
    "g15_g16_j8_o9_model_summary",
    with_catalog("""SELECT 'genre_budget_ratio' AS model_name, 'Genre Budget Ratio' AS model_label, count(*) AS years_evaluated, round(avg(wape), 4) AS average_wape_percent, round(avg(r2), 4) AS average_r_squared,
    round(avg(mae), 0) AS average_mae, round(avg(rmse), 0) AS average_rmse, round(corr(actual, predicted), 6) AS yearly_revenue_correlation FROM err WHERE primary_genre IS NULL""", RATIO_SQL),
)
def model_summary(spark, sf):
    out = backtest(stage(model_table(spark, sf)), ["genre_budget_ratio"], digits=False, prepared=True, cutoff=CUTOFF).best()
    out = rounded(rounded(out, 4, "average_wape_percent", "average_r_squared"), 0, "average_mae", "average_rmse")
    return rounded(out, 6, "yearly_revenue_correlation")


@query(
    "c5_holdout_chart",
    with_catalog("SELECT primary_genre AS genre, round(actual, 2) AS actual_total_revenue, round(predicted, -1) AS predicted_total_revenue FROM err WHERE fold = 2001 AND primary_genre IS NOT NULL ORDER BY actual DESC LIMIT 3", RATIO_SQL),
)
def holdout_chart(spark, sf):
    found = evaluate_holdout(stage(model_table(spark, sf)), 2001, model_name="genre_budget_ratio", digits=False, prepared=True, cutoff=CUTOFF)
    return rounded(rounded(charts.holdout_comparison(found.summary_by_genre, 3), 2, "actual_total_revenue"), -1, "predicted_total_revenue")


@query(
    "c6_accuracy_chart",
    with_catalog("SELECT CAST(fold AS INTEGER) AS validation_year, round(wape, 4) AS overall_wape_percent, round(r2, 4) AS overall_r_squared, n AS validation_rows FROM err WHERE primary_genre IS NULL", RATIO_SQL),
)
def accuracy_chart(spark, sf):
    found = backtest(stage(model_table(spark, sf)), ["genre_budget_ratio"], digits=False, prepared=True, cutoff=CUTOFF)
    return rounded(charts.accuracy_trend(found.overview), 4, "overall_wape_percent", "overall_r_squared")


@query(
    "u4_actual_totals",
    with_catalog("SELECT CAST(fold AS INTEGER) AS validation_year, round(actual, 2) AS actual_total_revenue FROM err WHERE primary_genre IS NULL", RATIO_SQL),
)
def actual_totals(spark, sf):
    found = backtest(stage(model_table(spark, sf)), ["genre_budget_ratio"], digits=False, prepared=True, cutoff=CUTOFF)
    return rounded(charts.actual_by_year(found.overview), 2, "actual_total_revenue")


# model comparison over several models; of forests, one of stumps has an SQL counterpart --------------------------


@query(
    "m5_m13_three_model_backtest",
    solved.recursive("""SELECT model AS model_name, years AS years_evaluated, round(wape, 4) AS average_wape_percent, round(r2, 4) AS average_r_squared, round(mae, 0) AS average_mae, round(rmse, 0) AS average_rmse,
    round(c, 6) AS yearly_revenue_correlation, row_number() OVER (ORDER BY c DESC, wape, r2 DESC, model) = 1 AS is_best FROM bsum""", MODEL_SQL + "," + solved.THREE_MODELS),
)
def three_model_backtest(spark, sf):
    found = backtest(stage(model_table(spark, sf)), ["ridge", "ols", "genre_budget_ratio"], digits=False, prepared=True, cutoff=CUTOFF)
    best = found.best().select(F.col("model_name").alias("_best"))
    out = stage(found.model_summary).join(best, F.col("model_name") == F.col("_best"), "left").withColumn("is_best", F.col("_best").isNotNull())
    out = rounded(rounded(out, 4, "average_wape_percent", "average_r_squared"), 0, "average_mae", "average_rmse")
    return rounded(out, 6, "yearly_revenue_correlation").select(
        "model_name", "years_evaluated", "average_wape_percent", "average_r_squared", "average_mae", "average_rmse", "yearly_revenue_correlation", "is_best"
    )


@query(
    "m5_linear_holdout_predictions",
    solved.recursive("SELECT model AS model_name, id, primary_genre AS genre, round(p, 0) AS predicted_revenue FROM bpr WHERE fold = 2001 AND model IN ('ridge', 'ols')", MODEL_SQL + "," + solved.THREE_MODELS),
)
def linear_holdout_predictions(spark, sf):
    rows = stage(model_table(spark, sf).withColumn("title", F.col("id").cast("string")))
    parts = [evaluate_holdout(rows, 2001, model_name=m, digits=False, prepared=True, cutoff=CUTOFF).predictions.withColumn("model_name", F.lit(m)) for m in ("ridge", "ols")]
    out = parts[0].unionByName(parts[1]).select("model_name", F.col("title").cast("bigint").alias("id"), "genre", "predicted_revenue")
    return rounded(out, 0, "predicted_revenue")


@query(
    "c7_c8_c10_s8_saved_backtest_charts",
    with_catalog("""SELECT CAST(fold AS INTEGER) AS validation_year, 'best: Genre Budget Ratio' AS series, round(predicted, -1) AS total FROM err WHERE primary_genre IS NULL
    UNION ALL SELECT CAST(fold AS INTEGER), 'Genre Budget Ratio', round(predicted, -1) FROM err WHERE primary_genre IS NULL
    UNION ALL SELECT CAST(fold AS INTEGER), 'Actual Revenue', round(actual, -1) FROM err WHERE primary_genre IS NULL""", RATIO_SQL),
)
def saved_backtest_charts(spark, sf):
    folder = f"{shared_folder(spark)}/catalens-export/{uuid.uuid4().hex}"
    rows = stage(order_catalog(spark, sf, *_COLUMNS))
    saved = saved_backtest(rows, folder, ("genre_budget_ratio",), (1996, 2001), CUTOFF, unique_ids=True)
    bars = charts.yearly_comparison(saved["backtest_overview"], saved["backtest_summary"], CUTOFF).select(
        "validation_year", F.concat(F.lit("best: "), "model_label").alias("series"), F.col("predicted_total_revenue").alias("total")
    )
    lines = charts.model_lines(saved["backtest_overview"], saved["backtest_summary"]).select("validation_year", "series", "total")
    return rounded(bars.unionByName(lines), -1, "total")


_STUMPS = {"trees": solved.STUMPS, "max_depth": 1, "bag_rows": 5_000}  # as in their SQL


@query(
    "m9_m13_four_model_backtest",
    solved.recursive("""SELECT model AS model_name, years AS years_evaluated, round(wape, 4) AS average_wape_percent, round(r2, 4) AS average_r_squared, round(mae, 0) AS average_mae, round(rmse, 0) AS average_rmse,
    round(c, 6) AS yearly_revenue_correlation FROM bsum""", MODEL_SQL + "," + solved.FOUR_MODELS),
)
def four_model_backtest(spark, sf):
    out = backtest(stage(model_table(spark, sf)), digits=False, prepared=True, cutoff=CUTOFF, forest_options=_STUMPS).model_summary
    out = rounded(rounded(out, 4, "average_wape_percent", "average_r_squared"), 0, "average_mae", "average_rmse")
    return rounded(out, 6, "yearly_revenue_correlation").select(
        "model_name", "years_evaluated", "average_wape_percent", "average_r_squared", "average_mae", "average_rmse", "yearly_revenue_correlation"
    )


@query(
    "m9_forest_of_stumps",
    solved.recursive("SELECT id, primary_genre AS genre, round(p, 0) AS predicted_revenue FROM bpr WHERE fold = 2001 AND model = 'random_forest'", MODEL_SQL + "," + solved.FOUR_MODELS),
)
def forest_of_stumps(spark, sf):
    rows = stage(model_table(spark, sf).withColumn("title", F.col("id").cast("string")))
    found = evaluate_holdout(rows, 2001, model_name="random_forest", digits=False, prepared=True, cutoff=CUTOFF, forest_options=_STUMPS)
    return rounded(found.predictions.select(F.col("title").cast("bigint").alias("id"), "genre", "predicted_revenue"), 0, "predicted_revenue")


@query("m9_m10_random_forest_holdout")
def random_forest_holdout(spark, sf):
    found = evaluate_holdout(stage(model_table(spark, sf)), 2001, model_name="random_forest", prepared=True, cutoff=CUTOFF)
    return found.summary_by_genre.select("genre", "model_type", "train_samples", "validation_samples", "wape_percent", "r_squared")


@query("m9_m13_default_backtest")
def default_backtest(spark, sf):
    """All four models at their settings over all folds."""
    return backtest(stage(model_table(spark, sf)), prepared=True, cutoff=CUTOFF).model_summary


@query(
    "m14_s6_s7_s8_saved_forecast",
    with_catalog("""SELECT primary_genre AS genre, CASE WHEN train_samples >= 12 THEN 'genre_budget_ratio_calibrated' ELSE 'genre_budget_ratio_shared' END AS model_type,
    n AS validation_samples, round(wape, 2) AS wape_percent FROM err WHERE fold = 2001 AND primary_genre IS NOT NULL""", RATIO_SQL),
)
def saved_forecast(spark, sf):
    folder = f"{shared_folder(spark)}/catalens-export/{uuid.uuid4().hex}"
    rows = stage(order_catalog(spark, sf, *_COLUMNS))
    run_forecast(rows, folder, 2001, CUTOFF, model_name="genre_budget_ratio", unique_ids=True)  # computes and saves
    again = run_forecast(rows, folder, 2001, CUTOFF, model_name="genre_budget_ratio", unique_ids=True)  # reads back
    return again.summary_by_genre.select("genre", "model_type", "validation_samples", "wape_percent")


_SIDE_SQL = """(SELECT '{sign}' AS sign, feature, round(coefficient, 4) AS coefficient FROM pcoef WHERE {by} > 0.03 OR (SELECT count(*) FROM pcoef WHERE {by} > 0.03) = 0 ORDER BY {by} DESC, feature LIMIT 4)"""


@query(
    "m15_m16_o7_revenue_profile",
    solved.recursive(_SIDE_SQL.format(sign="+", by="coefficient") + " UNION ALL " + _SIDE_SQL.format(sign="-", by="-coefficient"), MODEL_SQL + "," + solved.PROFILE),
)
def revenue_profile(spark, sf):
    found = profiles.high_revenue_profile(model_table(spark, sf), prepared=True)
    sign = lambda df, s: df.select(F.lit(s).alias("sign"), "feature", F.round("coefficient", 4).alias("coefficient"))
    return sign(found.top_positive_features, "+").unionByName(sign(found.top_negative_features, "-"))


@query(
    "m16_w12_g20_profile_split",
    with_catalog("""SELECT count(*) AS sample_rows, CAST(count(*) - round(count(*) * 0.2) AS BIGINT) AS training_rows, CAST(round(count(*) * 0.2) AS BIGINT) AS evaluation_rows,
    round(quantile_cont(revenue, 0.75), 1) AS high_revenue_threshold FROM m""", MODEL_SQL),
)
def profile_split(spark, sf):
    found = profiles.high_revenue_profile(model_table(spark, sf), prepared=True).overview
    return rounded(found.select("sample_rows", "training_rows", "evaluation_rows", "high_revenue_threshold"), 1, "high_revenue_threshold")


@query("m16_profile_overview", solved.recursive(solved.PROFILE_OVERVIEW, MODEL_SQL + "," + solved.PROFILE))
def profile_overview(spark, sf):
    return profiles.high_revenue_profile(model_table(spark, sf), prepared=True).overview


_PARTS = {  # of the comprehensive analysis: its figures
    "production_trend": ("total_movies", "average_movies_per_year", "peak_year", "peak_count", "trend_slope", "average_growth_rate"),
    "time_series": ("peak_movie_count_year", "peak_movie_count", "peak_revenue_year", "highest_rating_year", "highest_rating", "latest_movie_count_ma3", "strongest_revenue_growth_year"),
    "correlation": ("sample_size", "correlation", "r_squared", "average_roi", "median_roi"),
    "decades": ("most_productive_decade", "highest_rated_decade"),
    "performance": ("movie_count", "avg_rating", "avg_runtime"),
    "profile": ("sample_rows", "training_rows", "evaluation_rows", "high_revenue_threshold", "r_squared", "wape_percent", "predicted_high_rows"),
}
_PART_SQL_OF = {
    "production_trend": """SELECT '' AS about, sum(n) AS total_movies, avg(n) AS average_movies_per_year, arg_min(year, -n * 10000 + year) AS peak_year, max(n) AS peak_count, regr_slope(n, year) AS trend_slope, avg(ny) AS average_growth_rate FROM w""",
    "time_series": """SELECT '' AS about, arg_min(year, -n * 10000 + year) AS peak_movie_count_year, max(n) AS peak_movie_count, arg_max(year, rev) AS peak_revenue_year, arg_max(year, r) AS highest_rating_year, max(r) AS highest_rating,
        arg_max(n3, year) AS latest_movie_count_ma3, arg_max(year, revy) AS strongest_revenue_growth_year FROM w""",
    "correlation": """SELECT '' AS about, count(*) AS sample_size, corr(revenue, budget) AS correlation, regr_r2(revenue, budget) AS r_squared, avg((revenue - budget) / budget * 100) AS average_roi, median((revenue - budget) / budget * 100) AS median_roi FROM catalog WHERE budget > 0""",
    "decades": """SELECT '' AS about, (SELECT decade FROM dd ORDER BY n DESC, decade LIMIT 1) AS most_productive_decade, (SELECT decade FROM dd ORDER BY r DESC, decade LIMIT 1) AS highest_rated_decade""",
    "performance": "SELECT primary_genre AS about, count(title) AS movie_count, avg(vote_average) AS avg_rating, avg(runtime) AS avg_runtime FROM catalog GROUP BY primary_genre HAVING count(title) >= 5",
    "profile": "SELECT '' AS about, * FROM (" + solved.PROFILE_OVERVIEW + ")",
}
_EVERY_ORDER = MODEL_SQL.replace("2001-07-31", "2017-07-31")


@query(
    "q5_q6_comprehensive_analysis",
    solved.recursive(
        " UNION ALL ".join(
            f"SELECT '{part}' AS part, about, unnest([{', '.join(repr(c) for c in columns)}]) AS metric, round(unnest([{', '.join(f'{c}::DOUBLE' for c in columns)}]), 2) + 0 AS value FROM ({_PART_SQL_OF[part]})"
            for part, columns in _PARTS.items()
        ),
        _EVERY_ORDER + "," + YEARS_SQL + ", dd AS (SELECT CAST(year // 10 * 10 AS INTEGER) AS decade, count(title) AS n, avg(vote_average) AS r FROM catalog GROUP BY decade)," + solved.PROFILE,
    ),
)
def comprehensive(spark, sf):
    from catalens.plans.exploration import comprehensive_analysis

    rows = order_catalog(spark, sf, *_COLUMNS, "year", "vote_average")
    found = comprehensive_analysis(rows, unique_ids=True)
    parts = {
        "production_trend": found.production_trend, "time_series": found.time_series_summary, "correlation": found.budget_revenue_correlation,
        "decades": found.decade_leaders, "performance": found.genre_performance, "profile": found.high_revenue_profile.overview,
    }

    def long(part, df):
        about = F.col("primary_genre") if part == "performance" else F.lit("")
        figures = [F.struct(F.lit(c).alias("metric"), (F.round(F.col(c).cast("double"), 2) + 0.0).alias("value")) for c in _PARTS[part]]
        return df.select(F.lit(part).alias("part"), about.alias("about"), F.inline(F.array(*figures)))

    return reduce(lambda a, b: a.unionByName(b), [long(n, d) for n, d in parts.items()])


@query("q3_q7_c9_batch_report")
def batch_report(spark, sf):
    """The whole report over the orders as a cleaned catalog; one row per table written."""
    folder = f"{shared_folder(spark)}/catalens-export/{uuid.uuid4().hex}"
    rows = order_catalog(
        spark, sf, *_COLUMNS, "year", "vote_average", "vote_count", "popularity", "keyword"
    ).withColumns({f"{c}_observed": F.col(c).isNotNull() for c in ("budget", "revenue", "runtime")})
    rows.write.parquet(f"{folder}/input")
    made = run_report(
        spark, f"{folder}/report", f"{folder}/input", cutoff=CUTOFF, models=("genre_budget_ratio",), years=(1996, 2001), validation_year=2001
    )
    tables = [
        spark.read.parquet(path).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, path in made.items() if name != "forecast"
    ]
    return reduce(lambda a, b: a.unionByName(b), tables)
