"""Summaries, trends, statistics, quality, cleaning steps, charts and logs.

Inputs that an operator reads several times are staged: the joins behind the catalog then run once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalens.functions import scalars
from catalens.operators import charts, dedup, imputation, levels, oplog, quality, selection, sequence, sketches, summaries, trends
from catalens.operators.quantiles import exact_quantiles
from catalens.plans import profile as profiles
from catalens.plans import cleaning, exploration, incremental, reports
from catalens.sources import tables, versions
from catalens.sources.events import parse_events
from catalens.staging import new_folder, shared_folder, stage
from catalog_queries.registry import query
from catalog_queries.views import CUTOFF, PARTS_SQL, event_log, order_catalog, part_catalog, rounded, table, with_catalog

_G1_SQL = """tokens AS (SELECT unnest(string_split(keyword, '|')) AS genre, vote_average, revenue FROM catalog),
g1 AS (SELECT genre, count(vote_average) AS movie_count, avg(vote_average) AS r, avg(revenue) AS avg_revenue FROM tokens GROUP BY genre)"""


def _tokens_summary(spark, sf, digits=None):
    rows = order_catalog(spark, sf, "keyword", "vote_average", "revenue").withColumnRenamed("keyword", "primary_genre")
    return summaries.category_summary(rows, digits, ordered=False)


@query(
    "g1_category_summary",
    with_catalog("SELECT genre, movie_count, round(r, 4) AS avg_rating, round(avg_revenue, 1) AS avg_revenue FROM g1", _G1_SQL),
)
def category_summary(spark, sf):
    return rounded(rounded(_tokens_summary(spark, sf), 4, "avg_rating"), 1, "avg_revenue")


@query(
    "g2_yearly_summary",
    with_catalog("SELECT year, count(title) AS movie_count, round(avg(vote_average), 4) AS avg_rating, round(avg(revenue), 1) AS avg_revenue FROM catalog GROUP BY year"),
)
def yearly_summary(spark, sf):
    rows = order_catalog(spark, sf, "title", "year", "vote_average", "revenue")
    return rounded(rounded(summaries.yearly_summary(rows, None, ordered=False), 4, "avg_rating"), 1, "avg_revenue")


@query(
    "g3_dataset_overview",
    with_catalog("""SELECT count(*) AS movie_count, count(DISTINCT primary_genre) AS genre_count, round(avg(vote_average), 4) AS average_rating,
    median(runtime) AS median_runtime, round(CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_revenue FROM catalog"""),
)
def dataset_overview(spark, sf):
    rows = stage(order_catalog(spark, sf, "primary_genre", "vote_average", "runtime", "revenue"))
    return rounded(rounded(summaries.dataset_overview(rows, None), 4, "average_rating"), 2, "total_revenue")


@query(
    "g4_f15_category_performance",
    with_catalog("""SELECT primary_genre, count(title) AS movie_count, round(avg(vote_average), 4) AS avg_rating, round(avg(runtime), 4) AS avg_runtime,
    round(avg(budget), 1) AS avg_budget, round(avg(revenue), 1) AS avg_revenue FROM catalog GROUP BY primary_genre HAVING count(title) >= (SELECT count(*) // count(DISTINCT primary_genre) FROM catalog)"""),
)
def category_performance(spark, sf):
    rows = order_catalog(spark, sf, "title", "primary_genre", "year", "vote_average", "runtime", "budget", "revenue")
    least = rows.agg(F.floor(F.count("*") / F.count_distinct("primary_genre"))).first()[0]  # categories of at least mean size
    out = summaries.category_performance(rows, least, None, ordered=False)
    return rounded(rounded(out, 4, "avg_rating", "avg_runtime"), 1, "avg_budget", "avg_revenue")


@query(
    "g5_decades",
    with_catalog("""SELECT CAST(year // 10 * 10 AS INTEGER) AS decade, count(title) AS movie_count, round(avg(vote_average), 4) AS avg_rating, round(avg(runtime), 4) AS avg_runtime,
    round(CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_revenue FROM catalog GROUP BY decade"""),
)
def decades(spark, sf):
    out = summaries.decade_summary(order_catalog(spark, sf, "title", "year", "vote_average", "runtime", "revenue"), None)
    return rounded(rounded(out, 4, "avg_rating", "avg_runtime"), 2, "total_revenue")


@query(
    "g5_o8_decade_leaders",
    with_catalog("""SELECT (SELECT decade FROM d ORDER BY n DESC, decade LIMIT 1) AS most_productive_decade, (SELECT decade FROM d ORDER BY r DESC, decade LIMIT 1) AS highest_rated_decade""",
    "d AS (SELECT CAST(year // 10 * 10 AS INTEGER) AS decade, count(title) AS n, avg(vote_average) AS r FROM catalog GROUP BY ALL)"),
)
def decade_leaders(spark, sf):
    rows = order_catalog(spark, sf, "title", "year", "vote_average", "runtime", "revenue")
    return summaries.decade_leaders(summaries.decade_summary(rows, None))


YEARS_SQL = """y AS (SELECT year, count(title) AS n, avg(vote_average) AS r, CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS rev FROM catalog GROUP BY year),
w AS (SELECT *, avg(n) OVER o3 AS n3, avg(rev) OVER o3 AS rev3, (n - lag(n) OVER o) * 100.0 / lag(n) OVER o AS ny, (rev - lag(rev) OVER o) * 100 / lag(rev) OVER o AS revy
  FROM y WINDOW o AS (ORDER BY year), o3 AS (ORDER BY year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""


@query(
    "g6_w3_production_trend",
    with_catalog("""SELECT min(year) || '-' || max(year) AS period, CAST(sum(n) AS BIGINT) AS total_movies, round(avg(n), 4) AS average_movies_per_year,
    arg_min(year, -n * 10000 + year) AS peak_year, max(n) AS peak_count, CASE WHEN regr_slope(n, year) > 0 THEN 'increasing' WHEN regr_slope(n, year) < 0 THEN 'decreasing' ELSE 'stable' END AS trend_direction,
    round(regr_slope(n, year), 4) AS trend_slope, round(avg(ny), 4) AS average_growth_rate, round(avg(n) - regr_slope(n, year) * (avg(year) - min(year)), 4) AS regression_intercept
    FROM w WHERE year BETWEEN 1995 AND 2000""", YEARS_SQL),
)
def production_trend(spark, sf):
    rows = order_catalog(spark, sf, "title", "year", "vote_average")
    out = trends.production_trend(rows, 1995, 2000, digits=False)
    return rounded(out, 4, "average_movies_per_year", "trend_slope", "average_growth_rate", "regression_intercept")


@query(
    "g7_w1_w2_time_series_summary",
    with_catalog("""SELECT min(year) || '-' || max(year) AS period, min(year) AS start_year, max(year) AS end_year, arg_min(year, -n * 10000 + year) AS peak_movie_count_year, max(n) AS peak_movie_count,
    arg_max(year, rev) AS peak_revenue_year, round(max(rev), 3) AS peak_revenue, arg_max(year, r) AS highest_rating_year, round(max(r), 4) AS highest_rating,
    CASE WHEN regr_slope(n, year) > 0 THEN 'increasing' WHEN regr_slope(n, year) < 0 THEN 'decreasing' ELSE 'stable' END AS movie_count_trend,
    CASE WHEN regr_slope(rev, year) > 0 THEN 'increasing' WHEN regr_slope(rev, year) < 0 THEN 'decreasing' ELSE 'stable' END AS revenue_trend,
    round(regr_slope(n, year), 4) AS movie_count_trend_slope, round(regr_slope(rev, year), 0) AS revenue_trend_slope, round(arg_max(n3, year), 4) AS latest_movie_count_ma3,
    round(arg_max(rev3, year), 3) AS latest_revenue_ma3, arg_max(year, revy) AS strongest_revenue_growth_year FROM w""", YEARS_SQL),
)
def time_series_summary(spark, sf):
    out = trends.time_series_summary(order_catalog(spark, sf, "title", "year", "vote_average", "revenue"), digits=False)
    out = rounded(rounded(out, 3, "peak_revenue", "latest_revenue_ma3"), 0, "revenue_trend_slope")
    return rounded(out, 4, "highest_rating", "movie_count_trend_slope", "latest_movie_count_ma3")


@query(
    "w1_w2_yearly_series",
    with_catalog("""SELECT year, n AS movie_count, round(r, 4) AS avg_rating, round(rev, 3) AS total_revenue, round(n3, 4) AS movie_count_ma3, round(ny, 4) AS movie_count_yoy_percent,
    round(rev3, 3) AS total_revenue_ma3, round(revy, 4) AS revenue_yoy_percent FROM w""", YEARS_SQL),
)
def yearly_series(spark, sf):
    out = trends.trend_columns(trends.yearly_series(order_catalog(spark, sf, "title", "year", "vote_average", "revenue")))
    out = rounded(out, 4, "avg_rating", "movie_count_ma3", "movie_count_yoy_percent", "revenue_yoy_percent")
    return rounded(out, 3, "total_revenue", "total_revenue_ma3")


@query(
    "g8_budget_revenue_correlation",
    with_catalog("""SELECT count(*) AS sample_size, round(corr(revenue, budget), 6) AS correlation, CASE WHEN abs(corr(revenue, budget)) >= 0.3 THEN 'some' ELSE 'Very weak or no correlation' END AS correlation_strength,
    round(regr_r2(revenue, budget), 6) AS r_squared, round(regr_slope(revenue, budget), 6) AS regression_slope, round(regr_intercept(revenue, budget), 1) AS regression_intercept,
    round(avg((revenue - budget) / budget * 100), 2) AS average_roi, round(median((revenue - budget) / budget * 100), 4) AS median_roi, arg_max(title, (revenue - budget) / budget) AS best_roi_movie,
    round(max((revenue - budget) / budget * 100), 2) AS best_roi_value FROM catalog WHERE budget > 0"""),
)
def budget_revenue_correlation(spark, sf):
    out = trends.budget_revenue_correlation(stage(order_catalog(spark, sf, "id", "title", "budget", "revenue")), digits=False)
    out = rounded(rounded(out, 6, "correlation", "r_squared", "regression_slope"), 1, "regression_intercept")
    return rounded(rounded(out, 2, "average_roi", "best_roi_value"), 4, "median_roi")


@query(
    "g9_outliers",
    with_catalog("""SELECT 'budget' AS "column", round(any_value(m), 1) AS mean, round(any_value(s), 1) AS std, round(any_value(q1), 4) AS q1, round(any_value(q3), 4) AS q3, round(any_value(q3 - q1), 4) AS iqr,
    count(*) FILTER (abs(budget - m) / s > 3) AS z_score_outliers, count(*) FILTER (budget < q1 - 1.5 * (q3 - q1) OR budget > q3 + 1.5 * (q3 - q1)) AS iqr_outliers,
    (SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FROM (SELECT id FROM catalog, b WHERE budget < q1 - 1.5 * (q3 - q1) OR budget > q3 + 1.5 * (q3 - q1) ORDER BY id LIMIT 10)) AS examples
    FROM catalog, b""", "b AS (SELECT avg(budget) AS m, stddev_pop(budget) AS s, quantile_cont(budget, 0.25) AS q1, quantile_cont(budget, 0.75) AS q3 FROM catalog)"),
)
def outliers(spark, sf):
    rows = stage(order_catalog(spark, sf, "id", "budget").withColumn("title", F.col("id").cast("string")))
    out = trends.outlier_summary(rows, "budget", digits=False)
    out = rounded(rounded(out, 1, "mean", "std"), 4, "q1", "q3", "iqr")
    return out.withColumn("examples", F.nullif(F.array_join("example_titles", ","), F.lit(""))).drop("example_titles")


@query(
    "g9_outlier_rows",
    with_catalog("SELECT id, runtime FROM catalog, b WHERE runtime < q1 - 1.5 * (q3 - q1) OR runtime > q3 + 1.5 * (q3 - q1)",
    "b AS (SELECT quantile_cont(runtime, 0.25) AS q1, quantile_cont(runtime, 0.75) AS q3 FROM catalog)"),
)
def outlier_rows(spark, sf):
    return trends.outlier_rows(stage(order_catalog(spark, sf, "id", "runtime")), "runtime").select("id", "runtime")


@query(
    "g10_g12_quality_report",
    with_catalog("""SELECT * FROM (
    SELECT '*' AS "column", 'clean_rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM catalog
    UNION ALL SELECT '*', 'source_rows', CAST(count(*) AS VARCHAR) FROM catalog
    UNION ALL SELECT 'id', 'missing', '0' UNION ALL SELECT 'release_date', 'missing', '0' UNION ALL SELECT 'primary_genre', 'missing', '0'
    UNION ALL SELECT 'runtime', 'missing', CAST(count(*) - count(runtime) AS VARCHAR) FROM catalog
    UNION ALL SELECT 'runtime', 'min', CAST(min(runtime) AS VARCHAR) FROM catalog UNION ALL SELECT 'runtime', 'max', CAST(max(runtime) AS VARCHAR) FROM catalog
    UNION ALL SELECT 'runtime', 'median', CAST(median(runtime) AS VARCHAR) FROM catalog
    UNION ALL SELECT 'release_date', 'cleaned_start', CAST(min(release_date) AS VARCHAR) FROM catalog UNION ALL SELECT 'release_date', 'cleaned_end', CAST(max(release_date) AS VARCHAR) FROM catalog
    UNION ALL SELECT 'release_date', 'source_start', CAST(min(release_date) AS VARCHAR) FROM catalog UNION ALL SELECT 'release_date', 'source_end', CAST(max(release_date) AS VARCHAR) FROM catalog
    UNION ALL SELECT 'release_date', 'source_valid', CAST(count(release_date) AS VARCHAR) FROM catalog
    UNION ALL SELECT 'release_date', 'cutoff', '2001-07-31' UNION ALL SELECT 'primary_genre', 'distinct', CAST(count(DISTINCT primary_genre) AS VARCHAR) FROM catalog)"""),
)
def quality_report(spark, sf):
    rows = stage(order_catalog(spark, sf, "id", "primary_genre", "release_date", "runtime"))
    return quality.quality_report(rows, rows.select("release_date"), CUTOFF)


@query("g12_date_range", "SELECT CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS start, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS \"end\", count(*) AS valid_dates FROM orders")
def date_range(spark, sf):
    return quality.date_range(order_catalog(spark, sf, "release_date"))


@query("g17_fingerprints", "SELECT count(*) AS row_count, TRUE AS same_when_reordered, FALSE AS same_when_changed FROM orders")
def fingerprints(spark, sf):
    rows = order_catalog(spark, sf, "id", "title", "primary_genre", "revenue", "release_date")
    moved = rows.repartition(5, "title")
    changed = rows.withColumn("revenue", F.when(F.col("id") == 7, 0.0).otherwise(F.col("revenue")))
    mark = [quality.fingerprint(x).select("fingerprint").scalar() for x in (moved, changed)]
    return quality.fingerprint(rows).select(
        "row_count", (F.col("fingerprint") == mark[0]).alias("same_when_reordered"), (F.col("fingerprint") == mark[1]).alias("same_when_changed")
    )


@query("g18_top_values", "SELECT n_name AS value, count(*) AS rows FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY rows DESC, value LIMIT 5")
def top_values(spark, sf):
    return levels.top_values(order_catalog(spark, sf, "country"), "country", 5)


@query(
    "g19_category_levels",
    """SELECT n_name AS level FROM (SELECT n_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name HAVING count(*) >= 5 ORDER BY n DESC, n_name LIMIT 8) UNION ALL SELECT 'Other'""",
)
def category_levels(spark, sf):
    kept = levels.category_levels(order_catalog(spark, sf, "country").withColumnRenamed("country", "primary_genre"))
    return spark.createDataFrame([(x,) for x in kept], "level string")


@query(
    "g20_exact_quantiles",
    with_catalog("""SELECT primary_genre, measure, CAST(p.probability AS DOUBLE) AS probability, n, round(q[p.k], 4) AS value FROM (SELECT primary_genre, measure, count(v) AS n, quantile_cont(v, [0.1, 0.5, 0.75]) AS q
    FROM (SELECT primary_genre, 'budget' AS measure, budget AS v FROM catalog UNION ALL SELECT primary_genre, 'revenue', revenue FROM catalog) GROUP BY primary_genre, measure), (VALUES (0.1, 1), (0.5, 2), (0.75, 3)) p(probability, k)"""),
)
def quantiles(spark, sf):
    rows = stage(order_catalog(spark, sf, "primary_genre", "budget", "revenue"))
    out = exact_quantiles(rows, ["primary_genre"], {"budget": "budget", "revenue": "revenue"}, (0.1, 0.5, 0.75))
    return rounded(out, 4, "value").select("primary_genre", "measure", "probability", "n", "value")


_SKETCH_YEARS = (1994, 1996, 1998, 2000, 2001)


@query(
    "g20_quantile_sketches",
    with_catalog("""SELECT primary_genre, f.fold, measure, p.probability, CAST(count(v) AS BIGINT) AS n, TRUE AS within_bound
    FROM (SELECT primary_genre, year, 'budget' AS measure, budget AS v FROM catalog UNION ALL SELECT primary_genre, year, 'revenue', revenue FROM catalog) AS x
    JOIN (SELECT CAST(unnest([1994, 1996, 1998, 2000, 2001]) AS INTEGER) AS fold) AS f ON x.year < f.fold
    CROSS JOIN (SELECT CAST(unnest([0.1, 0.5, 0.9]) AS DOUBLE) AS probability) AS p GROUP BY ALL HAVING count(v) > 0"""),
)
def quantile_sketches_of_folds(spark, sf):
    """Quantiles of all rows before each fold from one sketch per category and year; whether their ranks keep three times the stated error."""
    rows = stage(order_catalog(spark, sf, "primary_genre", "year", "budget", "revenue"))
    yearly = stage(sketches.quantile_sketches(rows, ["primary_genre", "year"], {"budget": "budget", "revenue": "revenue"}))
    grown = sketches.growing_sketches(yearly, ["primary_genre"], "year", "fold", _SKETCH_YEARS)
    asked = stage(sketches.sketched_quantiles(grown, (0.1, 0.5, 0.9)))
    long = rows.select(
        F.col("primary_genre").alias("g"), F.col("year").alias("y"),
        F.inline(F.array(F.struct(F.lit("budget").alias("m"), F.col("budget").alias("v")), F.struct(F.lit("revenue").alias("m"), F.col("revenue").alias("v")))),
    ).filter("v is not null")
    met = long.join(asked, F.col("g").eqNullSafe(F.col("primary_genre")) & (F.col("m") == F.col("measure")) & (F.col("y") < F.col("fold")))
    placed = met.groupBy("primary_genre", "fold", "measure", "probability", "n").agg(
        F.count_if(F.col("v") < F.col("value")).alias("below"), F.count_if(F.col("v") <= F.col("value")).alias("upto"), F.count("*").alias("counted")
    )
    slack = F.lit(3 * sketches.rank_error()) * F.col("n") + 1
    wanted = F.col("probability") * F.col("n")
    good = (F.col("below") - slack <= wanted) & (wanted <= F.col("upto") + slack) & (F.col("counted") == F.col("n"))
    return placed.select("primary_genre", "fold", "measure", "probability", "n", good.alias("within_bound"))


@query(
    "g21_conditional_shares",
    with_catalog("""SELECT round(median(budget), 2) AS median_budget, round(median(runtime), 2) AS median_runtime, (SELECT list(primary_genre ORDER BY n DESC, primary_genre)[1:3] FROM (SELECT primary_genre, count(*) AS n FROM catalog WHERE revenue >= 200000 GROUP BY 1)) AS top_genres,
    round(avg((language = 'en')::INT) * 100, 2) AS english_share_percent, round(avg((country LIKE '%NATION_1%')::INT) * 100, 2) AS us_production_share_percent FROM catalog WHERE revenue >= 200000"""),
)
def conditional_shares(spark, sf):
    """Traits of the rows of high revenue; nations NATION_1x stand for the country asked about."""
    rows = order_catalog(spark, sf, "primary_genre", "language", "country", "budget", "runtime", "revenue").filter("revenue >= 200000")
    known = rows.withColumn("country", F.when(F.contains("country", F.lit("NATION_1")), "United States of America").otherwise("elsewhere"))
    found = profiles.selection_traits(stage(known.withColumn("release_quarter", F.lit("any"))))
    return rounded(found, 2, "median_budget", "median_runtime").select("median_budget", "median_runtime", "top_genres", "english_share_percent", "us_production_share_percent")


# categories so small that the size of comparable ones decides
_FINE_SQL = """gx AS (SELECT country || ' ' || language || ' ' || primary_genre AS genre, count(vote_average) AS movie_count, avg(vote_average) AS r FROM catalog GROUP BY genre),
  least_size AS (SELECT greatest(5, least(20, CASE WHEN count(*) >= 50 THEN count(*) // 50 ELSE 5 END)) AS size FROM catalog),"""


@query(
    "g26_insights",
    with_catalog("""SELECT 1 AS position, 'most_common_category' AS kind, genre AS subject, CAST(movie_count AS DOUBLE) AS value, 'largest category: ' || genre || ' (' || movie_count || ' rows)' AS text FROM (SELECT genre, movie_count FROM gx ORDER BY movie_count DESC, r DESC, genre LIMIT 1)
    UNION ALL SELECT 2, 'best_rated_category', genre, round(r, 4), 'best rated category of comparable size: ' || genre FROM (SELECT * FROM gx, least_size ORDER BY movie_count < size, r DESC, genre LIMIT 1)
    UNION ALL SELECT 3, 'busiest_year', CAST(year AS VARCHAR), n, 'year with most rows: ' || year || ' (' || n || ')' FROM (SELECT * FROM y ORDER BY n DESC, year LIMIT 1)
    UNION ALL SELECT 4, 'best_rated_year', CAST(year AS VARCHAR), round(r, 4), 'best rated year of five rows or more: ' || year FROM (SELECT * FROM y WHERE n >= 5 ORDER BY r DESC, year LIMIT 1)
    UNION ALL SELECT 5, 'budget_revenue_correlation', 'budget/revenue', round(corr(budget, revenue), 4), 'correlation of budget and revenue' FROM catalog WHERE budget > 0""", _FINE_SQL + YEARS_SQL),
)
def insights(spark, sf):
    rows = order_catalog(spark, sf, "title", "country", "language", "primary_genre", "year", "vote_average", "revenue", "budget")
    rows = rows.withColumn("primary_genre", F.concat_ws(" ", "country", "language", "primary_genre"))
    found = summaries.insights(rows, summaries.category_summary(rows, None, False), summaries.yearly_summary(rows, None, False))
    # rounded means within a text may differ in the last digit between engines; the value column has them
    return rounded(found.withColumn("text", F.regexp_replace("text", r"( \(mean .*\)|: -?[0-9.]+)$", "")), 4, "value")


@query(
    "g27_selection_meta",
    with_catalog("""SELECT count(*) AS input_rows, count(*) FILTER (year >= 1999) AS filtered_rows, count(DISTINCT primary_genre) AS genre_categories, 3 AS years_covered, 1999 AS first_year, 2001 AS last_year FROM catalog"""),
)
def selection_meta(spark, sf):
    rows = order_catalog(spark, sf, "title", "primary_genre", "year", "vote_average")
    return summaries.selection_meta(rows, rows.filter("year >= 1999"))


# cleaning steps -------------------------------------------------------------------------------


@query(
    "w4_u1_best_row_per_id",
    """SELECT l_orderkey AS id, l_extendedprice AS vote_count, l_quantity AS popularity, CAST(l_suppkey AS DOUBLE) AS revenue, CAST(l_partkey AS DOUBLE) AS runtime FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_quantity DESC, l_suppkey DESC, l_partkey DESC) = 1""",
)
def best_row_per_id(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("vote_count"), F.col("l_quantity").alias("popularity"),
        F.col("l_suppkey").cast("double").alias("revenue"), F.col("l_partkey").cast("double").alias("runtime"),
    )
    return dedup.deduplicate_ids(lines)


_SIGNED_SQL = PARTS_SQL + """, signed AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY tk, ok, lk ORDER BY vote_count DESC, popularity DESC) = 1)"""


@query("w5_signature_duplicates", f"WITH {_SIGNED_SQL} SELECT id, title, original_title, original_language FROM signed")
def signature_duplicates(spark, sf):
    return dedup.deduplicate_signatures(part_catalog(spark, sf)).select("id", "title", "original_title", "original_language")


@query("w6_title_collisions", f"WITH {_SIGNED_SQL} SELECT tk AS title_key, 2000 AS year, count(*) AS members FROM signed GROUP BY tk HAVING count(*) > 1")
def title_collisions(spark, sf):
    return dedup.collision_groups(dedup.deduplicate_signatures(part_catalog(spark, sf))).withColumnRenamed("_title_key", "title_key")


# with plain originals no candidate of one kind equals one of another, so the rule can be applied kind by kind
_NAMED_SQL = _SIGNED_SQL + """,
crowd AS (SELECT *, count(*) OVER (PARTITION BY tk) > 1 AS crowded, row_number() OVER (ORDER BY vote_count DESC, popularity DESC) AS place FROM signed),
one AS (SELECT *, row_number() OVER (PARTITION BY tk, ok ORDER BY place) = 1 AS first_original FROM crowd),
two AS (SELECT *, row_number() OVER (PARTITION BY tk, first_original, release_date ORDER BY place) = 1 AS first_day FROM one),
three AS (SELECT *, row_number() OVER (PARTITION BY tk, first_original, first_day, lk ORDER BY place) = 1 AS first_language FROM two)"""


@query(
    "w7_distinct_titles",
    f"""WITH {_NAMED_SQL} SELECT id, CASE WHEN NOT crowded THEN title WHEN first_original THEN title || ' (' || original_title || ')'
    WHEN first_day THEN title || ' (' || strftime(release_date, '%Y-%m-%d') || ')' WHEN first_language THEN title || ' [' || upper(original_language) || ']' ELSE title || ' #' || id END AS title FROM three""",
)
def distinct_titles(spark, sf):
    return dedup.disambiguate_titles(stage(dedup.deduplicate_signatures(part_catalog(spark, sf)))).select("id", "title")


# ranked by id, every title is on a fifth of all rows: the first has the date, the second the bare title, the others numbers
@query(
    "w7_numbered_titles",
    """SELECT id, CASE place WHEN 1 THEN title || ' (1999-12-31)' WHEN 2 THEN title ELSE title || ' #' || (place - 1) END AS title
    FROM (SELECT p_partkey AS id, p_type AS title, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey DESC) AS place FROM part)""",
)
def numbered_titles(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_type").alias("title"), F.lit(1999).alias("year"), F.lit("1999-12-31").cast("date").alias("release_date"),
        F.col("p_partkey").cast("double").alias("vote_count"),
    )
    named = dedup.disambiguate_titles(dedup.with_signature(rows))
    return named.select(F.col("vote_count").cast("long").alias("id"), "title")


@query(
    "w9_w10_j7_imputation",
    with_catalog("""SELECT id, coalesce(budget, m1, b2) AS budget, coalesce(runtime, m2, r2) AS runtime, coalesce(budget > 0, FALSE) AS budget_observed, coalesce(runtime > 0, FALSE) AS runtime_observed,
    revenue, TRUE AS revenue_observed, least(vote_average, 10) AS vote_average FROM catalog LEFT JOIN med USING (primary_genre),
    (SELECT median(coalesce(budget, m1)) AS b2, median(coalesce(runtime, m2)) AS r2 FROM catalog LEFT JOIN med USING (primary_genre))""",
    "med AS (SELECT primary_genre, median(budget) AS m1, median(runtime) AS m2 FROM catalog GROUP BY primary_genre)"),
)
def imputation_query(spark, sf):
    rows = order_catalog(spark, sf, "id", "primary_genre", "budget", "runtime", "revenue", "vote_average")
    return imputation.clean_measures(rows).drop("primary_genre")


@query("w11_sequential_ids", with_catalog("SELECT row_number() OVER (ORDER BY release_date, title, id) AS id, id AS source_id, release_date FROM catalog"))
def sequential_ids(spark, sf):
    rows = order_catalog(spark, sf, "id", "title", "release_date")
    return sequence.reindex_ids(rows, [F.col("release_date"), F.col("title"), F.col("id")]).select("id", "source_id", "release_date")


@query("w12_latest_rows", with_catalog("SELECT id, row_number() OVER (ORDER BY release_date DESC, title DESC, id DESC) <= 1000 AS is_latest FROM catalog"))
def latest_rows(spark, sf):
    rows = order_catalog(spark, sf, "id", "title", "release_date")
    return sequence.latest_rows_flag(rows, 1000, [F.col("title"), F.col("id")]).select("id", "is_latest")


@query(
    "w14_first_model_rows",
    "SELECT l_orderkey AS id, min(CAST(l_shipdate AS DATE)) AS release_date FROM lineitem GROUP BY l_orderkey",
)
def first_model_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").cast("date").alias("release_date"))
    return dedup.deduplicate_model_rows(lines)


def _part_source(spark, sf):
    # the same parts as a raw source, with gaps and dates beyond the cutoff
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("id"), F.when(F.col("p_brand") != "Brand#9", F.col("p_name")).alias("title"), F.col("p_type").alias("original_title"),
        F.col("p_brand").alias("original_language"), F.format_string("[{'name': '%s'}]", "p_type").alias("genres"),
        F.when(F.col("p_brand") == "Brand#8", "2000-13-01").otherwise(F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size")).cast("string")).alias("release_date"),
        F.col("p_size").cast("string").alias("vote_count"), F.col("p_partkey").cast("string").alias("popularity"),
        F.when(F.col("p_size") < 40, F.col("p_retailprice").cast("string")).alias("revenue"),
    )


# titles missing where the original title stands in, so nothing goes for want of a title
_SOURCE_SQL = """
parts AS (SELECT p_partkey AS id, CASE WHEN p_brand = 'Brand#9' THEN p_type ELSE p_name END AS title, p_type AS original_title, p_brand AS original_language, p_type AS genre,
  CAST(DATE '2000-01-01' + CAST(p_size AS INTEGER) AS DATE) AS release_date, CAST(p_size AS DOUBLE) AS vote_count, CAST(p_partkey AS DOUBLE) AS popularity,
  CASE WHEN p_size < 40 THEN p_retailprice END AS revenue, lower(CASE WHEN p_brand = 'Brand#9' THEN p_type ELSE p_name END) AS tk, lower(p_type) AS ok, lower(p_brand) AS lk
  FROM part WHERE p_brand <> 'Brand#8' AND p_size <= 45),
signed AS (SELECT *, revenue IS NOT NULL AS revenue_observed FROM parts QUALIFY row_number() OVER (PARTITION BY tk, ok, lk ORDER BY (revenue IS NOT NULL) DESC, vote_count DESC, popularity DESC) = 1),
crowd AS (SELECT *, count(*) OVER (PARTITION BY tk) > 1 AS crowded, row_number() OVER (ORDER BY revenue_observed DESC, vote_count DESC, popularity DESC) AS place FROM signed),
one AS (SELECT *, row_number() OVER (PARTITION BY tk, ok ORDER BY place) = 1 AND ok <> tk AS first_original FROM crowd),
two AS (SELECT *, row_number() OVER (PARTITION BY tk, first_original, release_date ORDER BY place) = 1 AS first_day FROM one),
three AS (SELECT *, row_number() OVER (PARTITION BY tk, first_original, first_day, lk ORDER BY place) = 1 AS first_language FROM two),
named AS (SELECT *, CASE WHEN NOT crowded THEN title WHEN first_original THEN title || ' (' || original_title || ')' WHEN first_day THEN title || ' (' || strftime(release_date, '%Y-%m-%d') || ')'
  WHEN first_language THEN title || ' [' || upper(original_language) || ']' ELSE title || ' #' || id END AS new_title FROM three),
med AS (SELECT genre, median(revenue) AS m FROM parts GROUP BY genre)"""


@query(
    "q1_w8_clean_catalog",
    f"""WITH {_SOURCE_SQL} SELECT row_number() OVER (ORDER BY release_date, new_title, id) AS id, id AS source_id, new_title AS title, original_title, genre AS primary_genre,
    coalesce(revenue, m) AS revenue, revenue_observed, release_date, CAST(2000 AS INTEGER) AS year, vote_count, popularity, 'Unknown' AS country, original_language AS language, 'Unknown' AS keyword
    FROM named JOIN med USING (genre)""",
)
def clean_catalog(spark, sf):
    # the language default is the original one, see the text preparation
    return cleaning.clean_catalog(_part_source(spark, sf), "2000-02-15").table.select(
        "id", "source_id", "title", "original_title", "primary_genre", "revenue", "revenue_observed", "release_date", "year", "vote_count",
        "popularity", "country", "language", "keyword",
    )


@query(
    "g11_cleaning_metrics",
    f"""WITH {_SOURCE_SQL} SELECT 'rows_loaded' AS metric, count(*) AS value FROM part UNION ALL SELECT 'rows_after_cleaning', count(*) FROM signed UNION ALL SELECT 'rows_removed_missing_title', 0
    UNION ALL SELECT 'duplicates_removed', (SELECT count(*) FROM parts) - (SELECT count(*) FROM signed) UNION ALL SELECT 'source_duplicates_removed', 0
    UNION ALL SELECT 'title_duplicates_removed', (SELECT count(*) FROM parts) - (SELECT count(*) FROM signed)
    UNION ALL SELECT 'title_collisions_disambiguated', count(*) FROM (SELECT tk FROM signed GROUP BY tk HAVING count(*) > 1)
    UNION ALL SELECT 'text_fields_filled', 2 * count(*) FROM signed UNION ALL SELECT 'rows_removed_invalid_release_date', count(*) FROM part WHERE p_brand = 'Brand#8'
    UNION ALL SELECT 'rows_removed_after_dataset_cutoff', count(*) FROM part WHERE p_brand <> 'Brand#8' AND p_size > 45""",
)
def cleaning_metrics(spark, sf):
    return cleaning.clean_catalog(_part_source(spark, sf), "2000-02-15").metrics


@query(
    "q2_reclean_changes_nothing",
    f"WITH {_SOURCE_SQL} SELECT count(*) AS rows, CAST(0 AS BIGINT) AS changed FROM signed",
)
def reclean(spark, sf):
    first = cleaning.clean_catalog(_part_source(spark, sf), "2000-02-15").table
    again = cleaning.reclean_catalog(first, "2000-02-15").table.select(*first.columns)
    tagged = first.withColumn("_n", F.lit(1)).unionByName(again.withColumn("_n", F.lit(-1)))
    return tagged.groupBy(*first.columns).agg(F.sum("_n").alias("n"), F.count_if(F.col("_n") == 1).alias("a")).agg(
        F.sum("a").alias("rows"), F.count_if(F.col("n") != 0).alias("changed")
    )


def _deliveries(spark, sf):
    # the raw parts with the brand as the delivery that a row came with
    brand = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("delivery"))
    return _part_source(spark, sf).join(brand, "id")


def _earlier(rows):
    """The source some time ago: a delivery was not there yet, another one was corrected since, a third one is gone today."""
    before = rows.filter("delivery <> 'Brand#3'").withColumn(
        "vote_count", F.when(F.col("delivery") == "Brand#4", F.lit("1")).otherwise(F.col("vote_count"))
    )
    gone = rows.filter("delivery = 'Brand#5'").withColumns({"delivery": F.lit("Brand#0"), "title": F.concat("title", F.lit(" old"))})
    return before.unionByName(gone)


_CLEANED = (
    "id", "source_id", "title", "original_title", "primary_genre", "revenue", "revenue_observed", "release_date", "year", "vote_count",
    "popularity", "country", "language", "keyword",
)


@query(
    "q2_incremental_clean",
    f"""WITH {_SOURCE_SQL} SELECT row_number() OVER (ORDER BY release_date, new_title, id) AS id, id AS source_id, new_title AS title, original_title, genre AS primary_genre,
    coalesce(revenue, m) AS revenue, revenue_observed, release_date, CAST(2000 AS INTEGER) AS year, vote_count, popularity, 'Unknown' AS country, original_language AS language, 'Unknown' AS keyword
    FROM named JOIN med USING (genre)""",
)
def incremental_clean(spark, sf):
    """An earlier state of the source is cleaned first; the second run parses what changed and equals a full one."""
    rows, folder = _deliveries(spark, sf), new_folder(spark)
    incremental.clean_changed(_earlier(rows), folder, "delivery", "2000-02-15")
    return incremental.clean_changed(rows, folder, "delivery", "2000-02-15").cleaned.table.select(*_CLEANED)


@query(
    "q3_changed_parts",
    """SELECT p_brand AS part, count(*) AS rows, CASE p_brand WHEN 'Brand#3' THEN 'new' WHEN 'Brand#4' THEN 'changed' ELSE 'same' END AS state FROM part GROUP BY p_brand
    UNION ALL SELECT 'Brand#0', count(*), 'removed' FROM part WHERE p_brand = 'Brand#5'""",
)
def changed_parts(spark, sf):
    rows, folder = _deliveries(spark, sf), new_folder(spark)
    incremental.clean_changed(_earlier(rows), folder, "delivery", "2000-02-15")
    return incremental.clean_changed(rows, folder, "delivery", "2000-02-15").parts


@query(
    "s6_s8_result_versions",
    with_catalog("""SELECT 2 AS versions, 1 AS removed, year, count(title) AS movie_count, round(avg(vote_average), 4) AS avg_rating FROM catalog GROUP BY year"""),
)
def result_versions(spark, sf):
    """Two runs save the yearly summary, the older one is removed; what a reader finds then is the newer one, whole."""
    rows, folder = order_catalog(spark, sf, "title", "year", "vote_average", "revenue"), new_folder(spark)
    for cutoff in (1995, 3000):
        summary = summaries.yearly_summary(rows.filter(F.col("year") < cutoff), None, ordered=False)
        versions.write_version(spark, folder, {"yearly": summary}, {"cutoff": str(cutoff)})
    found = versions.versions(spark, folder).count()
    removed = versions.remove_versions(spark, folder, keep=1)
    latest = versions.find_version(spark, folder, {"cutoff": "3000"})
    saved = versions.read_version(spark, folder, latest)["yearly"].select("year", "movie_count", F.round("avg_rating", 4).alias("avg_rating"))
    return saved.select(F.lit(found).alias("versions"), F.lit(removed).alias("removed"), "*")


@query("q4_filtered_exploration", with_catalog("""SELECT genre, movie_count, round(r, 4) AS avg_rating FROM (SELECT primary_genre AS genre, count(vote_average) AS movie_count, avg(vote_average) AS r FROM catalog
    WHERE year >= 1997 AND vote_average >= 5 AND contains(' ' || lower(replace(title, '#', ' ')) || ' ', ' customer ') GROUP BY primary_genre)"""))
def filtered_exploration(spark, sf):
    rows = order_catalog(spark, sf, "id", "title", "primary_genre", "year", "vote_average", "revenue")
    found = exploration.explore(rows, {"year_from": 1997, "min_rating": 5, "title_keyword": "Customer"})
    return found.genre_summary.select("genre", "movie_count").join(
        rounded(summaries.category_summary(found.filtered, None, False), 4, "avg_rating").select("genre", "avg_rating"), "genre"
    )


# charts ---------------------------------------------------------------------------------------


@query("c1_o5_category_bars", with_catalog("SELECT genre, movie_count FROM g1 ORDER BY movie_count DESC, r DESC, genre LIMIT 6", _G1_SQL))
def category_bars(spark, sf):
    return charts.category_bars(_tokens_summary(spark, sf), 6)


@query("c2_category_comparison", with_catalog("SELECT genre, movie_count, round(r, 4) AS avg_rating FROM g1 ORDER BY movie_count DESC, r DESC, genre LIMIT 6", _G1_SQL))
def category_comparison(spark, sf):
    return rounded(charts.category_comparison(_tokens_summary(spark, sf), 6), 4, "avg_rating")


@query("c3_yearly_trend", with_catalog("SELECT year, n AS movie_count, round(r, 4) AS avg_rating, (SELECT min(year) FROM y) AS first_year, (SELECT max(year) FROM y) AS last_year FROM y", YEARS_SQL))
def yearly_trend(spark, sf):
    rows = order_catalog(spark, sf, "title", "year", "vote_average")
    return rounded(charts.yearly_trend(summaries.yearly_summary(rows, None, False)), 4, "avg_rating")


@query("c4_budget_revenue_points", with_catalog("SELECT id, budget, revenue FROM catalog WHERE budget > 0 AND revenue > 0"))
def budget_revenue_points(spark, sf):
    return charts.budget_revenue_points(order_catalog(spark, sf, "id", "budget", "revenue"))


@query(
    "c4_m17_trend_line",
    with_catalog("""SELECT CAST(point AS INTEGER) AS point, round(log10(lo) + (log10(hi) - log10(lo)) * point / 199, 6) AS log_budget, round(slope * (log10(lo) + (log10(hi) - log10(lo)) * point / 199) + intercept, 6) AS log_revenue
    FROM (SELECT regr_slope(log10(revenue), log10(budget)) AS slope, regr_intercept(log10(revenue), log10(budget)) AS intercept, min(budget) AS lo, max(budget) AS hi FROM catalog WHERE budget > 0), range(200) t(point)"""),
)
def trend_line(spark, sf):
    out = charts.budget_revenue_line(order_catalog(spark, sf, "budget", "revenue"))
    return out.select("point", F.round(F.log10("budget"), 6).alias("log_budget"), F.round(F.log10("revenue"), 6).alias("log_revenue"))


# logs -----------------------------------------------------------------------------------------

_SESSION_SQL = "s AS (SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE event_type = 'signup'))"


@query("w13_latest_session", f"WITH {_SESSION_SQL} SELECT event_id, event_type AS event FROM s")
def latest_session(spark, sf):
    return oplog.latest_session(event_log(spark, sf), "signup").select("event_id", "event")


@query(
    "w13_all_sessions",
    """SELECT event_id, count(*) FILTER (event_type = 'signup') OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session,
    count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS own_session FROM events""",
)
def all_sessions(spark, sf):
    numbered = oplog.session_numbers(event_log(spark, sf), "signup", tie="event_id")
    own = oplog.session_numbers(numbered, "signup", tie="event_id", by=["request_id"], name="own_session")
    return own.select("event_id", "session", "own_session")


@query(
    "g23_event_counters",
    """SELECT 'failures' AS counter, count(*) FILTER (event_type = 'error') AS occurrences FROM events UNION ALL SELECT 'looks', count(*) FILTER (event_type IN ('view', 'click')) FROM events
    UNION ALL SELECT 'debounced', 0""",
)
def event_counters(spark, sf):
    return oplog.counters(event_log(spark, sf), {"failures": ("error",), "looks": ("view", "click"), "debounced": ("analysis_request_debounced",)})


@query("g23_event_counts", "SELECT event_type AS event, count(*) AS occurrences FROM events GROUP BY event_type")
def event_counts(spark, sf):
    return oplog.event_counts(event_log(spark, sf))


@query(
    "g24_mean_durations",
    """SELECT 'errors' AS label, 'error' AS event, round(avg(value), 4) AS mean_ms FROM events WHERE event_type = 'error' UNION ALL SELECT 'views', 'view', round(avg(value), 4) FROM events WHERE event_type = 'view'
    UNION ALL SELECT 'none', 'absent', 0""",
)
def mean_durations(spark, sf):
    out = oplog.mean_durations(event_log(spark, sf), {"errors": "error", "views": "view", "none": "absent"}, digits=None)
    return rounded(out, 4, "mean_ms")


@query(
    "g28_diagnosis",
    "SELECT 1 AS position, 'Some events failed.' AS cause UNION ALL SELECT 3, 'Someone bought or looked.'",
)
def diagnosis(spark, sf):
    counted = oplog.counters(event_log(spark, sf), {"failures": ("error",), "resets": ("reset",), "looks": ("view", "click"), "purchases": ("purchase",)})
    rules = ((("failures",), "Some events failed."), (("resets",), "Some resets."), (("purchases", "looks"), "Someone bought or looked."))
    return oplog.diagnosis(counted, rules)


@query(
    "o6_recent_events",
    """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS second, event_type AS event, CAST(user_id AS VARCHAR) AS request, 'message=' || props AS details FROM events ORDER BY ts DESC, event_id DESC LIMIT 15""",
)
def recent_events(spark, sf):
    out = oplog.recent_events(event_log(spark, sf), tie="event_id")
    return out.select(F.substring("timestamp", 1, 19).alias("second"), "event", "request", "details")


_LOG_SQL = """SELECT event_type AS event, count(*) AS lines, round(avg(CASE WHEN event_type <> 'error' THEN value END), 4) AS mean_ms FROM events WHERE event_type <> 'click' GROUP BY event_type"""


def _log_lines(spark, sf):
    # the events as JSON lines; errors quote their duration, clicks are cut off in the middle, and blank lines lie between
    e = table(spark, sf, "events")
    quoted = F.when(F.col("event_type") == "error", F.format_string('"%s"', F.col("value").cast("string"))).otherwise(F.col("value").cast("string"))
    line = F.concat(
        F.lit('{"timestamp": "'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit('", "event": "'), F.col("event_type"),
        F.lit('", "duration_ms": '), quoted, F.lit(', "rows": '), F.col("props"), F.lit("}"),
    )
    return e.select(F.explode(F.array(F.when(F.col("event_type") == "click", F.substring(line, 1, 40)).otherwise(line), F.lit(" "))).alias("value"))


@query("s4_q8_parsed_log", _LOG_SQL)
def parsed_log(spark, sf):
    return rounded(parse_events(_log_lines(spark, sf)).groupBy("event").agg(F.count("*").alias("lines"), F.avg("duration").alias("mean_ms")), 4, "mean_ms")


@query(
    "q8_log_report",
    "SELECT 'total' AS item, count(*) AS value FROM events WHERE event_type <> 'click' UNION ALL SELECT 'causes', 1 UNION ALL SELECT 'recent', 15",
)
def log_report(spark, sf):
    r = reports.log_report(parse_events(_log_lines(spark, sf)), whole_history=True)
    rows = lambda item, df: df.agg(F.count("*").alias("value")).select(F.lit(item).alias("item"), "value")
    return r.total.select(F.lit("total").alias("item"), F.col("total_events").alias("value")).unionByName(rows("causes", r.causes)).unionByName(rows("recent", r.recent))


# sources and sinks ----------------------------------------------------------------------------


@query("s1_s3_s5_csv_round_trip", with_catalog("SELECT id, title, revenue, release_date, year FROM catalog"))
def csv_round_trip(spark, sf):
    from catalens.functions.casting import restore_types

    folder = f"{shared_folder(spark)}/catalens-export/{uuid.uuid4().hex}"
    rows = order_catalog(spark, sf, "id", "title", "revenue", "release_date", "year", "keyword")
    tables.write_cleaned(rows, folder, "csv")
    return restore_types(tables.read_table(spark, folder)).select("id", "title", "revenue", "release_date", "year")


@query("s2_s5_parquet_by_decade", with_catalog("SELECT CAST(year // 10 * 10 AS INTEGER) AS decade, count(*) AS n FROM catalog WHERE year >= 2000 GROUP BY ALL"))
def parquet_by_decade(spark, sf):
    folder = f"{shared_folder(spark)}/catalens-export/{uuid.uuid4().hex}"
    rows = order_catalog(spark, sf, "id", "title", "year")
    tables.write_cleaned(rows, f"{folder}/movies_metadata.parquet", by_decade=True)
    saved = tables.read_raw_tables(spark, folder)["movies_metadata"]
    return saved.filter("decade = 2000").groupBy("decade").agg(F.count("*").alias("n"))
