"""SQL counterparts of the fitted models: normal equations solved by elimination in a recursive query."""

from __future__ import annotations

from catalens.functions.scalars import FEATURE_NAMES, QUARTERS
from catalog_queries.views import with_catalog

LEVELS = 5  # categories of the order catalog


def ridge(name: str, source: str, unknowns: int, models: str, unused: str = "FALSE") -> str:
    """Tables that end in ``<name>_fit`` (fold, model, start, b): intercept and slopes on columns as they are.

    ``source`` has fold, y and the regressors v (DOUBLE[]); ``models`` lists (model, alpha). Columns are
    standardised by their population deviation; constant ones, and those ``unused`` names, get slope 0.
    """
    p = unknowns
    return f"""
{name}_mom AS (SELECT fold, i, count(*) AS n, avg(v[i]) AS mean, CASE WHEN var_pop(v[i]) > 1e-12 * greatest(avg(v[i] * v[i]), 1e-300) THEN stddev_pop(v[i]) END AS sd, avg(y) AS my, covar_pop(v[i], y) AS cy
  FROM {source}, range(1, {p + 1}) r(i) GROUP BY fold, i),
{name}_cov AS (SELECT fold, i, j, covar_pop(v[i], v[j]) AS c FROM {source}, range(1, {p + 1}) r(i), range(1, {p + 1}) s(j) GROUP BY fold, i, j),
{name}_col AS (SELECT fold, i, model, alpha, n, mean, my, cy, CASE WHEN {unused} THEN NULL ELSE sd END AS sd FROM {name}_mom, (VALUES {models}) t(model, alpha)),
{name}_row AS (SELECT a.fold, a.model, a.i, list(CASE WHEN a.sd IS NULL OR b.sd IS NULL THEN (a.i = b.i)::INT ELSE a.n * c / (a.sd * b.sd) + a.alpha * (a.i = b.i)::INT END ORDER BY b.i)
    || [max(CASE WHEN a.sd IS NULL THEN 0 ELSE a.n * a.cy / a.sd END)] AS r
  FROM {name}_col a JOIN {name}_col b ON a.fold = b.fold AND a.model = b.model JOIN {name}_cov l ON l.fold = a.fold AND l.i = a.i AND l.j = b.i GROUP BY a.fold, a.model, a.i),
{name}_elim AS (
  SELECT fold, model, 1 AS k, list(r ORDER BY i) AS a FROM {name}_row GROUP BY fold, model
  UNION ALL
  SELECT fold, model, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / a[k][k]) ELSE list_transform(r, lambda x, j: x - r[k] * a[k][j] / a[k][k]) END)
  FROM {name}_elim WHERE k <= {p}),
{name}_slope AS (SELECT u.fold, u.model, u.i, u.mean, u.sd, u.my, coalesce(a[u.i][{p + 1}], 0) AS beta FROM {name}_elim e JOIN {name}_col u ON e.fold = u.fold AND e.model = u.model WHERE e.k = {p + 1}),
{name}_fit AS (SELECT fold, model, any_value(my) - sum(coalesce(beta / sd, 0) * mean) AS start, list(coalesce(beta / sd, 0) ORDER BY i) AS b, list(beta ORDER BY i) AS beta FROM {name}_slope GROUP BY fold, model)
"""


_OWN = ", ".join(f"(k = {g})::INT" for g in range(2, LEVELS + 1))
_CROSS = ", ".join(f"coalesce(lb, 0) * (k = {g})::INT" for g in range(2, LEVELS + 1))
_REGRESSORS = f"""[coalesce(lb, f1), coalesce(lb * lb, f2), coalesce(runtime, f3), coalesce(runtime * runtime, f4), year - 1995, sin(2 * pi() * month / 12), cos(2 * pi() * month / 12),
    (language = 'en')::INT, (country = 'usa')::INT, budget_observed::INT, runtime_observed::INT, {_OWN}, {_CROSS}]::DOUBLE[]"""

# the two observed flags are equal in this catalog: least squares gets by with the first
LINEAR = f"""
lm AS (SELECT fold, m.*, ln(1 + budget) AS lb FROM m, (VALUES (1996), (1997), (1998), (1999), (2000), (2001)) t(fold) WHERE year <= fold),
lmed AS (SELECT fold, coalesce(median(lb), 0) AS f1, coalesce(median(lb * lb), 0) AS f2, coalesce(median(runtime), 0) AS f3, coalesce(median(runtime * runtime), 0) AS f4 FROM lm WHERE year < fold GROUP BY fold),
llev AS (SELECT fold, primary_genre, count(*) AS train_samples, row_number() OVER (PARTITION BY fold ORDER BY primary_genre) AS k FROM lm WHERE year < fold GROUP BY fold, primary_genre),
lx AS (SELECT lm.*, train_samples, k, ln(1 + revenue) AS y, {_REGRESSORS} AS v FROM lm JOIN lmed USING (fold) JOIN llev USING (fold, primary_genre)),
lt AS (SELECT * FROM lx WHERE year < fold),
{ridge('lin', 'lt', 11 + 2 * (LEVELS - 1), "('ridge', 8.0), ('ols', 0.0)", "model = 'ols' AND i = 11")}"""

# a forest of stumps: bags drawn by digests of row, fold and draw; the best cut of each bag over all regressors
STUMPS = 8
_DIGEST = "('0x' || substr(md5(id || '|' || fold || '|' || {}), 1, 12))::BIGINT"
_STUMPS = f"""
fs AS (SELECT fold, primary_genre, avg(y) AS level FROM lt GROUP BY fold, primary_genre),
fx AS (SELECT lx.fold, id, lx.primary_genre, year, train_samples, revenue, y, {STUMPS} * (SELECT least(1.0, 5000.0 / count(*)) FROM lt WHERE lt.fold = lx.fold) AS expected,
    [coalesce(lb, f1), coalesce(lb * lb, f2), coalesce(runtime, f3), coalesce(runtime * runtime, f4), year, sin(2 * pi() * month / 12), cos(2 * pi() * month / 12),
    (language = 'en')::INT, (country = 'usa')::INT, budget_observed::INT, runtime_observed::INT, level, coalesce(lb, 0) * level]::FLOAT[] AS x
  FROM lx JOIN lmed USING (fold) JOIN fs USING (fold, primary_genre)),
fdraw AS (SELECT *, unnest(list_transform(range(1, floor(expected)::BIGINT + ({_DIGEST.format(0)} / pow(16, 12) < expected - floor(expected))::BIGINT + 1), lambda i: {_DIGEST.format('i')} % {STUMPS})) AS tree FROM fx WHERE year < fold),
fbag AS (SELECT fold, tree, id, any_value(x) AS x, any_value(y) AS y, count(*) AS w FROM fdraw GROUP BY fold, tree, id),
fmean AS (SELECT fold, tree, sum(w * y) / sum(w) AS centre FROM fbag GROUP BY fold, tree),
fval AS (SELECT fold, tree, j, x[j] AS z, sum(w) AS w, sum(w * (y - centre)) AS s, count(*) AS c FROM fbag JOIN fmean USING (fold, tree), range(1, 14) r(j) GROUP BY fold, tree, j, x[j]),
fcut AS (SELECT *, sum(w) OVER o AS lw, sum(s) OVER o AS ls, sum(c) OVER o AS lc, lead(z) OVER o AS next_z, sum(w) OVER g AS tw, sum(s) OVER g AS ts, sum(c) OVER g AS tc FROM fval
  WINDOW o AS (PARTITION BY fold, tree, j ORDER BY z), g AS (PARTITION BY fold, tree, j)),
fgain AS (SELECT *, ls * ls / lw + (ts - ls) * (ts - ls) / (tw - lw) - ts * ts / tw AS gain FROM fcut WHERE lc >= 3 AND tc - lc >= 3),
fbest AS (SELECT fold, tree, j, (z::DOUBLE + next_z) / 2 AS threshold, centre + ls / lw AS below, centre + (ts - ls) / (tw - lw) AS above
  FROM (SELECT *, max(gain) OVER (PARTITION BY fold, tree) AS top FROM fgain) JOIN fmean USING (fold, tree) WHERE gain >= top * (1 - 1e-9)
  QUALIFY row_number() OVER (PARTITION BY fold, tree ORDER BY j, z) = 1),
fp AS (SELECT fold, id, any_value(primary_genre) AS primary_genre, any_value(year) AS year, any_value(train_samples) AS train_samples, any_value(revenue) AS revenue,
    greatest(exp(avg(CASE WHEN x[j] <= threshold THEN below ELSE above END)) - 1, 0) AS p FROM fx JOIN fbest USING (fold) GROUP BY fold, id),"""


def _compared(forest: bool) -> str:
    """Uncalibrated predictions of the models, then calibration, predictions and errors per model and fold."""
    stumps = "UNION ALL SELECT 'random_forest', fold, id, primary_genre, year, train_samples, revenue, p FROM fp"
    return LINEAR + f""",
rt AS (SELECT *, CASE WHEN budget > 0 THEN revenue / budget END AS ratio FROM lx),
rall AS (SELECT fold, median(ratio) AS all_ratio, median(revenue) AS all_usual FROM rt WHERE year < fold GROUP BY fold),
rg AS (SELECT fold, primary_genre, coalesce(median(ratio), any_value(all_ratio), 1) AS ratio, coalesce(median(revenue), any_value(all_usual), 0) AS usual FROM rt JOIN rall USING (fold) WHERE year < fold GROUP BY fold, primary_genre),{_STUMPS if forest else ''}
base AS (
  SELECT model, fold, id, primary_genre, year, train_samples, revenue AS a, greatest(exp(start + list_dot_product(b, v)) - 1, 0) AS p FROM lx JOIN lin_fit USING (fold)
  UNION ALL
  SELECT 'genre_budget_ratio', fold, id, primary_genre, year, train_samples, revenue, greatest(CASE WHEN budget > 0 THEN budget * rg.ratio ELSE usual END, 0) FROM lx JOIN rg USING (fold, primary_genre)
  {stumps if forest else ''}),
bmom AS (SELECT model, fold, primary_genre, count(*) AS n, avg(p) AS mp, avg(a) AS ma, regr_slope(a, p) AS s, max(p) - min(p) AS span FROM base WHERE year < fold GROUP BY GROUPING SETS ((model, fold, primary_genre), (model, fold))),
braw AS (SELECT *, CASE WHEN n < 2 OR span <= 1e-9 OR s <= 0 OR s IS NULL THEN 0 ELSE ma - s * mp END AS i0, CASE WHEN n < 2 OR span <= 1e-9 THEN greatest(ma / mp, 0) WHEN s <= 0 THEN least(greatest(ma / mp, 0.05), 10) ELSE least(greatest(s, 0.05), 10) END AS s0 FROM bmom),
bcal AS (SELECT c.model, c.fold, c.primary_genre,
    CASE WHEN c.n >= 20 AND c.span > 1e-9 THEN w.i0 * (1 - least(1, c.n / 250.0)) + c.i0 * least(1, c.n / 250.0) ELSE w.i0 * (1 - least(1, c.n / 20.0)) END AS intercept,
    least(greatest(CASE WHEN c.n >= 20 AND c.span > 1e-9 THEN w.s0 * (1 - least(1, c.n / 250.0)) + c.s0 * least(1, c.n / 250.0) ELSE w.s0 * (1 - least(1, c.n / 20.0)) + c.ma / c.mp * least(1, c.n / 20.0) END, 0.05), 10) AS slope
  FROM braw c JOIN braw w ON c.model = w.model AND c.fold = w.fold AND w.primary_genre IS NULL AND c.primary_genre IS NOT NULL),
bpr AS (SELECT b.model, b.fold, b.id, b.primary_genre, b.a, greatest(intercept + slope * b.p, 0) AS p FROM base b JOIN bcal c ON b.model = c.model AND b.fold = c.fold AND b.primary_genre = c.primary_genre WHERE b.year = b.fold),
berr AS (SELECT model, fold, count(*) AS n, avg(abs(p - a)) AS mae, sqrt(avg((p - a) * (p - a))) AS rmse, sum(abs(p - a)) / sum(a) * 100 AS wape, 1 - sum((p - a) * (p - a)) / (var_pop(a) * count(*)) AS r2, sum(a) AS actual, sum(p) AS predicted
  FROM bpr GROUP BY model, fold),
bsum AS (SELECT model, count(*) AS years, avg(wape) AS wape, avg(r2) AS r2, avg(mae) AS mae, avg(rmse) AS rmse, corr(actual, predicted) AS c FROM berr GROUP BY model)
"""


THREE_MODELS, FOUR_MODELS = _compared(False), _compared(True)

# display names of the profile's regressors, in their order
PROFILE_NAMES = [
    *(FEATURE_NAMES[n] for n in ("log_budget", "runtime", "is_english", "is_us_production")),
    *(f"Release in {q}" for q in QUARTERS),
]
# ridge on the log target, over all rows (fold 0) and over all but the latest fifth (fold 1); regressors of the
# profile: gaps take the median, no column per category is left out
PROFILE = f"""
pd AS (SELECT *, row_number() OVER (ORDER BY release_date DESC, title DESC, id DESC) <= round(count(*) OVER () * 0.2) AS held FROM m),
pf AS (SELECT fold, pd.* FROM pd, (VALUES (0), (1)) t(fold)),
pmed AS (SELECT fold, median(ln(1 + budget)) AS f1, median(runtime) AS f2 FROM pf WHERE fold = 0 OR NOT held GROUP BY fold),
pg AS (SELECT fold, primary_genre, row_number() OVER (PARTITION BY fold ORDER BY count(*) DESC, primary_genre) AS k FROM pf WHERE fold = 0 OR NOT held GROUP BY fold, primary_genre HAVING count(*) >= 5),
pv AS (SELECT pf.*, ln(1 + revenue) AS y, [coalesce(ln(1 + budget), f1), coalesce(runtime, f2), (language = 'en')::INT, (country = 'usa')::INT,
    {", ".join(f"((month - 1) // 3 = {q})::INT" for q in range(4))}, {", ".join(f"(k = {g})::INT" for g in range(1, LEVELS + 1))}]::DOUBLE[] AS v FROM pf JOIN pg USING (fold, primary_genre) JOIN pmed USING (fold)),
px AS (SELECT * FROM pv WHERE fold = 0 OR NOT held),
{ridge('prof', 'px', 8 + LEVELS, "('profile', 6.0)")},
pname AS (SELECT * FROM (VALUES {", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(PROFILE_NAMES))}) t(i, feature)
  UNION ALL SELECT 8 + k, primary_genre || ' genre' FROM pg WHERE fold = 0),
pcoef AS (SELECT feature, beta[i] AS coefficient FROM prof_fit, pname WHERE fold = 0),
ppred AS (SELECT fold, held, revenue AS a, greatest(exp(start + list_dot_product(b, v)) - 1, 0) AS p FROM pv JOIN prof_fit USING (fold))
"""

PROFILE_OVERVIEW = """
SELECT 'ridge_log_revenue_profile' AS model_name, 'Ridge Revenue Profile' AS model_label, (SELECT count(*) FROM m) AS sample_rows, (SELECT count(*) FROM pd WHERE NOT held) AS training_rows, count(*) AS evaluation_rows,
  'latest holdout movies' AS evaluation_scope, (SELECT round(quantile_cont(revenue, 0.75), 2) FROM m) AS high_revenue_threshold, 0.75::DOUBLE AS high_revenue_quantile,
  round(1 - sum((p - a) * (p - a)) / (var_pop(a) * count(*)), 4) AS r_squared, round(avg(abs(p - a)), 2) AS mae, round(sum(abs(p - a)) / sum(a) * 100, 2) AS wape_percent,
  (SELECT CASE WHEN count(*) FILTER (p >= c) >= greatest(5, floor(count(*) * 0.12)) THEN count(*) FILTER (p >= c) ELSE count(*) FILTER (p >= d) END
   FROM ppred, (SELECT quantile_cont(a, 0.75) AS c, quantile_cont(p, 0.75) AS d FROM ppred WHERE fold = 0) WHERE fold = 0) AS predicted_high_rows
FROM ppred WHERE fold = 1 AND held
"""


def recursive(select: str, more: str) -> str:
    return with_catalog(select, more).replace("WITH ", "WITH RECURSIVE ", 1)
