"""Ridge and least squares on the log target, from moment sums.

One aggregation per (year, category) sums all products of fifteen shifted regressors. These blocks are
additive, so every fold's training Gram matrix is a sum of small rows: the data is read once for all
folds and alphas. The fold's median fill enters algebraically through the null indicators, the category
columns through the blocks' category. A category's two unknowns meet only the twelve shared ones, so they
are eliminated block by block: a fold's task solves a 12 x 12 system, whatever the number of categories,
and holds one row of sums per category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.functions.features import base_features
from catalens.operators.modelling import Centre
from catalens.operators.quantiles import Cumulative, exact_quantiles

# Regressors the sums run over. u and v are log budget and runtime, shifted, 0 where missing.
_PARTS = ("no_budget", "u", "uu", "no_runtime", "v", "vv", "t", "ms", "mc", "en", "us", "bo", "ro", "y")
_SUMS = ("one", *_PARTS)
_PAIRS = [(i, j) for i in range(len(_SUMS)) for j in range(i, len(_SUMS))]

COEFFICIENTS = ("intercept", "c_lb", "c_lb2", "c_rt", "c_rt2", "c_year", "c_ms", "c_mc", "c_en", "c_us", "c_bo", "c_ro", "c_lbx")
FILLS = ("fill_lb", "fill_lb2", "fill_rt", "fill_rt2")


def fold_medians(train: DataFrame, folds: list[int]) -> DataFrame:
    """Per validation year the medians of the four gappy regressors over the rows before it.

    log1p and squaring keep the order of positive values, so the middle two budgets and runtimes give
    the medians of their transforms as well.
    """
    grown = Cumulative("year", "validation_year", tuple(folds))
    middle = exact_quantiles(train.select("year", "budget", "runtime"), [], {"budget": "budget", "runtime": "runtime"}, cumulative=grown)

    def middle_of(measure: str, transform):
        a = F.max(F.when(F.col("measure") == measure, transform(F.col("lower"))))
        b = F.max(F.when(F.col("measure") == measure, transform(F.col("upper"))))
        return F.coalesce((a + b) / 2, F.lit(0.0))

    return middle.groupBy("validation_year").agg(
        middle_of("budget", F.log1p).alias("fill_lb"),
        middle_of("budget", lambda c: F.log1p(c) * F.log1p(c)).alias("fill_lb2"),
        middle_of("runtime", lambda c: c).alias("fill_rt"),
        middle_of("runtime", lambda c: c * c).alias("fill_rt2"),
    )


def _later_folds(folds: list[int]):
    years = F.array(*[F.lit(int(f)) for f in folds])
    return F.filter(years, lambda f: f > F.col("year")).alias("later")


def with_regressors(rows: DataFrame) -> DataFrame:
    """Add the unfilled regressors as ``x_<name>``."""
    return rows.select("*", *[c.alias(f"x_{n}") for n, c in base_features().items()])


def moment_blocks(train: DataFrame, centre: Centre) -> DataFrame:
    """Sums of all regressor products per (year, category): the only full pass over the data."""
    parts = {
        "one": "1.0D",
        "no_budget": "double(budget is null)",
        "u": f"coalesce(x_log_budget - {centre.log_budget!r}D, 0.0D)",
        "uu": f"coalesce(pow(x_log_budget - {centre.log_budget!r}D, 2), 0.0D)",
        "no_runtime": "double(runtime is null)",
        "v": f"coalesce(x_runtime - {centre.runtime!r}D, 0.0D)",
        "vv": f"coalesce(pow(x_runtime - {centre.runtime!r}D, 2), 0.0D)",
        "t": f"double(year - {int(centre.year)})",
        "ms": "x_month_sin", "mc": "x_month_cos", "en": "x_is_english", "us": "x_is_us_production",
        "bo": "x_budget_observed", "ro": "x_runtime_observed",
        "y": "log1p(revenue)",
    }
    rows = with_regressors(train).selectExpr("year", "primary_genre", *[f"{e} as {n}" for n, e in parts.items()])
    sums = [F.expr(f"sum({_SUMS[i]} * {_SUMS[j]}) as s{k}") for k, (i, j) in enumerate(_PAIRS)]
    return rows.groupBy("year", "primary_genre").agg(*sums)


def fit_linear(train: DataFrame, folds: list[int], centre: Centre, alphas: dict[str, float]) -> DataFrame:
    """Coefficients per (validation_year, category): one struct per model name in ``alphas``.

    A row also has the category's number of training rows and the fold's fills, all a prediction needs.
    """
    blocks = moment_blocks(train.filter(F.col("year") < max(folds)), centre)
    per_fold = (
        blocks.withColumn("later", _later_folds(folds))
        .withColumn("validation_year", F.explode("later"))
        .groupBy("validation_year", "primary_genre")
        .agg(*[F.expr(f"sum(s{k}) as s{k}") for k in range(len(_PAIRS))])
    )
    fills = fold_medians(train.filter(F.col("year") < max(folds)), folds)
    solvable = per_fold.join(fills, "validation_year", "left").fillna(0.0, list(FILLS))
    models = ", ".join(f"{m} struct<{', '.join(f'{c} double' for c in COEFFICIENTS)}>" for m in alphas)
    schema = (
        "validation_year int, primary_genre string, train_samples long, "
        + ", ".join(f"{f} double" for f in FILLS) + ", " + models
    )
    return solvable.groupBy("validation_year").applyInPandas(_solver(centre, dict(alphas)), schema)


def _solver(centre: Centre, alphas: dict[str, float]):
    sums, pairs = _SUMS, _PAIRS
    names, fill_names = COEFFICIENTS, FILLS
    shift_b, shift_r = centre.log_budget, centre.runtime

    def solve(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values("primary_genre").reset_index(drop=True)
        levels = len(pdf)
        at = {name: i for i, name in enumerate(sums)}
        width = len(sums)
        blocks = np.zeros((levels, width, width))
        for k, (i, j) in enumerate(pairs):
            blocks[:, i, j] = blocks[:, j, i] = pdf[f"s{k}"].to_numpy(float)
        fill = pdf.loc[0, list(fill_names)].to_numpy(float)

        # rows of `shape` write each regressor as a combination of the summed parts
        base = 11
        shape = np.zeros((base + 2, width))
        for row, (mid, plain, square, gap) in enumerate((
            (fill[0], shift_b, False, "no_budget"), (fill[1], shift_b, True, "no_budget"),
            (fill[2], shift_r, False, "no_runtime"), (fill[3], shift_r, True, "no_runtime"),
        )):
            lin, quad = ("u", "uu") if gap == "no_budget" else ("v", "vv")
            if square:
                shape[row, at[quad]], shape[row, at[lin]] = 1.0, 2 * plain
                shape[row, 0], shape[row, at[gap]] = plain**2, mid - plain**2
            else:
                shape[row, at[lin]] = 1.0
                shape[row, 0], shape[row, at[gap]] = plain, mid - plain
        for row, part in enumerate(("t", "ms", "mc", "en", "us", "bo", "ro"), start=4):
            shape[row, at[part]] = 1.0
        shape[base, 0] = 1.0  # category indicator
        shape[base + 1, at["u"]], shape[base + 1, 0], shape[base + 1, at["no_budget"]] = 1.0, shift_b, -shift_b

        whole = shape @ blocks @ shape.T  # products per category: shared regressors, then its own two
        total = shape @ blocks[:, :, 0].T
        of_y = shape @ blocks[:, :, at["y"]].T
        n = blocks[:, 0, 0].sum()
        y_mean = blocks[:, 0, at["y"]].sum() / n

        def spread(square, plain):
            """Scales of columns, 1 for constant ones, and which these are."""
            raw = square / n
            var = raw - (plain / n) ** 2
            flat = var <= 1e-12 * np.maximum(raw, 1e-300)
            return np.where(flat, 1.0, np.sqrt(np.where(flat, 1.0, var))), flat

        mean = total[:base].sum(1) / n
        gram = whole[:, :base, :base].sum(0) - n * np.outer(mean, mean)
        scale, flat = spread(np.diag(gram) + n * mean**2, n * mean)
        gram /= np.outer(scale, scale)
        gram[flat, :] = gram[:, flat] = 0.0
        shared_y = np.where(flat, 0.0, (of_y[:base].sum(1) - n * mean * y_mean) / scale)

        # the first category is the base level and has no columns of its own
        own_scale, own_flat = spread(whole[1:, [base, base + 1], [base, base + 1]].reshape(-1, 2), total[base:, 1:].T)
        keep = np.where(own_flat, 0.0, 1.0 / own_scale)
        own = whole[1:, base:, base:] * keep[:, :, None] * keep[:, None, :]
        sum_own = total[base:, 1:].T * keep
        own_y = of_y[base:, 1:].T * keep - sum_own * y_mean
        meets = np.empty((levels - 1, 2, base + 1))  # the intercept, then the shared regressors, centred
        meets[:, :, 0] = sum_own
        meets[:, :, 1:] = (whole[1:, base:, :base] * keep[:, :, None] - sum_own[:, :, None] * mean) / scale
        meets[:, :, 1:][:, :, flat] = 0.0
        shared = np.zeros((base + 1, base + 1))
        shared[0, 0], shared[1:, 1:] = n, gram

        out = pd.DataFrame(
            {
                "validation_year": pdf["validation_year"].astype("int32"),
                "primary_genre": pdf["primary_genre"],
                "train_samples": np.rint(blocks[:, 0, 0]).astype("int64"),
                **{f: fill[i] for i, f in enumerate(fill_names)},
            }
        )
        for model, alpha in alphas.items():
            penalty = alpha * np.eye(base + 1)
            penalty[0, 0] = 0.0
            if alpha > 0:
                inverse = np.linalg.inv(own + alpha * np.eye(2))
            else:  # the shortest solution where a category's columns are dependent
                inverse = np.linalg.pinv(own, rcond=1e-11, hermitian=True)
            back = inverse @ meets
            left = shared + penalty - np.einsum("gij,gik->jk", meets, back)
            right = np.append(0.0, shared_y) - np.einsum("gij,gi->j", back, own_y)
            if alpha > 0:
                beta = np.linalg.solve(left, right)
            else:
                beta = np.linalg.pinv(left, rcond=1e-11, hermitian=True) @ right
            gamma = np.einsum("gij,gj->gi", inverse, own_y) - back @ beta
            slope = beta[1:] / scale
            start = y_mean + beta[0] - slope @ mean
            own_slope = np.vstack([np.zeros((1, 2)), gamma * keep])
            rows = [dict(zip(names, map(float, (start + a, *slope, b)))) for a, b in own_slope]
            out[model] = rows
        return out

    return solve


def linear_prediction(model: str, centre: Centre):
    """Uncalibrated prediction of a row with regressors, joined with its (fold, category) coefficients."""
    terms = [f"{model}.intercept"]
    for c, x, fill in (
        ("c_lb", "log_budget", "fill_lb"), ("c_lb2", "log_budget_sq", "fill_lb2"), ("c_rt", "runtime", "fill_rt"),
        ("c_rt2", "runtime_sq", "fill_rt2"), ("c_lbx", "log_budget", "0.0D"),
    ):
        terms.append(f"{model}.{c} * coalesce(x_{x}, {fill})")
    for c, x in (
        ("c_ms", "month_sin"), ("c_mc", "month_cos"), ("c_en", "is_english"), ("c_us", "is_us_production"),
        ("c_bo", "budget_observed"), ("c_ro", "runtime_observed"),
    ):
        terms.append(f"{model}.{c} * x_{x}")
    terms.append(f"{model}.c_year * (year - {int(centre.year)})")
    return F.expr(f"greatest(expm1({' + '.join(terms)}), 0.0D)")
