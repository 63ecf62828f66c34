"""Numeric cleaning: observed flags, invalid values to null, category-then-global median fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.functions.casting import number_column
from catalens.functions.scalars import clipped
from catalens.operators.quantiles import exact_medians
from catalens.roles import MEASURES, OBSERVED
from catalens.staging import stage

# Measures that must be positive, that must not be negative, that are filled per category.
POSITIVE = ("budget", "revenue", "runtime")
NON_NEGATIVE = ("vote_count", "popularity")
BY_CATEGORY = ("budget", "revenue", "runtime", "popularity")
FALLBACK = 0.0


def valid_measure(name: str, c: Column) -> Column:
    if name in POSITIVE:
        return F.when(c > 0, c)
    if name in NON_NEGATIVE:
        return F.when(c >= 0, c)
    return c


def observed_flags(df: DataFrame, preserve: bool = False) -> DataFrame:
    """Add ``<measure>_observed`` (value > 0); ``preserve`` keeps flags that are there."""
    added = {}
    for measure, flag in OBSERVED.items():
        if measure not in df.columns or (preserve and flag in df.columns):
            continue
        added[flag] = F.coalesce(number_column(df, measure) > 0, F.lit(False))
    return df.withColumns(added) if added else df


def invalid_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: valid_measure(c, number_column(df, c)) for c in MEASURES if c in df.columns})


def _with_gaps(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of the columns that hold a null."""
    if not columns:
        return []
    found = df.agg(*[F.coalesce(F.max(F.col(c).isNull()), F.lit(False)).alias(c) for c in columns]).first()
    return [c for c in columns if found[c]]


def impute_medians(df: DataFrame, columns: tuple[str, ...] = MEASURES) -> DataFrame:
    """Fill nulls with the category median, then with the median of the column as filled so far, then 0.

    ``df`` is read several times: pass a staged table. Medians are worked out only of columns that have a null to
    fill, the global ones only where the category medians left some. The global medians are looked up as one-row
    scalar subqueries, the category medians by a join whose side Spark sizes itself.
    """
    present = [c for c in columns if c in df.columns]
    gaps = _with_gaps(df, present)
    grouped = [c for c in gaps if c in BY_CATEGORY and "primary_genre" in df.columns]
    filled = df.withColumns({c: F.col(c).cast("double") for c in present})
    if grouped:
        narrow = df.select("primary_genre", *grouped).filter(F.col("primary_genre").isNotNull())
        medians = exact_medians(narrow, ["primary_genre"], {c: c for c in grouped})
        medians = stage(medians.select("primary_genre", F.struct(*grouped).alias("_category_median")))
        filled = (
            filled.join(medians, "primary_genre", "left")
            .withColumns({c: F.coalesce(F.col(c), F.col("_category_median")[c]) for c in grouped})
            .select(*df.columns)
        )
        left = _with_gaps(filled, grouped)
        gaps = [c for c in gaps if c in left or c not in grouped]
    if not gaps:
        return filled
    overall = exact_medians(filled.select(*gaps), [], {c: c for c in gaps})
    fill = overall.select(F.struct(*gaps)).scalar()
    return filled.withColumns({c: F.coalesce(F.col(c), fill.getField(c), F.lit(FALLBACK)) for c in gaps})


def impute_measures(df: DataFrame) -> DataFrame:
    """Imputation of all measures present, then the rating bounded to [0, 10]."""
    imputed = impute_medians(df)
    if "vote_average" in imputed.columns:
        imputed = imputed.withColumn("vote_average", clipped(F.col("vote_average"), 0, 10))
    return imputed


def clean_measures(df: DataFrame, preserve_flags: bool = False) -> DataFrame:
    """Flags from the raw values, invalid to null, imputation."""
    return impute_measures(stage(invalid_to_null(observed_flags(df, preserve_flags))))
