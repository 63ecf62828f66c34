"""Preparation of the modelling table and choice of validation years."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalens.functions.casting import day_column, number_column, observed_flag
from catalens.functions.text import first_token, parse_list
from catalens.operators.dedup import deduplicate_model_rows
from catalens.roles import DEFAULT_CUTOFF, OBSERVED

# Columns the modelling table keeps, in order.
MODEL_COLUMNS = (
    "id", "source_id", "title", "primary_genre", "budget", "budget_observed", "revenue", "revenue_observed",
    "runtime", "runtime_observed", "release_date", "year", "month", "language", "country",
)


def prepare_modelling(df: DataFrame, cutoff: str = DEFAULT_CUTOFF, deduplicate: bool = True) -> DataFrame:
    """Modelling table: titled, one row per id, dated up to the cutoff, target not imputed.

    ``deduplicate=False`` skips the shuffle by id for input known to have unique ids.
    """
    if "release_date" not in df.columns:
        raise KeyError("a 'release_date' column is needed")

    def source(*names: str):
        found = next((n for n in names if n in df.columns), None)
        return F.col(found).cast("string") if found else F.lit(None).cast("string")

    rows = df
    if "title" in df.columns:
        rows = rows.filter(F.col("title").isNotNull())
    if deduplicate:
        # prune before the rows travel
        used = [c for c in (*MODEL_COLUMNS, "genres", "original_language", "production_countries") if c in df.columns]
        rows = deduplicate_model_rows(rows.select(*used))
    rows = rows.withColumns(
        {
            "primary_genre": first_token(source("primary_genre", "genres")),
            "language": F.array_join(parse_list(source("language", "original_language")), "|"),
            "country": F.array_join(parse_list(source("country", "production_countries")), "|"),
            "release_date": day_column(rows, "release_date"),
        }
    ).filter(F.col("release_date") <= F.lit(cutoff).cast("date"))
    rows = rows.withColumns({"year": F.year("release_date"), "month": F.month("release_date")})
    for measure, flag in OBSERVED.items():
        value = number_column(rows, measure) if measure in rows.columns else F.lit(None).cast("double")
        seen = observed_flag(rows, flag, F.coalesce(value > 0, F.lit(False)))
        rows = rows.withColumn(flag, seen).withColumn(measure, F.when((value > 0) & F.col(flag), value))
    return rows.select(*[c for c in MODEL_COLUMNS if c in rows.columns])


def eligible_rows(prepared: DataFrame, need_budget: bool = False) -> DataFrame:
    rows = prepared.filter(F.col("primary_genre").isNotNull() & F.col("revenue").isNotNull())
    return rows.filter(F.col("budget").isNotNull()) if need_budget else rows


def year_profile(prepared: DataFrame) -> DataFrame:
    """Per year: eligible rows, those with a budget, and sums that place the regressors' centre."""
    return eligible_rows(prepared).groupBy("year").agg(
        F.count("*").alias("rows"),
        F.count("budget").alias("budget_rows"),
        F.sum(F.log1p("budget")).alias("log_budget_sum"),
        F.sum("runtime").alias("runtime_sum"),
        F.count("runtime").alias("runtime_rows"),
    )


def candidate_years(
    profile: DataFrame,
    start_year: int | None = None,
    end_year: int | None = None,
    min_train_rows: int = 12,
    min_validation_rows: int = 3,
    max_years: int = 15,
) -> DataFrame:
    """Validation years with enough earlier and own rows (counted with a budget), latest ``max_years``
    of them (0 keeps all)."""
    earlier = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    years = profile.filter("budget_rows > 0").withColumn(
        "train_rows", F.coalesce(F.sum("budget_rows").over(earlier), F.lit(0))
    )
    if start_year is not None:
        years = years.filter(F.col("year") >= start_year)
    if end_year is not None:
        years = years.filter(F.col("year") <= end_year)
    years = years.filter((F.col("train_rows") >= min_train_rows) & (F.col("budget_rows") >= min_validation_rows))
    years = years.select(
        F.col("year").alias("validation_year"), "train_rows", F.col("budget_rows").alias("validation_rows")
    )
    return years.orderBy(F.desc("validation_year")).limit(max_years) if max_years else years


@dataclass(frozen=True)
class Centre:
    """Shift of the regressors that keeps the moment sums well conditioned. It does not affect results."""

    log_budget: float = 0.0
    runtime: float = 0.0
    year: int = 0

    @classmethod
    def of(cls, profile_rows: list) -> Centre:
        with_budget = sum(r.budget_rows for r in profile_rows)
        with_runtime = sum(r.runtime_rows for r in profile_rows)
        return cls(
            sum(r.log_budget_sum or 0.0 for r in profile_rows) / with_budget if with_budget else 0.0,
            sum(r.runtime_sum or 0.0 for r in profile_rows) / with_runtime if with_runtime else 0.0,
            min((r.year for r in profile_rows), default=0),
        )
