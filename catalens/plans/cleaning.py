"""Cleaning pipelines: raw tables to the cleaned catalog, and re-cleaning of a cleaned one.

The order of the steps is part of the result: measures are imputed before duplicates are removed, text
gaps are filled after it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalens.functions.casting import (
    day_column, identifier_column, number_column, require_cleaned, restore_types,
)
from catalens.functions.text import first_token, pipe_joined, strip, trimmed
from catalens.operators import dedup, imputation, quality
from catalens.operators.sequence import reindex_ids
from catalens.roles import CLEANED_COLUMNS, DEFAULT_CUTOFF, OBSERVED, TEXT_DEFAULTS, TEXTS
from catalens.sources import tables
from catalens.staging import observed_write, spread, stage_counted

# Sources a text column is completed from.
COALESCED = {
    "title": ("title", "original_title"), "language": ("language", "original_language"),
    "country": ("country", "production_countries"), "keyword": ("keyword", "keywords"),
}


@dataclass
class Cleaned:
    """The cleaned table, its (metric, value) table and, from ``prepare_catalog``, the quality report.

    The table is made when it is first asked for: the metrics need neither new titles nor numbers.
    """

    make_table: Callable[[], DataFrame]
    metrics: DataFrame
    report: DataFrame | None = None

    @cached_property
    def table(self) -> DataFrame:
        return self.make_table()


def coalesce_sources(df: DataFrame) -> DataFrame:
    added = {}
    for target, sources in COALESCED.items():
        present = [F.col(s).cast("string") for s in sources if s in df.columns]
        added[target] = F.coalesce(*present) if present else F.lit(None).cast("string")
    return df.withColumns(added)


def prepare_texts(df: DataFrame) -> DataFrame:
    """Complete text columns from their sources, first category, pipe-joined lists, trim."""
    rows = coalesce_sources(df)
    category = next((c for c in ("primary_genre", "genres") if c in rows.columns), None)
    if category:
        rows = rows.withColumn("primary_genre", first_token(F.col(category)))
    rows = rows.withColumns({c: pipe_joined(F.col(c)) for c in ("country", "keyword", "language")})
    return normalise_texts(rows)


def normalise_texts(df: DataFrame) -> DataFrame:
    return df.withColumns({c: trimmed(F.col(c).cast("string")) for c in TEXTS if c in df.columns})


def title_identity(df: DataFrame) -> DataFrame:
    """Original title and language default to title and language."""
    added = {}
    for target, source in (("original_title", "title"), ("original_language", "language")):
        own = strip(F.col(target)) if target in df.columns else F.lit(None).cast("string")
        other = strip(F.col(source)) if source in df.columns else F.lit(None).cast("string")
        added[target] = F.coalesce(own, other)
    return df.withColumns(added)


def fill_texts(df: DataFrame) -> DataFrame:
    """Default for null or blank text cells; a missing column is added with the default."""
    filled = {}
    for c, default in TEXT_DEFAULTS.items():
        filled[c] = F.coalesce(trimmed(F.col(c)), F.lit(default)) if c in df.columns else F.lit(default)
    return df.withColumns(filled)


def _text_gaps(df: DataFrame):
    gaps = F.lit(0).cast("bigint")
    for c in TEXT_DEFAULTS:
        gaps = gaps + (F.count_if(trimmed(F.col(c)).isNull()) if c in df.columns else F.count("*"))
    return gaps


def _removal_reason(df: DataFrame, cutoff: str):
    """Why a row goes: checked in order, so each row counts once. The date comparison is by day."""
    title = F.col("title").isNull() if "title" in df.columns else F.lit(True)
    return (
        F.when(title, "missing_title")
        .when(F.col("release_date").isNull(), "invalid_date")
        .when(F.col("release_date") > F.lit(cutoff).cast("date"), "after_cutoff")
    )


def _long(row: DataFrame, names: list[str]) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("bigint").alias("value")) for n in names]
    return row.select(F.inline(F.array(*pairs)))


REMOVED = {
    "rows_removed_missing_title": "missing_title", "rows_removed_invalid_release_date": "invalid_date",
    "rows_removed_after_dataset_cutoff": "after_cutoff",
}


def loaded_figures() -> dict[str, Column]:
    """Counts of tagged rows by the reason they go."""
    figures = {"rows_loaded": F.count("*"), "kept": F.count_if(F.col("_gone").isNull())}
    return figures | {name: F.count_if(F.col("_gone") == reason) for name, reason in REMOVED.items()}


def tag_rows(parsed: DataFrame, cutoff: str, preserve_flags: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows, each by itself: day, why it goes (``_gone``), observed flags, invalid measures as null."""
    if "release_date" not in parsed.columns:
        raise KeyError("a 'release_date' column is needed")
    tagged = parsed.withColumn("release_date", day_column(parsed, "release_date"))
    tagged = tagged.withColumn("_gone", _removal_reason(tagged, cutoff))
    tagged = imputation.invalid_to_null(imputation.observed_flags(tagged, preserve_flags))
    kept_columns = [c for c in CLEANED_COLUMNS if c in tagged.columns and c != "year"]
    return tagged.select(*carried, *kept_columns, "_gone")


def _pipeline(parsed: DataFrame, cutoff: str, preserve_flags: bool, keep_source: bool, unicode: bool) -> Cleaned:
    # parsing happens once; later passes read columns, and the counts come with the write
    tagged, loaded = stage_counted(tag_rows(parsed, cutoff, preserve_flags), loaded_figures())
    return clean_tagged(tagged, loaded, keep_source, unicode)


def clean_tagged(tagged: DataFrame, loaded: dict[str, int], keep_source: bool = False, unicode: bool = True) -> Cleaned:
    """What depends on all rows: imputation, duplicates, titles, numbers. ``loaded``: ``loaded_figures`` of the rows."""
    dated = tagged.filter(F.col("_gone").isNull()).drop("_gone").withColumn("year", F.year("release_date"))
    measured = imputation.impute_measures(dated)
    ranked = dedup.rank_rows(dedup.with_signature(measured, unicode))  # one ranking for all that follows
    id_rows = dated.select("id").distinct().count() if "id" in dated.columns else loaded["kept"]
    unique = dedup.deduplicate_ranked(ranked, unique_ids=id_rows == loaded["kept"])
    signed, final = stage_counted(unique, {"rows": F.count("*"), "gaps": _text_gaps(unique)})

    def numbered() -> DataFrame:
        named = dedup.disambiguate_titles(signed).drop(dedup.RANK, *dedup.SIGNATURE)
        filled = fill_texts(named)
        if keep_source and "source_id" in filled.columns:
            filled = filled.withColumn("source_id", F.coalesce(F.col("source_id"), F.col("id"))) if "id" in filled.columns else filled
        else:
            filled = filled.withColumn("source_id", F.col("id") if "id" in filled.columns else F.lit(None).cast("bigint"))
        output = filled.select(*[c for c in CLEANED_COLUMNS if c in filled.columns])
        order = [F.col("release_date"), F.col("title"), F.col("source_id"), dedup.row_hash(output)]
        return reindex_ids(output, order)

    counts = dedup.collision_groups(signed).agg(F.count("*").alias("title_collisions_disambiguated"))
    known = {**loaded, "id_rows": id_rows, "rows_after_cleaning": final["rows"], "text_fields_filled": final["gaps"]}
    counted = counts.withColumns({n: F.lit(v) for n, v in known.items()}).withColumns(
        {
            "source_duplicates_removed": F.col("kept") - F.col("id_rows"),
            "title_duplicates_removed": F.col("id_rows") - F.col("rows_after_cleaning"),
            "duplicates_removed": F.col("kept") - F.col("rows_after_cleaning"),
        }
    )
    metrics = _long(
        counted,
        [
            "rows_loaded", "rows_after_cleaning", "rows_removed_missing_title", "duplicates_removed", "source_duplicates_removed",
            "title_duplicates_removed", "title_collisions_disambiguated", "text_fields_filled",
            "rows_removed_invalid_release_date", "rows_removed_after_dataset_cutoff",
        ],
    )
    return Cleaned(numbered, metrics)


def clean_catalog(df: DataFrame, cutoff: str = DEFAULT_CUTOFF, unicode: bool = True) -> Cleaned:
    """Clean a raw or partly cleaned table."""
    return _pipeline(parse_raw(spread(df, len(df.inputFiles()))), cutoff, preserve_flags=False, keep_source=False, unicode=unicode)


def parse_raw(df: DataFrame) -> DataFrame:
    """Lists, texts and ids of raw rows, each row by itself."""
    parsed = title_identity(prepare_texts(df))
    if "id" in parsed.columns:
        parsed = parsed.withColumn("id", identifier_column(parsed))
    return parsed.drop("source_id")


def reclean_catalog(df: DataFrame, cutoff: str = DEFAULT_CUTOFF, unicode: bool = True) -> Cleaned:
    """Re-validate a cleaned table: no list parsing, observed flags and source ids kept. Repeating it
    changes nothing."""
    rows = spread(df, len(df.inputFiles()))
    for c in ("id", "source_id"):
        if c in rows.columns:
            rows = rows.withColumn(c, identifier_column(rows, c))
    return _pipeline(title_identity(normalise_texts(rows)), cutoff, preserve_flags=True, keep_source=True, unicode=unicode)


def merge_raw(raw: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Metadata with keywords and credits (one row per id each) joined on, and (metric, value) counts.

    Rows without a numeric id are dropped from every table. The side tables are reduced to one row per
    id before the join, so a repeated id cannot multiply or pile up rows."""
    if "movies_metadata" not in raw:
        raise FileNotFoundError("the movies_metadata table is required")
    movies = raw["movies_metadata"]
    merged = movies.withColumn("id", identifier_column(movies)).filter("id is not null")
    for name, columns in (("keywords", ("keywords",)), ("credits", ("cast", "crew"))):
        if name in raw:
            merged = merged.join(first_rows(raw[name].select("id", *columns)), "id", "left")
    counts = movies.agg(
        F.count("*").alias("raw_movies_rows"), F.count_if(identifier_column(movies).isNull()).alias("invalid_movie_id_rows_removed")
    )
    metrics = _long(counts, counts.columns)
    for name, label in (("keywords", "raw_keywords_rows"), ("credits", "raw_credits_rows"), ("ratings_small", "ratings_small_rows")):
        if name in raw:
            metrics = metrics.unionByName(_long(raw[name].agg(F.count("*").alias(label)), [label]))
    return merged, metrics


def first_rows(side: DataFrame) -> DataFrame:
    """One row per numeric id; of several, the one with the lowest content hash."""
    ided = side.withColumn("id", identifier_column(side)).filter("id is not null")
    return dedup.first_per_key(ided, ["id"], [dedup.row_hash(ided)])


def backfill_observed(df: DataFrame, raw_movies: DataFrame | None = None) -> DataFrame:
    """Complete observed flags from raw values by ``source_id``, then from the value itself."""
    flags = list(OBSERVED.items())
    rows = df
    incomplete = any(f not in df.columns for _, f in flags)
    if incomplete and raw_movies is not None and "source_id" in df.columns:
        raw = raw_movies.select(
            identifier_column(raw_movies).alias("source_id"),
            *[F.coalesce(number_column(raw_movies, m) > 0, F.lit(False)).alias(f"_{f}") for m, f in flags],
        ).filter("source_id is not null")
        rows = df.join(dedup.first_per_key(raw, ["source_id"], [dedup.row_hash(raw)]), "source_id", "left")
    completed = {}
    for measure, flag in flags:
        known = [F.col(flag)] if flag in df.columns else []
        if f"_{flag}" in rows.columns:
            known.append(F.col(f"_{flag}"))
        own = number_column(df, measure) > 0 if measure in df.columns else F.lit(False)
        completed[flag] = F.coalesce(*known, own, F.lit(False))
    return rows.withColumns(completed).drop(*[f"_{f}" for _, f in flags])


def prepare_catalog(
    spark: SparkSession, path: str | None = None, raw_folder: str | None = None, export_path: str | None = None,
    cutoff: str = DEFAULT_CUTOFF, export_format: str = "csv", unicode: bool = True,
) -> Cleaned:
    """Load, clean, report and optionally export.

    With ``path`` a cleaned table is re-cleaned (flags completed from ``raw_folder`` where they are
    missing); without it the raw tables of ``raw_folder`` are merged and cleaned."""
    raw = tables.read_raw_tables(spark, raw_folder) if raw_folder else {}
    if path is not None:
        typed = restore_types(tables.read_table(spark, path))
        source = require_cleaned(backfill_observed(typed, raw.get("movies_metadata")))
        result = reclean_catalog(source, cutoff, unicode)
        merge = None
    else:
        source, merge = merge_raw(raw)
        result = clean_catalog(source, cutoff, unicode)
    if merge is not None:
        result.metrics = result.metrics.unionByName(merge)
    if not export_path:
        result.report = quality.quality_report(result.table, source, cutoff)
        return result
    # the report's counts come with the export, its medians from the columns that it wrote
    made, figures = result.table, quality.table_figures(result.table)
    if export_format == "parquet":
        got = observed_write(made, figures, lambda rows: tables.write_cleaned(rows, export_path))
        result.make_table = lambda: spark.read.schema(made.schema).parquet(export_path)
    else:
        staged, got = stage_counted(made, figures)
        tables.write_cleaned(staged, export_path, export_format)
        result.make_table = lambda: staged
    del result.table  # the cached one; the next look reads what was written
    result.report = quality.quality_report(result.table, source, cutoff, got)
    return result


def cleaned_schema() -> T.StructType:
    """The fixed schema of a cleaned table."""
    kinds = {"id": T.LongType(), "source_id": T.LongType(), "year": T.IntegerType(), "release_date": T.DateType()}
    kinds |= {c: T.BooleanType() for c in OBSERVED.values()} | {c: T.DoubleType() for c in imputation.MEASURES}
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in CLEANED_COLUMNS])
