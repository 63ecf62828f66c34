"""Quality figures and content fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalens.functions.casting import day_column, number_column
from catalens.functions.text import strip
from catalens.operators.quantiles import exact_quantiles
from catalens.roles import MEASURES

# Columns a fingerprint covers.
FINGERPRINT_COLUMNS = (
    "id", "source_id", "title", "primary_genre", "budget", "revenue", "runtime", "release_date", "language", "country",
)


def date_range(df: DataFrame, column: str = "release_date") -> DataFrame:
    day = day_column(df, column)
    return df.agg(
        F.date_format(F.min(day), "yyyy-MM-dd").alias("start"),
        F.date_format(F.max(day), "yyyy-MM-dd").alias("end"),
        F.count(day).alias("valid_dates"),
    )


def _long(row: DataFrame, entries: list[tuple[str, str, Column]]) -> DataFrame:
    """Turn a one-row frame into (column, metric, value) rows."""
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.lit(m).alias("metric"), v.cast("string").alias("value"))
                    for c, m, v in entries
                ]
            )
        )
    )


def table_figures(cleaned: DataFrame) -> dict[str, Column]:
    """The report's counts and extremes of a cleaned table: aggregates of one pass, which a write can observe."""
    parts = {"rows": F.count("*")} | {f"null_{c}": F.count_if(F.col(c).isNull()) for c in cleaned.columns}
    for c in MEASURES:
        if c in cleaned.columns:
            parts |= {f"min_{c}": F.min(number_column(cleaned, c)), f"max_{c}": F.max(number_column(cleaned, c))}
    if "release_date" in cleaned.columns:
        day = day_column(cleaned, "release_date")
        parts |= {"first_day": F.min(day), "last_day": F.max(day)}
    return parts


def _known_row(cleaned: DataFrame, figures: dict[str, object]) -> DataFrame:
    """Figures at hand as a one-row frame of the types that the aggregates have."""
    kinds = cleaned.agg(*[c.alias(n) for n, c in table_figures(cleaned).items()]).schema
    return cleaned.sparkSession.range(1).select(*[F.lit(figures[f.name]).cast(f.dataType).alias(f.name) for f in kinds])


def quality_report(
    cleaned: DataFrame, source: DataFrame | None = None, cutoff: str | None = None, figures: dict[str, object] | None = None
) -> DataFrame:
    """Long table (column, metric, value as text): rows, nulls per column, distinct categories, date
    ranges of source and cleaned table, min/median/max of the measures.

    One wide aggregate per table, one pass for the medians. ``figures``: the values of ``table_figures`` where
    the write of the table observed them; the wide aggregate is then spared."""
    measures = [c for c in MEASURES if c in cleaned.columns]
    entries: list[tuple[str, str, Column]] = [("*", "clean_rows", F.col("rows"))]
    entries += [(c, "missing", F.col(f"null_{c}")) for c in cleaned.columns]
    entries += [(c, m, F.bround(F.col(f"{m}_{c}"), 2)) for c in measures for m in ("min", "max")]
    if "release_date" in cleaned.columns:
        entries += [("release_date", "cleaned_start", F.col("first_day")), ("release_date", "cleaned_end", F.col("last_day"))]
    counted = _known_row(cleaned, figures) if figures else cleaned.agg(*[c.alias(n) for n, c in table_figures(cleaned).items()])
    report = _long(counted, entries)
    if "primary_genre" in cleaned.columns:
        kinds = cleaned.select("primary_genre").distinct().agg(F.count("primary_genre").alias("n"))
        report = report.unionByName(_long(kinds, [("primary_genre", "distinct", F.col("n"))]))
    if measures:
        medians = exact_quantiles(cleaned.select(*measures), [], {c: number_column(cleaned, c) for c in measures})
        report = report.unionByName(
            medians.select(
                F.col("measure").alias("column"), F.lit("median").alias("metric"), F.bround("value", 2).cast("string").alias("value")
            )
        )
    if source is not None:
        entries = [("*", "source_rows", F.col("rows"))]
        parts = [F.count("*").alias("rows")]
        if "release_date" in source.columns:
            day = day_column(source, "release_date")
            parts += [F.min(day).alias("a"), F.max(day).alias("b"), F.count(day).alias("valid")]
            entries += [
                ("release_date", "source_start", F.col("a")), ("release_date", "source_end", F.col("b")),
                ("release_date", "source_valid", F.col("valid")),
            ]
        report = report.unionByName(_long(source.agg(*parts), entries))
    if cutoff is not None:
        report = report.unionByName(_long(cleaned.sparkSession.range(1), [("release_date", "cutoff", F.lit(cutoff))]))
    return report


def part_fingerprints(df: DataFrame, part: str) -> DataFrame:
    """(part, rows, fingerprint): what the rows of each part hold in all columns, whatever their order.

    A null cell differs from an empty one by its place in the hashed text of the row."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in sorted(df.columns) if c != part]
    return df.groupBy(F.col(part).cast("string").alias("part")).agg(
        F.count("*").alias("rows"), F.sum(F.xxhash64(*cells).cast("decimal(20,0)")).cast("string").alias("fingerprint")
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (row_count, columns, fingerprint): independent of row order and partitioning.

    Dates count as text, null numbers as -1, text trimmed with null as ''. Row hashes are added up as
    decimals, so the sum cannot overflow."""
    used = [c for c in FINGERPRINT_COLUMNS if c in df.columns]
    normal = []
    for c in used:
        kind = df.schema[c].dataType
        if c == "release_date":
            normal.append(F.coalesce(F.date_format(day_column(df, c), "yyyy-MM-dd"), F.lit("")))
        elif isinstance(kind, T.NumericType):
            normal.append(F.coalesce(number_column(df, c), F.lit(-1.0)))
        else:
            normal.append(F.coalesce(strip(F.col(c).cast("string")), F.lit("")))
    total = F.sum(F.xxhash64(*normal).cast("decimal(20,0)")) if used else F.lit(0)
    return df.agg(
        F.count("*").alias("row_count"),
        F.lit(",".join(used)).alias("columns"),
        F.coalesce(total.cast("string"), F.lit("0")).alias("fingerprint"),
    )
