"""Lenient coercions: whatever does not parse becomes null, never an error and never NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalens.functions.text import trimmed
from catalens.roles import MEASURES, OBSERVED, REQUIRED_CLEANED_COLUMNS, TEXTS, require


_DAY = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def to_number(c: Column) -> Column:
    """Double, null for unparseable text and for NaN."""
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_day(c: Column) -> Column:
    """Date from text that is ``yyyy-MM-dd`` as a whole, or that with a full time of day after it; from a date or a timestamp."""
    text = F.trim(c.cast("string"))
    strict = F.when(text.rlike(_DAY), F.substring(text, 1, 10))
    return F.try_to_timestamp(strict, F.lit("yyyy-MM-dd")).cast("date")


def day_column(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return to_day(F.col(name))


def number_column(df: DataFrame, name: str) -> Column:
    """``to_number`` without the needless cast for integral columns."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("double")
    return to_number(F.col(name))


def identifier_column(df: DataFrame, name: str = "id") -> Column:
    """Nullable long. Integral input is passed through so that a partitioning by it stays usable."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.LongType):
        return F.col(name)
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    # whole numbers go straight to bigint; a double in between would round ids beyond 2^53
    return F.coalesce(F.col(name).cast("string").try_cast("bigint"), to_number(F.col(name)).try_cast("bigint"))


def year_column(df: DataFrame) -> Column:
    """The ``year`` column if there is one, else the year of ``release_date``."""
    if "year" in df.columns:
        if isinstance(df.schema["year"].dataType, T.IntegralType):
            return F.col("year").cast("int")
        return to_number(F.col("year")).try_cast("int")
    if "release_date" not in df.columns:
        raise KeyError("a 'year' or a 'release_date' column is needed")
    return F.year(day_column(df, "release_date"))


def flag_text(c: Column) -> Column:
    """true/1/yes and false/0/no in any case to boolean, anything else to null."""
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text.isin("true", "1", "yes"), True).when(text.isin("false", "0", "no"), False)


def observed_flag(df: DataFrame, name: str, fallback: Column) -> Column:
    """Coerce an observed-flag column; gaps take ``fallback``.

    Text flags are read by word; only when not a single value of the column is such a word are they
    read as numbers (non-zero is true), which a scalar subquery decides inside the plan.
    """
    if name not in df.columns:
        return fallback
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return F.coalesce(F.col(name), fallback)
    worded = flag_text(F.col(name))
    any_word = df.agg(F.coalesce(F.max(worded.isNotNull()), F.lit(False)).alias("any")).scalar()
    numeric = to_number(F.col(name)) != 0
    return F.coalesce(F.when(any_word, worded).otherwise(numeric), fallback)


def restore_types(df: DataFrame) -> DataFrame:
    """Re-type an exported cleaned table read back as text: one projection."""
    casts = {}
    for c in df.columns:
        if c in ("id", "source_id"):
            casts[c] = identifier_column(df, c)
        elif c == "year":
            casts[c] = to_number(F.col(c)).try_cast("int")
        elif c in MEASURES:
            casts[c] = to_number(F.col(c))
        elif c in OBSERVED.values():
            casts[c] = F.col(c) if isinstance(df.schema[c].dataType, T.BooleanType) else flag_text(F.col(c))
        elif c == "release_date":
            casts[c] = day_column(df, c)
        elif c in TEXTS:
            casts[c] = trimmed(F.col(c))
    return df.withColumns(casts)


def require_cleaned(df: DataFrame) -> DataFrame:
    require(df, *REQUIRED_CLEANED_COLUMNS)
    return df
