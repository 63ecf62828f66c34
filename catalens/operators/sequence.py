"""Global row order without a single-task window: numbering and chronological splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalens.staging import stage

_ROW_BITS = 33  # fixed value: monotonically_increasing_id keeps the row's place in its partition here


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Add 1..n in ``order``: range-partitioned sort, per-partition counts, offsets.

    The sorted table is staged because partition numbers are only meaningful for one evaluation. The
    offsets are one row per partition, staged as well: their size is known, so no row travels to meet them. Give ``order`` a unique tail: it fixes ties, and lets the range
    partitioning split a heavily repeated leading value.
    """
    marked = _marked(df, order)
    counts = marked.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stage(counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    place = F.col("_mark").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        marked.join(offsets, "_part")
        .withColumn(name, F.col("_before") + place + 1)
        .drop("_mark", "_part", "_before")
    )


def _marked(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` range-partitioned and sorted, staged, with ``_part`` and the row's ``_mark``, ascending in the order."""
    sorted_rows = stage(df.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id()))
    return sorted_rows.withColumn("_part", F.shiftright("_mark", _ROW_BITS))


def number_within(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "place", position: str = "_position") -> DataFrame:
    """Number the rows of each group 1, 2, ... in ``order``; null group columns form groups as well.

    Rows are numbered over all groups (kept as ``position``) and each group's first number is taken off, so a group
    is never gathered: its first number is a partial aggregate, and rows meet it in an equi-join.
    """
    numbered = number_rows(df, [*[F.col(g) for g in groups], *order], position)
    first = numbered.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]).agg(F.min(position).alias("_first"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)])
    placed = numbered.join(first, same).withColumn(name, F.col(position) - F.col("_first") + 1)
    return placed.drop("_first", *[f"_g{i}" for i in range(len(groups))])


def running_count(df: DataFrame, flag: Column, order: Sequence[Column], name: str, by: Sequence[str] = ()) -> DataFrame:
    """How many rows up to and including each one, in ``order``, have ``flag``; per value of ``by`` if given.

    A prefix sum in parts: range-partitioned sort, the flags of each part, offsets over one row per part, and a
    running sum inside the part. No window holds the whole table or a whole value of ``by``.
    """
    flagged = df.withColumn("_flag", F.coalesce(flag, F.lit(False)).cast("long"))
    marked = _marked(flagged, [*[F.col(c) for c in by], *order])
    per_part = marked.groupBy("_part").agg(F.sum("_flag").alias("_flags"))
    before = F.sum("_flags").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stage(per_part.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    inside = F.sum("_flag").over(Window.partitionBy("_part").orderBy("_mark").rowsBetween(Window.unboundedPreceding, 0))
    counted = marked.withColumn(name, inside).join(offsets, "_part").withColumn(name, F.col(name) + F.col("_before"))
    if by:
        keys = [F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]
        first = counted.groupBy(*keys).agg(F.min(F.col(name) - F.col("_flag")).alias("_first"))
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)])
        counted = counted.join(first, same).withColumn(name, F.col(name) - F.col("_first"))
    return counted.select(*df.columns, name)


def reindex_ids(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Replace ``id`` by 1..n in ``order``. Where there is no ``source_id`` the old id is kept under it."""
    if "id" not in df.columns:
        return df
    columns = df.columns
    if "source_id" not in columns:
        df = df.withColumn("source_id", F.col("id"))
        columns = [columns[0], "source_id", *columns[1:]] if columns[0] == "id" else [*columns, "source_id"]
    numbered = number_rows(df, order, "_number")
    return numbered.withColumn("id", F.col("_number")).select(*columns)


def latest_rows_flag(
    df: DataFrame, take: int, tie: Sequence[Column], day: str = "release_date", name: str = "is_latest"
) -> DataFrame:
    """Flag the last ``take`` rows in (day, tie) order.

    Only day counts are needed to find the day the boundary falls into; just the rows of that one day
    are put in order. Days number in the ten thousands at most, so their running total is a small window.
    """
    days = df.groupBy(day).agg(F.count("*").alias("n"))
    newer = F.coalesce(F.sum("n").over(Window.orderBy(F.desc(day)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = (
        days.withColumn("newer", newer)
        .filter((F.col("newer") < take) & (F.col("newer") + F.col("n") >= take))
        .first()
    )
    if found is None:  # fewer rows than asked for
        return df.withColumn(name, F.lit(True))
    edge, wanted = found[day], take - found["newer"]
    inside = number_rows(df.filter(F.col(day) == F.lit(edge)), tie, "_place")
    first_kept = found["n"] - wanted
    inside = inside.withColumn(name, F.col("_place") > first_kept).drop("_place")
    outside = df.filter(F.col(day) != F.lit(edge)).withColumn(name, F.col(day) > F.lit(edge))
    return outside.unionByName(inside)
