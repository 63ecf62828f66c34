"""Cuts that split the order of ids into ranges of about equal size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_IDS = 10_000  # ids that cuts of an order without quantiles are taken from


def id_cuts(df: DataFrame, column: str, shares: list[float], error: float) -> list:
    """Ascending distinct values of ``column`` near the given shares of its order; nulls are left out.

    Numbers: approximate quantiles, as whole numbers. Other types that Spark can order (text, dates): from the
    ``SAMPLE_IDS`` distinct values of least hash, so a value that repeats counts once. Cuts only balance ranges; any
    cuts give the same result.
    """
    known = df.select(F.col(column).alias("_cut")).filter("_cut is not null")
    if not shares:
        return []
    if isinstance(known.schema["_cut"].dataType, T.NumericType):
        return sorted({int(c) for c in known.approxQuantile("_cut", shares, error)})
    sample = known.distinct().orderBy(F.xxhash64("_cut"), "_cut").limit(SAMPLE_IDS)
    values = [r["_cut"] for r in sample.orderBy("_cut").collect()]
    return list(dict.fromkeys(values[min(int(s * len(values)), len(values) - 1)] for s in shares)) if values else []
