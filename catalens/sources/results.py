"""Saved forecast results in versions, and their reuse when data and parameters are unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.operators.quality import fingerprint
from catalens.sources.tables import exists
from catalens.sources.versions import find_version, read_version, write_version

_PARTS = ("overview", "summary_by_genre", "predictions")


def content_key(df: DataFrame) -> dict[str, str]:
    row = fingerprint(df).first()
    return {"row_count": str(row.row_count), "fingerprint": row.fingerprint}


def run_key(df: DataFrame, parameters: dict[str, object], content: dict[str, str] | None = None) -> dict[str, str]:
    """Content fingerprint of the input and the parameters, as text: what a saved result stands for. ``content``: the
    ``content_key`` of the input, where it is at hand."""
    return {**(content or content_key(df)), **{f"param_{k}": str(v) for k, v in sorted(parameters.items())}}


def write_forecast(result, folder: str, validation_year: int, key: dict[str, str] | None = None) -> dict[str, str]:
    """Write overview (with the key), summary and predictions as a new version of their year; paths by table."""
    root = f"{folder}/validation_year={validation_year}"
    overview = result.overview.withColumns({k: F.lit(v) for k, v in (key or {}).items()})
    tables = dict(zip(_PARTS, (overview, result.summary_by_genre, result.predictions)))
    made = write_version(overview.sparkSession, root, tables, key)
    return {p: f"{root}/version={made.name}/{p}" for p in _PARTS}


def read_forecast(spark: SparkSession, folder: str, validation_year: int, key: dict[str, str] | None = None):
    """The three tables of the latest version (of those saved with ``key``, if given), or a result that holds an error."""
    from catalens.plans.forecasting import Forecast

    root = f"{folder}/validation_year={validation_year}"
    found = find_version(spark, root, key)
    if found is None:
        return Forecast(error=f"not saved or missing: validation year {validation_year}")
    saved = read_version(spark, root, found)
    return Forecast(*[saved[p] for p in _PARTS], years=[validation_year])


def matches(overview: DataFrame, key: dict[str, str]) -> bool:
    if any(k not in overview.columns for k in key):
        return False
    row = overview.first()
    return row is not None and all(str(row[k]) == v for k, v in key.items())


def write_frames(frames: dict[str, DataFrame], folder: str, key: dict[str, str]) -> None:
    """Persist result tables with the key they belong to."""
    for name, frame in frames.items():
        frame.withColumns({k: F.lit(v) for k, v in key.items()}).write.mode("overwrite").parquet(f"{folder}/{name}")


def read_frames(spark: SparkSession, names: list[str], folder: str, key: dict[str, str]) -> dict[str, DataFrame] | None:
    """The saved tables when every one exists and carries exactly this key, else None."""
    frames = {}
    for name in names:
        if not exists(spark, f"{folder}/{name}/_SUCCESS"):
            return None
        frame = spark.read.parquet(f"{folder}/{name}")
        if not matches(frame, key):
            return None
        frames[name] = frame.drop(*key)
    return frames
