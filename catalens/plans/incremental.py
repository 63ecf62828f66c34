"""Cleaning of a source that grows: only parts whose content changed are parsed again.

What a row gives by itself (lists, texts, days, flags, why it goes) is kept as Parquet per part of the
source: a delivery, a month, a file. Fingerprints tell which parts are new, changed or gone. Imputation,
duplicates, titles and numbers depend on all rows and are worked out over the whole parsed table each time,
so the result equals that of a full run.

The state is a table of versions (``sources.versions``): its rows say in which run's folder a part lies. A
run that breaks off leaves a folder that no state names; ``tidy`` removes it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.operators.quality import part_fingerprints
from catalens.plans.cleaning import Cleaned, clean_tagged, loaded_figures, parse_raw, tag_rows
from catalens.roles import DEFAULT_CUTOFF
from catalens.sources.tables import delete
from catalens.sources.versions import find_version, folders, read_version, remove_versions, write_version
from catalens.staging import spread, stage, stage_counted

MAX_RUNS = 20  # folders that parsed parts may be spread over before they are put together

_KEPT = "part string, rows long, fingerprint string, run string"


@dataclass
class Incremental:
    """The cleaned catalog, and what became of each part: (part, rows, state)."""

    cleaned: Cleaned
    parts: DataFrame


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def clean_changed(
    source: DataFrame, folder: str, part: str, cutoff: str = DEFAULT_CUTOFF, unicode: bool = True, max_runs: int = MAX_RUNS
) -> Incremental:
    """Clean ``source`` as ``clean_catalog`` does, parsing only the parts that differ from those kept in ``folder``.

    ``part`` names the column whose values make the parts; null is one of them. The column itself is no input
    of the cleaning. Another cutoff or another set of columns counts as a change of every part. State of a part: new, changed,
    same or removed. Every part is read to take its fingerprint. One run at a time may write to a folder.
    """
    spark = source.sparkSession
    columns = [c for c in source.columns if c != part]
    key = {"cutoff": cutoff, "columns": ",".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in sorted(columns))}
    found = find_version(spark, folder, key)
    kept = read_version(spark, folder, found)["parts"] if found else spark.createDataFrame([], _KEPT)
    old = kept.select(F.col("part").alias("_part"), F.col("rows").alias("_rows"), F.col("fingerprint").alias("_fingerprint"), "run", F.lit(True).alias("_known"))
    met = part_fingerprints(source, part).withColumn("_here", F.lit(True)).join(old, _same("part", "_part"), "full")
    unchanged = (F.col("rows") == F.col("_rows")) & (F.col("fingerprint") == F.col("_fingerprint"))
    state = F.when(F.col("_here").isNull(), "removed").when(F.col("_known").isNull(), "new").when(unchanged, "same").otherwise("changed")
    name = F.when(F.col("_here").isNull(), F.col("_part")).otherwise(F.col("part"))
    parts = stage(met.select(name.alias("part"), F.coalesce("rows", "_rows").alias("rows"), state.alias("state"), "fingerprint", "run"))

    current = parts.filter("state <> 'removed'")
    moving = F.col("state").isin("new", "changed")
    differ, fresh_rows = parts.agg(F.count_if(F.col("state") != "same"), F.coalesce(F.sum(F.when(moving, F.col("rows"))), F.lit(0))).first()
    if found is None or differ:
        run = f"r{uuid.uuid4().hex}"
        moved = parts.filter(moving).select(F.col("part").alias("_moved"))
        changed = source.withColumn("_part", F.col(part).cast("string")).drop(part).join(moved, _same("_part", "_moved"), "left_semi")
        changed = spread(changed, len(source.inputFiles()), fresh_rows)
        fresh = tag_rows(parse_raw(changed), cutoff, carried=("_part",))
        home = F.when(F.col("state") == "same", F.col("run")).otherwise(F.lit(run))
        if len(_runs(current)) >= max_runs:  # parsed rows are put together, not parsed again
            fresh = fresh.unionByName(_parsed(spark, folder, current.filter("state = 'same'")).drop("run"))
            home = F.lit(run)
        fresh.write.parquet(f"{folder}/parsed/run={run}")
        write_version(spark, folder, {"parts": current.select("part", "rows", "fingerprint", home.alias("run"))}, key)
        current = read_version(spark, folder, find_version(spark, folder, key))["parts"]
    rows, loaded = stage_counted(_parsed(spark, folder, current).drop("_part", "run"), loaded_figures())
    return Incremental(clean_tagged(rows, loaded, unicode=unicode), parts.select("part", "rows", "state"))


def tidy(spark: SparkSession, folder: str) -> int:
    """Remove all states but the latest and the parsed rows that it does not name; returns the folders removed."""
    removed = remove_versions(spark, folder, keep=1)
    latest = find_version(spark, folder)
    named = {r.run for r in read_version(spark, folder, latest)["parts"].select("run").distinct().collect()} if latest else set()
    for run in folders(spark, f"{folder}/parsed", "run="):
        if run not in named:
            delete(spark, f"{folder}/parsed/run={run}")
            removed += 1
    return removed


def _runs(parts: DataFrame) -> list[str]:
    """Run folders that hold parts; ``clean_changed`` keeps them few."""
    return [r.run for r in parts.filter("run is not null").select("run").distinct().collect()]


def _parsed(spark: SparkSession, folder: str, parts: DataFrame) -> DataFrame:
    """Parsed rows of the parts, each from the run that the state names; other runs are not looked at."""
    # the run of an empty state holds no part, but its columns
    names = _runs(parts) or folders(spark, f"{folder}/parsed", "run=")[-1:]
    rows = spark.read.option("basePath", f"{folder}/parsed").parquet(*[f"{folder}/parsed/run={n}" for n in names])
    named = parts.select(F.col("part").alias("_named"), F.col("run").alias("_run"))
    return rows.join(named, _same("_part", "_named") & (F.col("run") == F.col("_run")), "left_semi")
