"""Result tables in versions: a reader sees all tables of one run or none of them.

A version is a folder of its own, ``version=<number>-<random>``, whose files never change. Its manifest is
written last, so a run that breaks off leaves a folder that no reader takes for a version.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.sources.tables import delete, exists

_PREFIX = "version="
_SCHEMA = "version string, number long, written_at timestamp, tables array<string>, key string"


@dataclass(frozen=True)
class Version:
    name: str
    number: int
    tables: tuple[str, ...]
    key: dict[str, str]


def folders(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names of what lies in ``folder`` and starts with ``prefix``, without it, in order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}*")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().getName().removeprefix(prefix) for f in found or [])


def _number(name: str) -> int:
    return int(name.split("-")[0])


def write_version(spark: SparkSession, folder: str, tables: dict[str, DataFrame], key: dict[str, str] | None = None) -> Version:
    """Write the tables as a new version; ``key`` says what they stand for.

    Two runs that write at the same time get folders of their own; the number is the same then, and the
    name decides which one counts as the latest.
    """
    number = max((_number(n) for n in folders(spark, folder, _PREFIX)), default=0) + 1
    made = Version(f"{number:08d}-{uuid.uuid4().hex[:12]}", number, tuple(tables), dict(key or {}))
    root = f"{folder}/{_PREFIX}{made.name}"
    for name, table in tables.items():
        table.write.parquet(f"{root}/{name}")
    row = [(made.name, number, list(tables), json.dumps(made.key, sort_keys=True))]
    manifest = spark.createDataFrame(row, "version string, number long, tables array<string>, key string")
    manifest.withColumn("written_at", F.current_timestamp()).coalesce(1).write.json(f"{root}/manifest")
    return made


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """Complete versions, one row each: (version, number, written_at, tables, key as JSON)."""
    done = [n for n in folders(spark, folder, _PREFIX) if exists(spark, f"{folder}/{_PREFIX}{n}/manifest/_SUCCESS")]
    if not done:
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).json([f"{folder}/{_PREFIX}{n}/manifest" for n in done])


def find_version(spark: SparkSession, folder: str, key: dict[str, str] | None = None) -> Version | None:
    """The latest complete version, of those that carry ``key`` if one is given."""
    rows = versions(spark, folder)
    if key is not None:
        rows = rows.filter(F.col("key") == json.dumps(key, sort_keys=True))
    row = rows.orderBy(F.desc("number"), F.desc("version")).first()
    return None if row is None else Version(row.version, row.number, tuple(row.tables), json.loads(row.key))


def read_version(spark: SparkSession, folder: str, version: Version) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{folder}/{_PREFIX}{version.name}/{t}") for t in version.tables}


def remove_versions(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Delete all but the latest ``keep`` complete versions, and what broken-off runs before them left; returns how many went.

    The manifest goes first: a version half deleted is none. A reader of a version that goes must be done with it.
    Folders younger than the oldest version kept are left, as their runs may still be writing.
    """
    kept = {r.version for r in versions(spark, folder).orderBy(F.desc("number"), F.desc("version")).limit(keep).collect()}
    oldest = min((_number(n) for n in kept), default=None)
    gone = [n for n in folders(spark, folder, _PREFIX) if n not in kept and oldest is not None and _number(n) <= oldest]
    for n in gone:
        delete(spark, f"{folder}/{_PREFIX}{n}/manifest")
        delete(spark, f"{folder}/{_PREFIX}{n}")
    return len(gone)
