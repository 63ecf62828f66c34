"""Materialisation of intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession

ROWS_A_TASK = 20_000  # fixed value: so many rows are worth a task of their own


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; without one, a folder of the warehouse, which all executors share as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_catalens"


_written: list[str] = []


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Used where a table is read several times or must not be recomputed differently (numbering by
    partition). The columnar copy keeps column pruning for the later passes, cuts the lineage and
    survives the loss of executors.
    """
    path = f"{shared_folder(df.sparkSession)}/catalens-stage/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed_write(df: DataFrame, figures: dict[str, Column], write: Callable[[DataFrame], None]) -> dict[str, object] | None:
    """Aggregates of the rows that ``write`` writes, taken in the same pass; None where Spark reported none.

    The observation is the last step before the write, so it lies in the stage that writes: rows of a task that
    is tried again count once. Counts, sums, minima and maxima, but no distinct aggregates.
    """
    seen = Observation()
    write(df.observe(seen, *[c.alias(n) for n, c in figures.items()]))
    got = seen.get
    return got if got and set(figures) <= set(got) else None


def stage_counted(df: DataFrame, figures: dict[str, Column]) -> tuple[DataFrame, dict[str, object]]:
    """``stage(df)`` and aggregates of its rows from the pass that writes it.

    An input that Spark finds empty while it runs may report nothing; the figures are then read from the staged table.
    """
    made: list[DataFrame] = []
    got = observed_write(df, figures, lambda rows: made.append(stage(rows)))
    return made[0], got if got is not None else made[0].agg(*[c.alias(n) for n, c in figures.items()]).first().asDict()


def spread(df: DataFrame, files: int, rows: int | None = None) -> DataFrame:
    """``df`` dealt evenly over the cores where it comes from few files.

    Spark cuts files by their bytes: a small one of many rows makes one or two tasks, and all that is worked out
    on each row would run in these. ``rows``: their number, where it is known. Tables of no file stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = cores if rows is None else min(cores, rows // ROWS_A_TASK + 1)
    return df.repartition(tasks) if tasks > 1 and 0 < 2 * files <= cores else df


def new_folder(spark: SparkSession) -> str:
    """A folder of its own beside the staged tables, deleted with them."""
    path = f"{shared_folder(spark)}/catalens-stage/{uuid.uuid4().hex}"
    _written.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the tables staged by this process; results that still read them must be written before."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed
