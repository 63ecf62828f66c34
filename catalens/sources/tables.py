"""Reading raw multi-table CSV folders and cleaned tables, writing cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Logical names of the raw tables; their columns come from the files and are read as text.
RAW_TABLES = ("movies_metadata", "keywords", "credits", "ratings_small", "links_small")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it belongs to."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a path on whatever file system it belongs to; nothing happens where there is none."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV with a header, without inferring types (reads the first line only)."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header as text columns; a file whose header differs from the first one's ends in an error.

    With ``multi_line`` a quoted cell may hold line breaks, and one file is one task. Without it Spark splits
    large files, but such cells would be torn: say so for sources known to have none.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header(spark, path)])
    options = {"header": True, "multiLine": multi_line, "escape": '"', "mode": "PERMISSIVE", "enforceSchema": False}
    return spark.read.options(**options).schema(schema).csv(path)


def read_raw_tables(spark: SparkSession, folder: str, multi_line: bool = True) -> dict[str, DataFrame]:
    """The raw tables found in ``folder`` as Parquet ``<name>.parquet`` or ``<name>.csv``; those not there are left out."""
    tables = {}
    for name in RAW_TABLES:
        if exists(spark, f"{folder}/{name}.parquet"):
            tables[name] = spark.read.parquet(f"{folder}/{name}.parquet")
        elif exists(spark, f"{folder}/{name}.csv"):
            tables[name] = read_csv(spark, f"{folder}/{name}.csv", multi_line)
    return tables


def write_cleaned(df: DataFrame, path: str, fmt: str = "parquet", by_decade: bool = False) -> str:
    """Write a cleaned table: Parquet (optionally partitioned by decade), or CSV with ISO dates."""
    writer = df
    if by_decade:
        writer = df.withColumn("decade", (F.floor(F.col("year") / 10) * 10).cast("int"))
    out = writer.write.mode("overwrite")
    if by_decade:
        out = out.partitionBy("decade")
    if fmt == "csv":
        out.option("header", True).option("dateFormat", "yyyy-MM-dd").option("escape", '"').csv(path)
    else:
        out.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned table by its format: CSV files as text columns, anything else as Parquet."""
    if path.endswith(".csv") or _holds_csv(spark, path):
        return read_csv(spark, path)
    return spark.read.parquet(path)


def _holds_csv(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        raise FileNotFoundError(path)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(path, "*.csv"))
    return found is not None and len(found) > 0
