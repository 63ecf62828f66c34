"""The operation log: JSON lines with an open schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalens.sources.tables import exists

# Keys of a log line the report reads.
EVENT_KEYS = (
    "timestamp", "event", "thread", "analysis_request_id", "analysis_in_progress", "chart_generation_in_progress",
    "request_id", "source", "duration_ms", "rows", "message",
)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Log lines as text columns; blank and malformed lines are dropped, a missing file is empty.

    A key with an unexpected type keeps its line: all keys come as text, and ``duration`` is the number
    written without quotes, as only those count for averages.
    """
    lines = spark.read.text(path) if exists(spark, path) else spark.createDataFrame([], "value string")
    return parse_events(lines)


def parse_events(lines: DataFrame, column: str = "value") -> DataFrame:
    schema = T.StructType([T.StructField(k, T.StringType()) for k in EVENT_KEYS] + [T.StructField("_bad", T.StringType())])
    parsed = F.from_json(F.col(column), schema, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    rows = lines.filter(F.trim(F.col(column)) != "").select(parsed.alias("e"), F.col(column).alias("_line"))
    rows = rows.filter(F.col("e").isNotNull() & F.col("e._bad").isNull())
    bare = F.regexp_extract("_line", r'"duration_ms"\s*:\s*(-?[0-9][0-9.eE+-]*)\s*[,}]', 1)
    return rows.select(*[F.col(f"e.{k}").alias(k) for k in EVENT_KEYS], F.nullif(bare, F.lit("")).try_cast("double").alias("duration"))
