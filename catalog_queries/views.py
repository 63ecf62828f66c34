"""The tables seen as catalogs: orders (with customer, nation and line totals), parts, events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens import Roles

CUTOFF = "2001-07-31"  # fixed value: last day of the order catalog; 2001 is a partial year


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Cost and quantity per order. Whole hundredths are added, so the sums do not depend on the order of adding."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")

    def total(c):
        return F.sum(F.floor(c * 100 + 0.5)) / 100.0

    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(total(F.col("l_quantity") * F.col("p_retailprice")).alias("budget"), total(F.col("l_quantity")).alias("runtime"))
    )


def order_catalog(spark: SparkSession, sf: str, *columns: str, whole_days: bool = True) -> DataFrame:
    """Orders in canonical roles; joins no more than the asked columns need. ``whole_days=False`` leaves the
    date the timestamp it is stored as, which a filter on it can be pushed down to."""
    rows = table(spark, sf, "orders")
    need = set(columns)
    if need & {"title", "language", "keyword", "country"}:
        rows = rows.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if "country" in need:
        rows = rows.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    if need & {"budget", "runtime"}:
        rows = rows.join(order_lines(spark, sf), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    day = F.col("o_orderdate").cast("date")
    known = {
        "id": "o_orderkey", "title": "c_name", "primary_genre": "o_orderpriority", "budget": "budget", "revenue": "o_totalprice",
        "release_date": day if whole_days else "o_orderdate", "year": F.year(day), "runtime": "runtime",
        "vote_average": (F.col("o_custkey") % 101).cast("double") / 10, "vote_count": F.col("o_custkey").cast("double"),
        "popularity": (F.col("o_orderkey") % 97).cast("double"), "language": F.lower("c_mktsegment"),
        "country": "n_name", "keyword": F.concat_ws("|", "c_mktsegment", "o_orderpriority"),
    }
    return Roles(**{c: known[c] for c in columns}).bind(rows)


CATALOG_SQL = """
lines AS (
  SELECT l_orderkey, CAST(sum(CAST(l_quantity * p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS budget,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS runtime
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
catalog AS (
  SELECT o_orderkey AS id, c_name AS title, o_orderpriority AS primary_genre, budget, o_totalprice AS revenue,
         CAST(o_orderdate AS DATE) AS release_date, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month, runtime,
         CAST(o_custkey % 101 AS DOUBLE) / 10 AS vote_average, CAST(o_custkey AS DOUBLE) AS vote_count,
         CAST(o_orderkey % 97 AS DOUBLE) AS popularity, lower(c_mktsegment) AS language, n_name AS country,
         concat_ws('|', c_mktsegment, o_orderpriority) AS keyword
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN lines ON o_orderkey = l_orderkey)
"""


def with_catalog(select: str, more: str = "") -> str:
    return f"WITH {CATALOG_SQL}{',' + more if more else ''} {select}"


def part_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Parts: many share a name, which stands for the title."""
    parts = table(spark, sf, "part")
    return Roles(
        id="p_partkey", title="p_name", original_title="p_type", original_language="p_brand",
        release_date=F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size")), year=F.lit(2000),
        vote_count=F.col("p_size").cast("double"), popularity=F.col("p_partkey").cast("double"), revenue="p_retailprice",
    ).bind(parts)


PARTS_SQL = """
parts AS (
  SELECT p_partkey AS id, p_name AS title, p_type AS original_title, p_brand AS original_language,
         CAST(DATE '2000-01-01' + CAST(p_size AS INTEGER) AS DATE) AS release_date, CAST(p_size AS DOUBLE) AS vote_count,
         CAST(p_partkey AS DOUBLE) AS popularity, p_retailprice AS revenue,
         lower(p_name) AS tk, lower(p_type) AS ok, lower(p_brand) AS lk
  FROM part)
"""


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id"), F.col("ts").alias("timestamp"), F.col("event_type").alias("event"), F.col("value").alias("duration"),
        F.col("user_id").alias("request_id"), F.col("props").alias("message"),
    )


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round for comparison, away from the noise of floating-point sums."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})
