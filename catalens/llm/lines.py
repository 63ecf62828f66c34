"""Line dedup over levelled sorted runs of line hashes. DataFrame operations only."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.llm.ranges import id_cuts
from catalens.staging import shared_folder, stage

#: The white space that does not count at the ends of a line, and the letters without case.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_KEY = 10


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(SPACE)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _hash(key: Column) -> Column:
    """128 bits as two longs; null for keys too short to count."""
    return F.when(F.char_length(key) >= MIN_KEY, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")))


@dataclass
class LineRuns:
    """The hashes seen so far and the first row that held each, as sorted bucketed runs on levels.

    A batch's new hashes become a run of level 0; ``fan_in`` runs of a level are merged into one of the
    next, so there are few runs and each hash is rewritten a logarithmic number of times. Runs are
    bucketed by hash and sorted inside the buckets: the anti-join of a batch with a run shuffles the batch
    alone and merges two sorted sides. They lie in the shared folder and outlive the session's executors.
    """

    spark: SparkSession
    fan_in: int = 2
    levels: list[list[str]] = field(default_factory=list)

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (
            rows.repartition(buckets, "h1", "h2").write.bucketBy(buckets, "h1", "h2").sortBy("h1", "h2")
            .option("path", f"{shared_folder(self.spark)}/catalens-lines/{name}").format("parquet").saveAsTable(name)
        )
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Add a batch (h1, h2, row), one that holds no smaller row than the batches before."""
        new = batch.groupBy("h1", "h2").agg(F.min("row").alias("row"), F.count("*").alias("holders"))
        for run in self.runs():
            new = new.join(run.hint("merge"), ["h1", "h2"], "left_anti")
        self._place(self._write(new), 0)

    def _place(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_in:
            merged, *rest = (self.spark.table(n) for n in self.levels[level])
            for run in rest:
                merged = merged.unionByName(run)
            name, self.levels[level] = self._write(merged), []
            self._place(name, level + 1)

    def index(self) -> DataFrame:
        first, *rest = self.runs()
        for run in rest:
            first = first.unionByName(run)
        return first


def dropped_lines(df: DataFrame, row_id: str = "doc_id", text: str = "text", batches: int = 4, fan_in: int = 2) -> DataFrame:
    """(row_id, drop): for each row id that loses lines, the hashes of the keys it loses.

    A line's key is the line without white space at its ends and with A-Z lower-cased. A key of 10 code
    points or more is kept where the smallest row id holds it and lost elsewhere. Rows of a null id count
    as larger than all others and lose every key another row id holds, the same as one row; rows that
    repeat an id are one holder. ``batches``: the table is added to the runs in that many steps of
    ascending row id (a corpus that grows would add each delivery as one). Ids may be of any type that Spark can order.
    """
    spark = df.sparkSession
    keys = F.transform(_lines(F.col(text)), lambda line: _hash(line_key(line)))
    # one pass over the texts leaves each row's distinct hashes
    held = stage(
        df.select(F.col(row_id).alias("row"), F.explode(F.array_distinct(F.filter(keys, lambda k: k.isNotNull()))).alias("k"))
        .select("row", "k.h1", "k.h2")
    )
    shares = [i / batches for i in range(1, batches)]
    cuts = id_cuts(held, "row", shares, 0.01)
    runs, row = LineRuns(spark, fan_in), F.col("row")
    if not cuts:
        runs.add(held.filter(row.isNotNull()))
    for i, cut in enumerate(cuts):
        runs.add(held.filter((row <= cut) & (row > cuts[i - 1])) if i else held.filter(row <= cut))
    if cuts:
        runs.add(held.filter(row > cuts[-1]))
    runs.add(held.filter(row.isNull()))
    index = runs.index().select("h1", "h2", F.col("row").alias("first"))
    # what has a first row other than itself goes; an equi-join that adaptive execution can split
    lost = held.join(index, ["h1", "h2"]).filter("first < row or (row is null and first is not null)")
    return lost.groupBy("row").agg(F.collect_set(F.struct("h1", "h2")).alias("drop")).withColumnRenamed("row", row_id)


def dedup_lines(df: DataFrame, row_id: str = "doc_id", text: str = "text", batches: int = 4, fan_in: int = 2) -> DataFrame:
    """``df`` with ``text`` replaced by its kept lines joined by \\n, and ``n_lines``, ``n_dropped`` (long).

    See ``dropped_lines`` for what goes. All rows stay; null and empty texts have one empty line and
    become empty; other columns stay as they are.
    """
    drop = dropped_lines(df, row_id, text, batches, fan_in).select(F.col(row_id).alias("_row"), F.col("drop").alias("_drop"))
    lines = _lines(F.col(text))
    kept = F.filter(
        F.col("_lines"),
        lambda line: ~F.coalesce(F.array_contains(F.col("_drop"), _hash(line_key(line))), F.lit(False)),
    )
    joined = df.join(drop, df[row_id].eqNullSafe(F.col("_row")), "left").withColumn("_lines", lines)
    kept = F.when(F.col("_drop").isNull(), F.col("_lines")).otherwise(kept)
    return (
        joined.withColumn("_kept", kept)
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dropped", (F.size("_lines") - F.size("_kept")).cast("long"))
        .withColumn(text, F.array_join("_kept", "\n"))
        .drop("_row", "_drop", "_lines", "_kept")
    )


def drop_repeated_lines(df: DataFrame, row_id: str = "doc_id", text: str = "text", n_chars: str | None = None) -> DataFrame:
    """``df`` with ``text`` replaced by its kept lines and ``n_chars``, if named, by the characters left. All other
    columns are carried, whatever their names. See ``dropped_lines`` for what goes."""
    rest = [c for c in df.columns if c not in (text, n_chars)]
    carried = df.select(F.struct(*[F.col(c) for c in rest]).alias("doc"), F.col(row_id).alias("row"), F.col(text).alias("text"))
    kept = dedup_lines(carried, "row", "text")
    new = {text: F.col("text"), n_chars: F.char_length("text").cast("long")}
    return kept.select(*[(new[c] if c in new else F.col("doc")[c]).alias(c) for c in df.columns])
