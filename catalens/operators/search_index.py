"""Repeated search of titles and keywords by an inverted index kept beside the cleaned table.

A needle that occurs as whole words has all its words among those of the text, so the rows of its rarest word are the
candidates; the phrase test of a scan decides on them. Postings are partitioned by a hash of the word: a search reads
the buckets of its words and the texts of its candidates.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.functions.text import search_forms, search_needle
from catalens.operators.folding import fold_unicode

_WORD = r"[\p{L}\p{N}]+"
_WORDLESS = ""  # posting of every row: needles that have no word of their own are looked up under it


@dataclass
class SearchIndex:
    """``postings`` (bucket, word, id) and ``forms`` (id, forms: the search forms that a needle may stand in)."""

    postings: DataFrame
    forms: DataFrame
    buckets: int


def build_index(df: DataFrame, id: str = "id", title: str = "title", keyword: str = "keyword", buckets: int = 64) -> SearchIndex:
    """Index of a table with a unique id; a column that is not there has no texts. Null texts hold nothing."""
    present = {n: c for n, c in (("_title", title), ("_keyword", keyword)) if c in df.columns}
    rows = df.select(F.col(id).alias("id"), *[F.col(c).cast("string").alias(n) for n, c in present.items()])
    rows = fold_unicode(rows, list(present))
    forms = rows.select("id", search_forms(*[F.col(n) if n in present else F.lit(None).cast("string") for n in ("_title", "_keyword")]).alias("forms"))
    words = F.flatten(F.transform("forms", lambda f: F.regexp_extract_all(f, F.lit(_WORD), F.lit(0))))
    postings = forms.filter(F.size("forms") > 0).select("id", F.explode(F.array_distinct(F.concat(words, F.array(F.lit(_WORDLESS))))).alias("word"))
    return SearchIndex(postings.select(_bucket(buckets).alias("bucket"), "word", "id"), forms, buckets)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int")


def write_index(index: SearchIndex, folder: str) -> None:
    """Write the index; postings lie in a folder per bucket, sorted by word. A bucket with frequent words is several files."""
    postings = index.postings.repartitionByRange("bucket", "word", "id").sortWithinPartitions("bucket", "word")
    postings.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/buckets={index.buckets}/postings")
    index.forms.write.mode("overwrite").parquet(f"{folder}/buckets={index.buckets}/forms")


def read_index(spark: SparkSession, folder: str, buckets: int = 64) -> SearchIndex:
    root = f"{folder}/buckets={buckets}"
    return SearchIndex(spark.read.parquet(f"{root}/postings"), spark.read.parquet(f"{root}/forms"), buckets)


def _words(form: str) -> list[str]:
    return ["".join(run) for inside, run in groupby(form, lambda ch: unicodedata.category(ch)[0] in "LN") if inside]


def search(index: SearchIndex, needles: Sequence[str]) -> DataFrame:
    """(needle, id) of all matches, those that a scan for each needle finds (``apply_filters`` with a title keyword).

    Empty needles match nothing. The needles are a list of the caller; all of them are answered in one pass.
    """
    spark = index.postings.sparkSession
    asked = [(n, form, word) for n in dict.fromkeys(needles) if (form := search_needle(n)) for word in dict.fromkeys(_words(form) or [_WORDLESS])]
    schema = "needle string, form string, word string"
    wanted = spark.createDataFrame(asked, schema)
    places = sorted({r[0] for r in wanted.select(_bucket(index.buckets)).distinct().collect()})  # of the needles' words
    postings = index.postings.filter(F.col("bucket").isin(places))  # a partition filter on a written index
    held = dict(postings.join(wanted.select("word").distinct(), "word").groupBy("word").count().collect())
    rarest = {}
    for n, form, word in asked:
        best = rarest.get(n)
        if best is None or held.get(word, 0) < held.get(best[2], 0):
            rarest[n] = (n, form, word)
    found = postings.join(spark.createDataFrame(list(rarest.values()), schema), "word").join(index.forms, "id")
    apart = r"[\p{L}\p{N}]"
    pattern = F.concat(F.lit(rf"(?<!{apart})\Q"), F.col("form"), F.lit(rf"\E(?!{apart})"))
    return found.filter(F.exists("forms", lambda f: F.contains(f, F.col("form")) & F.regexp_like(f, pattern))).select("needle", "id")
