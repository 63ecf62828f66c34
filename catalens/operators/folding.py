"""Unicode NFKC by a dictionary of words.

Few words change under NFKC. Those that might are found by a cheap expression, the distinct ones are folded once by an
Arrow function, and texts that hold them are put together again; all other rows never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.functions.text import match_key, nfkc, search_text, word_match
from catalens.staging import stage

# Ranges of characters that NFKC leaves alone wherever they stand. All others may change or join.
SETTLED = (
    (0x0000, 0x009F), (0x00C0, 0x0131), (0x0134, 0x013E), (0x0141, 0x0148), (0x014A, 0x017E), (0x0391, 0x03A1), (0x03A3, 0x03CE),
    (0x0400, 0x0482), (0x048A, 0x052F), (0x05D0, 0x05EA), (0x0620, 0x064A), (0x0904, 0x0928), (0x2010, 0x2010), (0x2012, 0x2016), (0x2018, 0x2023),
    (0x20A0, 0x20A7), (0x20A9, 0x20C0), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3),
)
# a wider class of few ranges: most texts of European languages hold none of it
_BEYOND_LATIN = r"[\x{A0}-\x{BF}\x{132}\x{133}\x{13F}\x{140}\x{149}\x{17F}-\x{10FFFF}]"
_UNSETTLED = "[^" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in SETTLED) + "]"


def fold_unicode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the NFKC form of text columns.

    A blank neither joins with its neighbours nor changes, so a text's form is that of its words. The words that may
    change make a dictionary of distinct ones; each distinct text that holds some is rebuilt and joined back. Where
    there are none the table is left as it is. The folded texts are staged: the planner knows their size.
    """
    each = df.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("_text"))
    wide = F.octet_length("_text") > F.char_length("_text")  # not ASCII, without a regex
    texts = each.filter(wide & F.col("_text").rlike(_BEYOND_LATIN) & F.col("_text").rlike(_UNSETTLED)).distinct()
    held = F.array_distinct(F.filter(F.split("_text", " "), lambda w: w.rlike(_UNSETTLED)))
    words = stage(texts.select("_text", F.explode(held).alias("_word")))
    if words.isEmpty():
        return df
    dictionary = stage(words.select("_word").distinct().withColumn("_form", nfkc(F.col("_word"))).filter("_form <> _word"))
    known = words.join(dictionary, "_word").groupBy("_text").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_form"))).alias("_known"))
    rebuilt = F.transform(F.split("_text", " "), lambda w: F.coalesce(F.try_element_at("_known", w), w))
    folded = stage(known.select("_text", F.array_join(rebuilt, " ").alias("_form")))
    if folded.isEmpty():
        return df
    for c in columns:
        df = df.join(folded, F.col(c) == F.col("_text"), "left").withColumn(c, F.coalesce("_form", c)).drop("_text", "_form")
    return df


def _with_form(df: DataFrame, column: str, name: str, form) -> DataFrame:
    folded = fold_unicode(df.withColumn("_folded", F.col(column).cast("string")), ["_folded"])
    return folded.withColumn(name, form(F.col("_folded"))).drop("_folded")


def with_match_key(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the match key of a text column."""
    return _with_form(df, column, name, lambda c: match_key(c, unicode=False))


def with_search_text(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the search form of a text column."""
    return _with_form(df, column, name, lambda c: search_text(c, unicode=False))


def search_words(df: DataFrame, column: str, needle: str) -> DataFrame:
    """The rows whose text holds the needle as whole words."""
    folded = fold_unicode(df.withColumn("_folded", F.col(column).cast("string")), ["_folded"])
    return folded.filter(word_match(F.col("_folded"), needle, unicode=False)).drop("_folded")
