"""Filters, multi-key sorting, paging, top-k and selection differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.functions.casting import day_column, identifier_column, number_column, year_column
from catalens.functions.scalars import finite
from catalens.functions.text import contains_text, token_word_match, word_match
from catalens.operators.folding import fold_unicode

PAGE_SIZE = 120  # fixed value: rows per page
# fixed value: default order of a selection
DEFAULT_ORDER = (("vote_average", False), ("revenue", False))


def selection_predicate(df: DataFrame, filters: Mapping[str, object] | None, unicode: bool = True) -> Column:
    """Conjunction of all active filters as one column, so Catalyst can split and push it down."""
    filters = filters or {}
    terms: list[Column] = []
    first, last = filters.get("year_from"), filters.get("year_to")
    if first is not None:
        terms.append(year_column(df) >= int(first))
    if last is not None:
        terms.append(year_column(df) <= int(last))
    if "release_date" in df.columns and "year" not in df.columns:
        # the same range on the raw date, which a Parquet scan can push down
        day = F.col("release_date")
        if df.schema["release_date"].dataType.typeName() in ("date", "timestamp", "timestamp_ntz"):
            if first is not None:
                terms.append(day >= F.lit(f"{int(first):04d}-01-01").cast("date"))
            if last is not None:
                terms.append(day < F.lit(f"{int(last) + 1:04d}-01-01").cast("date"))
    if filters.get("min_rating") is not None and "vote_average" in df.columns:
        terms.append(number_column(df, "vote_average") >= float(filters["min_rating"]))
    genre = str(filters.get("genre") or "").strip()
    if genre and genre.lower() != "all" and "primary_genre" in df.columns:
        terms.append(contains_text(F.col("primary_genre"), genre))
    for name in ("language", "country"):
        wanted = str(filters.get(name) or "")
        if wanted and name in df.columns:
            needle = wanted.strip().lower()
            terms.append(F.coalesce(F.contains(F.lower(F.col(name)), F.lit(needle)), F.lit(False)))
    query = _query(filters)
    if query:
        terms.append(_text_predicate(df, query, {c: c for c in ("title", "keyword")}, unicode))
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def _query(filters: Mapping[str, object]) -> str:
    return str(filters.get("keyword") or filters.get("keywords") or filters.get("title_keyword") or "")


def _text_predicate(df: DataFrame, query: str, names: Mapping[str, str], unicode: bool) -> Column:
    hits = []
    if "title" in df.columns:
        hits.append(word_match(F.col(names["title"]), query, unicode))
    if "keyword" in df.columns:
        hits.append(token_word_match(F.col(names["keyword"]), query, unicode))
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def apply_filters(df: DataFrame, filters: Mapping[str, object] | None = None, unicode: bool = True) -> DataFrame:
    """The rows that pass all active filters. Texts to be searched are folded (``fold_unicode``) in what the other
    filters leave; ``unicode=False`` skips that where texts are ASCII or folded already."""
    filters = filters or {}
    query = _query(filters)
    if not (query and unicode):
        return df.filter(selection_predicate(df, filters, unicode))
    rest = {k: v for k, v in filters.items() if k not in ("keyword", "keywords", "title_keyword")}
    names = {c: f"_folded_{c}" for c in ("title", "keyword") if c in df.columns}
    rows = df.filter(selection_predicate(df, rest)).withColumns({n: F.col(c).cast("string") for c, n in names.items()})
    found = fold_unicode(rows, list(names.values())).filter(_text_predicate(df, query, names, unicode=False))
    return found.drop(*names.values())


def positive_pairs(df: DataFrame, cost: str = "budget", income: str = "revenue") -> DataFrame:
    """Rows where both measures are positive and finite."""
    a, b = number_column(df, cost), number_column(df, income)
    return df.withColumns({cost: a, income: b}).filter(
        (F.col(cost) > 0) & (F.col(income) > 0) & finite(F.col(cost)) & finite(F.col(income))
    )


def order_columns(order: Sequence[tuple[str, bool]]) -> list[Column]:
    """(column, ascending) pairs as sort columns, nulls last either way."""
    return [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in order]


def promote_sort(order: Sequence[tuple[str, bool]], column: str) -> list[tuple[str, bool]]:
    """Sort state after choosing ``column``: it moves to the front, and flips when it was there already."""
    known = dict(order)
    ascending = not known[column] if column in known else column in ("title", "primary_genre", "release_date")
    return [(column, ascending)] + [(c, up) for c, up in order if c != column]


def sort_selection(df: DataFrame, order: Sequence[tuple[str, bool]] = DEFAULT_ORDER) -> DataFrame:
    return df.orderBy(*order_columns([(c, up) for c, up in order if c in df.columns]))


def page(
    df: DataFrame, number: int, order: Sequence[tuple[str, bool]] = DEFAULT_ORDER, size: int = PAGE_SIZE
) -> DataFrame:
    """Rows [number*size, (number+1)*size) of the order. For deep pages prefer ``page_after``."""
    return sort_selection(df, order).offset(number * size).limit(size)


def page_after(
    df: DataFrame, last: Mapping[str, object], order: Sequence[tuple[str, bool]], size: int = PAGE_SIZE
) -> DataFrame:
    """The page following the row ``last``: a filter plus a bounded top-k instead of a growing offset.
    The order has to end in a unique column."""
    after, tied = F.lit(False), F.lit(True)
    for c, up in order:
        value = last[c]
        if value is None:
            further = F.lit(False)
        else:
            further = (F.col(c) > F.lit(value)) if up else (F.col(c) < F.lit(value))
            further = F.coalesce(further, F.lit(False)) | F.col(c).isNull()
        after = after | (tied & further)
        tied = tied & F.col(c).eqNullSafe(F.lit(value))
    return df.filter(after).orderBy(*order_columns(order)).limit(size)


def page_count(df: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    rows = F.count("*")
    return df.agg(rows.alias("rows"), F.greatest(F.ceil(rows / size), F.lit(1)).alias("pages"))


def top_titles(df: DataFrame, limit: int = 10) -> DataFrame:
    """Best rated, then highest income, then title and id: a bounded top-k per task."""
    columns = [c for c in ("title", "primary_genre", "year", "vote_average", "runtime", "revenue") if c in df.columns or c == "year"]
    order = [("vote_average", False), ("revenue", False), ("title", True), ("id", True)]
    order = [(c, up) for c, up in order if c in df.columns]
    return df.withColumn("year", year_column(df)).orderBy(*order_columns(order)).limit(limit).select(*columns)


def distinct_categories(df: DataFrame) -> DataFrame:
    return df.select("primary_genre").filter("primary_genre is not null").distinct().orderBy("primary_genre")


def _identity(df: DataFrame, by_id: bool) -> DataFrame:
    if by_id:
        return df.select(identifier_column(df).alias("i"))
    parts = []
    parts.append((F.col("id").cast("string") if "id" in df.columns else F.lit(None).cast("string")).alias("i"))
    title = F.coalesce(F.col("title").cast("string"), F.lit("")) if "title" in df.columns else F.lit("")
    parts.append(F.lower(F.trim(title)).alias("t"))
    parts.append((day_column(df, "release_date") if "release_date" in df.columns else F.lit(None).cast("date")).alias("d"))
    parts.append((F.col("year").cast("int") if "year" in df.columns else F.lit(None).cast("int")).alias("y"))
    return df.select(*parts)


def selection_change(previous: DataFrame, current: DataFrame, by_id: bool | None = None) -> DataFrame:
    """How many identities the current selection adds to and removes from the previous one: one row.

    ``by_id=None`` checks whether ids are complete and unique on both sides (two small aggregates) and
    falls back to (id, title, date, year). Both sides are tagged and counted per identity in a single
    aggregation, which combines map-side and treats nulls as equal.
    """
    if by_id is None:
        by_id = all("id" in d.columns and _complete_ids(d) for d in (previous, current))
    old = _identity(previous, by_id).withColumn("side", F.lit(1))
    new = _identity(current, by_id).withColumn("side", F.lit(2))
    keys = [c for c in old.columns if c != "side"]
    seen = old.unionByName(new).groupBy(*keys).agg(F.bit_or("side").alias("sides"))
    return seen.agg(F.count_if(F.col("sides") == 2).alias("added"), F.count_if(F.col("sides") == 1).alias("removed"))


def _complete_ids(df: DataFrame) -> bool:
    # unique means that no id occurs twice: a grouped count, not a distinct set in one place
    counted = df.groupBy(identifier_column(df).alias("i")).agg(F.count("*").alias("n"))
    bad = counted.filter((F.col("n") > 1) | F.col("i").isNull())
    return bad.isEmpty()
