"""De-duplication by ranked choice, and disambiguation of titles that still collide.

All rows share one ranking, so they are numbered in it once (a range-partitioned sort). "First row of each key"
is then the smallest number of the key, a hash aggregate over one long, and a semi-join on that number: map-side
combining leaves one number per key and task, and the numbers that rows meet on are unique, so a key holding a
third of all rows is nowhere gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.functions.casting import day_column, identifier_column
from catalens.functions.text import match_key, strip
from catalens.operators.folding import fold_unicode
from catalens.operators.sequence import number_rows, number_within
from catalens.roles import OBSERVED
from catalens.staging import stage

# Columns whose presence raises a row's quality, and the ranking measures in order.
QUALITY_COLUMNS = (
    "primary_genre", "country", "keyword", "language", "budget", "revenue", "runtime",
    "vote_average", "vote_count", "popularity",
)
RANKING_MEASURES = ("vote_count", "popularity", "revenue", "runtime", "budget")
SIGNATURE = ("_title_key", "_original_key", "_language_key")


RANK = "_rank"  # a row's number in the ranking, 1 for the best


def best_rows(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of rows with a unique number ``_rank`` the lowest one per key columns; null keys form a group of their own."""
    best = ranked.groupBy(*keys).agg(F.min(RANK).alias(RANK)).select(RANK)
    return ranked.join(best, RANK, "left_semi").select(*ranked.columns)


def _number(df: DataFrame, term: Column) -> Column | None:
    """A term as a double that never puts two values the wrong way round, null lowest; None where it has no fixed width."""
    kind = df.select(term.alias("t")).schema["t"].dataType.typeName()
    if kind == "date":
        term = F.unix_date(term)
    elif kind == "timestamp":
        term = F.unix_micros(term)
    elif kind not in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        return None
    return F.coalesce(term.cast("double"), F.lit(float("-inf")))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], lead: Column | None = None) -> DataFrame:
    """The row with the smallest ``order`` per key columns; null keys form a group of their own, and of rows that tie
    in ``order`` one stays.

    ``lead`` is a double that grows with the order, not necessarily strictly; by default the first term, where that is
    a number or a date. Its minimum per key is a hash aggregate and leaves few contenders; only where these tie are
    they numbered in the whole order. Rows meet their minimum on key and lead, so a hot key's rows part.
    """
    if set(df.columns) <= set(keys):
        return df.distinct()
    lead = _number(df, order[0]) if lead is None else lead
    if lead is not None:
        led = df.withColumn("_lead", lead)
        best = led.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min("_lead").alias("_least"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
        df = stage(led.join(best, same & (F.col("_lead") == F.col("_least")), "left_semi").drop("_lead"))
        if df.groupBy(*keys).count().filter("count > 1").isEmpty():
            return df
    return best_rows(number_rows(df, order, RANK), keys).drop(RANK)


def row_hash(df: DataFrame) -> Column:
    """Content hash, the last tie-break where the input order means nothing."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def quality_score(df: DataFrame) -> Column:
    score = F.lit(0)
    for c in QUALITY_COLUMNS:
        if c in df.columns:
            score = score + F.col(c).isNotNull().cast("int")
    for c in OBSERVED.values():
        if c in df.columns:
            score = score + F.coalesce(F.col(c), F.lit(False)).cast("int") * 2
    return score


def ranking(df: DataFrame) -> list[Column]:
    """Ascending sort terms that put the better row first."""
    terms = [-quality_score(df)]
    for c in RANKING_MEASURES:
        if c in df.columns:
            terms.append(-F.coalesce(F.col(c), F.lit(-1.0)))
    if "release_date" in df.columns:
        terms.append(F.coalesce(day_column(df, "release_date"), F.lit("9999-12-31").cast("date")))
    return [*terms, row_hash(df)]


def ranking_lead(df: DataFrame) -> Column:
    """Quality and first measure of the ranking in one double: the measure counts up to a million millions."""
    measure = next((c for c in RANKING_MEASURES if c in df.columns), None)
    second = F.greatest(F.least(F.coalesce(F.col(measure).cast("double"), F.lit(-1.0)), F.lit(1e12)), F.lit(-1e12)) if measure else F.lit(0.0)
    return -(quality_score(df) * 4e12 + second)


def rank_rows(df: DataFrame) -> DataFrame:
    """``df``, staged, with each row's number in the ranking; signature columns have no say in it."""
    return number_rows(df, ranking(df.drop(*SIGNATURE)), RANK)


def deduplicate_ids(df: DataFrame) -> DataFrame:
    """Best row per id; rows without id count as one group. Keeps the numbers of ``rank_rows`` where there are some."""
    return best_rows(df, ["id"]) if RANK in df.columns else first_per_key(df, ["id"], ranking(df), ranking_lead(df))


def with_signature(df: DataFrame, unicode: bool = True) -> DataFrame:
    """``df`` with the match keys of title and original title and the lower-case language."""
    spoken = next((c for c in ("original_language", "language") if c in df.columns), None)
    language = F.lower(strip(F.coalesce(F.col(spoken), F.lit("")))) if spoken else F.lit("")
    titles = [c for c in ("title", "original_title") if c in df.columns]
    keyed = df.withColumns({f"_folded_{c}": F.col(c) for c in titles})
    if unicode:
        keyed = fold_unicode(keyed, [f"_folded_{c}" for c in titles])
    keys = {SIGNATURE[0]: match_key(F.col("_folded_title"), unicode=False), SIGNATURE[2]: language}
    keys[SIGNATURE[1]] = match_key(F.col(f"_folded_{titles[-1]}"), unicode=False)
    return keyed.withColumns({c: keys[c] for c in SIGNATURE}).drop(*[f"_folded_{c}" for c in titles])


def deduplicate_signatures(df: DataFrame, unicode: bool = True) -> DataFrame:
    """Best row per (title, year, original title, language) in match-key form; keeps the key columns, and the numbers of
    ``rank_rows`` where there are some."""
    keyed = df if SIGNATURE[0] in df.columns else with_signature(df, unicode)
    ranked = keyed if RANK in df.columns else rank_rows(keyed)
    return best_rows(ranked, [SIGNATURE[0], "year", *SIGNATURE[1:]]).select(*df.columns, *[c for c in SIGNATURE if c not in df.columns])


def deduplicate_ranked(ranked: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Best row per id, then per signature, of rows with the numbers of ``rank_rows`` and the signature's keys.

    Both choices are made on the narrow keys; the rows themselves travel once, to the numbers that stay.
    ``unique_ids`` says that no id stands on two rows, so the first choice would keep them all.
    """
    signature = [SIGNATURE[0], "year", *SIGNATURE[1:]]
    by_id = "id" in ranked.columns and not unique_ids
    slim = ranked.select(RANK, *signature, *(["id"] if by_id else []))
    if by_id:
        slim = best_rows(slim, ["id"])
    best = slim.groupBy(*signature).agg(F.min(RANK).alias(RANK)).select(RANK)
    return ranked.join(best, RANK, "left_semi").select(*ranked.columns)


def collision_groups(keyed: DataFrame) -> DataFrame:
    """(title key, year) pairs shared by several rows, with their number of rows."""
    return (
        keyed.filter((F.col("_title_key") != "") & F.col("year").isNotNull())
        .groupBy("_title_key", "year")
        .agg(F.count("*").alias("members"))
        .filter("members > 1")
    )


def _candidates(df: DataFrame, text: Callable[[str], Column], differs: Column) -> list[Column]:
    """Distinguishing titles in order of preference, null where there is none; ``text`` gives a text column."""
    base, original = strip(text("title")), strip(text("original_title"))
    day = F.date_format(day_column(df, "release_date"), "yyyy-MM-dd") if "release_date" in df.columns else F.lit(None)
    language = strip(F.coalesce(text("original_language"), text("language")))
    ident = F.coalesce(*[F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string") for c in ("source_id", "id")])
    return [
        F.when((original != "") & differs, F.concat(base, F.lit(" ("), original, F.lit(")"))),
        F.concat(base, F.lit(" ("), day, F.lit(")")),
        F.when(language != "", F.concat(base, F.lit(" ["), F.upper(language), F.lit("]"))),
        F.concat(base, F.lit(" #"), ident),
        base,
    ]


def _text_of(df: DataFrame, prefix: str = "") -> Callable[[str], Column]:
    return lambda c: F.col(prefix + c).cast("string") if c in df.columns else F.lit(None).cast("string")


def title_candidates(df: DataFrame) -> Column:
    """Distinguishing titles in order of preference: original title, date, language, id, the bare title."""
    text = _text_of(df)
    differs = match_key(strip(text("original_title"))) != match_key(strip(text("title")))
    return F.filter(F.array(*_candidates(df, text, differs)), lambda x: x.isNotNull())


def _keyed_candidates(df: DataFrame) -> DataFrame:
    """(_rank, _title_key, year, _base, _base_key, _options): candidates with their match keys, made of folded texts."""
    texts = [c for c in ("title", "original_title", "original_language", "language") if c in df.columns]
    both = fold_unicode(df.withColumns({f"_folded_{c}": F.col(c).cast("string") for c in texts}), [f"_folded_{c}" for c in texts])
    raw, folded = _text_of(df), _text_of(df, "_folded_")
    differs = match_key(strip(folded("original_title")), unicode=False) != match_key(strip(folded("title")), unicode=False)
    pairs = [
        F.when(shown.isNotNull(), F.struct(shown.alias("text"), match_key(plain, unicode=False).alias("key")))
        for shown, plain in zip(_candidates(df, raw, differs), _candidates(df, folded, differs))
    ]
    return both.select(
        RANK, "_title_key", "year", strip(raw("title")).alias("_base"), match_key(strip(folded("title")), unicode=False).alias("_base_key"),
        F.filter(F.array(*pairs), lambda x: x.isNotNull()).alias("_options"),
    )


def disambiguate_titles(keyed: DataFrame) -> DataFrame:
    """Give the rows of each collision group distinct titles, in ranking order.

    Every row is to take the first of its candidates no better-ranked row of its group took, then
    ``title #2``, ``#3``, ... That outcome is found without walking the group in order: in each round
    all rows ask for their current candidate, each candidate goes to its best-ranked asker, and
    refused rows move on to their next one. A candidate only ever passes to a better-ranked row, so
    when nobody is refused any more the holders are those of the sequential rule. A round is a
    grouped minimum joined back, however large a group is; only groups with a refusal enter the next one.
    """
    df = keyed if RANK in keyed.columns else rank_rows(keyed)
    group = ["_title_key", "year"]
    groups = stage(collision_groups(df).select(*group))
    if groups.isEmpty():
        return keyed
    rivals = df.join(groups, group, "left_semi")
    state = stage(_keyed_candidates(rivals).withColumns({"_at": F.lit(0), "_extra": F.lit(0).cast("long")}))
    settled = []
    while True:
        listed = F.try_element_at("_options", F.col("_at") + 1)
        number = F.concat(F.lit(" #"), F.col("_extra").cast("string"))
        asked = state.withColumns({
            "_wish": F.coalesce(listed["text"], F.concat("_base", number)), "_wish_key": F.coalesce(listed["key"], F.concat("_base_key", number)),
        })
        slot = [*group, "_wish_key"]
        holders = asked.groupBy(*slot).agg(F.min(RANK).alias("_holder"))
        judged = asked.join(holders, slot).withColumn("_refused", F.col(RANK) != F.col("_holder"))
        judged = stage(judged.drop("_holder"))  # one table per round; the next round starts from it
        unsettled = stage(judged.filter("_refused").select(*group).distinct())
        if unsettled.isEmpty():
            settled.append(judged)
            break
        settled.append(judged.join(unsettled, group, "left_anti"))
        state = _advance(judged.join(unsettled, group, "left_semi"))
    names = reduce(DataFrame.unionByName, [part.select(RANK, F.col("_wish").alias("_new_title")) for part in settled])
    named = df.join(names, RANK, "left").withColumn("title", F.coalesce("_new_title", "title"))
    return named.select(*keyed.columns)


def _advance(judged: DataFrame) -> DataFrame:
    """Move refused rows to their next wish. A row that runs out of candidates starts at the number it
    can have at best: one more than its place among the rows of its group that ran out. Places are numbered
    over all groups at once, so a title on many rows without ids of their own is in no task as a whole."""
    moved = judged.withColumn("_at", F.col("_at") + F.col("_refused").cast("int"))
    moved = moved.withColumn(
        "_extra", F.when(F.col("_refused") & (F.col("_extra") > 0), F.col("_extra") + 1).otherwise(F.col("_extra"))
    ).drop("_wish", "_wish_key", "_refused")
    out = F.col("_at") >= F.size("_options")
    spent = moved.filter(out)
    if spent.isEmpty():
        return moved
    placed = number_within(spent, ["_title_key", "year"], [F.col(RANK)], "_place")
    placed = placed.withColumn("_extra", F.greatest("_extra", F.col("_place") + 1)).drop("_place", "_position")
    return moved.filter(~out).unionByName(placed)


def deduplicate_model_rows(df: DataFrame) -> DataFrame:
    """First row per id (rows without id dropped), or per (title, date) where there is no id column."""
    tie = [row_hash(df)]
    lead = [F.col(c) for c in ("release_date", "title") if c in df.columns]
    if "id" in df.columns:
        ided = df.withColumn("id", identifier_column(df)).filter("id is not null")
        return first_per_key(ided, ["id"], [*lead, *tie])
    keys = [c for c in ("title", "release_date") if c in df.columns] or df.columns
    return first_per_key(df, keys, tie)
