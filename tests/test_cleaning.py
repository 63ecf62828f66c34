"""Text and type coercion, cleaning end to end, sources and sinks."""

import datetime as dt
import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalens.functions import casting, scalars, text
from catalens.operators import imputation
from catalens.operators.imputation import clean_measures
from catalens.plans.cleaning import (
    backfill_observed, clean_catalog, cleaned_schema, merge_raw, prepare_catalog, reclean_catalog,
)
from catalens.sources.tables import read_csv, read_raw_tables, write_cleaned

DRAMA = '[{"id": 18, "name": "Drama"}]'


@pytest.mark.parametrize(
    "cell, tokens",
    [
        ("[{'id': 1, 'name': 'Drama'}]", ["Drama"]),
        ('[{\'id\': 1, \'name\': "It\'s"}]', ["It's"]),
        ("[{'id': 1, 'name': None}]", []),
        ("[{'a': None, 'name': 'X'}, {'name': ' Y '}]", ["X", "Y"]),
        ("{'name': 'X'}", ["X"]),
        ("[]", []),
        ("Action|Drama", ["Action", "Drama"]),
        ("a, b", ["a", "b"]),
        ("   ", []),
        (None, []),
        ("[{'iso_3166_1': 'US'}]", ["US"]),
        ("[{'name': '', 'iso_639_1': 'en'}]", ["en"]),
        ("['a', 'b']", ["a", "b"]),
        ("[broken, text", ["[broken", "text"]),
    ],
)
def test_parse_list(spark, cell, tokens):
    df = spark.createDataFrame([(cell,)], "c string")
    assert df.select(text.parse_list(F.col("c")).alias("t")).first().t == tokens


def test_days_numbers_ids(spark):
    cells = ["2017-07-31", "1", "1995", "1997-13-01", " ", None, "2001-02-03 04:05:06"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r.d for r in df.select(casting.to_day(F.col("c")).alias("d")).collect()]
    assert got == [dt.date(2017, 7, 31), None, None, None, None, None, dt.date(2001, 2, 3)]
    ids = spark.createDataFrame([("1997-08-20",), ("",), ("12",), ("7.0",), (None,)], "id string")
    assert [r.i for r in ids.select(casting.identifier_column(ids).alias("i")).collect()] == [None, None, 12, 7, None]
    n = spark.createDataFrame([("x",), ("NaN",), ("3.5",)], "v string")
    assert [r.v for r in n.select(casting.to_number(F.col("v")).alias("v")).collect()] == [None, None, 3.5]


def test_observed_flags_read_words_or_numbers(spark):
    words = spark.createDataFrame([("Yes",), ("0",), ("7",), (None,)], "f string")
    assert [r.x for r in words.select(casting.observed_flag(words, "f", F.lit(True)).alias("x")).collect()] == [True, False, True, True]
    numbers = spark.createDataFrame([("2.5",), ("0.0",), (None,)], "f string")
    assert [r.x for r in numbers.select(casting.observed_flag(numbers, "f", F.lit(False)).alias("x")).collect()] == [True, False, False]


@pytest.mark.parametrize("value", ["ＷＡＬＬ·Ｅ", "Spider-Man", "É", "É  x", "a b", "ﬁn②", "  Ab\tC ", "don’t—stop…"])
def test_keys_equal_python(spark, value):
    df = spark.createDataFrame([(value,)], "c string")
    row = df.select(text.match_key(F.col("c")).alias("k"), text.search_text(F.col("c")).alias("s")).first()
    folded = unicodedata.normalize("NFKC", value)
    assert row.k == " ".join(folded.strip().lower().split())
    plain = "".join(" " if unicodedata.category(ch)[0] in "PS" else ch for ch in folded.lower())
    assert row.s == " ".join(plain.split()) == text.search_needle(value)


def test_predicates(spark):
    df = spark.createDataFrame([("The Ring: Two", "fictional place|ring master, x")], "t string, k string")
    t, k = F.col("t"), F.col("k")
    row = df.select(
        text.word_match(t, "ring").alias("a"), text.word_match(t, "rin").alias("b"), text.same_text(t, "the ring two").alias("c"),
        text.starts_with_words(t, "The-Ring").alias("d"), text.starts_with_words(t, "the ri").alias("e"),
        text.token_word_match(k, "master").alias("f"), text.token_same_text(k, "Fictional Place!").alias("g"),
        text.token_same_text(k, "ring").alias("h"), text.contains_text(t, "all").alias("i"), text.contains_text(t, "rinG:").alias("j"),
    ).first()
    assert list(row) == [True, False, True, True, False, True, True, False, True, True]


def test_labels(spark):
    row = spark.range(1).select(
        scalars.quarter_label(F.lit(12)), scalars.quarter_label(F.lit(None).cast("int")), scalars.quarter_label(F.lit(1)),
        scalars.fold_year_label(F.lit(2017), "2017-07-31"), scalars.fold_year_label(F.lit(2016), "2017-07-31"),
        scalars.feature_display_name(F.lit("quarter::Q1 (Jan-Mar)")), scalars.feature_display_name(F.lit("genre::War")),
        scalars.feature_display_name(F.lit("log_budget_sq")), scalars.strength_label(F.lit(-0.5)), scalars.decade(F.lit(1999)),
        scalars.model_type_label(F.lit("ols"), F.lit(3), 12),
    ).first()
    assert list(row) == [
        "Q4 (Oct-Dec)", "Unknown", "Q1 (Jan-Mar)", "2017 (Jan-Jul only)", "2016", "Release in Q1 (Jan-Mar)", "War genre",
        "Log Budget Sq", "Moderate correlation", 1990, "global_ols_shared",
    ]


def metrics(result):
    return {r.metric: r.value for r in result.metrics.collect()}


def test_cutoff_is_inclusive(spark):
    days = ["2001-02-03", "2017-07-31", "2017-08-01", "2031-01-01", "not a day", None]
    df = spark.createDataFrame([(50 + i, f"film {i}", d, 3.5, i) for i, d in enumerate(days)], "id long, title string, release_date string, vote_average double, vote_count long")
    df = df.withColumn("genres", F.lit(DRAMA))
    r = clean_catalog(df)
    assert sorted(x.title for x in r.table.collect()) == ["film 0", "film 1"]
    m = metrics(r)
    assert m["rows_removed_after_dataset_cutoff"] == 2 and m["rows_loaded"] == 6 and m["rows_after_cleaning"] == 2


def test_duplicate_ids_and_numbering(spark):
    rows = [("900", "Quarry", 4.0, 1), ("17", "Lagoon", 9.1, 3), ("900", "Quarry, second print", 4.0, 8), ("17", "Lagoon", None, 99), ("3", "Harbour", 1.0, 1)]
    df = spark.createDataFrame(rows, "id string, title string, vote_average double, vote_count long").withColumns(
        {"genres": F.lit(DRAMA), "release_date": F.expr("cast(date_add(date'1980-01-01', cast(id as int)) as string)")}
    )
    r = clean_catalog(df)
    got = [(x.id, x.source_id, x.title) for x in r.table.orderBy("id").collect()]
    assert got == [(1, 3, "Harbour"), (2, 17, "Lagoon"), (3, 900, "Quarry, second print")]
    assert metrics(r)["duplicates_removed"] == 2


RAW = (
    "id long, title string, original_title string, original_language string, release_date string, genres string, vote_average double, "
    "vote_count long, budget long, revenue long, runtime long, popularity double, production_countries string, keywords string"
)


def raw_row(id, title, original, language, day, votes, genres=DRAMA, places=None, words=None):
    return id, title, original, language, day, genres, votes / 10, votes, 0, 0, 40 + votes, votes / 7, places, words


def test_same_title_and_year_in_other_languages(spark):
    places = '[{"name": "Chile"}]'
    rows = [raw_row(i, "Harbour", o, lang, f"1997-0{i}-12", 10 * i, places=places, words='[{"name": "sea"}]') for i, o, lang in ((3, "Havn", "da"), (4, "Puerto", "es"), (5, "Satama", "fi"))]
    r = clean_catalog(spark.createDataFrame([*rows, raw_row(6, "Harbour", "Port", "fr", "1998-01-01", 5)], RAW))
    assert {x.title for x in r.table.collect()} == {"Harbour (Havn)", "Harbour (Puerto)", "Harbour (Satama)", "Harbour"}
    m = metrics(r)
    assert m["title_collisions_disambiguated"] == 1 and m["duplicates_removed"] == 0


def test_signature_duplicate_and_text_defaults(spark):
    rows = [raw_row(i, t, "Lagoon", "it", f"2005-11-0{i}", v, genres=None) for i, t, v in ((1, "Lagoon", 3), (2, " lagoon ", 8), (3, "LAGOON", 5))]
    r = clean_catalog(spark.createDataFrame(rows, RAW).withColumn("language", F.lit(None).cast("string")))
    row = r.table.first()
    assert r.table.count() == 1 and None not in list(row)
    assert (row.primary_genre, row.country, row.keyword, row.language) == ("Unknown", "Unknown", "Unknown", "it")
    m = metrics(r)
    assert m["duplicates_removed"] == 2 and m["title_duplicates_removed"] == 2 and m["text_fields_filled"] == 3


def test_imputation_order(spark):
    rows = [("A", 10.0), ("A", None), ("A", 20.0), ("B", None), ("B", -1.0), ("C", 4.0), (None, None)]
    df = spark.createDataFrame(rows, "primary_genre string, budget double").withColumn("vote_average", F.lit(11.0))
    got = clean_measures(df).toPandas()
    # category A fills with 15; the overall median is then taken over 10, 15, 20, 4
    frame = pd.DataFrame(rows, columns=["g", "b"])
    frame.loc[frame.b <= 0, "b"] = None
    frame["b"] = frame.b.fillna(frame.groupby("g").b.transform("median"))
    frame["b"] = frame.b.fillna(frame.b.median())
    assert sorted(got.budget) == sorted(frame.b) and set(got.vote_average) == {10.0}
    empty = spark.createDataFrame([("A", None)], "primary_genre string, budget double")
    assert clean_measures(empty).first().budget == 0.0 and clean_measures(empty).first().budget_observed is False


def test_medians_only_of_columns_with_gaps(spark, monkeypatch):
    asked = []
    known = imputation.exact_medians
    monkeypatch.setattr(imputation, "exact_medians", lambda df, keys, measures, **o: asked.append((list(keys), sorted(measures))) or known(df, keys, measures, **o))
    rows = [("A", 10.0, 1.0, 5), ("A", None, 2.0, 6), ("B", 3.0, 4.0, 7)]
    kinds = "primary_genre string, budget double, revenue double, vote_count int"
    got = imputation.impute_medians(spark.createDataFrame(rows, kinds))
    assert sorted(r.budget for r in got.collect()) == [3.0, 10.0, 10.0] and asked == [(["primary_genre"], ["budget"])]
    assert dict(got.dtypes)["vote_count"] == "double"  # as where there are gaps
    asked.clear()
    # a category without a value leaves gaps to the global median, of the column as filled so far
    more = imputation.impute_medians(spark.createDataFrame([*rows, ("C", None, 8.0, None)], kinds))
    assert sorted(r.budget for r in more.collect()) == [3.0, 10.0, 10.0, 10.0]
    assert sorted(r.vote_count for r in more.collect()) == [5.0, 6.0, 6.0, 7.0]
    assert asked == [(["primary_genre"], ["budget"]), ([], ["budget", "vote_count"])]
    asked.clear()
    assert imputation.impute_medians(spark.createDataFrame(rows[:1], kinds)).first().budget == 10.0 and not asked


def cleaned_input():
    n = 3
    days = ["2003-05-06", "2010-10-10", "2010-12-01"]
    measures = {c: [float(k * (i + 1)) for i in range(n)] for k, c in enumerate(("budget", "revenue", "runtime", "vote_average", "vote_count", "popularity"), 2)}
    texts = {c: [f"{c} {i}" for i in range(n)] for c in ("title", "primary_genre", "country", "keyword")}
    return pd.DataFrame({"id": [7001, 88, 512], **texts, **measures, "release_date": days, "year": [int(d[:4]) for d in days], "language": ["en", "fr", "en"]})


def test_prepare_cleaned_csv_and_export(spark, tmp_path):
    source = tmp_path / "cleaned.csv"
    cleaned_input().to_csv(source, index=False)
    r = prepare_catalog(spark, str(source), export_path=str(tmp_path / "out"))
    back = read_csv(spark, f"{tmp_path}/out/*.csv").toPandas().sort_values("id")
    assert back.id.tolist() == ["1", "2", "3"] and back.source_id.tolist() == ["7001", "88", "512"]
    assert back.release_date.tolist() == ["2003-05-06", "2010-10-10", "2010-12-01"]
    assert [f.name for f in r.table.schema] == cleaned_schema().names
    assert [f.dataType for f in r.table.schema] == [f.dataType for f in cleaned_schema()]
    report = {(x.column, x.metric): x.value for x in r.report.collect()}
    assert report[("*", "clean_rows")] == "3" and report[("release_date", "cleaned_end")] == "2010-12-01"
    again = reclean_catalog(r.table)
    assert sorted(map(str, again.table.collect())) == sorted(map(str, r.table.collect()))
    write_cleaned(r.table, str(tmp_path / "pq"), by_decade=True)
    assert spark.read.parquet(str(tmp_path / "pq")).filter("decade = 2010").count() == 2


def test_missing_columns_are_named(spark, tmp_path):
    cleaned_input().drop(columns=["keyword", "runtime"]).to_csv(tmp_path / "x.csv", index=False)
    with pytest.raises(KeyError, match="runtime"):
        prepare_catalog(spark, str(tmp_path / "x.csv"))


def test_flags_from_raw_values(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 9.0)], "source_id long, budget double").withColumns(
        {"revenue": F.lit(1.0), "runtime": F.lit(1.0)}
    )
    raw = spark.createDataFrame([("1", "0", "3", "x"), ("1", "0", "3", "x"), ("2", "10", "0", "5"), ("bad", "1", "1", "1")], "id string, budget string, revenue string, runtime string")
    got = {r.source_id: (r.budget_observed, r.revenue_observed, r.runtime_observed) for r in backfill_observed(df, raw).collect()}
    assert got == {1: (False, True, False), 2: (True, False, True), 3: (True, True, True)}


def test_raw_folder_end_to_end(spark, tmp_path):
    pd.DataFrame(
        {
            "id": ["1", "2", "1997-08-20", "2"], "title": ["One", 'Two, "quoted"\nline', "Bad", "Two again"],
            "genres": ["[{'id': 1, 'name': 'Drama'}]"] * 4, "release_date": ["2000-01-01", "2001-05-05", "2002-01-01", "2001-05-05"],
            "budget": ["10", "0", "1", "0"], "revenue": ["100", "", "1", ""], "runtime": ["90", "", "1", "80"], "vote_average": ["7", "8", "1", "8"],
            "vote_count": ["5", "6", "1", "1"], "popularity": ["1.5", "x", "1", "2"], "original_language": ["en", "fr", "en", "fr"],
            "production_countries": ["[{'iso_3166_1': 'US', 'name': 'United States of America'}]"] * 4, "original_title": ["One", "Deux", "Bad", "Deux"],
        }
    ).to_csv(tmp_path / "movies_metadata.csv", index=False)
    pd.DataFrame({"id": ["1", "1", "2"], "keywords": ["[{'name': 'k1'}]", "[{'name': 'k1'}]", "[]"]}).to_csv(tmp_path / "keywords.csv", index=False)
    merged, counts = merge_raw(read_raw_tables(spark, str(tmp_path)))
    assert merged.count() == 3
    r = prepare_catalog(spark, raw_folder=str(tmp_path))
    m = metrics(r)
    assert (m["raw_movies_rows"], m["invalid_movie_id_rows_removed"], m["raw_keywords_rows"], m["source_duplicates_removed"]) == (4, 1, 3, 1)
    rows = r.table.orderBy("id").collect()
    assert [x.source_id for x in rows] == [1, 2] and rows[0].keyword == "k1" and rows[1].keyword == "Unknown"
    assert rows[0].country == "United States of America" and rows[1].budget == 10.0 and rows[1].budget_observed is False


def test_input_order_and_partitions_do_not_matter(spark):
    rows = [
        (i % 40, f"T{i % 7}", f"O{i % 5}", ["en", "fr"][i % 2], f"200{i % 3}-0{i % 9 + 1}-11", DRAMA, float(i % 10), i % 13, i % 3 * 100, i % 4 * 50, 60 + i % 9, float(i % 6), None, None)
        for i in range(90)
    ]
    a = clean_catalog(spark.createDataFrame(rows, RAW).repartition(1))
    b = clean_catalog(spark.createDataFrame(rows[::-1], RAW).repartition(7))
    assert sorted(map(str, a.table.collect())) == sorted(map(str, b.table.collect()))
    assert metrics(a) == metrics(b)
    titled = a.table.groupBy(F.lower("title"), "year").count().filter("count > 1")
    assert titled.isEmpty()
