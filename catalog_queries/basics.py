"""Coercions, projections, filters, joins, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalens.functions import casting, scalars, text
from catalens.functions.features import BASE_FEATURES, base_features, category_features, grouped_category, profile_features
from catalens.operators import dedup, folding, imputation, search_index, selection
from catalens.operators.modelling import eligible_rows, prepare_modelling
from catalens.plans import cleaning
from catalens.staging import new_folder
from catalog_queries.registry import query
from catalog_queries.views import CUTOFF, order_catalog, part_catalog, rounded, table, with_catalog

# casts ----------------------------------------------------------------------------------------


@query(
    "t1_t2_lenient_casts",
    """SELECT o_orderkey AS id, o_totalprice AS number, CAST(NULL AS DOUBLE) AS word,
    CAST(o_orderdate AS DATE) AS day, CAST(NULL AS DATE) AS no_month, CAST(NULL AS DATE) AS year_only FROM orders""",
)
def lenient_casts(spark, sf):
    o = table(spark, sf, "orders")
    year = F.date_format("o_orderdate", "yyyy")
    return o.select(
        F.col("o_orderkey").alias("id"), casting.to_number(F.col("o_totalprice").cast("string")).alias("number"),
        casting.to_number(F.col("o_orderpriority")).alias("word"), casting.to_day(F.col("o_orderdate").cast("string")).alias("day"),
        casting.to_day(F.concat(year, F.lit("-13-01"))).alias("no_month"), casting.to_day(year).alias("year_only"),
    )


@query(
    "t3_restore_types",
    with_catalog("SELECT id, title, primary_genre, revenue, revenue > 200000 AS revenue_observed, release_date, year, vote_average FROM catalog"),
)
def restore_types(spark, sf):
    typed = order_catalog(spark, sf, "id", "title", "primary_genre", "revenue", "release_date", "year", "vote_average")
    as_text = typed.withColumn("revenue_observed", F.col("revenue") > 200000).select(
        *[F.col(c).cast("string").alias(c) for c in (*typed.columns, "revenue_observed")]
    )
    padded = as_text.withColumn("title", F.concat(F.lit("  "), "title", F.lit(" ")))
    return casting.restore_types(padded).select(
        "id", "title", "primary_genre", "revenue", "revenue_observed", "release_date", "year", "vote_average"
    )


@query(
    "t5_observed_flags",
    """SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE ELSE o_totalprice > 200000 END AS flag,
    o_totalprice > 200000 AS flag_without_column FROM orders""",
)
def observed_flags(spark, sf):
    o = table(spark, sf, "orders").withColumn(
        "flag", F.when(F.col("o_orderstatus") == "F", " Yes").when(F.col("o_orderstatus") == "O", "false").otherwise("?")
    )
    fallback = F.col("o_totalprice") > 200000
    return o.select(
        F.col("o_orderkey").alias("id"), casting.observed_flag(o, "flag", fallback).alias("flag"),
        casting.observed_flag(o, "absent", fallback).alias("flag_without_column"),
    )


@query(
    "t6_t10_identifiers",
    """SELECT c_custkey AS id, c_custkey AS from_decimal_text, CAST(NULL AS BIGINT) AS from_date,
    CASE WHEN c_acctbal < 0 THEN c_custkey ELSE c_nationkey END AS source_id FROM customer""",
)
def identifiers(spark, sf):
    c = table(spark, sf, "customer").select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("a"), F.lit("1997-08-20").alias("b"), "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("string")).alias("s"),
    )
    return c.select(
        F.col("c_custkey").alias("id"), casting.identifier_column(c, "a").alias("from_decimal_text"),
        casting.identifier_column(c, "b").alias("from_date"),
        F.coalesce(casting.identifier_column(c, "s"), F.col("c_custkey")).alias("source_id"),
    )


@query(
    "t7_date_parts",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n FROM orders GROUP BY ALL",
)
def date_parts(spark, sf):
    rows = order_catalog(spark, sf, "release_date")
    return rows.groupBy(casting.year_column(rows).alias("year"), F.month("release_date").alias("month")).agg(F.count("*").alias("n"))


# texts ----------------------------------------------------------------------------------------


@query(
    "p1_p2_p3_list_parsing",
    """SELECT c_custkey AS id, concat_ws('|', c_mktsegment, 'It''s', n_name) AS dicts, c_mktsegment AS first_dict,
    concat_ws('|', c_mktsegment, n_name) AS delimited, CAST(0 AS INTEGER) AS bare_number_dicts FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def list_parsing(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    dicts = F.format_string(
        "[{'id': %d, 'name': '%s', 'x': None}, {'id': 2, 'name': \"It's\"}, {'name': None}, {'iso_3166_1': '%s'}]", "c_custkey", "c_mktsegment", "n_name"
    )
    return c.select(
        F.col("c_custkey").alias("id"), text.pipe_joined(dicts).alias("dicts"), text.first_token(dicts).alias("first_dict"),
        text.pipe_joined(F.concat("c_mktsegment", F.lit(" |, "), "n_name")).alias("delimited"),
        F.size(text.parse_list(F.format_string('{"k": %d}', "c_custkey"))).alias("bare_number_dicts"),
    )


@query(
    "p1_event_properties",
    "SELECT event_type, count(*) AS events, CAST(0 AS BIGINT) AS named FROM events GROUP BY event_type",
)
def event_properties(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("event_type").agg(
        F.count("*").alias("events"), F.sum(F.size(text.parse_list(F.col("props")))).cast("bigint").alias("named")
    )


@query(
    "p4_p5_p6_p8_text_preparation",
    """SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE c_name END AS title, c_mktsegment AS original_title,
    c_mktsegment AS primary_genre, concat_ws('|', n_name, 'X') AS country, CASE WHEN c_nationkey < 10 THEN 'en' ELSE 'xx' END AS language,
    'xx' AS original_language FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def text_preparation(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    raw = c.select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(" "), "c_name")).alias("title"),
        F.col("c_mktsegment").alias("original_title"), F.format_string("[{'name': '%s'}]", "c_mktsegment").alias("genres"),
        F.format_string("[{'name': '%s'}, {'iso_3166_1': 'X'}]", "n_name").alias("production_countries"),
        F.when(F.col("c_nationkey") < 10, "en").alias("language"), F.lit("xx").alias("original_language"),
    )
    return cleaning.title_identity(cleaning.prepare_texts(raw)).select(
        "id", "title", "original_title", "primary_genre", "country", "language", "original_language"
    )


@query(
    "p7_match_keys",
    "SELECT doc_id, md5(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS key FROM documents",
)
def match_keys(spark, sf):
    keyed = folding.with_match_key(table(spark, sf, "documents").select("doc_id", "text"), "text", "key")
    return keyed.select("doc_id", F.md5("key").alias("key"))


@query(
    "p9_quality_scores",
    with_catalog("""SELECT id, CAST(1 + 1 + 1 + 1 + (budget IS NOT NULL)::INT + 1 + (runtime IS NOT NULL)::INT + 3
    + 2 * (budget > 90000 IS TRUE)::INT + 2 * (revenue > 200000)::INT AS INTEGER) AS score FROM catalog"""),
)
def quality_scores(spark, sf):
    rows = order_catalog(
        spark, sf, "id", "primary_genre", "country", "keyword", "language", "budget", "revenue", "runtime", "vote_average", "vote_count", "popularity"
    ).withColumns({"budget_observed": F.col("budget") > 90000, "revenue_observed": F.col("revenue") > 200000})
    return rows.select("id", dedup.quality_score(rows).alias("score"))


@query(
    "p10_title_candidates",
    """SELECT p_partkey AS id, concat_ws(';', p_name || ' (' || p_type || ')', p_name || ' (' || strftime(DATE '2000-01-01' + CAST(p_size AS INTEGER), '%Y-%m-%d') || ')',
    p_name || ' [' || upper(p_brand) || ']', p_name || ' #' || p_partkey, p_name) AS candidates FROM part""",
)
def title_candidates(spark, sf):
    rows = part_catalog(spark, sf)
    return rows.select("id", F.array_join(dedup.title_candidates(rows), ";").alias("candidates"))


@query(
    "p11_text_defaults",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN 'Unknown' ELSE o_orderpriority END AS primary_genre,
    CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE 'en' END AS language, 'unknown' AS original_language, 'Unknown' AS country FROM orders""",
)
def text_defaults(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")).alias("primary_genre"),
        F.when(F.col("o_orderstatus") == "P", "  ").otherwise(" en").alias("language"), F.lit(None).cast("string").alias("country"),
    )
    return cleaning.fill_texts(o).select("id", "primary_genre", "language", "original_language", "country")


@query(
    "p12_f13_valid_and_clipped",
    """SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS budget, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS vote_count,
    greatest(least(c_acctbal / 500, 10), 0) AS rating FROM customer""",
)
def valid_and_clipped(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("budget"), F.col("c_acctbal").alias("vote_count"), (F.col("c_acctbal") / 500).alias("r")
    )
    return imputation.invalid_to_null(c).select("id", "budget", "vote_count", scalars.clipped(F.col("r"), 0, 10).alias("rating"))


@query(
    "p13_category_tokens",
    with_catalog("""SELECT id, len(string_split(keyword, '|')) AS by_pipe, string_split(keyword, '|')[1] AS first_token,
    2 AS by_comma, 1 AS pipe_wins FROM catalog"""),
)
def category_tokens(spark, sf):
    rows = order_catalog(spark, sf, "id", "keyword", "primary_genre")
    tokens = text.category_tokens(F.concat(F.lit(" "), "keyword", F.lit("| ")))
    return rows.select(
        "id", F.size(tokens).cast("bigint").alias("by_pipe"), tokens[0].alias("first_token"),
        F.size(text.category_tokens(F.concat("primary_genre", F.lit(", x,")))).alias("by_comma"),
        F.size(text.category_tokens(F.lit("a, b|"))).alias("pipe_wins"),
    )


@query(
    "p14_search_texts",
    "SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(text), '[\\p{P}\\p{S}]', ' ', 'g'), '\\s+', ' ', 'g'))) AS form FROM documents",
)
def search_texts(spark, sf):
    formed = folding.with_search_text(table(spark, sf, "documents").select("doc_id", "text"), "text", "form")
    return formed.select("doc_id", F.md5("form").alias("form"))


@query(
    "p15_p21_p22_p24_p25_p27_labels",
    with_catalog("""SELECT id, CASE WHEN month <= 3 THEN 'Q1 (Jan-Mar)' WHEN month <= 6 THEN 'Q2 (Apr-Jun)' WHEN month <= 9 THEN 'Q3 (Jul-Sep)' ELSE 'Q4 (Oct-Dec)' END AS quarter,
    CAST(year // 10 * 10 AS INTEGER) AS decade, round((revenue - budget) / budget * 100, 4) AS roi,
    CASE WHEN revenue > budget THEN 'increasing' WHEN revenue < budget THEN 'decreasing' ELSE 'stable' END AS direction,
    CASE WHEN runtime >= 100 THEN 'global_ridge_calibrated' ELSE 'global_ridge_shared' END AS model_type,
    CASE WHEN year = 2001 THEN '2001 (Jan-Jul only)' ELSE CAST(year AS VARCHAR) END AS year_label FROM catalog"""),
)
def labels(spark, sf):
    r = order_catalog(spark, sf, "id", "budget", "revenue", "release_date", "year", "runtime")
    return r.select(
        "id", scalars.quarter_label(F.month("release_date")).alias("quarter"), scalars.decade(F.col("year")).alias("decade"),
        F.round(scalars.return_percent(F.col("budget"), F.col("revenue")), 4).alias("roi"),
        scalars.direction_label(F.col("revenue") - F.col("budget")).alias("direction"),
        scalars.model_type_label(F.lit("ridge"), F.col("runtime"), 100).alias("model_type"),
        scalars.fold_year_label(F.col("year"), CUTOFF).alias("year_label"),
    )


@query(
    "p23_p26_names_and_strengths",
    with_catalog("""SELECT primary_genre, primary_genre || ' genre' AS feature, CASE WHEN abs(r) >= 0.7 THEN 'Strong correlation' WHEN abs(r) >= 0.5 THEN 'Moderate correlation'
    WHEN abs(r) >= 0.3 THEN 'Weak correlation' ELSE 'Very weak or no correlation' END AS strength
    FROM (SELECT primary_genre, corr(budget, runtime) AS r FROM catalog GROUP BY primary_genre)"""),
)
def names_and_strengths(spark, sf):
    r = order_catalog(spark, sf, "primary_genre", "budget", "runtime").filter("budget is not null and runtime is not null")
    return r.groupBy("primary_genre").agg(scalars.pearson(F.col("budget"), F.col("runtime")).alias("r")).select(
        "primary_genre", scalars.feature_display_name(F.concat(F.lit("genre::"), "primary_genre")).alias("feature"),
        scalars.strength_label(F.col("r")).alias("strength"),
    )


def _feature_input(spark, sf):
    rows = order_catalog(spark, sf, "id", "primary_genre", "budget", "revenue", "release_date", "runtime", "language", "country")
    rows = rows.withColumn("language", F.when(F.col("language") == "building", F.lit("English|x")).otherwise(F.col("language")))
    rows = rows.withColumn("country", F.when(F.col("country") == "NATION_1", F.lit("united states of America")).otherwise(F.col("country")))
    return prepare_modelling(rows, CUTOFF)


@query(
    "p16_p17_p18_p20_feature_rows",
    with_catalog("""SELECT id, round(ln(1 + budget), 6) AS log_budget, round(ln(1 + budget) * ln(1 + budget), 5) AS log_budget_sq, runtime,
    runtime * runtime AS runtime_sq, CAST(year AS DOUBLE) AS year, round(sin(2 * pi() * month / 12), 6) + 0 AS month_sin, round(cos(2 * pi() * month / 12), 6) + 0 AS month_cos,
    CAST(language = 'building' AS DOUBLE) AS is_english, CAST(country = 'NATION_1' AS DOUBLE) AS is_us_production,
    CAST(coalesce(budget > 0, FALSE) AS DOUBLE) AS budget_observed, CAST(coalesce(runtime > 0, FALSE) AS DOUBLE) AS runtime_observed,
    CAST(primary_genre = '5-LOW' AS DOUBLE) AS low, round(CASE WHEN primary_genre = '5-LOW' THEN coalesce(ln(1 + budget), 0) ELSE 0 END, 6) AS log_budget_x_low
    FROM catalog WHERE release_date <= DATE '2001-07-31'"""),
)
def feature_rows(spark, sf):
    rows = _feature_input(spark, sf)
    extra = category_features(["1-URGENT", "5-LOW"])
    out = rows.select(
        "id", *[c.alias(n) for n, c in base_features().items()], extra["genre::5-LOW"].alias("low"),
        extra["log_budget_x_genre::5-LOW"].alias("log_budget_x_low"),
    )
    out = rounded(out, 6, "log_budget", "month_sin", "month_cos", "log_budget_x_low")
    return rounded(out, 5, "log_budget_sq").withColumns({c: F.col(c) + 0 for c in ("month_sin", "month_cos")}).select(
        "id", *BASE_FEATURES, "low", "log_budget_x_low"
    )


@query(
    "p19_profile_features",
    with_catalog("""SELECT id, CAST(month BETWEEN 1 AND 3 AS DOUBLE) AS q1, CAST(primary_genre = '5-LOW' AS DOUBLE) AS low,
    CAST(primary_genre <> '5-LOW' AS DOUBLE) AS other, CASE WHEN primary_genre = '5-LOW' THEN '5-LOW' ELSE 'Other' END AS grouped
    FROM catalog WHERE release_date <= DATE '2001-07-31'"""),
)
def profile_feature_rows(spark, sf):
    rows = _feature_input(spark, sf)
    f = profile_features(["5-LOW", "Other"], ["Q1 (Jan-Mar)"])
    return rows.select(
        "id", f["quarter::Q1 (Jan-Mar)"].alias("q1"), f["genre::5-LOW"].alias("low"), f["genre::Other"].alias("other"),
        grouped_category(["5-LOW", "Other"]).alias("grouped"),
    )


# filters --------------------------------------------------------------------------------------


@query(
    "f1_f2_f3_f4_selection",
    with_catalog("""SELECT id, year, vote_average, primary_genre, language, country FROM catalog WHERE year BETWEEN 1996 AND 1999 AND vote_average >= 5
    AND contains(lower(primary_genre), 'urg') AND contains(language, 'build') AND contains(lower(country), 'nation_1')"""),
)
def basic_selection(spark, sf):
    # no year column: the year range becomes a range of the date, which the scan can use to skip row groups
    rows = order_catalog(spark, sf, "id", "release_date", "vote_average", "primary_genre", "language", "country", whole_days=False)
    f = {"year_from": 1996, "year_to": 1999, "min_rating": 5, "genre": "URG", "language": "Build", "country": "nation_1"}
    kept = selection.apply_filters(rows, f)
    return kept.withColumn("year", casting.year_column(kept)).drop("release_date")


@query(
    "f5_word_search",
    """SELECT doc_id, lang FROM documents WHERE contains(' ' || trim(regexp_replace(regexp_replace(lower(text), '[\\p{P}\\p{S}]', ' ', 'g'), '\\s+', ' ', 'g')) || ' ', ' la un ')""",
)
def word_search(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return folding.search_words(d, "text", "La, un").select("doc_id", "lang")


@query(
    "f6_f7_f8_token_predicates",
    with_catalog("""SELECT id, contains(' ' || regexp_replace(lower(primary_genre), '[\\p{P}\\p{S}]', ' ', 'g') || ' ', ' low ') AS token_word,
    language = 'building' OR trim(regexp_replace(lower(primary_genre), '[\\p{P}\\p{S}]', ' ', 'g')) = '5 low' AS word_or_token, primary_genre = '5-LOW' AS exact_token,
    primary_genre = '4-NOT SPECIFIED' AS starts, contains(lower(primary_genre), 'o') AS holds FROM catalog"""),
)
def token_predicates(spark, sf):
    r = order_catalog(spark, sf, "id", "keyword", "language", "primary_genre")
    return r.select(
        "id", text.token_word_match(F.col("keyword"), "Low").alias("token_word"),
        (text.same_text(F.col("language"), "Building") | text.token_same_text(F.col("keyword"), "5 low")).alias("word_or_token"),
        text.token_same_text(F.col("keyword"), "5-low").alias("exact_token"),
        text.starts_with_words(F.col("primary_genre"), "4 not").alias("starts"), text.contains_text(F.col("primary_genre"), " O ").alias("holds"),
    )


@query(
    "f9_f10_search_selection",
    """SELECT p_partkey AS id, p_name AS title FROM part WHERE p_size >= 10 AND (contains(' ' || lower(p_name) || ' ', ' ring ') OR lower(p_type) = 'ring')""",
)
def search_selection(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("keyword"), F.col("p_size").cast("double").alias("vote_average")
    )
    return selection.apply_filters(rows, {"min_rating": 10, "title_keyword": " Ring "}).select("id", "title")


NEEDLES = ("Ring", "large ring", "SMALL", "ring, steel", "blue gear", "absent", "...", "g")


@query(
    "f9_indexed_searches",
    f"""SELECT needle, p_partkey AS id FROM part, (SELECT unnest({list(NEEDLES)!r}) AS needle), LATERAL (SELECT
    trim(regexp_replace(regexp_replace(lower(needle), '[\\p{{P}}\\p{{S}}]', ' ', 'g'), '\\s+', ' ', 'g')) AS form) WHERE form <> '' AND
    (contains(' ' || regexp_replace(regexp_replace(lower(p_name), '[\\p{{P}}\\p{{S}}]', ' ', 'g'), '\\s+', ' ', 'g') || ' ', ' ' || form || ' ')
     OR contains(' ' || regexp_replace(regexp_replace(lower(p_type), '[\\p{{P}}\\p{{S}}]', ' ', 'g'), '\\s+', ' ', 'g') || ' ', ' ' || form || ' '))""",
)
def indexed_searches(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("keyword"))
    folder = new_folder(spark)
    search_index.write_index(search_index.build_index(rows, buckets=8), folder)
    return search_index.search(search_index.read_index(spark, folder, buckets=8), NEEDLES)


@query(
    "f11_f12_removal_counts",
    with_catalog("""SELECT CASE WHEN country = 'NATION_3' THEN 'missing_title' WHEN primary_genre = '5-LOW' THEN 'invalid_date'
    WHEN release_date > DATE '2000-06-30' THEN 'after_cutoff' ELSE 'kept' END AS reason, count(*) AS n FROM catalog GROUP BY reason"""),
)
def removal_counts(spark, sf):
    r = order_catalog(spark, sf, "title", "release_date", "country", "primary_genre")
    r = r.withColumns(
        {"title": F.when(F.col("country") != "NATION_3", F.col("title")), "release_date": F.when(F.col("primary_genre") != "5-LOW", F.col("release_date"))}
    )
    reason = F.coalesce(cleaning._removal_reason(r, "2000-06-30"), F.lit("kept"))
    return r.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(
    "f14_positive_pairs",
    with_catalog("SELECT id, budget, revenue FROM catalog WHERE budget > 0 AND revenue > 0"),
)
def positive_pairs(spark, sf):
    return selection.positive_pairs(order_catalog(spark, sf, "id", "budget", "revenue"))


@query(
    "f16_f17_eligible_rows",
    with_catalog("""SELECT year, count(*) AS rows, count(budget) AS with_budget FROM catalog
    WHERE release_date <= DATE '2001-07-31' AND country <> 'NATION_3' AND revenue > 100000 GROUP BY year"""),
)
def eligible(spark, sf):
    r = order_catalog(spark, sf, "id", "title", "primary_genre", "budget", "revenue", "release_date", "country")
    r = r.withColumns(
        {"title": F.when(F.col("country") != "NATION_3", F.col("title")), "revenue": F.when(F.col("revenue") > 100000, F.col("revenue"))}
    )
    rows = eligible_rows(prepare_modelling(r, CUTOFF))
    return rows.groupBy("year").agg(F.count("*").alias("rows"), F.count("budget").alias("with_budget"))


# joins ----------------------------------------------------------------------------------------


@query(
    "j1_j2_j3_merged_sources",
    """SELECT d.doc_id AS id, d.lang, CAST(l.quality AS VARCHAR) AS keywords, CAST(l.toxic AS VARCHAR) AS cast_text FROM documents d
    LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id""",
)
def merged_sources(spark, sf):
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    raw = {
        "movies_metadata": d.select(F.col("doc_id").cast("string").alias("id"), "lang"),
        "keywords": l.select(F.col("doc_id").cast("string").alias("id"), F.col("quality").cast("string").alias("keywords")),
        "credits": l.select(F.col("doc_id").cast("string").alias("id"), F.col("toxic").cast("string").alias("cast"), F.lit("").alias("crew")),
    }
    merged, _ = cleaning.merge_raw(raw)
    return merged.select("id", "lang", "keywords", F.col("cast").alias("cast_text"))


@query(
    "j3_merge_counts",
    """SELECT 'raw_movies_rows' AS metric, count(*) AS value FROM documents UNION ALL SELECT 'invalid_movie_id_rows_removed', count(*) FROM documents WHERE lang = 'fr'
    UNION ALL SELECT 'raw_keywords_rows', count(*) FROM labels UNION ALL SELECT 'ratings_small_rows', count(*) FROM conversations""",
)
def merge_counts(spark, sf):
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    raw = {
        "movies_metadata": d.select(F.when(F.col("lang") == "fr", "1997-08-20").otherwise(F.col("doc_id").cast("string")).alias("id")),
        "keywords": l.select(F.col("doc_id").alias("id"), F.col("quality").alias("keywords")), "ratings_small": table(spark, sf, "conversations"),
    }
    return cleaning.merge_raw(raw)[1]


@query(
    "j4_flag_backfill",
    with_catalog("""SELECT c.id, CASE WHEN l_orderkey IS NOT NULL THEN l.budget > 50000 ELSE FALSE END AS budget_observed, TRUE AS revenue_observed,
    CASE WHEN l_orderkey IS NOT NULL THEN l.runtime > 60 ELSE FALSE END AS runtime_observed FROM catalog c LEFT JOIN lines l ON c.id = l_orderkey"""),
)
def flag_backfill(spark, sf):
    rows = order_catalog(spark, sf, "id", "revenue", "budget", "runtime").withColumn("source_id", F.col("id"))
    raw = order_catalog(spark, sf, "id", "revenue", "budget", "runtime").withColumns(
        {"budget": F.col("budget") - 50000, "runtime": F.col("runtime") - 60}
    ).filter("budget is not null")
    return cleaning.backfill_observed(rows, raw).select("id", "budget_observed", "revenue_observed", "runtime_observed")


@query(
    "j9_u3_selection_change",
    """SELECT count(*) FILTER (b AND NOT a) AS added, count(*) FILTER (a AND NOT b) AS removed
    FROM (SELECT year(o_orderdate) >= 1998 AS a, o_totalprice > 250000 AS b FROM orders)""",
)
def selection_change(spark, sf):
    rows = order_catalog(spark, sf, "id", "year", "revenue")
    return selection.selection_change(rows.filter("year >= 1998"), rows.filter("revenue > 250000"))


@query(
    "j9_selection_change_by_row",
    with_catalog("""SELECT count(*) FILTER (b AND NOT a) AS added, count(*) FILTER (a AND NOT b) AS removed FROM
    (SELECT title, release_date, year, bool_or(year >= 1998) AS a, bool_or(revenue > 250000) AS b FROM catalog GROUP BY ALL)"""),
)
def selection_change_by_row(spark, sf):
    rows = order_catalog(spark, sf, "title", "release_date", "year", "revenue")
    return selection.selection_change(rows.filter("year >= 1998"), rows.filter("revenue > 250000"))


# sorts and set operations ---------------------------------------------------------------------


@query(
    "o2_top_titles",
    with_catalog("""SELECT title, primary_genre, year, vote_average, runtime, revenue FROM catalog
    ORDER BY vote_average DESC NULLS LAST, revenue DESC NULLS LAST, title, id LIMIT 25"""),
)
def top_titles(spark, sf):
    rows = order_catalog(spark, sf, "id", "title", "primary_genre", "year", "vote_average", "runtime", "revenue")
    return selection.top_titles(rows, 25)


_ORDER = [("runtime", True), ("vote_average", False), ("id", True)]


@query(
    "o3_o4_sorted_page",
    with_catalog("SELECT id, runtime, vote_average FROM catalog ORDER BY runtime NULLS LAST, vote_average DESC NULLS LAST, id LIMIT 120 OFFSET 240"),
)
def sorted_page(spark, sf):
    return selection.page(order_catalog(spark, sf, "id", "runtime", "vote_average"), 2, _ORDER)


@query(
    "o4_page_after_row",
    with_catalog("""SELECT id, primary_genre, revenue FROM catalog WHERE primary_genre > '3-MEDIUM' OR (primary_genre = '3-MEDIUM' AND revenue < 250000)
    ORDER BY primary_genre, revenue DESC, id LIMIT 120"""),
)
def page_after_row(spark, sf):
    rows = order_catalog(spark, sf, "id", "primary_genre", "revenue")
    last = {"primary_genre": "3-MEDIUM", "revenue": 250000.0, "id": 10**15}
    return selection.page_after(rows, last, [("primary_genre", True), ("revenue", False), ("id", True)])


@query("o4_page_count", "SELECT count(*) AS rows, CAST(ceil(count(*) / 120.0) AS BIGINT) AS pages FROM orders")
def page_count(spark, sf):
    return selection.page_count(order_catalog(spark, sf, "id"))


@query("g25_u1_distinct_categories", "SELECT DISTINCT o_orderpriority AS primary_genre FROM orders")
def distinct_categories(spark, sf):
    return selection.distinct_categories(order_catalog(spark, sf, "primary_genre"))


@query(
    "u1_first_row_per_key",
    """SELECT l_orderkey, l_linenumber, min(l_shipdate) AS l_shipdate FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def first_row_per_key(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return dedup.first_per_key(lines, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate")])
