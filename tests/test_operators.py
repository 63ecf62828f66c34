"""Operators against pandas/numpy or against brute force on small in-line data."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalens.operators import folding, oplog, quantiles, search_index
from catalens.operators.dedup import (
    deduplicate_ids, deduplicate_ranked, deduplicate_signatures, disambiguate_titles, first_per_key, rank_rows, with_signature,
)
from catalens.operators.quantiles import exact_medians, exact_quantiles
from catalens.operators.selection import apply_filters, page, page_after, promote_sort, selection_change, top_titles
from catalens.operators.sequence import latest_rows_flag, number_rows, number_within, running_count
from catalens.operators import summaries, trends
from catalens.operators.quality import fingerprint, quality_report


@pytest.mark.parametrize("accuracy", [10_000, 60])
def test_exact_quantiles_equal_pandas(spark, accuracy):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(
        {
            "g": rng.choice(["a", "b", "c", None], 4000, p=[0.6, 0.3, 0.09, 0.01]),
            "x": np.round(rng.lognormal(3, 2, 4000), 2),
            "y": rng.integers(0, 6, 4000).astype(float),
        }
    )
    frame.loc[frame.index % 11 == 0, "x"] = np.nan
    tiny = pd.DataFrame({"g": ["one", "two", "two", "none"], "x": [4.0, 1.0, 2.0, np.nan], "y": [1.0, 2.0, 8.0, np.nan]})
    frame = pd.concat([frame, tiny], ignore_index=True)
    df = spark.createDataFrame(frame).repartition(7)
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = exact_quantiles(df, ["g"], {"x": "x", "y": "y"}, probs, accuracy).toPandas()
    assert "none" not in set(got.g)
    for (g, m, p), value in got.set_index(["g", "measure", "probability"])["value"].items():
        rows = frame[frame.g.isna()] if pd.isna(g) else frame[frame.g == g]
        assert value == pytest.approx(rows[m].quantile(p), rel=1e-12), (g, m, p)
    assert len(got) == 6 * 2 * len(probs)
    whole = exact_medians(df, [], {"x": "x", "y": "y"}).first()
    assert whole.x == pytest.approx(frame.x.median()) and whole.y == frame.y.median()


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles_of_many_values_inside_a_bracket(spark, monkeypatch, accuracy):
    monkeypatch.setattr(quantiles, "CELLS", 8)
    rng = np.random.default_rng(1)
    columns = {
        "wide": np.exp(rng.uniform(-600, 600, 1500)) * rng.choice([-1, 1], 1500), "even": np.arange(1500.0), "one": np.full(1500, 7.0),
        "heavy": np.where(rng.random(1500) < 0.7, 3.0, rng.normal(size=1500)), "ends": np.where(rng.random(1500) < 0.3, np.inf, rng.normal(size=1500)),
    }
    frame = pd.DataFrame(columns)
    probs = (0.0, 0.1, 0.5, 0.503, 1.0)
    got = exact_quantiles(spark.createDataFrame(frame), [], {c: c for c in columns}, probs, accuracy).toPandas()
    for r in got.itertuples():
        ranks = np.sort(columns[r.measure])[[int(np.floor(r.probability * 1499)), int(np.ceil(r.probability * 1499))]]
        assert (r.lower, r.upper) == tuple(ranks), r
    assert len(got) == 25


@pytest.mark.parametrize("sample", [40, 10**6])
def test_quantiles_of_growing_groups(spark, monkeypatch, sample):
    monkeypatch.setattr(quantiles, "SAMPLE_ROWS", sample)
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"g": rng.choice(["a", "b", None], 600, p=[0.7, 0.25, 0.05]), "year": rng.integers(2000, 2006, 600), "x": np.round(rng.lognormal(2, 2, 600), 1)})
    frame.loc[frame.index % 7 == 0, "x"] = np.nan
    grown = quantiles.Cumulative("year", "until", (2001, 2003, 2006, 2009))
    got = exact_quantiles(spark.createDataFrame(frame), ["g"], {"x": "x"}, (0.5, 0.9), accuracy=50, cumulative=grown).toPandas()
    for r in got.itertuples():
        own = frame[(frame.year < r.until) & (frame.g.isna() if pd.isna(r.g) else frame.g == r.g)].x.dropna()
        assert r.n == len(own) and r.value == pytest.approx(own.quantile(r.probability)), r
    assert len(got) == 3 * 4 * 2


@pytest.mark.parametrize("edge", [-1e9, 40.5, 1e9])
def test_a_bracket_that_missed_is_opened(spark, monkeypatch, edge):
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda c, edges, accuracy: F.array(*[F.lit(edge)] * len(edges)))
    df = spark.createDataFrame([("a" if i % 2 else None, float(i)) for i in range(100)], "g string, x double")
    got = exact_quantiles(df, ["g"], {"x": "x"}, (0.0, 0.5, 0.9)).toPandas()
    for g, own in got.groupby(got.g.fillna("")):
        values = pd.Series(np.arange(1.0, 100, 2) if g else np.arange(0.0, 100, 2))
        assert own.set_index("probability")["value"].to_dict() == pytest.approx({p: values.quantile(p) for p in (0.0, 0.5, 0.9)})


def test_first_per_key_takes_the_smallest(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (None, 9, "c"), (None, 2, "d")], "k int, o int, v string")
    assert {r.v for r in first_per_key(df, ["k"], [F.col("o")]).collect()} == {"b", "d"}


def test_first_per_key_with_nulls_ties_and_hot_keys(spark):
    rows = [(None if i % 3 == 0 else i % 7, None if i % 5 == 0 else float(i % 4), f"v{i % 11}") for i in range(400)]
    df = spark.createDataFrame(rows + rows, "k int, o double, v string")
    got = first_per_key(df, ["k"], [F.col("o"), F.col("v")]).collect()
    want = {}
    for k, o, v in rows:
        mine = (o is not None, o or 0.0, v)
        if k not in want or mine < want[k]:
            want[k] = mine
    assert {r.k: (r.o is not None, r.o or 0.0, r.v) for r in got} == want and len(got) == len(want)
    by_text = first_per_key(df, ["k"], [F.col("v"), F.col("o")])
    assert by_text.count() == len(want) and {r.v for r in by_text.collect()} == {"v0"}


def test_numbers_in_groups_and_running_counts(spark):
    rows = [(None if i % 3 == 0 else i % 2, i * 37 % 101, i % 4 == 0 or None) for i in range(101)]
    df = spark.createDataFrame(rows, "g int, t int, start boolean").repartition(7)
    placed = number_within(df, ["g"], [F.col("t")]).collect()
    for g in {r[0] for r in rows}:
        mine = sorted((r.t, r.place) for r in placed if r.g == g)
        assert [p for _, p in mine] == list(range(1, len(mine) + 1))
    for by in ((), ("g",)):
        counted = running_count(df, F.col("start"), [F.col("t")], "n", by).collect()
        for g in {r[0] for r in rows} if by else {None}:
            mine = sorted((r for r in counted if not by or r.g == g), key=lambda r: r.t)
            total = 0
            for r in mine:
                total += bool(r.start)
                assert r.n == total
    assert running_count(df.limit(0), F.col("start"), [F.col("t")], "n").count() == 0


def test_sessions_of_a_log(spark):
    rows = [("view", 1, "a"), ("app_started", 2, "a"), ("view", 3, "b"), ("app_started", 3, "b"), ("app_started", 4, "b"), (None, 5, "a")]
    log = spark.createDataFrame(rows, "event string, timestamp int, user string")
    numbered = oplog.session_numbers(log, tie="event")
    assert {(r.event, r.timestamp): r.session for r in numbered.collect()} == {
        ("view", 1): 0, ("app_started", 2): 1, ("app_started", 3): 2, ("view", 3): 2, ("app_started", 4): 3, (None, 5): 3,
    }
    own = oplog.session_numbers(log, tie="event", by=["user"])
    assert {(r.event, r.timestamp): r.session for r in own.collect()}[(None, 5)] == 1
    assert [tuple(r) for r in oplog.session_summary(numbered).orderBy("session").collect()] == [(0, 1, 1, 1), (1, 1, 2, 2), (2, 2, 3, 3), (3, 2, 4, 5)]


def test_one_title_on_a_third_of_all_rows_gets_numbers(spark):
    rows = [(f"Other {i}" if i % 3 else "Ｓame", 2001, float(-i)) for i in range(90)]
    df = spark.createDataFrame(rows, "title string, year int, vote_count double")
    got = {int(-r.vote_count): r.title for r in disambiguate_titles(with_signature(df)).collect()}
    same = [got[i] for i in range(0, 90, 3)]
    assert same == ["Ｓame"] + [f"Ｓame #{n}" for n in range(2, 31)]
    assert all(got[i] == f"Other {i}" for i in range(90) if i % 3)


def test_folding_equals_python_and_settled_ranges_hold(spark):
    import unicodedata

    joins = {int(d.split()[1], 16) for c in range(0x110000) if (d := unicodedata.decomposition(chr(c))) and "<" not in d and " " in d}
    joins |= set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for lo, hi in folding.SETTLED:
        for c in range(lo, hi + 1):
            assert unicodedata.normalize("NFKC", chr(c)) == chr(c) and not unicodedata.combining(chr(c)) and c not in joins, hex(c)
    random.seed(3)
    letters = ["a", " ", "é", "e\u0301", "ﬁ", "①", "Ａ", "漢", "\u1100\u1161", "\u00a0", "ｶ\uff9e", "\u0301", "™", "“", "Ω"]
    texts = ["".join(random.choice(letters) for _ in range(random.randrange(12))) for _ in range(400)] + ["", None, "plain", "  two  blanks "]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "i int, a string, b string")
    got = folding.fold_unicode(df, ["a", "b"]).collect()
    assert len(got) == len(texts)
    for r in got:
        want = texts[r.i] and unicodedata.normalize("NFKC", texts[r.i])
        assert (r.a, r.b) == (want, want)
    found = {r.i for r in folding.search_words(df, "a", "①").collect()}
    shown = {i: "".join(" " if unicodedata.category(c)[0] in "PS" else c for c in unicodedata.normalize("NFKC", t or "").lower()) for i, t in enumerate(texts)}
    assert found == {i for i, t in shown.items() if re.search(r"(?<!\w)1(?!\w)", t)}


def test_index_finds_what_a_scan_finds(spark, tmp_path):
    rng = random.Random(12)
    words = ["Ring", "the", "ＲＩＮＧ", "e\u0301t", "ét", "10", "a'b", "\u0301", "x-y", "™", "漢字"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(5))), "|".join(rng.choice(words) for _ in range(rng.randrange(4)))) for i in range(200)]
    rows += [(900, None, None), (901, "", "the ring"), (902, "the  ring", None)]
    df = spark.createDataFrame(rows, "id long, title string, keyword string").withColumns({c: F.lit(1) for c in ("word", "form", "bucket", "forms")})
    search_index.write_index(search_index.build_index(df, buckets=4), str(tmp_path))
    index = search_index.read_index(spark, str(tmp_path), buckets=4)
    needles = ["ring", "the ring", "THE", "ét", "a b", "y x", "tm", "漢字 10", "", "!", "\u0301", "absent", "ring"]
    got = [tuple(r) for r in search_index.search(index, needles).collect()]
    assert len(got) == len(set(got))
    for n in needles:
        assert {i for m, i in got if m == n} == ({r.id for r in apply_filters(df, {"title_keyword": n}).collect()} if n else set()), n
    assert search_index.search(search_index.build_index(df.limit(0)), needles).count() == 0 == search_index.search(index, []).count()
    only = search_index.build_index(df.select("id", "title"))
    assert {r.id for r in search_index.search(only, ["the"]).collect()} == {r.id for r in apply_filters(df.drop("keyword"), {"keyword": "the"}).collect()}


def _serial_titles(rows):
    """The sequential rule, for comparison."""
    import unicodedata

    def key(t):
        return " ".join(unicodedata.normalize("NFKC", t or "").strip().lower().split())

    used, out = {}, {}
    for r in rows:
        taken = used.setdefault((key(r["title"]), r["year"]), set())
        options = []
        if r["original_title"] and key(r["original_title"]) != key(r["title"]):
            options.append(f"{r['title']} ({r['original_title']})")
        options += [f"{r['title']} ({r['release_date']})", f"{r['title']} [{r['original_language'].upper()}]"]
        if r["id"] is not None:
            options.append(f"{r['title']} #{r['id']}")
        options.append(r["title"])
        pick = next((o for o in options if key(o) not in taken), None)
        n = 2
        while pick is None:
            if key(f"{r['title']} #{n}") not in taken:
                pick = f"{r['title']} #{n}"
            n += 1
        taken.add(key(pick))
        out[(r["title"], r["original_title"], r["original_language"], r["year"])] = pick
    return out


def test_disambiguation_equals_sequential_rule(spark):
    random.seed(5)
    rows, seen = [], set()
    for i in range(120):
        title = random.choice(["Harbour", "Lagoon", "harbour"])
        # originals that look like dates make candidates of different kinds compete
        original = random.choice([title, "À Deriva", "2009-07-31", "2009-07-30", "Choi Voi"])
        language = random.choice(["pt", "vi", "en"])
        signature = (title.lower(), original.lower(), language)
        if signature in seen:
            continue
        seen.add(signature)
        rows.append(
            dict(
                id=random.choice([2, 3, 4]), title=title, original_title=original, original_language=language,
                release_date=random.choice(["2009-07-30", "2009-07-31"]), year=2009, vote_count=float(1000 - i),
            )
        )
    assert len(rows) > 20
    df = spark.createDataFrame(
        [tuple(r.values()) for r in rows],
        "id long, title string, original_title string, original_language string, release_date string, year int, vote_count double",
    ).withColumn("release_date", F.col("release_date").cast("date"))
    keyed = deduplicate_signatures(df)
    assert keyed.count() == len(rows)
    got = {
        (r._title_key, r._original_key, r._language_key): r.title
        for r in disambiguate_titles(keyed).collect()
    }
    want = {
        (k[0].lower(), k[1].lower(), k[2]): v for k, v in _serial_titles(rows).items()
    }
    assert got == want


def test_rows_do_not_travel_to_meet_offsets_and_travel_once_to_be_chosen(spark, capsys):
    df = spark.range(40_000).select(
        (F.col("id") % 30_011).alias("id"), F.concat(F.lit("T "), (F.hash("id") % 9_000).cast("string")).alias("title"),
        F.lit("en").alias("language"), F.lit(2009).alias("year"), (F.col("id") * 7919 % 40_009).cast("double").alias("vote_count"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        ranked = rank_rows(with_signature(df))
        ranked.explain()
        assert "Exchange hashpartitioning" not in capsys.readouterr().out
        chosen = deduplicate_ranked(ranked)
        chosen.explain("simple")
        plan = capsys.readouterr().out
        assert plan.count("vote_count") and plan.count("LeftSemi") == 2
        got = {(r.id, r.title, r.vote_count) for r in chosen.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    frame = df.toPandas().sort_values("vote_count", ascending=False)
    frame = frame.drop_duplicates("id").drop_duplicates("title")
    assert got == set(zip(frame.id, frame.title, frame.vote_count))
    single = rank_rows(with_signature(df.dropDuplicates(["id"])))
    once = deduplicate_ranked(single, unique_ids=True)
    once.explain()
    assert capsys.readouterr().out.count("LeftSemi") == 1
    assert {r._rank for r in once.collect()} == {r._rank for r in deduplicate_ranked(single).collect()}


def test_number_rows_and_latest_flag(spark):
    df = spark.range(1000).select(
        F.date_add(F.lit("2010-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("release_date"),
        F.concat(F.lit("t"), (F.col("id") * 37 % 1000).cast("string")).alias("title"), "id",
    )
    rows = number_rows(df.repartition(5), [F.col("release_date"), F.col("title")]).toPandas().sort_values("position")
    assert rows.position.tolist() == list(range(1, 1001))
    expected = df.toPandas().sort_values(["release_date", "title"]).title.tolist()
    assert rows.title.tolist() == expected
    flagged = latest_rows_flag(df, 210, [F.col("title"), F.col("id")]).toPandas()
    assert set(flagged[flagged.is_latest].title) == set(expected[-210:]) and len(flagged) == 1000
    assert latest_rows_flag(df, 5000, [F.col("title")]).filter("is_latest").count() == 1000


SEARCH = [
    ("Owl at Noon", "Nature", 1988, 7.9, "night bird|forest|at dawn"),
    ("Attic", "Mystery", 2016, 7.1, "old house|batch"),
    ("Night-Bird!", "Nature", 2003, 6.4, "heron|wetland"),
    ("Forest Law", "Drama", 1961, 5.2, "court|land bird night"),
    ("Up", "Natural History", 1999, 6.9, "balloon|supper"),
]


@pytest.fixture(scope="module")
def search(spark):
    return spark.createDataFrame(SEARCH, "title string, primary_genre string, year int, vote_average double, keyword string")


@pytest.mark.parametrize(
    "query, titles",
    [
        ("at", {"Owl at Noon"}),  # neither in "Attic" nor in "batch"
        ("up", {"Up"}),
        ("night bird", {"Owl at Noon", "Night-Bird!"}),
        ("NIGHT -- bird", {"Owl at Noon", "Night-Bird!"}),
        ("forest", {"Owl at Noon", "Forest Law"}),
        ("heron", {"Night-Bird!"}),
        (" \t ", set()),
        ("bird|forest", set()),  # no match across tokens
    ],
)
def test_word_search(search, query, titles):
    assert {r.title for r in apply_filters(search, {"title_keyword": query}).collect()} == titles


def test_filters_commute_and_combine(search):
    f = {"year_from": 1985, "year_to": 2005, "min_rating": 6.5, "genre": "natur"}
    at_once = {r.title for r in apply_filters(search, f).collect()}
    step = search
    for k in reversed(f):
        step = apply_filters(step, {k: f[k]})
    assert at_once == {r.title for r in step.collect()} == {"Owl at Noon", "Up"}
    assert apply_filters(search, {"genre": "All"}).count() == 5


def test_paging_and_sort_state(search):
    order = [("vote_average", False), ("title", True)]
    first = page(search, 0, order, 2).collect()
    second = page(search, 1, order, 2).collect()
    keyed = page_after(search, first[-1].asDict(), order, 2).collect()
    assert second == keyed and [r.title for r in first] == ["Owl at Noon", "Attic"]
    assert promote_sort([("revenue", False), ("title", True)], "title") == [("title", False), ("revenue", False)]
    assert promote_sort([("revenue", False)], "title")[0] == ("title", True)
    assert [r.title for r in top_titles(search, 2).collect()] == ["Owl at Noon", "Attic"]


def test_selection_change(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, title string")
    b = spark.createDataFrame([(2, "y"), (4, "w")], "id int, title string")
    assert selection_change(a, b).first() == (1, 2)
    dup = spark.createDataFrame([(2, "Y "), (2, "q"), (None, None)], "id int, title string")
    assert selection_change(b, dup).first() == (2, 1)


def _panel(spark, frame):
    return spark.createDataFrame(frame)


def test_summaries_equal_pandas(spark):
    rng = np.random.default_rng(1)
    n = 500
    frame = pd.DataFrame(
        {
            "id": range(n), "title": [f"t{i}" for i in range(n)],
            "primary_genre": rng.choice(["Action", "Drama|Comedy", "Comedy, Horror", " "], n),
            "year": rng.integers(1988, 2012, n), "vote_average": np.round(rng.uniform(0, 10, n), 1),
            "revenue": rng.lognormal(10, 1, n), "budget": rng.lognormal(9, 1, n), "runtime": rng.integers(60, 200, n).astype(float),
        }
    )
    df = _panel(spark, frame)
    tokens = frame.assign(g=frame.primary_genre.map(lambda s: [p.strip() for p in s.replace("|", ",").split(",")])).explode("g")
    tokens = tokens[tokens.g != ""]
    want = tokens.groupby("g").agg(c=("vote_average", "count"), r=("vote_average", "mean"))
    got = summaries.category_summary(df, None).toPandas().set_index("genre")
    assert got.movie_count.to_dict() == want.c.to_dict()
    assert np.allclose(got.avg_rating.loc[want.index], want.r)
    over = summaries.dataset_overview(df, None).first()
    assert over.movie_count == n and over.genre_count == 4 and over.median_runtime == frame.runtime.median()
    assert over.total_revenue == pytest.approx(frame.revenue.sum())
    per = frame.groupby("year").title.count()
    slope, intercept = np.polyfit(per.index - per.index.min(), per.values, 1)
    trend = trends.production_trend(df, digits=False).first()
    assert trend.trend_slope == pytest.approx(slope) and trend.regression_intercept == pytest.approx(intercept)
    assert trend.peak_year == per.idxmax() and trend.average_growth_rate == pytest.approx(per.pct_change().mean() * 100)
    series = trends.time_series_summary(df, digits=False).first()
    rev = frame.groupby("year").revenue.sum()
    assert series.latest_revenue_ma3 == pytest.approx(rev.rolling(3, min_periods=1).mean().iloc[-1])
    assert series.strongest_revenue_growth_year == rev.pct_change().idxmax()
    corr = trends.budget_revenue_correlation(df, digits=False).first()
    assert corr.correlation == pytest.approx(np.corrcoef(frame.budget, frame.revenue)[0, 1])
    roi = (frame.revenue - frame.budget) / frame.budget * 100
    assert corr.median_roi == pytest.approx(roi.median()) and corr.best_roi_movie == frame.title[roi.idxmax()]
    out = trends.outlier_summary(df, digits=False).first()
    q1, q3 = frame.revenue.quantile([0.25, 0.75])
    mask = (frame.revenue < q1 - 1.5 * (q3 - q1)) | (frame.revenue > q3 + 1.5 * (q3 - q1))
    z = (frame.revenue - frame.revenue.mean()).abs() / frame.revenue.std(ddof=0) > 3
    assert (out.iqr_outliers, out.z_score_outliers) == (mask.sum(), z.sum())
    assert out.example_titles == frame.title[mask].head(10).tolist()
    facts = summaries.insights(df).toPandas()
    assert sorted(facts.position) == [1, 2, 3, 4, 5]
    meta = summaries.selection_meta(df, df.filter("year >= 2000")).first()
    assert meta.input_rows == n and meta.filtered_rows == (frame.year >= 2000).sum() and meta.first_year == 2000
    line = trends.log_log_line(df)
    assert line.first().slope == pytest.approx(np.polyfit(np.log10(frame.budget), np.log10(frame.revenue), 1)[0])
    points = trends.log_log_points(line).toPandas()
    assert len(points) == 200 and points.budget.max() == pytest.approx(frame.budget.max())
    decades = summaries.decade_summary(df, None)
    leader = summaries.decade_leaders(decades).first()
    assert leader.most_productive_decade == frame.groupby(frame.year // 10 * 10).title.count().idxmax()


def test_empty_selection(spark, search):
    none = search.withColumn("runtime", F.lit(1.0)).filter("year > 3000")
    assert [r.text for r in summaries.insights(none).collect()] == ["nothing selected"]
    assert summaries.dataset_overview(none).first() == (0, 0, 0.0, 0.0, 0.0)


def test_degenerate_statistics(spark):
    flat = spark.createDataFrame([(1, "a", 5.0, 10.0), (2, "b", 5.0, 20.0)], "id int, title string, budget double, revenue double")
    r = trends.budget_revenue_correlation(flat).first()
    assert (r.correlation, r.regression_slope, r.regression_intercept, r.r_squared) == (0.0, 0.0, 15.0, 0.0)
    assert trends.budget_revenue_correlation(flat.limit(1)).count() == 0
    one = spark.createDataFrame([("a", 2000, 7.0)], "title string, year int, vote_average double")
    t = trends.production_trend(one).first()
    assert (t.trend_slope, t.average_growth_rate, t.regression_intercept, t.trend_direction) == (0.0, 0.0, 1.0, "stable")
    same = spark.createDataFrame([(1, "a", 4.0)] * 3, "id int, title string, revenue double")
    o = trends.outlier_summary(same).first()
    assert (o.z_score_outliers, o.iqr_outliers, o.example_titles) == (0, 0, [])


def test_fingerprint_is_order_independent(spark, search):
    a = fingerprint(search).first()
    assert a == fingerprint(search.repartition(3).orderBy("title")).first()
    assert a.fingerprint != fingerprint(search.withColumn("title", F.concat("title", F.lit("x")))).first().fingerprint
    assert a.row_count == 5


def test_quality_report(spark):
    df = spark.createDataFrame(
        [(1, "a", "D", "2001-01-01", 5.0), (2, None, "D", "2003-01-01", 7.5)],
        "id int, title string, primary_genre string, release_date string, revenue double",
    )
    got = {(r.column, r.metric): r.value for r in quality_report(df, df, "2017-07-31").collect()}
    assert got[("title", "missing")] == "1" and got[("revenue", "median")] == "6.25"
    assert got[("release_date", "source_start")] == "2001-01-01" and got[("primary_genre", "distinct")] == "1"


def test_brackets_of_a_sample_hold_their_ranks(spark, monkeypatch):
    rng = np.random.default_rng(23)
    frame = pd.DataFrame({"g": rng.choice(["a", "b"], 40_000), "year": rng.integers(2000, 2006, 40_000), "x": rng.normal(size=40_000)})
    monkeypatch.setattr(quantiles, "SAMPLE_ROWS", 8_000)
    opened, counted = [], quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda long, group, brackets: opened.append(brackets.count()) or counted(long, group, brackets))
    grown = quantiles.Cumulative("year", "until", (2003, 2006))
    got = exact_quantiles(spark.createDataFrame(frame), ["g"], {"x": "x"}, cumulative=grown).toPandas()
    for r in got.itertuples():
        assert r.value == frame[(frame.g == r.g) & (frame.year < r.until)].x.median()
    assert len(got) == 4 and sum(opened) == 0  # no bracket is opened, which would multiply the rows by the thresholds
