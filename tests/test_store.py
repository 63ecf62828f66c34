"""Versioned results, cleaning of changed parts, observed figures and quantile sketches."""

import pytest
from pyspark.sql import functions as F

from catalens import staging
from catalens.operators.quality import part_fingerprints
from catalens.operators.sketches import growing_sketches, merge_sketches, quantile_sketches, rank_error, sketched_quantiles
from catalens.plans import incremental
from catalens.plans.cleaning import clean_catalog
from catalens.sources import versions
from catalens.staging import spread, stage_counted


def test_versions_are_whole_or_not_there(spark, tmp_path):
    folder = str(tmp_path)
    assert versions.find_version(spark, folder) is None and versions.versions(spark, folder).count() == 0
    assert versions.remove_versions(spark, folder) == 0
    one, two = spark.range(3), spark.range(5)
    first = versions.write_version(spark, folder, {"a": one, "b": two}, {"k": "1"})

    def fails():
        raise RuntimeError("lost")

    class Broken:  # a run that ends between its tables
        write = property(lambda self: fails())

    with pytest.raises(RuntimeError):
        versions.write_version(spark, folder, {"a": two, "b": Broken()}, {"k": "2"})
    assert versions.find_version(spark, folder) == first
    assert versions.find_version(spark, folder, {"k": "2"}) is None
    last = versions.write_version(spark, folder, {"a": two, "b": one}, {"k": "3"})
    assert last.number > first.number and versions.find_version(spark, folder, {"k": "1"}) == first
    read = versions.read_version(spark, folder, versions.find_version(spark, folder))
    assert (read["a"].count(), read["b"].count()) == (5, 3)
    assert versions.remove_versions(spark, folder, keep=1) == 2  # the first one and what broke off
    assert [r.version for r in versions.versions(spark, folder).collect()] == [last.name]


def test_figures_come_with_the_write(spark):
    rows = spark.range(1000, numPartitions=5).repartition(3)
    staged, got = stage_counted(rows, {"n": F.count("*"), "most": F.max("id")})
    assert got == {"n": 1000, "most": 999} and staged.count() == 1000
    empty, got = stage_counted(rows.filter("id < 0"), {"n": F.count("*"), "most": F.max("id")})
    assert got == {"n": 0, "most": None} and empty.count() == 0
    assert stage_counted(spark.createDataFrame([], "id long"), {"n": F.count("*")})[1] == {"n": 0}


SCHEMA = "part string, id string, title string, genres string, release_date string, revenue string"


def source(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def all_rows(frame):
    return sorted(map(str, frame.collect()))


def test_changed_parts_give_the_full_result(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    rows = [(p, str(10 * k + i), f"t{i}", "Drama", f"2000-01-{i + 1:02d}", str(i * 10)) for k, p in enumerate("abc") for i in range(4)]
    rows += [(None, "90", "t1", "Drama", "2000-02-01", None), (None, None, None, None, None, None)]
    first = incremental.clean_changed(source(spark, rows), folder, "part")
    assert {(r.part, r.state) for r in first.parts.collect()} == {("a", "new"), ("b", "new"), ("c", "new"), (None, "new")}
    assert all_rows(first.cleaned.table) == all_rows(clean_catalog(source(spark, rows).drop("part")).table)

    parsed = []
    plain = incremental.parse_raw
    monkeypatch.setattr(incremental, "parse_raw", lambda df: parsed.append(df) or plain(df))
    again = incremental.clean_changed(source(spark, rows[::-1]), folder, "part")  # another order is no change
    assert {r.state for r in again.parts.collect()} == {"same"} and not parsed

    later = [r for r in rows if r[0] != "a"] + [("d", "70", "t2", "Drama", "2000-01-05", "7")]
    later = [("b", *r[1:5], "999") if r[:2] == ("b", "10") else r for r in later]
    now = incremental.clean_changed(source(spark, later), folder, "part", max_runs=1)
    assert {(r.part, r.state) for r in now.parts.collect()} == {("a", "removed"), ("b", "changed"), ("c", "same"), (None, "same"), ("d", "new")}
    assert {r._part for r in parsed[0].select("_part").distinct().collect()} == {"b", "d"}
    want = clean_catalog(source(spark, later).drop("part"))
    assert all_rows(now.cleaned.table) == all_rows(want.table) and all_rows(now.cleaned.metrics) == all_rows(want.metrics)
    # with one run allowed, what was the same has been put together with the rest
    assert incremental.tidy(spark, folder) > 0
    kept = incremental.clean_changed(source(spark, later), folder, "part")
    assert {r.state for r in kept.parts.collect()} == {"same"} and all_rows(kept.cleaned.table) == all_rows(want.table)
    other = incremental.clean_changed(source(spark, later), folder, "part", cutoff="2000-01-02")
    assert {r.state for r in other.parts.collect()} == {"new"}  # nothing is known for another cutoff
    none = incremental.clean_changed(source(spark, []), folder, "part")
    assert none.cleaned.table.count() == 0


def test_part_fingerprints(spark):
    one = spark.createDataFrame([("p", "", None), ("p", "x", "y"), ("q", None, "")], "part string, a string, b string")
    got = {r.part: (r.rows, r.fingerprint) for r in part_fingerprints(one, "part").collect()}
    assert got["p"][0] == 2 and got["q"][0] == 1
    moved = {r.part: (r.rows, r.fingerprint) for r in part_fingerprints(one.orderBy(F.desc("a")).select("b", "a", "part"), "part").collect()}
    assert moved == got
    swapped = spark.createDataFrame([("q", "", None)], "part string, a string, b string")
    assert part_fingerprints(swapped, "part").first().fingerprint != got["q"][1]


def test_quantile_sketches_keep_their_rank_error(spark):
    k = 256
    n = 60_000
    rows = spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 3).cast("string"))).alias("g"),
        (F.col("id") % 5 + 2000).cast("int").alias("year"), (F.xxhash64("id") % 1000).cast("double").alias("v"),
        F.lit(None).cast("double").alias("w"),
    )
    yearly = quantile_sketches(rows, ["g", "year"], {"v": "v", "w": "w"}, k)
    assert {r.measure for r in yearly.select("measure").distinct().collect()} == {"v"}  # no row without values
    grown = growing_sketches(yearly, ["g"], "year", "fold", (2001, 2003, 2005), k)
    table = rows.toPandas()
    for r in sketched_quantiles(grown, (0.0, 0.25, 0.5, 1.0)).collect():
        v = table[(table.g == r.g) & (table.year < r.fold)].v
        assert r.n == len(v)
        slack = 3 * rank_error(k) * len(v) + 1
        assert (v < r.value).sum() - slack <= r.probability * len(v) <= (v <= r.value).sum() + slack
        assert r.value in set(v)
    whole = merge_sketches(yearly, [], k).first()
    assert whole.n == n
    few = spark.createDataFrame([(x,) for x in (5.0, 1.0, 3.0, float("nan"), None)], "v double")
    got = sketched_quantiles(quantile_sketches(few, [], {"v": "v"}), (0.0, 0.5, 1.0)).collect()
    assert [(r.n, r.value) for r in got] == [(3, 1.0), (3, 3.0), (3, 5.0)]


def test_one_file_is_parsed_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "ROWS_A_TASK", 10)
    rows = [("ab"[i % 2], str(i), f"t{i}", "Drama", "2000-01-01", str(i)) for i in range(60)]
    source(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/source")
    raw = spark.read.parquet(f"{tmp_path}/source")
    folder = f"{tmp_path}/state"
    made = incremental.clean_changed(raw, folder, "part")
    (run,) = versions.folders(spark, f"{folder}/parsed", "run=")
    assert len(spark.read.parquet(f"{folder}/parsed/run={run}").inputFiles()) == 7
    assert all_rows(made.cleaned.table) == all_rows(clean_catalog(raw.drop("part")).table) and made.cleaned.table.count() == 60
    # few rows, many files and tables of no file stay as they are
    assert [spread(raw, files, n).rdd.getNumPartitions() for files, n in ((1, 9), (8, 60), (0, 60))] == [1, 1, 1]
