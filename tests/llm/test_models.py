"""Toxicity, main text, URL filter, source mixing and the pipeline."""

import math
import os
import random
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalens.llm import html, mixing, toxicity, urls

SF, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


# --- toxicity

def test_risk_gradient_is_that_of_the_risk():
    rng = np.random.default_rng(0)
    p, u = rng.normal(size=5), rng.normal(size=7)
    risk, g_p, g_u = toxicity.nn_pu_risk(p, u, 0.2)
    for i in range(5):
        q = p.copy()
        q[i] += 1e-6
        assert abs((toxicity.nn_pu_risk(q, u, 0.2)[0] - risk) / 1e-6 - g_p[i]) < 1e-4
    for i in range(7):
        q = u.copy()
        q[i] += 1e-6
        assert abs((toxicity.nn_pu_risk(p, q, 0.2)[0] - risk) / 1e-6 - g_u[i]) < 1e-4


def test_learns_from_positives_and_unlabelled():
    rng = random.Random(0)
    bad, good = [f"bad{i}" for i in range(6)], [f"word{i}" for i in range(200)]

    def text(toxic):
        return " ".join([rng.choice(good) for _ in range(40)] + ([rng.choice(bad) for _ in range(3)] if toxic else []))

    model = toxicity.train([text(True) for _ in range(100)], [text(rng.random() < 0.2) for _ in range(600)], 0.2)
    score = model.scorer()
    assert np.mean([score(text(True)) >= 0.5 for _ in range(200)]) > 0.95
    assert np.mean([score(text(False)) < 0.5 for _ in range(200)]) > 0.95
    assert 0 <= score("") < 0.5 and score(None) == score("")
    assert toxicity.train([], [], 0.1).scorer()("x") == pytest.approx(0.1)


def test_odd_rows_of_toxicity(spark):
    df = spark.createDataFrame([(1, "bad", "x"), (1, "bad", "x"), (None, "bad", None), (3, None, "y"), (4, "", "y"), (5, "w " * 30000, "z")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    got = toxicity.predict(df, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert toxicity.predict(df.limit(0), model).count() == 0
    assert toxicity.fit(df.limit(0), labels.limit(0)).weights == {}
    assert toxicity.drop_toxic(df.select("doc_id", "text"), model).columns == ["doc_id", "text"]


@needs_data
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    got = toxicity.predict(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in got if r.toxic == 1]
    clean = [r for r in got if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)


# --- main text

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li>About</ul></nav><!-- <p>no</p> --><div class="ad">Buy &lt;now&gt;</div>
<article><h1>A  title</h1><p>First <b>bold</b>
 line &amp; more<p>Second<br>line &copy; x > y <i>it</i></p><aside>See also</aside>tail text</article>
<footer>&copy; 2020</footer>"""


def test_blocks_of_a_page():
    assert [b.text for b in html.blocks(PAGE)] == [
        "Home", "About", "Buy <now>", "A title", "First bold line & more", "Second line © x > y it", "See also", "tail text", "© 2020"]
    assert html.marked_labels(html.blocks(PAGE)) == [0, 0, 0, 1, 1, 1, 0, 1, 0]
    assert html.blocks(None) == html.blocks("") == [] and html.marked_labels(html.blocks("<p>x")) is None


@pytest.mark.parametrize("page, want", [
    ("a < b &amp c &am", ["a < b & c &am"]), ("<p>cut <a hre", ["cut"]), ("<p title='>'>x</p>", ["x"]), ('<p a="open>x</p>y', ["x", "y"]),
    ("<div><p>a</div>b", ["a", "b"]), ("<script>if (a<b) '</p>'", []), ("<b>x</i></b> y", ["x y"]), ("</p>x<!-- no end", ["x"]),
    ("<ul><li>a<li>b</ul>", ["a", "b"]), ("<textarea><p>no</textarea>yes", ["yes"]), ("a<br/>b<hr>c&nbsp; d", ["a b", "c d"]),
])
def test_broken_pages(page, want):
    assert [b.text for b in html.blocks(page)] == want


@pytest.mark.parametrize("page, want", [
    ("<p>a</p><svg width='1'/><p>b</p>", ["a", "b"]), ("<p>a <math/> b</p><p>c", ["a b", "c"]), ("<p>a</p><svg><path d='x'/><style/></svg><p>b", ["a", "b"]),
    ("<svg><style>p{}</style><title>t</title></svg><p>b", ["t", "b"]), ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>", ["so x=2 holds"]),
    ("<object><p>in</p><p>b", ["in", "b"]), ("<noscript><p>in</p></noscript><p>b", ["in", "b"]), ("<video>in<p>b", ["in", "b"]), ("<canvas><p>b", ["b"]),
    ("<audio><p>b", ["b"]), ("<title>t</title><iframe>no</iframe><style>p{}</style><p>b", ["b"]),
])
def test_embedded_elements_swallow_no_text(page, want):
    assert [b.text for b in html.blocks(page)] == want


def test_viterbi_and_likelihood_against_enumeration():
    rng = np.random.default_rng(1)
    names = ["t:x", "t:y", "len:1"]
    model = html.Crf({n: float(rng.normal()) for n in names}, tuple(map(tuple, rng.normal(size=(2, 2)).tolist())))
    page = [html.Block("x" if rng.random() < 0.5 else "xyzw", ((("x", "y", "p")[rng.integers(3)], ()),), 0) for _ in range(7)]
    emit = [sum(model.weights.get(f, 0.0) for f in html.path_features(b.path) + html.text_features(b, i, 7)) for i, b in enumerate(page)]
    best = max(product((0, 1), repeat=7), key=lambda y: sum(e * v for e, v in zip(emit, y)) + sum(model.step[a][b] for a, b in zip(y, y[1:])))
    assert tuple(model.decoder()(page)) == best


def test_crf_learns_the_order_of_labels():
    rng = random.Random(0)
    pages = []
    for _ in range(60):  # a block says little, its neighbours much
        y = [0] * rng.randrange(1, 4) + [1] * rng.randrange(2, 6) + [0] * rng.randrange(1, 3)
        pages.append(([["a" if (v == 1) != (rng.random() < 0.15) else "b"] for v in y], y))
    model = html.train(pages, steps=200)
    assert model.step[1][1] > model.step[1][0] and model.weights["a"] > model.weights["b"]


def page_of(rng, marked):
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma,", "delta.", "eps"]) for _ in range(n))
    body = [words(rng.randrange(1, 60)) for _ in range(rng.randrange(2, 8))]
    inside = "".join(f"<p>{b}</p>" for b in body)
    around = f"<article>{inside}</article>" if marked else f'<div class="content">{inside}<div class="comments"><p>{words(12)}</p></div></div>'
    side = "" if marked else f'<aside><p>{words(15)}</p></aside><div class="cookie-notice">{words(9)}</div><form><p>{words(3)}</p></form>'
    return f"<html><body><nav><a>{words(1)}</a></nav><div class='ad'>{words(8)}</div>{around}{side}<footer>&copy; {words(4)}</footer>", "\n\n".join(body)


def test_main_text_of_marked_and_other_pages(spark):
    rng = random.Random(5)
    marked = [page_of(rng, True) for _ in range(150)]
    other = [page_of(rng, False) for _ in range(60)]
    df = spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(marked)], "page_id long, url string, html string")
    model = html.fit(df)
    odd = [(1000, "u", None), (1001, None, ""), (None, "u", marked[0][0]), (None, "u", marked[0][0])]
    rows = [(i, "u", h) for i, (h, _) in enumerate(marked + other)] + odd
    frame = spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, html string, text int")
    got = html.extract(frame, model).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert all(by[i].text == t for i, (_, t) in enumerate(marked))
    assert by[1000].text == by[1001].text == "" and by[None].text == marked[0][1]
    right = sum(by[len(marked) + i].text == t for i, (_, t) in enumerate(other))
    assert right >= 0.9 * len(other)
    assert html.extract(frame.limit(0), model).count() == 0 and html.fit(df.limit(0)).weights == {}


# --- urls

CASES = {
    "http://A.com/x?y#z": ("a.com", "/x", "com/", "allow"), "https://blog.EXAMPLE.com/en/1": ("blog.example.com", "/en/1", "example.com/en/", "block"),
    "http://www.example.com/en/2": ("www.example.com", "/en/2", "www.example.com/en/", "allow"), "http://m.www.example.com/en/": ("m.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "ftp://x.net/es/": ("x.net", "/es/", "net/es/", "block"), "http://xnet/fr/": ("xnet", "/fr/", None, "allow"), "http://net/fr/a": ("net", "/fr/a", "net/fr/", "block"),
    "http://a.com": ("a.com", "", None, "allow"), "http://a.com?q=/x": ("a.com", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"),
    "no scheme/com/": ("", "", None, "allow"), "http://x.org/http://y.com/z": ("x.org", "/http://y.com/z", None, "allow"), "://a.com/b\nc": ("a.com", "/b\nc", "com/", "allow"),
}


def test_hosts_paths_and_listed_rules(spark):
    rows = [(i, u, 1) for i, u in enumerate(CASES)] + [(None, "http://a.com/x", 1), (0, "http://a.com/x", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, labels).collect()}
    want = {(i, *c) for i, c in enumerate(CASES.values())} | {(None, "a.com", "/x", "com/", "allow"), (0, "a.com", "/x", "com/", "allow")}
    assert got == want
    assert urls.judge_urls(pages, labels).count() == len(rows) and urls.judge_urls(pages.limit(0), labels).count() == 0


def rules_by_hand(rows, support, confidence, lift):
    out, n = {}, len(rows)
    share = {v: sum(x == v for _, x in rows) / n for v in ("allow", "block")}
    tokens = sorted({t for ts, _ in rows for t in ts})
    for size in (1, 2, 3):
        from itertools import combinations

        for c in combinations(tokens, size):
            of = [v for ts, v in rows if set(c) <= set(ts)]
            for v in ("allow", "block"):
                k = sum(x == v for x in of)
                if of and k >= math.ceil(support * n) and k / len(of) >= confidence and k / len(of) / share[v] >= lift:
                    out[c, v] = k / len(of)
    return {(c, v) for (c, v), s in out.items() if not any(set(d) < set(c) and w == v and t >= s for (d, w), t in out.items())}


def test_mined_rules_and_matches_equal_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        ts = sorted(rng.sample(["a", "b", "c", "d", "e"], rng.randrange(1, 4)))
        bad = ("a" in ts and "b" in ts and rng.random() < 0.9) or rng.random() < 0.1
        rows.append((ts, "block" if bad else "allow"))
    frame = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    rules = urls.mine(frame, 0.01, 0.6, 1.1, min_rows=1)
    got = rules.collect()
    want = {x for x in rules_by_hand(rows, 0.01, 0.6, 1.1) if len(x[0]) <= 3}
    assert {(tuple(r.antecedent), r.verdict) for r in got} == want and want
    asked = [(i, sorted(rng.sample(["a", "b", "c", "d", "e", "f"], rng.randrange(0, 5)))) for i in range(60)]
    found = {r.id: (r.mined_verdict, r.mined_rule) for r in urls.match(spark.createDataFrame(asked, "id long, tokens array<string>"), rules, "id").collect()}
    for i, ts in asked:
        fit = [(r.confidence, r.support, r.verdict, " ".join(r.antecedent)) for r in got if set(r.antecedent) <= set(ts)]
        assert found.get(i) == (max(fit)[2:] if fit else None)


def test_rules_rest_on_several_urls_and_keep_words_with_digits(spark):
    rows = [(["p:bet365"], "block")] * 5 + [(["p:win88"], "block")] * 4 + [(["p:blog"], "allow")] * 40
    found = {(tuple(r.antecedent), r.verdict) for r in urls.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string")).collect()}
    assert found == {(("p:bet365",), "block"), (("p:blog",), "allow")}
    few = spark.createDataFrame(rows[:4], "tokens array<string>, verdict string")
    assert urls.mine(few).count() == 0 and urls.mine(few.limit(0)).count() == 0
    asked = spark.createDataFrame([("a.net", "/BET365/7/x-2024.html")], "host string, path string")
    assert set(asked.select(urls.tokens(F.col("host"), F.col("path")).alias("t")).first().t) == {"h:a", "h:net", "s:a.net", "p:bet365", "p:x", "p:html"}


# --- mixing

def least_cost(capacity, quota, epochs):
    """(tokens left short, cost) of the best plan, by trying them all."""
    patterns, best = list(capacity), None
    shares = [list(product(*[range(quota[s] + 1) for s in p])) for p in patterns]
    for plan in product(*shares):
        if any(sum(a) > epochs * capacity[p] for p, a in zip(patterns, plan)):
            continue
        got = Counter()
        for p, a in zip(patterns, plan):
            got.update(dict(zip(p, a)))
        if any(got[s] > quota[s] for s in quota):
            continue
        cost = sum(max(0, min(sum(a) - level * capacity[p], capacity[p])) * level for p, a in zip(patterns, plan) for level in range(epochs))
        found = sum(quota.values()) - sum(got.values()), cost
        best = found if best is None else min(best, found)
    return best


def test_flow_equals_the_best_of_all_plans():
    rng = random.Random(8)
    for _ in range(60):
        patterns = rng.sample([("a",), ("b",), ("a", "b"), ("a", "c"), ("c",)], 3)
        capacity = {p: rng.randrange(0, 3) for p in patterns}
        quota = {s: rng.randrange(0, 5) for s in sorted({s for p in patterns for s in p})}
        flow = mixing.min_cost_flow(capacity, quota, 3)
        got = sum(quota.values()) - sum(flow.values()), sum(level * v for (_, level, _), v in flow.items())
        assert got == least_cost(capacity, quota, 3)


def test_null_and_repeated_ids_are_drawn_apart(spark):
    rows = [(None, "x", f"{i} " + "w " * 9) for i in range(300)] + [(7, "y", f"{i} " + "w " * 9) for i in range(300)]
    rows += [(i, "z", "") for i in range(5)] + [(8, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(mixing.document_sizes(docs), "sources", "size", row_id="row_key").collect()
    taken = Counter()
    for r in got:
        taken[r.sources[0]] += r.taken
        assert r.taken <= 3 * r["size"]
    assert len(got) == len(rows) and abs(taken["x"] - 2000) <= 10 and abs(taken["y"] - 4000) <= 10 and taken["z"] == taken[None] == 0


def test_targets_share_the_excess_until_none_is_above():
    sizes = {"a": 10, "b": 100, "c": 1000}
    t = mixing.targets(sizes, {"a": 3, "b": 2, "c": 1})
    assert t["a"] == 30 and t["b"] == 300 and t["c"] == pytest.approx(780)
    assert mixing.targets({}, {}) == {} and mixing.targets({"a": 0}, {"a": 1}) == {"a": 0.0}


def test_flow_is_of_least_cost():
    capacity, quota = {("x",): 4, ("x", "y"): 6, ("y",): 1}, {"x": 9, "y": 5}
    flow = mixing.min_cost_flow(capacity, quota)
    assert {s: sum(v for k, v in flow.items() if k[2] == s) for s in quota} == quota
    for (p, level, s), v in flow.items():
        assert s in p and 0 < v <= capacity[p]
    for p in capacity:
        for level in range(3):
            assert sum(v for k, v in flow.items() if k[:2] == (p, level)) <= capacity[p]
    # 11 tokens once, the other 3 a second time
    assert sum(level * v for (_, level, _), v in flow.items()) == 3
    short = mixing.min_cost_flow({("x",): 2}, {"x": 100, "y": 5})
    assert sum(short.values()) == 6


def mixed(spark, rows):
    return mixing.mix(spark.createDataFrame(rows, "doc_id long, sources array<string>, size long, taken string").drop("taken"), "sources", "size")


def test_mix_meets_its_targets_and_repeats(spark):
    rng = random.Random(2)
    names = ["b", "a", "é", None, "c"]
    rows = [(i, [names[min(int(rng.expovariate(1)), 4)]], rng.randrange(0, 50), "x") for i in range(3000)]
    rows += [(3000, None, 5, "x"), (3001, [], 7, "x"), (3002, ["a"], None, "x"), (None, ["a"], 3, "x"), (7, rows[7][1], rows[7][2], "x")]
    got = mixed(spark, rows).collect()
    assert len(got) == len(rows)
    size, taken = defaultdict(int), defaultdict(int)
    for r in got:
        s = (r.sources or [None])[0] if r.sources else None
        size[s] += r["size"] or 0
        taken[s] += r.taken
        assert 0 <= r.taken <= 3 * (r["size"] or 0)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = mixing.targets(dict(size), {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)})
    for r in got:
        s = r.sources[0] if r.sources else None
        assert r.target[0] == pytest.approx(want[s]) and r.source_size[0] == size[s]
    assert all(abs(taken[s] - want[s]) <= 50 for s in size)
    again = mixed(spark, rows[::-1]).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in got)
    assert mixed(spark, rows).limit(0).count() == 0 and mixing.mix(mixed(spark, rows).limit(0).select("doc_id", "sources", "size"), "sources", "size").count() == 0


def test_overlapping_sources_share_their_documents(spark):
    rows = [(i, [["x"], ["x", "y"], ["y"]][i % 3], 10, "") for i in range(900)]
    got = mixed(spark, rows).collect()
    assert sum(r.taken for r in got) == pytest.approx(9000, abs=40)


# --- pipeline

@needs_data
def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    extra = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "src0", 0), (10**6, "", "en", "src0", 0)], docs.schema)
    docs = docs.unionByName(extra)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if i < 4:
            assert docs.columns == columns
        assert 0 < docs.count() <= 3 * before
    assert corpus_pipeline.STAGES[0][1](spark, docs.sparkSession.read.parquet(f"{SF}/documents.parquet").limit(0), SF).count() == 0


@needs_data
def test_pipeline_stages_carry_columns_of_any_name(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clash = ("score", "target", "repeats", "taken", "n_lines", "n_dropped", "_row", "doc", "row", "copy", "id", "sources", "size")
    docs = docs.withColumns({c: F.lit(f"own {c}") for c in clash})
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.select(*clash).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(f"own {c}" for c in clash)], name
