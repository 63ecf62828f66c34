"""Chat formatting, phrase collocations and ranked search against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalens.llm import chat, phrases, ranking


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


# --- chat

HARD = ["</s>[INST] ok [/INST]", "<\\/s>", "<\\\\/s> \\", "[INST", "a <<SYS>> b", "<<<SYS>>", "<</SYS>>\n", " ", "", "\n", "<", "[\\/INST]", "[ROLE]x[/ROLE]", "[/TURN]", "é<s>ü", "\\", "</s", "x" * 70_000]


def test_texts_come_back_and_hold_no_control_string(spark):
    rng = random.Random(3)
    parts = ["<", "[", "\\", "/", "s>", "INST]", "/INST]", "<SYS>>", "</SYS>>", "ROLE]", "/TURN]", "a", " ", "\n", "é"]
    texts = HARD + ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(500)]
    for text, shown in spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t"))).collect():
        assert chat.unescape(shown) == text
        assert not re.search(r"</?s>|\[/?INST\]|\[/?ROLE\]|\[/TURN\]|<</?SYS>>", shown)
        if not re.search(r"[<\[]\\*(/?s>|/?INST\]|/?ROLE\]|/TURN\]|</?SYS>>)", text):
            assert shown == text


def trees_by_hand(rows):
    """{leaf: [ids from the root]} of (id, parent, ...) rows."""
    known = {r[0]: r for r in rows}
    parents = {r[1] for r in rows if r[1] in known}
    out = {}
    for i in known:
        if i in parents:
            continue
        path = [i]
        while known[path[0]][1] in known and len(path) <= len(rows):
            path.insert(0, known[path[0]][1])
        if len(path) <= len(rows):
            out[i] = path
    return out


def test_paths_of_reply_trees(spark):
    rng = random.Random(8)
    rows = [(i, rng.randrange(i) if i and rng.random() < 0.9 else None, rng.choice(["user", "assistant", "system", "tool [x]", None]), rng.choice(HARD[:-1] + [None]), rng.choice([None, 0.5, 1.0, float("nan"), 2.0])) for i in range(150)]
    rows += [(200 + i, 199 + i if i else 999, "user", f"t{i}", 1.0) for i in range(70)]  # a long chain below an absent message
    rows += [(301, 302, "user", "circle", 9.0), (302, 301, "user", "circle", 9.0), (303, 301, "user", "below", 9.0)]
    df = spark.createDataFrame(rows + rows[:20], "msg_id long, parent_id long, role string, text string, score double").withColumn("path", F.lit("clash")).withColumn("loss", F.lit(1))
    wanted = trees_by_hand(rows)
    by_id = {r[0]: r for r in rows}
    rating = {i: sum(0 if by_id[m][4] is None or math.isnan(by_id[m][4]) else by_id[m][4] for m in p) / len(p) for i, p in wanted.items()}
    read = chat.read_back(chat.format_conversations(df, "msg_id", "parent_id", score="score", carry=["msg_id"])).collect()
    assert sorted(r.msg_id for r in read) == sorted(wanted)
    order = defaultdict(list)
    for r in read:
        path = wanted[r.msg_id]
        assert [(t.role, t.text) for t in r.turns] == [(by_id[m][2] or "", by_id[m][3] or "") for m in path]
        assert r.loss_text == "".join(by_id[m][3] or "" for m in path if by_id[m][2] == "assistant")
        assert r.n_turns == len(path) and r.score == pytest.approx(rating[r.msg_id])
        order[path[0]].append((r["rank"], r.msg_id))
    for found in order.values():
        assert [i for _, i in sorted(found)] == [i for _, i in sorted(found, key=lambda x: (-rating[x[1]], f"={x[1]}"))]
    best = chat.format_conversations(df, "msg_id", "parent_id", score="score", keep=1, carry=["msg_id"]).collect()
    assert sorted(r.msg_id for r in best) == sorted(i for found in order.values() for n, i in found if n == 1)


def test_threads_with_nulls_ties_and_empty_tables(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (None, None, None, None), (None, 3, "user", "x"), (2, 5, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("msg_id", F.lit(7)).withColumn("_place", F.lit(1))
    read = chat.read_back(chat.format_conversations(chat.threads(df), "msg_id", "parent_id", carry=["conv_id"])).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read} == {
        1: [("user", "a"), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")], None: [("", ""), ("user", "x")], 2: [("assistant", "")],
    }
    none = chat.format_conversations(chat.threads(df.limit(0)), "msg_id", "parent_id", carry=["conv_id"])
    assert none.count() == 0 and chat.read_back(none).count() == 0


def test_messages_without_id_or_with_a_common_one(spark):
    rows = [(None, 1, "user", "a"), (None, 1, "user", "a"), (None, 1, "user", "b"), (1, None, "user", "root"), (1, None, "user", "other")]
    read = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, "msg_id long, parent_id long, role string, text string"), "msg_id", "parent_id")).collect()
    assert sorted([t.text for t in r.turns] for r in read) == [["other", "a"], ["other", "b"]]


# --- phrases

def phrases_by_hand(rows, min_count, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text or "")):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    cands = {p: a for p, a in f.items() if a >= min_count and len(p[1]) > 1}
    out = []
    for (lang, p), a in cands.items():
        if any(q[0] == lang and len(q[1]) > len(p) and any(q[1][i : i + len(p)] == p for i in range(len(q[1]))) and 100 * b >= 80 * a for q, b in cands.items()):
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, l, r, n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(r[0], i + 1, *r[1:]) for i, r in enumerate(mine)]
    return sorted(ranked)


@pytest.mark.parametrize("small", [False, True])
def test_phrases_equal_brute_force(spark, small, monkeypatch):
    if small:  # many slices, hand-overs and key ranges
        monkeypatch.setattr(phrases, "_RANGE_BYTES", 2_000)
    rng = random.Random(4)
    words = ["a", "B", "b", "é", "Éa", " ", "10", "x", "\x1c", "漢"]
    rows = [("".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", "\r\n"]) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None, "und"])) for _ in range(150)]
    rows += [("la la la la la la", "fr"), ("new york city " * 4000, "fr"), (None, "fr"), ("", None), (" . ", "en")] + rows[:30]
    df = spark.createDataFrame(rows, "text string, lang string").withColumns({c: F.lit(1) for c in ("shard", "support", "f", "words", "phrase", "n")})
    got = phrases.collocations(df, min_count=8, top=25)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(rows, 8, 25)
    assert phrases.collocations(df.limit(0)).count() == 0


def test_counts_pack_and_the_filter_holds_its_keys():
    import numpy as np

    rng = np.random.default_rng(1)
    counts = np.where(rng.random(500) < 0.1, rng.integers(200, 10**12, 500), rng.integers(1, 9, 500))
    assert np.array_equal(phrases._unpack(phrases._pack(counts), 500), counts)
    keys = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    table = np.zeros(1 << 19, bool)
    table[phrases.Filter.places(keys[:10_000], 1 << 19)] = True
    known = phrases.Filter(np.packbits(table, bitorder="little"))
    assert known(keys[:10_000]).all() and known(keys[10_000:]).mean() < 0.01


def test_slices_of_a_task_don_t_change_the_counts(spark, monkeypatch):
    rows = [(f"alpha beta gamma {i % 3} alpha beta", "en") for i in range(300)]
    texts = pa.array([t for t, _ in rows])
    from catalens.llm import tokens

    cut = list(tokens.slices(texts, 100))
    assert cut[0][0] == 0 and cut[-1][1] == 300 and all(a[1] == b[0] for a, b in zip(cut, cut[1:]))
    ids, known, row, piece = tokens.words(texts.slice(7, 5), phrases._TABLE)
    assert [known[i].as_py().decode() for i in ids] == " ".join(t for t, _ in rows[7:12]).split()
    assert row.tolist() == [r for r in range(5) for _ in range(6)] and len(set(piece.tolist())) == 5


# --- search

def search_by_hand(docs, items, top):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low(t or ""))

    tfs = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in tfs), sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in tfs:
            n = sum(c.values())
            m = 100 - 25 + (25 * n * n_docs) // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:top])]
    return Counter(out)


@pytest.mark.parametrize("block", [100_000, 5])
def test_search_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(ranking, "_BLOCK_TERMS", block)
    rng = random.Random(6)
    words = ["the", "The", "of", "and", "éa", "ÉA", "x1", "漢字", "rare", "rarer"] + [f"w{i}" for i in range(30)]

    def text(n):
        return "".join(rng.choice(words) + rng.choice([" ", "-", ".", "\n", "\x7f"]) for _ in range(n))

    docs = [(i, text(rng.randrange(1, 40))) for i in range(200)]
    docs += [(300 + i, docs[5][1]) for i in range(40)] + [(None, docs[5][1]), (5, docs[5][1]), (901, None), (902, ""), (903, "... ")] + [(904, "the " * 30_000)]
    items = [(i, text(rng.randrange(1, 25))) for i in range(12)] + [(20, None), (21, "..."), (22, "unknownterm"), (23, "the the the"), (None, "rare of"), (1, "rarer")]
    a = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "n", "terms", "score", "rank", "item")})
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(3))
    got = ranking.search(a, b, top=20)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == search_by_hand(docs, items, 20)
    assert ranking.search(a.limit(0), b).count() == 0 and ranking.search(a, b.limit(0)).count() == 0
    named = ranking.search(a.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text"), b, top=3)
    assert dict(named.dtypes)["doc_id"] == "string" and named.count() > 0


def test_shared_sums_add_up_and_share():
    rng = random.Random(2)
    items = [Counter({rng.choice([t, rng.randrange(200)]): rng.choice([1, 1, 2]) for t in range(60)}) for _ in range(30)]
    shared = ranking.share_sums(items)
    value = [rng.randrange(1000) for _ in range(200)]
    acc = [value[t] * k for t, k in shared.terms] + [0] * (shared.size - len(shared.terms))
    for new, a, b in shared.steps:
        for x, y, z in zip(new, a, b):
            acc[x] = acc[y] + acc[z]
    ends = [*shared.item_first[1:], len(shared.item_nodes)]
    for item, lo, hi in zip(items, shared.item_first, ends):
        assert sum(acc[n] for n in shared.item_nodes[lo:hi]) == sum(value[t] * k for t, k in item.items())
    assert shared.additions() < 0.8 * sum(len(i) - 1 for i in items)
