"""Line dedup, licences, Order MinHash, pieces."""

import hashlib
import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalens.llm import licenses, lines, orderminhash, pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WS = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def lines_by_hand(rows):
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = lower(line.strip(WS))
            if len(k) >= 10:
                order = (i is None, i)
                first[k] = min(first.get(k, order), order)
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if len(lower(x.strip(WS))) < 10 or first[lower(x.strip(WS))] == (i is None, i)]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("batches, fan_in", [(1, 2), (4, 2), (7, 3)])
def test_lines_equal_brute_force(spark, batches, fan_in):
    rng = random.Random(1)
    pool = [f"a line that repeats {i}" for i in range(12)] + ["short", "", "  A LINE that repeats 3\t", "Ünïcode líne lång", "ünïcode líne lång"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9)))) for i in range(80)]
    rows += [(90, None), (91, ""), (92, "\n\n"), (None, "a line that repeats 1\nonly where the id is null"), (93, "only where the id is null"), (5, rows[5][1])]
    rows[3] = (3, "own line of three\nown line of three")
    df = spark.createDataFrame([(i, t, "k", "n") for i, t in rows], "doc_id long, text string, row string, n_lines_ string")
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in lines.dedup_lines(df, batches=batches, fan_in=fan_in).collect()]
    assert Counter(got) == Counter(lines_by_hand(rows))
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_runs_take_deliveries_one_after_the_other(spark):
    runs = lines.LineRuns(spark, fan_in=2)
    for lo in range(0, 50, 10):
        runs.add(spark.createDataFrame([(h % 7, h % 3, lo + h % 10) for h in range(30)], "h1 long, h2 long, row long"))
    assert len(runs.runs()) < 5
    index = runs.index().collect()
    assert len(index) == len({(r.h1, r.h2) for r in index}) == 21 and max(r.row for r in index) < 10


def test_licences_in_other_dress(spark):
    mit = licenses.KNOWN[0][1]
    dressed = mit.replace("MIT License", "MIT Licence").upper().replace("\n\n", "\n\nCopyright (c) 2019-2021 Some Body\nAll rights reserved.\n\n", 1).replace(",", " ;")
    rows = [(1, dressed), (2, mit + " and more"), (3, None), (4, ""), (5, "text\nreleased under the mit licence\nLicensed under CC BY-NC 4.0"), (5, "text\nreleased under the mit licence\nLicensed under CC BY-NC 4.0"),
            (None, "Licensed under the Apache License, Version 2.0."), (7, "x " * 50_000)]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, license string, digest string")
    got = {(r.doc_id, r.license, r.license_lines) for r in licenses.scan(df).collect()}
    assert got == {(1, "MIT", ""), (2, None, ""), (3, None, ""), (4, None, ""), (5, None, "CC-BY-NC-4.0,MIT"), (None, "Apache-2.0", "Apache-2.0"), (7, None, "")}
    assert licenses.scan(df).count() == len(rows) and licenses.scan(df.limit(0)).count() == 0


def test_whole_texts_of_long_licences(spark):
    text = {p.stem: p.read_text(encoding="utf-8") for p in licenses._TEXTS.glob("*.txt")}
    apache, gpl = text["Apache-2.0"], text["GPL-3.0"]
    rows = [(n, t) for n, t in text.items()] + [
        ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2019 Some Body").upper()),
        ("Apache-2.0", apache[: apache.index("   APPENDIX")]),
        ("GPL-3.0", gpl[: gpl.index("END OF TERMS")]),
        ("MIT", licenses.KNOWN[0][1].replace("MIT License\n\n", "Copyright (c) 2020 Some Body\n\n")),
        (None, gpl[: len(gpl) // 2]),
    ]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    assert {r.doc_id: r.license for r in licenses.scan(df).collect()} == {i: n for i, (n, _) in enumerate(rows)}
    assert len(text) == 14


def test_each_known_licence_has_its_own_digest(spark):
    names = {n for n, _ in licenses.KNOWN}
    assert {r.license for r in licenses.known_digests(spark).collect()} == names


def test_numbered_kmers_tell_occurrences_apart():
    code = orderminhash._codes("abcabcabc")
    h = orderminhash.numbered_kmers(code, 3)
    assert len(set(h.tolist())) == len(h) == 7
    assert h[0] == orderminhash.numbered_kmers(orderminhash._codes("abc"), 3)[0]


def test_order_minhash_feels_order_and_length():
    rng = random.Random(8)
    a = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    near = a[:2000] + "#" + a[2000:]
    swapped = a[2000:] + a[:2000]
    other = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    s = {k: orderminhash.sketch(orderminhash._codes(v)) for k, v in dict(a=a, near=near, swapped=swapped, other=other).items()}
    assert orderminhash.likeness(s["a"], s["a"]) == 1
    assert orderminhash.likeness(s["a"], s["near"]) > 0.9
    assert orderminhash.likeness(s["a"], s["other"]) < 0.1
    assert orderminhash.likeness(s["a"], s["swapped"]) < 0.75 < orderminhash.likeness(s["a"], s["near"])


@pytest.mark.parametrize("n", [1, 7, 300, 20_000])
def test_the_cut_changes_no_sketch(n, monkeypatch):
    code = np.random.default_rng(n).integers(97, 101, n).astype(np.uint32)
    h = orderminhash.numbered_kmers(code, orderminhash.K)
    deal = [int(orderminhash._mix(np.array([x + np.uint64(1)]))[0]) for x in h] if n <= 300 else None
    s = orderminhash.sketch(code)
    if deal:
        for k in range(orderminhash.SKETCHES):
            own = sorted((d, i) for i, d in enumerate(deal) if d >> 58 == k)[: orderminhash.TUPLE]
            assert (s[k] >= 0) == bool(own)
    assert (s == orderminhash.sketch(code.copy())).all()


def test_edited_texts(spark):
    rng = random.Random(3)
    rows = [(i * 3, "".join(rng.choice("abcde é😀") for _ in range(rng.randrange(0, 60)))) for i in range(50)]
    rows += [(500, None), (501, ""), (502, "z")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_chars int").repartition(5)
    for part_rows in (1, 7, 4096):
        got = {r.doc_id: r for r in orderminhash.fingerprints_with_edits(df, part_rows=part_rows).collect()}
        assert len(got) == len(rows)
        prints = {r.doc_id: r.fingerprint for r in orderminhash.fingerprints(df).collect()}
        for k, (i, t) in enumerate(rows):
            own, following = t or "", rows[(k + 1) % len(rows)][1] or ""
            edited = own[: len(own) - len(own) // 2] + following[: len(own) // 2]
            r = got[i]
            assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.fingerprint == prints[i] and 0 <= r.near_edited <= 1
            if edited == own:
                assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
    assert orderminhash.fingerprints_with_edits(df.limit(0)).count() == 0
    many = spark.createDataFrame([(i, f"text number {i} of many") for i in range(300)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:  # more than 64 parts
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        got = orderminhash.fingerprints_with_edits(many, part_rows=2).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = {hashlib.sha256((f"text number {i} of many"[: len(t) - len(t) // 2] + f"text number {(i + 1) % 300} of many"[: len(t) // 2]).encode()).hexdigest() for i in range(300) for t in [f"text number {i} of many"]}
    assert len(got) == 300 and {r.edited_sha256 for r in got} == want
    again = spark.createDataFrame([(1, "same"), (1, "same"), (None, "x"), (None, "x"), (2, "same")], "doc_id long, text string")
    assert orderminhash.fingerprints_with_edits(again).count() == 5


needs_model = pytest.mark.skipif(not os.path.exists(MODEL), reason="needs the tokenizer files")
ODD = ["", "a", "  two  spaces ", "a ▁ literal", "\n\n", "émoji 😀 x\n y", "x" * 3000, " " * 70, "tab\tand\rreturn", "\u0000 nul"]


@needs_model
def test_pieces_round_trip_and_repeat(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a text without id"), (98, None), (3, ODD[3])]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, ids int")
    coded = pieces.encode(df, MODEL)
    got = pieces.add_decoded(coded, MODEL).collect()
    checked = pieces.encode(df, MODEL, with_decoded=True).collect()
    assert Counter((r.doc_id, r.decoded) for r in checked) == Counter(rows)
    assert Counter((r.doc_id, r.decoded) for r in got) == Counter(rows)
    again = pieces.encode(df.repartition(3), MODEL).collect()
    assert Counter((r.doc_id, tuple(r.ids or ())) for r in again) == Counter((r.doc_id, tuple(r.ids or ())) for r in got)
    assert pieces.encode(df.limit(0), MODEL).count() == 0
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert all(sp.decode(list(r.ids)) == t for r, (_, t) in zip(sorted((r for r in got if r.doc_id in (1, 2, 5)), key=lambda r: r.doc_id), [rows[1], rows[2], rows[5]]))


@needs_model
def test_segmentations_are_drawn_by_their_weight():
    model = pieces.load(MODEL)
    lattice = {model.text[i]: model.weight[i] for i in np.flatnonzero(model.usable)}
    word, found = "▁there", {}

    def walk(at, path, weight):
        if at == len(word):
            found[path] = weight
        for to in range(at + 1, len(word) + 1):
            if word[at:to] in lattice:
                walk(to, (*path, word[at:to]), weight + lattice[word[at:to]])

    walk(0, (), 0.0)
    n = 20_000
    ids, ends = pieces.Segmenter(model).encode(["there"] * n, np.random.default_rng(0).integers(0, 1 << 62, n))
    drawn = Counter(tuple(model.text[i] for i in ids[a:b]) for a, b in zip(ends[:-1], ends[1:]))
    whole = sum(map(math.exp, found.values()))
    assert set(drawn) <= set(found)
    assert all(abs(drawn[k] / n - math.exp(v) / whole) < 0.015 for k, v in found.items())


@needs_model
def test_a_model_without_byte_pieces_is_refused():
    class Sp:
        pass

    with pytest.raises(Exception):
        pieces.Pieces.load(b"no model")


def test_bounds_do_not_depend_on_what_is_learnt_together(monkeypatch):
    rng = random.Random(9)
    model = pieces.load(MODEL)
    texts = ["".join(rng.choice("abcdeé xyz  ") for _ in range(rng.randrange(200))) for _ in range(300)]
    one, two = pieces.Segmenter(model), pieces.Segmenter(model)
    chunks = sorted({c for t in texts for c in one.chunks.findall("\u2581" + t.replace(" ", "\u2581"))})
    one._learn(chunks)
    for lo in reversed(range(0, len(chunks), 37)):
        two._learn(chunks[lo : lo + 37])
    for c in chunks:
        a, b = one.known[c], two.known[c]
        x, y = one.first[one.begin[a] + 1], two.first[two.begin[b] + 1]
        n = one.edge_end[a] - x
        assert n == two.edge_end[b] - y
        assert np.array_equal(one.cum[x : x + n], two.cum[y : y + n]) and np.array_equal(one.piece[x : x + n], two.piece[y : y + n])


def test_a_small_cache_changes_nothing_and_stays_small(monkeypatch):
    rng = random.Random(10)
    model = pieces.load(MODEL)
    texts = [" ".join("".join(rng.choice("abcdeghilmnorst") for _ in range(rng.randrange(1, 9))) for _ in range(200)) for _ in range(120)]
    seeds = np.arange(120)
    ids, ends = pieces.Segmenter(model).encode(texts, seeds)
    monkeypatch.setattr(pieces, "_CACHE_BYTES", 1 << 21)
    small = pieces.Segmenter(model)
    for lo in range(0, 120, 10):
        got, cut = small.encode(texts[lo : lo + 10], seeds[lo : lo + 10])
        assert np.array_equal(got, ids[ends[lo] : ends[lo + 10]]) and cut[-1] == ends[lo + 10] - ends[lo]
        small._trim()
        assert small.cached_bytes() < 1 << 21


def test_long_chunks_are_drawn_as_short_ones(monkeypatch):
    rng = random.Random(11)
    model = pieces.load(MODEL)
    texts = ["".join(rng.choice("abcdeghilmnorsté漢\U0001f600") for _ in range(n)) for n in (1, 40, 3_000, 40_000)] + ["a b", ""]
    seeds = np.arange(len(texts))
    monkeypatch.setattr(pieces, "_LONG", 10**9)
    ids, ends = pieces.Segmenter(model).encode(texts, seeds)
    monkeypatch.setattr(pieces, "_LONG", 0)
    monkeypatch.setattr(pieces, "_STRETCH", 1_000)
    got, cut = pieces.Segmenter(model).encode(texts, seeds)
    assert np.array_equal(cut, ends) and np.array_equal(got, ids)
    for t, a, b in zip(texts, ends[:-1], ends[1:]):
        assert pieces.decode(model, ids[a:b].tolist()) == t


def test_ids_of_text_give_the_result_of_numbers(spark):
    base = ["a line that repeats itself", "short", "another line of this text"]
    rows = [(i, "\n".join([base[i % 3], f"own line of row {i % 7}", base[0]]) if i else None) for i in range(40)]
    numbers = spark.createDataFrame(rows, "doc_id long, text string")
    texts = numbers.withColumn("doc_id", F.format_string("%04d", "doc_id"))
    for made in (lines.dedup_lines, lambda df: orderminhash.fingerprints_with_edits(df, part_rows=8)):
        want = {f"{r.doc_id:04d}": tuple(r[1:]) for r in made(numbers).collect()}
        assert {r.doc_id: tuple(r[1:]) for r in made(texts).collect()} == want and len(want) == 40
        assert made(texts.filter("doc_id < '0'")).count() == 0


def test_the_bound_of_the_cache_changes_no_ids(spark, monkeypatch):
    texts = [" ".join(str(i * j) for j in range(40)) for i in range(60)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(pieces, "_BLOCK_CHARS", 700)
    small = pieces.encode(df, MODEL, cache_bytes=1 << 18).orderBy("doc_id").collect()
    assert small == pieces.encode(df, MODEL).orderBy("doc_id").collect() and small[-2].ids is None and small[-1].ids == []
