"""SimHash, near-duplicate groups, embeddings and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from catalens.llm import components, embeddings, simhash, tiles

WORDS = [f"w{i}" for i in range(60)]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def fingerprint_by_hand(text, words):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    runs = [w[i : i + words] for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_by_hand(ids, linked):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            for x in (a, b):
                if root[x] != low:
                    root[x], changed = low, True
    return root


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(200, 200), (300, 301), (301, 300), (300, 301)]
    edges += [(rng.randrange(400, 480), rng.randrange(400, 480)) for _ in range(40)]
    frame = spark.createDataFrame(edges + [(None, 5)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(frame).collect()}
    want = {k: v for k, v in components_by_hand({x for e in edges for x in e}, edges).items() if k != v}
    assert got == want
    assert components.connected_components(frame.limit(0)).count() == 0


def test_fingerprints_equal_those_by_hand():
    for t in ("", "A b", "one Two three", "  tab\tand\nline  Ä É x ", text_of(random.Random(1), 400)):
        made = int(simhash.fingerprint(simhash.shingle_hashes(t, 3))[0])
        assert made == fingerprint_by_hand(t, 3)
    assert simhash.fingerprint(simhash.shingle_hashes(None, 3))[0] == 0


def test_exact_keys_lose_no_pair():
    keys = [sum(1 << b for b in k) for k in simhash.exact_keys(2)]
    rng = random.Random(5)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        assert any((x ^ y) & k == 0 for k in keys)


@pytest.mark.parametrize("block_rows", [5, 4096])
def test_links_of_fingerprints(spark, block_rows):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    fps = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)} | {rng.getrandbits(64) for _ in range(60)}
    ids = {i: f for i, f in enumerate(sorted(fps))}
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in ids.items()]
    frame = spark.createDataFrame(rows, "node long, fp0 long")
    got = simhash.link_fingerprints(frame, "node", simhash.exact_keys(2), 64, 2, block_rows=block_rows)
    links = [(a, b) for a in ids for b in ids if a < b and (ids[a] ^ ids[b]).bit_count() <= 2]
    moved = {r.node: r.component for r in components.connected_components(got).collect()}
    assert {i: moved.get(i, i) for i in ids} == components_by_hand(ids, links)


def test_simhash_components_with_nulls_copies_and_other_columns(spark):
    rng = random.Random(2)
    long = text_of(rng, 3000)
    rows = [(1, long, "x"), (2, long + " tail", "x"), (3, "", None), (4, None, "y"), (5, " \n", "y"), (6, long, "z"), (6, long, "z"), (None, long, "z"), (7, "alone here now", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_components(df).collect()), key=str)
    by = {r[0]: f"{fingerprint_by_hand(r[1], 3):016x}" for r in rows}
    linked = [(a, b) for a in by for b in by if a and b and a < b and (int(by[a], 16) ^ int(by[b], 16)).bit_count() <= 2]
    root = components_by_hand([i for i in by if i], linked)
    want = sorted(((r[0], by[r[0]], root.get(r[0], 1)) for r in rows), key=str)
    assert got == want
    assert simhash.simhash_components(df.limit(0)).collect() == []


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(5)
    base = [text_of(rng, 300) for _ in range(12)]
    rows = [(i, t, 1) for i, t in enumerate(base)] + [(100 + i, t, 2) for i, t in enumerate(base[:6])]
    rows += [(7, base[7], 1), (None, base[2], 3), (None, None, 4), (None, "", 4), (50, "  ", 5)]
    # names that the operator uses itself
    df = spark.createDataFrame(rows, "doc_id long, text string, row int").withColumns({"who": F.lit("w"), "fp0": F.lit(1), "component_id": F.lit(2), "doc": F.lit(3)})
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    found = {r.doc_id: r.component_id for r in simhash.simhash_components(df.filter("doc_id is not null")).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(found.values()))
    assert simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_tiles_meet_every_pair_once_and_stay_small(spark):
    df = spark.createDataFrame([(k, i) for k, n in ((1, 50), (2, 1), (3, 7)) for i in range(n)], "k int, id long")
    rows = tiles.tiled(df, ["k"], "id", 10).collect()
    pairs = {}
    by = {}
    for r in rows:
        by.setdefault((r.k, r.tile_i, r.tile_j), []).append(r)
    for (k, i, j), own in by.items():
        one, two = tiles.sides(np.array([r.block for r in own]), i, j)
        for a in one:
            for b in two:
                x, y = own[a].id, own[b].id
                if i != j or x < y:
                    key = (k, min(x, y), max(x, y))
                    pairs[key] = pairs.get(key, 0) + 1
    want = {(k, a, b): 1 for k, n in ((1, 50), (3, 7)) for a in range(n) for b in range(a + 1, n)}
    assert pairs == want
    assert max(len(v) for v in by.values()) < 50


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(200, 33))
    v /= np.linalg.norm(v, axis=1)[:, None]
    codes, scale, error = embeddings.quantise(v)
    assert (np.linalg.norm(v - scale[:, None] * codes, axis=1) <= error).all()
    rows = np.arange(200)
    found = {(i, int(j)) for i, js in embeddings.cosines_above(v, rows, rows, 0.3) for j in js}
    assert found == {(i, j) for i in range(200) for j in range(i + 1, 200) if v[i] @ v[j] >= 0.3}


@pytest.mark.parametrize("block_rows", [8, 2048])
def test_near_vectors_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 16))
    vectors = [(centres[rng.integers(6)] + rng.normal(size=16) * 0.15 * rng.random()).astype(float).tolist() for _ in range(90)]
    vectors += [vectors[0], vectors[0], [0.0] * 16, None, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [None] + [1.0] * 15, [1.0], [2.0], []]
    label = [int(rng.integers(2)) for _ in vectors]
    label[5] = None
    label[90] = label[91] = label[0]
    label[97] = label[98] = 1
    ids = list(range(len(vectors)))
    rng.shuffle(ids)
    df = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in zip(ids, vectors, label)], "vec_id long, embedding array<double>, label int, node string")

    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = []
    for a in range(len(ids)):
        for b in range(a):
            x, y = vectors[a], vectors[b]
            if usable(x) and usable(y) and len(x) == len(y) and label[a] is not None and label[a] == label[b]:
                if np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                    links.append((ids[a], ids[b]))
    root = components_by_hand(ids, links)
    want = {(i, sum(i in p for p in links), root[i], root[i] == i) for i in ids}
    got = [tuple(r) for r in embeddings.near_vectors(df, block_rows=block_rows).collect()]
    assert len(got) == len(ids) and set(got) == want
    assert embeddings.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_vectors_of_extreme_components(spark, kind):
    big, small = (1e200, 1e-200) if kind == "double" else (3e38, 1e-44)
    rows = [(1, [big, big], 1), (2, [big, big], 1), (3, [1.0, 1.0], 1), (4, [small, small], 1), (5, [big, -big], 1), (6, [small, 0.0], 1), (7, [-0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (0, 6), 7: (0, 7)}
    with pytest.raises(TypeError):
        embeddings.near_vectors(df.withColumn("label", df.label.cast("string")))
