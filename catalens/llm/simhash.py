"""SimHash fingerprints of word shingles, linked by pivot distance tables.

Candidates meet in blocks of equal bits (``exact_keys``: no pair is lost) or in tables of sampled bits
(``sampled_keys``: for wide radii, with a stated recall). In a block, every fingerprint has a row of
precomputed distances to reference fingerprints; by the triangle inequality a pair whose rows differ by
more than the radius in any place is discarded. The Hamming distance is computed for what is left.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.components import connected_components
from catalens.llm.tasks import map_batches
from catalens.llm.tiles import Forest, over_tiles, sides, tiled
from catalens.staging import stage

_CHUNK = 1 << 16  # shingles whose bits are counted at a time


def shingle_hashes(text: str | None, words: int, bits: int = 64) -> np.ndarray:
    """(shingles, bits / 64) hashes of a text's word shingles, repeats included; no word: no row.

    White space is [\\x20\\x09-\\x0D] and only A-Z is lower-cased, which is what bytes.lower and
    bytes.split do. Fewer words than a shingle: the whole sequence is the one shingle.
    """
    w = (text or "").encode().lower().split()
    if not w:
        return np.empty((0, bits // 64), dtype=np.uint64)
    runs = [w] if len(w) < words else zip(*(w[i:] for i in range(words)))
    joined = map(b" ".join, runs)
    if bits == 64:
        digest = xxhash.xxh64_intdigest
        return np.fromiter((digest(s, 42) for s in joined), dtype=np.uint64).reshape(-1, 1)
    digests = [[xxhash.xxh3_128_digest(s, 42 + k) for k in range(bits // 128)] for s in joined]
    return np.frombuffer(b"".join(d for row in digests for d in row), dtype="<u8").reshape(-1, bits // 64)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """Bits set in over half the hashes, as 64-bit words; without hashes: zero."""
    n, lanes = hashes.shape
    counts = np.zeros(64 * lanes, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        raw = np.ascontiguousarray(hashes[at : at + _CHUNK]).view(np.uint8).reshape(-1, 8 * lanes)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)


def distinct_hashes(hashes: np.ndarray) -> np.ndarray:
    """The rows of ``hashes`` without repeats: the set of shingles, told apart by their first 64 bits."""
    return hashes[np.unique(hashes[:, 0], return_index=True)[1]]


def fingerprints(df: DataFrame, row_id: str, text: str = "text", words: int = 3, bits: int = 64, distinct: bool = False) -> DataFrame:
    """(row_id, fp0, fp1, ...): the fingerprint's 64-bit words as signed longs. Null text counts as empty.

    ``distinct``: a repeated shingle counts once, so that the bits follow the sets of shingles, and a column
    ``n_shingles`` tells their number.
    """
    lanes = bits // 64
    kind = dict(df.dtypes)[row_id]
    names = [f"fp{k}" for k in range(lanes)] + ["n_shingles"] * distinct

    def run(batches):
        for b in batches:
            made, size = np.empty((b.num_rows, lanes), dtype=np.uint64), np.empty(b.num_rows, dtype=np.int64)
            for i, t in enumerate(b.column(1)):
                hashes = shingle_hashes(t.as_py(), words, bits)
                if distinct:
                    hashes = distinct_hashes(hashes)
                made[i], size[i] = fingerprint(hashes), len(hashes)
            cols = [pa.array(np.ascontiguousarray(made[:, k]).view(np.int64)) for k in range(lanes)]
            more = [pa.array(size)] if distinct else []
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, *more], names=[row_id, *names])

    return map_batches(
        df.select(row_id, F.col(text).cast("string").alias("_text")), run, f"`{row_id}` {kind}, " + ", ".join(f"{n} long" for n in names)
    )


def exact_keys(radius: int) -> list[list[int]]:
    """Bit sets of which one at least is equal in any two 64-bit fingerprints at ``radius`` or less.

    The bits are cut into radius + 2 runs; that many differing bits leave two runs untouched, and a set
    is two whole runs.
    """
    cuts = np.array_split(np.arange(64), radius + 2)
    return [[*map(int, a), *map(int, b)] for a, b in combinations(cuts, 2)]


def sampled_keys(rows: int, bits: int, agree: float, recall: float, seed: int, bucket_rows: int = 1024) -> list[list[int]]:
    """Seeded bit samples: a pair that agrees in a share ``agree`` of its bits meets in one with probability ``recall``.

    The sample size follows the logarithm of ``rows``, so buckets of unrelated rows stay at ``bucket_rows``.
    """
    size = max(2, round(math.log2(max(rows, 2) / bucket_rows)))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - agree**size))
    rng = np.random.default_rng(seed)
    return [sorted(map(int, rng.choice(bits, size, replace=False))) for _ in range(tables)]


def _key(positions: list[int]) -> F.Column:
    """The bits at the positions, as a long: a mask per word, hashed where there is more than one word."""
    masks: dict[int, int] = {}
    for p in positions:
        masks[p // 64] = masks.get(p // 64, 0) | 1 << (p % 64)
    signed = {k: m - (1 << 64) if m >> 63 else m for k, m in masks.items()}
    parts = [F.col(f"fp{k}").bitwiseAND(F.lit(m).cast("long")) for k, m in sorted(signed.items())]
    return parts[0] if len(parts) == 1 else F.xxhash64(*parts)


def pivots(count: int, lanes: int, seed: int = 7) -> np.ndarray:
    """Seeded reference fingerprints."""
    return np.random.default_rng(seed).integers(0, np.iinfo(np.uint64).max, (count, lanes), dtype=np.uint64, endpoint=True)


def distance_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """(references, rows) Hamming distances."""
    return np.stack([np.bitwise_count(fps ^ r).sum(1, dtype=np.int16) for r in refs])


def close_pairs(fps: np.ndarray, table: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int):
    """Yield (left row, right rows within the radius), the right ones behind the left one where sides are the same."""
    same = left is right
    step = max(1, (1 << 20) // max(1, len(right)))
    for at in range(0, len(left), step):
        rows = left[at : at + step]
        near = np.ones((len(rows), len(right)), dtype=bool)
        if same:
            near &= right[None, :] > rows[:, None]
        for d in table:  # discard by the largest coordinate difference
            near &= np.abs(d[rows][:, None] - d[right][None, :]) <= radius
        a, b = np.nonzero(near)
        if not len(a):
            continue
        found = np.bitwise_count(fps[rows[a]] ^ fps[right[b]]).sum(1) <= radius
        a, b = a[found], b[found]
        for own in np.split(np.arange(len(a)), np.flatnonzero(np.diff(a)) + 1):
            if len(own):
                yield int(rows[a[own[0]]]), right[b[own]]


def _small_pairs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of small groups, without a loop over the groups."""
    ends = np.repeat(starts + sizes, sizes)
    rows = np.arange(len(ends)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    after = ends - rows - 1
    left = np.repeat(rows, after)
    return left, left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)


def link_fingerprints(fps: DataFrame, node: str, keys: list[list[int]], bits: int, radius: int, refs: int = 16, block_rows: int = 4096) -> DataFrame:
    """Pairs (a, b) whose components are those of all links between nodes: a shared key and ``radius`` or fewer differing bits.

    One row of ``fps`` (node, fp0, ...) per distinct fingerprint. A tile joins its linked nodes into trees
    and returns those, so rows grow with the nodes alone; a pair of a tree need not be a link itself.
    """
    lanes = bits // 64
    names = [f"fp{k}" for k in range(lanes)]
    keyed = fps.select(node, *names, F.explode(F.array(*[F.struct(F.lit(t).alias("table"), _key(k).alias("key")) for t, k in enumerate(keys)])).alias("_k"))
    keyed = keyed.select(node, *names, "_k.table", "_k.key")
    refs_ = pivots(refs, lanes)

    def work(table: pa.Table, at: np.ndarray) -> pa.RecordBatch:
        ids = table.column(node).to_numpy()
        fp = np.stack([table.column(n).to_numpy().view(np.uint64) for n in names], axis=1)
        dist = distance_table(fp, refs_)
        block, ti, tj = (table.column(c).to_numpy() for c in ("block", "tile_i", "tile_j"))
        out_a, out_b = [], []
        sizes = np.diff(at)
        small = (sizes <= 24) & (ti[at[:-1]] == tj[at[:-1]])
        left, right = _small_pairs(at[:-1][small], sizes[small])
        if len(left):
            keep = np.ones(len(left), dtype=bool)
            for d in dist:
                keep &= np.abs(d[left] - d[right]) <= radius
            left, right = left[keep], right[keep]
            keep = np.bitwise_count(fp[left] ^ fp[right]).sum(1) <= radius
            out_a.append(ids[left[keep]])
            out_b.append(ids[right[keep]])
        for g in np.flatnonzero(~small):
            own = slice(at[g], at[g + 1])
            one, two = sides(block[own], ti[at[g]], tj[at[g]])
            forest = Forest(sizes[g])
            for row, others in close_pairs(fp[own], dist[:, own], one, two, radius):
                forest.join(row, others)
            if forest.links:
                links = np.array(forest.links)
                out_a.append(ids[own][links[:, 0]])
                out_b.append(ids[own][links[:, 1]])
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (out_a, out_b))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    tiles = tiled(keyed, ["table", "key"], node, block_rows)
    return over_tiles(tiles, ["table", "key"], work, "a long, b long").filter("a != b").distinct()


def simhash_components(df: DataFrame, row_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """(row_id, fingerprint, component_id): 64-bit fingerprints linked at ``radius`` or fewer differing bits.

    ``fingerprint``: 16 lower-case hexadecimal digits; ``component_id``: the smallest row id reachable by
    links, itself included. Null and empty texts have fingerprint zero and link like any other. Repeated
    rows stay, with the same component; a null id is never the smallest (null only where a component has
    no other). Rows of equal fingerprint meet in a partial aggregate first, so a group of copies is one
    node. Other columns are ignored.
    """
    own = stage(fingerprints(df.select(row_id, text), row_id, text, words))
    nodes = stage(own.groupBy("fp0").agg(F.min(row_id).alias("_first")))
    links = link_fingerprints(nodes.select(F.col("fp0").alias("node"), "fp0"), "node", exact_keys(radius), 64, radius)
    moved = connected_components(links)
    tied = nodes.join(moved, nodes.fp0 == moved.node, "left").select("fp0", "_first", F.coalesce("component", "fp0").alias("_root"))
    least = tied.groupBy("_root").agg(F.min("_first").alias("component_id"))
    place = tied.join(least, "_root").select("fp0", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp0"), 16, "0"))
    return own.join(place, "fp0").select(row_id, hexed.alias("fingerprint"), "component_id")


def drop_near_duplicates(df: DataFrame, row_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """``df`` with one row of each component of ``simhash_components``: the one with the smallest id, nulls last.

    Of rows that repeat that id one stays. Null and empty texts are alike. All columns are carried, whatever their names.
    """
    rows = stage(df.select(F.struct("*").alias("doc")).withColumn("row", F.monotonically_increasing_id()))
    ident, whole = F.col("doc")[row_id], F.col("doc")[text]
    named = rows.select(F.struct(ident.isNull().alias("none"), ident.alias("id"), "row").alias("who"), whole.alias("text"))
    gone = simhash_components(named, "who", "text", words, radius).filter("who.row <> component_id.row").select("who.row")
    return rows.join(gone, "row", "left_anti").select("doc.*")
