"""Phrase collocations by SON partitioning.

Documents are dealt to a few shards. Each shard is mined completely at the support lowered in proportion to its
share of the text; a phrase frequent overall is frequent in at least one shard, so the union of the local results
misses none. A last pass counts all candidates over all documents exactly, by their words.

Mining and filtering go by 64-bit hashes: a collision or a false positive of the filter adds a candidate, which the
exact count refuses again. The shards stay few because the support is an absolute number: beyond ``min_count`` shards
the local support would be one. A shard is therefore mined by many tasks, which combine their counts by key range.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalens.llm import tokens
from catalens.llm.tasks import map_batches, ship
from catalens.staging import stage

_SLICE_BYTES = 8 << 20  # text read into words at a time
_HELD_KEYS = 4_000_000  # counts a task combines before it hands them on
_RANGE_BYTES = 16 << 20  # text for each range of keys: bounds what one group of ``_frequent_keys`` holds
_FILTER_BITS_MAX = 1 << 28  # 32 MB: the largest filter that is broadcast
_FILTER_BLOCK = 1 << 16  # bits
_TABLE = tokens.kinds(gap=b" \t", brk=b".,;:!?\n\x0b\x0c\r")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Slice:
    """The words of some rows of one language, with the hashes of their phrases."""

    def __init__(self, texts: pa.Array, lang: str):
        import xxhash

        self.ids, self.words, _, self.piece = tokens.words(texts, _TABLE)
        seed = xxhash.xxh64_intdigest(lang) & 0x7FFFFFFF
        known = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words.to_pylist()), np.uint64, len(self.words))
        self.hashes = [known[self.ids]] if len(self.ids) else [np.empty(0, np.uint64)]

    def keys(self, n: int) -> np.ndarray:
        """Hash of the n words from each place on; places near the end of a piece have none of their own (see ``whole``)."""
        while len(self.hashes) < n:
            k = len(self.hashes)
            before, last = self.hashes[-1], self.hashes[0]
            self.hashes.append(_mix(before[: max(len(last) - k, 0)] * _ODD + last[k:]))
        return self.hashes[n - 1]

    def whole(self, n: int) -> np.ndarray:
        """Places from which n words lie in one piece."""
        return self.piece[: max(len(self.piece) - n + 1, 0)] == self.piece[n - 1 :]


def _combine(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed counts (ones by default)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys))).astype(np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Filter:
    """A set of keys with false positives: two bits a key in a table of bounded size."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    @staticmethod
    def places(keys: np.ndarray, n_bits: int) -> np.ndarray:
        mask = np.uint64(n_bits - 1)
        return np.concatenate([keys & mask, (keys >> np.uint64(28)) * _ODD >> np.uint64(20) & mask])

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.places(keys, len(self.bits) * 8)
        hit = (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
        return (hit[: len(keys)] & hit[len(keys) :]).astype(bool)


def _build_filter(keys: DataFrame) -> Filter:
    """The filter of a staged table of packed keys; tasks set the bits, the driver joins blocks of a table of bounded size."""
    n = keys.agg(F.sum(F.octet_length("keys") / 8)).first()[0] or 0
    bits = int(min(_FILTER_BITS_MAX, max(_FILTER_BLOCK, 1 << int(16 * n).bit_length())))

    def set_bits(batches):
        for b in batches:
            at = np.unique(Filter.places(np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64), bits)).astype(np.int64)
            block = at // _FILTER_BLOCK
            cut = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(at) else []
            yield pa.record_batch({"block": pa.array(block[cut], pa.int32()), "places": pa.array([(p % _FILTER_BLOCK).astype(np.uint16).tobytes() for p in np.split(at, cut[1:])] if len(at) else [], pa.binary())})

    def join_bits(group: pa.Table) -> pa.Table:
        table = np.zeros(_FILTER_BLOCK, dtype=bool)
        for p in group["places"].to_pylist():
            table[np.frombuffer(p, np.uint16)] = True
        return pa.table({"block": group["block"][:1], "bits": pa.array([np.packbits(table, bitorder="little").tobytes()], pa.binary())})

    table = np.zeros(bits // 8, dtype=np.uint8)
    blocks = map_batches(keys.select("keys"), set_bits, "block int, places binary").groupBy("block").applyInArrow(join_bits, "block int, bits binary")
    for block, part in blocks.toLocalIterator():
        table[block * _FILTER_BLOCK // 8 :][: _FILTER_BLOCK // 8] = np.frombuffer(part, np.uint8)
    return Filter(table)


def _by_lang(batch: pa.RecordBatch, n: int):
    """(first ``n`` column values, texts) of each run of rows with equal values there, a slice of text at a time."""
    text = batch.column(n)
    names = [f"k{i}" for i in range(n)]
    groups = pa.table([*batch.columns[:n], pa.array(np.arange(len(text)))], names=[*names, "at"]).group_by(names).aggregate([("at", "list")])
    for row in groups.to_pylist():
        mine = text.take(pa.array(row["at_list"]))
        for lo, hi in tokens.slices(mine, _SLICE_BYTES):
            yield [row[k] for k in names], mine.slice(lo, hi - lo)


def _mine(docs: DataFrame, levels: Sequence[int], ranges: int, narrower=None) -> DataFrame:
    """Packed keys of the phrases of ``levels`` words that are frequent in some shard.

    ``narrower``: broadcast filter of shorter candidates; phrases that hold another part are left out.
    """

    def count(batches):
        held: dict[tuple, list] = {}
        size = 0

        def flush():
            for (lang, shard, support), parts in held.items():
                keys, counts = _combine(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                part = (keys >> np.uint64(32)).astype(np.int64) * ranges >> 32
                cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(keys) else np.empty(0, np.int64)
                ends = np.append(cut, len(keys))
                yield pa.record_batch({
                    "lang": pa.array([lang] * len(cut), pa.string()),
                    "shard": pa.array([shard] * len(cut), pa.int32()),
                    "support": pa.array([support] * len(cut), pa.int64()),
                    "part": pa.array(part[cut], pa.int32()),
                    "keys": pa.array([keys[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                    "counts": pa.array([_pack(counts[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                })
            held.clear()

        for b in batches:
            for group, texts in _by_lang(b, 3):
                read = _Slice(texts, group[0])
                shorter = None if narrower is None else narrower.value(read.keys(levels[0] - 1))
                for n in levels:
                    ok = read.whole(n)
                    if shorter is not None:
                        for k in range(n - levels[0] + 2):
                            ok = ok & shorter[k : k + len(ok)]
                    found = _combine(read.keys(n)[ok])
                    size += len(found[0])
                    held.setdefault(tuple(group), []).append(found)
            if size > _HELD_KEYS:
                yield from flush()
                size = 0
        yield from flush()

    def frequent(group: pa.Table) -> pa.Table:
        shard, support = group["shard"].to_numpy(), group["support"].to_numpy()
        packed, counts = group["keys"].to_pylist(), group["counts"].to_pylist()
        found = []
        for s in np.unique(shard):
            at = np.flatnonzero(shard == s)
            keys, total = _combine(
                np.concatenate([np.frombuffer(packed[i], np.uint64) for i in at]),
                np.concatenate([_unpack(counts[i], len(packed[i]) // 8) for i in at]),
            )
            found.append(keys[total >= support[at[0]]])
        keys = np.unique(np.concatenate(found))
        return pa.table({"keys": pa.array([keys.tobytes()], pa.binary())})

    counted = map_batches(docs.select("lang", "shard", "support", "text"), count, "lang string, shard int, support long, part int, keys binary, counts binary")
    return counted.groupBy("lang", "part").applyInArrow(frequent, "keys binary")


def _pack(counts: np.ndarray) -> bytes:
    """A byte for each count, 0 for those that need more, and these behind them."""
    small = np.where(counts > 255, 0, counts).astype(np.uint8)
    return small.tobytes() + counts[counts > 255].astype(np.int64).tobytes()


def _unpack(packed: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(packed[:n], np.uint8).astype(np.int64)
    counts[counts == 0] = np.frombuffer(packed[n:], np.int64)
    return counts


def _distinct_rows(columns: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct row, how many rows equal it) of whole numbers under 2^32, compared exactly."""
    code = columns[0].astype(np.uint64)
    for c in columns[1:]:
        code = np.unique(code, return_inverse=True)[1].astype(np.uint64) << np.uint64(32) | c.astype(np.uint64)
    _, at, counts = np.unique(code, return_index=True, return_counts=True)
    return at, counts


def _count(docs: DataFrame, longest: int, candidates) -> DataFrame:
    """(lang, words, phrase, f) of all candidates, by their words; with no words: the occurrences of all words."""

    def count(batches):
        for b in batches:
            for (lang,), texts in _by_lang(b, 1):
                read, known = _Slice(texts, lang), candidates.value
                yield _counted(lang, 0, pa.array([""]), np.array([len(read.ids)]))
                for n in range(1, longest + 1):
                    at = np.flatnonzero(read.whole(n))
                    at = at[known(read.keys(n)[at])]
                    columns = [read.ids[at + k] for k in range(n)]
                    if not len(at):
                        continue
                    first, counts = _distinct_rows(columns)
                    spelt = [read.words.take(pa.array(c[first])).cast(pa.large_string()) for c in columns]
                    phrase = pc.binary_join_element_wise(*spelt, pa.scalar(" ", pa.large_string())) if n > 1 else spelt[0]
                    yield _counted(lang, n, phrase.cast(pa.string()), counts)

    counted = map_batches(docs.select("lang", "text"), count, "lang string, words int, phrase string, f long")
    return counted.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))


def _counted(lang: str, n: int, phrase: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    size = len(phrase)
    return pa.record_batch({
        "lang": pa.array([lang] * size, pa.string()), "words": pa.array([n] * size, pa.int32()),
        "phrase": phrase, "f": pa.array(counts, pa.int64()),
    })


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 30, longest: int = 4, shards: int = 4) -> DataFrame:
    """(lang, words, phrase, f): every phrase of 1 to ``longest`` words that occurs ``min_count`` times in its language.

    ``words`` = 0 has the number of all word occurrences of a language. A null language counts as ``und``, a null text
    as empty; rows that repeat count each time. Texts are read whole. Only the two columns named are read, so other
    columns may have any name. An empty table gives no rows. ``shards``: at most ``min_count``; fewer prune more.
    """
    ship(df.sparkSession)
    spark = df.sparkSession
    docs = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    dealt = docs.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int"))
    size = dealt.groupBy("lang", "shard").agg(F.sum(F.octet_length("text")).alias("size"))
    whole = F.greatest(F.sum("size").over(Window.partitionBy("lang")), F.lit(1))
    lowered = stage(size.select("lang", "shard", "size", F.greatest(F.expr("1L"), F.ceil(F.lit(min_count).cast("decimal(20,0)") * F.col("size") / whole)).cast("long").alias("support")))
    ranges = int(max(1, (lowered.agg(F.sum("size")).first()[0] or 0) // _RANGE_BYTES))
    dealt = dealt.join(lowered.drop("size"), ["lang", "shard"])
    found, narrower = [], None
    for n in range(1, longest + 1, 2):
        levels = [k for k in (n, n + 1) if k <= longest]
        found.append(stage(_mine(dealt, levels, ranges, narrower)))
        narrower = spark.sparkContext.broadcast(_build_filter(found[-1]))
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    counts = _count(docs, longest, spark.sparkContext.broadcast(_build_filter(union)))
    return counts.filter((F.col("f") >= min_count) | (F.col("words") == 0))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 30, longest: int = 4, top: int = 2000, absorbed: int = 80, shards: int = 4) -> DataFrame:
    """The ``top`` phrases of each language by floor(2000000 a / (l + r)) at their weakest cut.

    (lang, rank, phrase, a, l, r, n, score): ``a`` occurrences of the phrase, ``l`` and ``r`` of its parts, ``n`` of
    all words. A phrase goes when a longer frequent one around it has ``absorbed`` per cent of its occurrences. Ties:
    the earlier cut; equal scores by ``a`` descending, then by the phrase's bytes. See ``frequent_phrases`` for nulls,
    repeated rows and empty tables.
    """
    f = stage(frequent_phrases(df, text, lang, min_count, longest, shards))
    candidates = f.filter("words > 1").withColumnRenamed("f", "a")
    part = f.filter(F.col("words").between(1, longest - 1))
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.selectExpr("*", "substring_index(phrase, ' ', cut) AS head", "substring_index(phrase, ' ', cut - words) AS rest")
    cuts = cuts.join(part.selectExpr("lang", "phrase AS head", "f AS l"), ["lang", "head"]).join(part.selectExpr("lang", "phrase AS rest", "f AS r"), ["lang", "rest"])
    # the quotient is at most a million: only the dividend needs more than 64 bits
    scored = cuts.withColumn("score", F.expr("CAST(a AS DECIMAL(20,0)) * 2000000 DIV (CAST(l AS DECIMAL(20,0)) + r)"))
    weakest = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    inner = candidates.filter("words > 2").select(
        "lang", F.col("a").alias("around"),
        F.explode(F.expr(
            "flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1),"
            " i -> array_join(slice(split(phrase, ' ', -1), i, n), ' '))))"
        )).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = weakest.join(inner, ["lang", "phrase"], "left").filter(F.expr(f"coalesce(CAST(around AS DECIMAL(20,0)) * 100 < CAST(a AS DECIMAL(20,0)) * {int(absorbed)}, true)"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    best = kept.select("lang", "phrase", "a", "w.l", "w.r", "w.score").withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.join(f.filter("words = 0").select("lang", F.col("f").alias("n")), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
