"""Order MinHash fingerprints: minimal occurrence-numbered k-mers, in text order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.ranges import id_cuts
from catalens.llm.tasks import map_batches

K, TUPLE, SKETCHES = 8, 2, 64
_DIGITS = 8  # hexadecimal digits of a sketch; a sketch without k-mers is written as dashes
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def numbered_kmers(code: np.ndarray, k: int) -> np.ndarray:
    """A hash per k-mer and number of its occurrence, in text order; a text shorter than k is one k-mer."""
    if not len(code):
        return np.empty(0, dtype=np.uint64)
    k = min(k, len(code))
    n = len(code) - k + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, dtype=np.uint64)
        wide = code.astype(np.uint64)
        for i in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + wide[i : i + n]
        h = _mix(h)
        # one sort groups equal k-mers in text order: hash above, position below
        bits = np.uint64(max(1, int(n - 1).bit_length()))
        place = np.sort((h >> bits << bits) | np.arange(n, dtype=np.uint64))
        group = place >> bits
        new = np.r_[True, group[1:] != group[:-1]]
        rank = np.arange(n)
        occurrence = rank - np.maximum.accumulate(np.where(new, rank, 0))
        if occurrence.any():
            at = (place & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            number = np.empty(n, dtype=np.uint64)
            number[at] = occurrence.astype(np.uint64)
            h = np.where(number > 0, _mix(h + number * _M1), h)
    return h


def sketch(code: np.ndarray, k: int = K, size: int = TUPLE, sketches: int = SKETCHES) -> np.ndarray:
    """A hash per sketch, -1 for a sketch without k-mers.

    The numbered k-mers are dealt to the sketches by their hash, instead of hashing each once per sketch;
    of its own, a sketch takes the ``size`` smallest, puts them in text order and hashes the tuple. So each
    costs one hash, whatever the number of sketches, and equal texts have equal sketches.
    """
    out = np.full(sketches, -1, dtype=np.int64)
    h = numbered_kmers(code, k)
    if not len(h):
        return out
    with np.errstate(over="ignore"):
        deal = _mix(h + np.uint64(1))  # high bits: which sketch, all bits: order inside it
        width = np.uint64(64 - int(sketches - 1).bit_length())
        pick = np.arange(len(h))
        if len(h) > 40 * size * sketches:  # the smallest lie below a cut nearly always; if not, all are looked at
            low = deal & ((np.uint64(1) << width) - np.uint64(1))
            cut = np.uint64(int(float(1 << int(width)) * 20 * size * sketches / len(h)))
            few = np.flatnonzero(low < cut)
            if np.bincount((deal[few] >> width).astype(np.int64), minlength=sketches).min() >= size:
                pick = few
        order = pick[np.argsort(deal[pick], kind="stable")]
        own = (deal[order] >> width).astype(np.int64)
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        count = np.minimum(np.diff(np.append(first, len(own))), size)
        chosen = np.full((len(first), size), len(h), dtype=np.int64)
        for i in range(size):
            has = count > i
            chosen[has, i] = order[first[has] + i]
        chosen.sort(axis=1)  # text order
        value = np.zeros(len(first), dtype=np.uint64)
        padded = np.append(h, np.uint64(0))
        for i in range(size):
            value = _mix(value * np.uint64(3) + padded[chosen[:, i]] + np.uint64(i + 1))
        out[own[first]] = (value >> np.uint64(32)).astype(np.int64)
    return out


def written(s: np.ndarray) -> str:
    return "".join("-" * _DIGITS if v < 0 else f"{v:0{_DIGITS}x}" for v in s.tolist())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal sketches among those that one side has; two empty texts are alike."""
    used = (a >= 0) | (b >= 0)
    return float(((a == b) & used).sum() / used.sum()) if used.any() else 1.0


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def fingerprints(df: DataFrame, row_id: str = "doc_id", text: str = "text", k: int = K, size: int = TUPLE, sketches: int = SKETCHES) -> DataFrame:
    """(row_id, fingerprint) of every row; null text counts as empty."""
    kind = dict(df.dtypes)[row_id]

    def run(batches):
        for b in batches:
            made = [written(sketch(_codes(t.as_py() or ""), k, size, sketches)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.string())], names=[row_id, "fingerprint"])

    return map_batches(df.select(row_id, F.col(text).cast("string").alias("_text")), run, f"`{row_id}` {kind}, fingerprint string")


def fingerprints_with_edits(df: DataFrame, row_id: str = "doc_id", text: str = "text", part_rows: int = 4096) -> DataFrame:
    """(row_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next
    row's text, or all of it, in ascending ``row_id`` (after the last row: the first one's). Ids are taken
    as unique, of any type that Spark can order; rows that repeat an id are put in the order of their text's hash,
    null ids come first. An empty table gives an empty result.

    Each part of the id order is one sorted group of ``part_rows`` rows or more that a task reads as a stream;
    the first row of a part is copied to the end of the part before it, so a text is shuffled once.
    """
    from pyspark.sql import Window

    own = df.select(F.col(row_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    rows = own.count()
    ids = own.select("_id").filter("_id is not null")
    # a part is read as a stream, so its size is free: no more parts than the cluster's partitions can use
    parts = max(1, min(-(-rows // part_rows), 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    cuts = id_cuts(ids, "_id", [i / parts for i in range(1, parts)], 0.1 / parts)
    part = F.lit(0)
    if cuts:  # how many cuts lie below the id: first among every 64th, then among the next 64
        def below(some) -> F.Column:
            return F.size(F.filter(some, lambda c: c < F.col("_id")))

        coarse = 64 * below(F.array(*map(F.lit, cuts[63::64]))) if len(cuts) >= 64 else F.lit(0)
        part = F.coalesce(coarse + below(F.slice(F.array(*map(F.lit, cuts)), coarse + 1, F.lit(64))), F.lit(0))
    order = F.struct(F.col("_id").isNotNull().alias("f"), F.col("_id").alias("i"), F.xxhash64("_text").alias("h"))
    placed = own.withColumn("_part", part).withColumn("_order", order)
    # the least row of each part, one row per part
    firsts = placed.groupBy("_part").agg(F.min("_order").alias("_least"))
    before = F.coalesce(F.lag("_part").over(Window.orderBy("_part")), F.lit(None))
    firsts = firsts.select("_part", "_least", before.alias("_before"), F.max("_part").over(Window.partitionBy(F.lit(0))).alias("_last"))
    known = {r["_part"]: (r["_least"]["i"], r["_least"]["h"], r["_last"] if r["_before"] is None else r["_before"]) for r in firsts.collect()}
    to = df.sparkSession.createDataFrame(
        [(p, i, h, b) for p, (i, h, b) in known.items()], f"_part int, _first_id {dict(own.dtypes)['_id']}, _first_hash long, _to int"
    )
    # one row per part, a bounded number
    met = placed.join(F.broadcast(to), "_part")
    is_first = F.col("_id").eqNullSafe(F.col("_first_id")) & (F.col("_order.h") == F.col("_first_hash"))
    both = F.when(is_first, F.array(F.struct(F.col("_part").alias("p"), F.lit(False).alias("tail")), F.struct(F.col("_to").alias("p"), F.lit(True).alias("tail"))))
    dealt = met.select("_id", "_text", "_order", F.explode(F.coalesce(both, F.array(F.struct(F.col("_part").alias("p"), F.lit(False).alias("tail"))))).alias("_at"))
    dealt = dealt.select("_at.p", "_at.tail", "_order.f", F.col("_order.i").alias("i"), F.col("_order.h").alias("h"), "_id", "_text")
    kind = dict(own.dtypes)["_id"]
    done = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

    def run(batches):
        import hashlib

        def made(row, following):
            own_id, text_, code, sk = row
            n = len(text_)
            edited = text_[: n - n // 2] + following[1][: n // 2]
            e = sketch(_codes(edited)) if edited != text_ else sk
            return own_id, n, hashlib.sha256(edited.encode()).hexdigest(), written(sk), written(e), likeness(sk, e), likeness(sk, following[3])

        held, at, out = None, None, []
        for b in batches:
            for p, tail, own_id, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                text_ = t.as_py()
                code = _codes(text_)
                row = own_id, text_, code, sketch(code)
                if held is not None and at == p:
                    out.append(made(held, row))
                held, at = (None, None) if tail else (row, p)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, b.schema.field(2).type) for i, c in enumerate(zip(*out))], names=["_id", *[d.split()[0] for d in done.split(", ")]])
                out = []

    ordered = dealt.repartition(len(known) or 1, "p").sortWithinPartitions("p", "tail", "f", "i", "h").select("p", "tail", "_id", "_text")
    return map_batches(ordered, run, f"_id {kind}, {done}").withColumnRenamed("_id", row_id)
