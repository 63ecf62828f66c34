"""Embedding near duplicates by int8 tile products with error bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.llm.components import connected_components
from catalens.llm.tiles import Forest, over_tiles, sides, tiled
from catalens.staging import stage

_SLACK = 1e-9  # covers the rounding of the bounds themselves, many times over
_ROWS = 256  # rows of a tile compared at a time


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scales and error bounds of unit vectors: |v - scale * code| <= error."""
    scale = np.abs(vectors).max(1) / 127
    scale[scale == 0] = 1
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    error = np.sqrt(((vectors - scale[:, None] * codes) ** 2).sum(1)) * (1 + 1e-12)
    return codes, scale, error


def cosines_above(unit: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float):
    """Yield (left row, right rows of cosine >= threshold); right ones behind the left one where sides are the same.

    Int8 products give each cosine up to e1 (1 + e2) + e2, the error bounds of the two vectors; only pairs
    that the bound leaves possible are computed in double precision. The products are sums of integers
    below 2^24 in float32 blocks of 1,024 dimensions, so they are exact.
    """
    same = left is right
    codes, scale, error = quantise(unit)
    codes = codes.astype(np.float32)
    for at in range(0, len(left), _ROWS):
        rows = left[at : at + _ROWS]
        product = np.zeros((len(rows), len(right)))
        for d in range(0, codes.shape[1], 1024):
            product += codes[rows, d : d + 1024] @ codes[right, d : d + 1024].T
        most = product * scale[rows][:, None] * scale[right][None, :]
        most += error[rows][:, None] * (1 + error[right][None, :]) + error[right][None, :] + _SLACK
        near = most >= threshold
        if same:
            near &= right[None, :] > rows[:, None]
        a, b = np.nonzero(near)
        for lo in range(0, len(a), 1 << 16):  # in full precision
            x, y = a[lo : lo + (1 << 16)], b[lo : lo + (1 << 16)]
            near[x, y] = np.einsum("ij,ij->i", unit[rows[x]], unit[right[y]]) >= threshold
        for i in np.flatnonzero(near.any(1)):
            yield int(rows[i]), right[near[i]]


_EXTREME = 1e100  # beyond it, or below its inverse, squares may overflow or vanish


def _cells(df: DataFrame, embedding: str) -> Column:
    """The components in the type they are stored in if that is float, else as doubles; -0.0 counts as 0.0."""
    kind = "float" if df.schema[embedding].dataType.elementType.typeName() == "float" else "double"
    return F.transform(F.col(embedding), lambda x: F.when(x == 0, F.lit(0).cast(kind)).otherwise(x.cast(kind)))


def _copies(df: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """Distinct usable vectors of a label: (label, v, node, copies, shrink, norm); the unit vector is v / shrink / norm."""
    usable = F.col(embedding).isNotNull() & F.col(label).isNotNull() & ~F.exists(
        F.col(embedding), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )
    rows = df.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), _cells(df, embedding).alias("v"), usable.alias("ok")).filter("ok and id is not null")
    rows = rows.groupBy("label", "v").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    top = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    rows = rows.withColumn("top", top).filter("top > 0")
    rows = rows.withColumn("shrink", F.when((F.col("top") > _EXTREME) | (F.col("top") < 1 / _EXTREME), F.col("top")).otherwise(1.0)).drop("top")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x.cast("double") / F.col("shrink")) * (x.cast("double") / F.col("shrink")))
    return rows.withColumn("norm", F.sqrt(square))


def near_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = 0.98, block_rows: int = 2048) -> DataFrame:
    """(vec_id, n_links, component_id, kept): vectors of equal label linked at cosine >= threshold.

    One row per row of ``df``. ``n_links``: rows linked directly, itself not counted; ``component_id``: the
    smallest vec_id reachable by links; ``kept``: whether that is the row's own. Vectors that are null,
    zero, or hold a null or non-finite component, vectors without label, and rows without id link with
    nothing (component_id is their own id). Vectors of different length don't link. Equal vectors meet in a
    partial aggregate and are one node with a count; the rest of a label is compared in tiles of at most
    two blocks, whatever its size. Components travel as they are stored, floats as four bytes; a tile makes
    unit vectors and codes of them. It returns link counts per vector and a spanning forest of its
    links, never all pairs. Ids are taken as unique. Components may be as large or small as doubles are: where squares
    would overflow or vanish, a vector is divided by its largest component first. Labels of another type than
    integers raise a TypeError.
    """
    nodes = stage(_copies(df, vec_id, embedding, label).withColumn("size", F.size("v")))
    tiles = tiled(nodes.select("label", "size", "node", "copies", "v", "shrink", "norm"), ["label", "size"], "node", block_rows)
    kinds = nodes.schema["label"].dataType.typeName()
    if kinds not in ("byte", "short", "integer", "long"):
        raise TypeError("labels are integers")

    def work(table: pa.Table, at: np.ndarray) -> pa.RecordBatch:
        ids, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        block, ti, tj = (table.column(c).to_numpy() for c in ("block", "tile_i", "tile_j"))
        lists = table.column("v").combine_chunks()
        values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        shrink, norm = table.column("shrink").to_numpy(), table.column("norm").to_numpy()
        out = []  # node, links counted here, other node of a forest link
        for lo, hi in zip(at[:-1], at[1:]):
            unit = values[ends[lo] : ends[hi]].reshape(hi - lo, -1).astype(np.float64)
            unit = unit / shrink[lo:hi, None] / norm[lo:hi, None]
            one, two = sides(block[lo:hi], ti[lo], tj[lo])
            forest, links = Forest(hi - lo), np.zeros(hi - lo, dtype=np.int64)
            own = copies[lo:hi]
            for row, others in cosines_above(unit, one, two, threshold):
                links[row] += own[others].sum()
                links[others] += own[row]
                forest.join(row, others)
            found = np.flatnonzero(links)
            out.append((ids[lo + found], links[found], np.full(len(found), -1), np.zeros(len(found), bool)))
            if forest.links:
                pairs = np.array(forest.links) + lo
                out.append((ids[pairs[:, 0]], np.zeros(len(pairs), np.int64), ids[pairs[:, 1]], np.ones(len(pairs), bool)))
        cols = [np.concatenate(x) for x in zip(*out)]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["node", "links", "other", "is_link"])

    found = stage(over_tiles(tiles.withColumn("node", F.col("node").cast("long")), ["label", "size"], work, "node long, links long, other long, is_link boolean"))
    moved = connected_components(found.filter("is_link"), "node", "other")
    counts = found.filter("not is_link").groupBy("node").agg(F.sum("links").alias("links"))
    placed = (
        nodes.select("node", "copies", "label", "v").join(counts, "node", "left").join(moved, "node", "left")
        .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
        .filter("n_links > 0")
    )
    own = df.select(F.col(vec_id).alias("_id"), F.when(F.col(vec_id).isNotNull(), F.col(label)).alias("label"), _cells(df, embedding).alias("v"))
    joined = own.withColumn("_digest", F.xxhash64("v")).join(placed.withColumn("_digest", F.xxhash64("v")), ["_digest", "label", "v"], "left")
    component = F.coalesce("component_id", "_id")
    return joined.select(
        F.col("_id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"),
        F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"),
    )
