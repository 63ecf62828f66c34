"""Compare the rows of a group with each other in tiles of bounded size, in as many tasks as there are tiles."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.llm.tasks import map_batches

TILE = ("tile_i", "tile_j")


def tiled(df: DataFrame, keys: Sequence[str], row_id: str, block_rows: int, weight: Column | None = None, block_weight: int = 1) -> DataFrame:
    """Rows of groups of two or more, once per tile of their group: adds ``tile_i, tile_j, block``.

    A group of n rows gets ``ceil(n / block_rows)`` blocks (more if the sum of ``weight`` asks for it), a
    row one of them by a hash of ``row_id``, and each pair of blocks one tile. So no task holds more than
    two blocks, whatever the size of a group; a group of one block is one tile.
    """
    total = F.sum(weight) if weight is not None else F.lit(0)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"), total.alias("_w")).filter("_n > 1")
    blocks = F.greatest(F.ceil(F.col("_n") / block_rows), F.ceil(F.col("_w") / block_weight), F.lit(1)).cast("int")
    placed = (
        df.join(sizes, list(keys)).withColumn("_blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(row_id), F.col("_blocks")).cast("int"))
    )
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    return (
        placed.select("*", other)
        .withColumn("tile_i", F.least("block", "_other")).withColumn("tile_j", F.greatest("block", "_other"))
        .drop("_n", "_w", "_blocks", "_other")
    )


def whole_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the groups' bounds, from batches sorted by ``keys`` (integers)."""

    def bounds(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        new[:1] = True
        for k in keys:
            v = table.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.append(np.flatnonzero(new), table.num_rows)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and all(held[-1].column(k)[-1].as_py() == batch.column(k)[-1].as_py() for k in keys):
            held.append(batch)  # sorted: the same group all through
            continue
        table = pa.Table.from_batches([*held, batch])
        at = bounds(table)
        last = int(at[-2])
        if last:
            yield table.slice(0, last), at[:-1]
        held = table.slice(last).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, bounds(table)


def over_tiles(tiles: DataFrame, keys: Sequence[str], work: Callable[[pa.Table, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """Run ``work(table, bounds)`` over the tiles, many small ones in one call."""
    by = [*keys, *TILE]

    def run(batches):
        for table, at in whole_groups(batches, by):
            made = work(table.combine_chunks(), at)
            if made.num_rows:
                yield made

    return map_batches(tiles.repartition(*by).sortWithinPartitions(*by), run, schema)


class Forest:
    """Joins rows of a tile; keeps one link per join, so a clique of n rows leaves n - 1 links."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def join(self, row: int, others: np.ndarray) -> None:
        roots = np.unique(np.append(self.root[others], self.root[row]))
        for r in roots[1:]:
            self.links.append((int(roots[0]), int(r)))
            self.root[self.root == r] = roots[0]


def sides(block: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of a tile's two sides; the same ones twice on the diagonal."""
    if i == j:
        rows = np.arange(len(block))
        return rows, rows
    return np.flatnonzero(block == i), np.flatnonzero(block == j)
