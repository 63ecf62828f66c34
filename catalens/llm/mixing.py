"""Mix sources to target weights: min-cost flow over membership patterns, then seeded documents."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalens.staging import stage

EPOCHS = 3
_LEVEL_BITS = 12  # 4,096 cells of a pattern per refinement
_LEVELS = 4
_BROADCAST_PATTERNS = 10_000  # a plan of so many rows goes to every task, a larger one is joined by shuffle


def targets(sizes: dict, weights: dict, epochs: int = EPOCHS) -> dict:
    """Share the sum of ``sizes`` by weight; no target above ``epochs`` times its source's size.

    What is above goes to the other sources by weight, until none is above (or all are at their limit).
    """
    left, open_, out = float(sum(sizes.values())), list(sizes), {}
    while open_:
        whole = sum(weights[s] for s in open_)
        share = {s: left * weights[s] / whole if whole else 0.0 for s in open_}
        full = [s for s in open_ if share[s] > epochs * sizes[s]]
        if not full:
            return out | share
        for s in full:
            out[s] = float(epochs * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def min_cost_flow(capacity: dict, quota: dict, epochs: int = EPOCHS) -> dict:
    """{(pattern, level, source): tokens}: fill the quotas from the patterns at least repetition cost.

    ``capacity``: tokens of a pattern, a tuple of the sources that share it; each of its ``epochs``
    repetition levels offers them again, at a convex cost of 0, 1, 2, ... a token. Successive shortest
    paths with potentials on the graph start - (pattern, level) - pattern - source - end. Quotas that the
    patterns can't fill are filled as far as they go. Amounts are integers. The graph has one node per
    pattern and source, not per document.
    """
    graph: dict = {}

    def edge(a, b, room, cost):
        graph.setdefault(a, []).append([b, room, cost, len(graph.setdefault(b, []))])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    start, end = ("start",), ("end",)
    graph[start] = []
    graph[end] = []
    for p, tokens in capacity.items():
        for level in range(epochs):
            edge(start, ("level", p, level), tokens, level)
            for s in p:
                edge(("level", p, level), ("source", s), tokens, 0)
    for s, tokens in quota.items():
        edge(("source", s), end, tokens, 0)
    potential = dict.fromkeys(graph, 0)
    while True:
        tick, dist, via = count(), {start: 0}, {}
        heap = [(0, next(tick), start)]
        while heap:
            d, _, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for i, (b, room, cost, _) in enumerate(graph[a]):
                at = d + cost + potential[a] - potential[b]
                if room > 0 and at < dist.get(b, float("inf")):
                    dist[b], via[b] = at, (a, i)
                    heapq.heappush(heap, (at, next(tick), b))
        if end not in dist:
            break
        for a in graph:
            potential[a] += min(dist.get(a, dist[end]), dist[end])
        path, b = [], end
        while b != start:
            a, i = via[b]
            path.append((a, i))
            b = a
        moved = min(graph[a][i][1] for a, i in path)
        for a, i in path:
            b, _, _, back = graph[a][i]
            graph[a][i][1] -= moved
            graph[b][back][1] += moved
    return {
        (a[1], a[2], b[1]): graph[b][back][1]
        for a, edges in graph.items() if a[0] == "level"
        for b, _, _, back in edges if b[0] == "source" and graph[b][back][1] > 0
    }


def _digit(level: int):
    """A row's cell at a level of refinement: 12 bits of its seeded hash."""
    return F.shiftrightunsigned("_hash", 64 - _LEVEL_BITS * (level + 1)).bitwiseAND((1 << _LEVEL_BITS) - 1)


def _cut_hashes(rows: DataFrame, cuts: DataFrame, few: bool) -> DataFrame:
    """(pattern, level, source, part, cell): the hash prefix up to which a pattern's rows hold ``tokens``.

    ``rows`` (_pattern, _hash, _size) are never sorted or gathered: each level of refinement sums sizes
    per cell (a partial aggregate of at most 4,096 cells per cut) and goes on in the cell in which the cut
    falls. After the last level the cut falls before or behind the cell, whichever is nearer.
    """
    now = cuts.withColumn("_prefix", F.lit(0).cast("long")).withColumn("_left", F.col("tokens").cast("double"))
    keys = ["_pattern", "_cut"]
    for level in range(_LEVELS):
        prefix = F.shiftrightunsigned("_hash", 64 - _LEVEL_BITS * level) if level else F.lit(0).cast("long")
        wanted = now.select("_pattern", "_prefix").distinct()
        at = rows.withColumn("_prefix", prefix).withColumn("_digit", _digit(level))
        cells = at.groupBy("_pattern", "_prefix", "_digit").agg(F.sum("_size").alias("_cell_size")) if not level else (
            at.join(F.broadcast(wanted) if few else wanted, ["_pattern", "_prefix"], "left_semi")
            .groupBy("_pattern", "_prefix", "_digit").agg(F.sum("_size").alias("_cell_size"))
        )
        met = now.select(*keys, "_prefix", "_left").join(cells, ["_pattern", "_prefix"])
        before = F.sum("_cell_size").over(Window.partitionBy(*keys).orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1))
        met = met.withColumn("_before", F.coalesce(before, F.lit(0)))
        # the last cell that begins at or before the cut
        inside = met.filter(F.col("_before") <= F.col("_left"))
        found = inside.groupBy(*keys, "_prefix", "_left").agg(F.max(F.struct("_digit", "_before", "_cell_size")).alias("_f"))
        now = stage(found.select(
            *keys, F.shiftleft("_prefix", _LEVEL_BITS).bitwiseOR(F.col("_f._digit")).alias("_prefix"),
            (F.col("_left") - F.col("_f._before")).alias("_left"), F.col("_f._cell_size").alias("_cell_size"),
        ))
    past = F.when(F.col("_left") * 2 >= F.col("_cell_size"), 1).otherwise(0)
    return now.select(*keys, (F.col("_prefix") + past).alias("_below"))


def mix(df: DataFrame, sources: str, size: str, weights: Sequence[float] = (1, 2, 3), seed: int = 5, row_id: str = "doc_id", epochs: int = EPOCHS) -> DataFrame:
    """``df`` with ``taken`` (long), ``repeats`` (int), ``source_size`` and ``target`` arrays per own source.

    ``sources``: array of the sources a row belongs to (a null element is a source of its own; an empty or
    null array counts as the null source); ``size``: its tokens (null: 0). Sources in code point order,
    null last, weigh ``weights``, repeating; ``targets`` says what they get. Rows are summed by pattern of
    sources, tokens flow from patterns to sources at least repetition cost, and each repetition level of a
    pattern takes rows in the order of a seeded hash of the id until the flow is met; whole rows are
    taken, so a source misses its target by at most half the rows of one 48-bit hash cell per level. Rows that
    repeat an id go together. No row is taken more than ``epochs`` times. The driver sees one row per
    pattern. Equal input gives equal output.
    """
    none = F.array(F.lit(None).cast("string"))
    own = F.when(F.size(F.coalesce(F.col(sources), none)) > 0, F.coalesce(F.col(sources), none)).otherwise(none)
    rows = df.withColumn("_pattern_sources", F.array_sort(F.array_distinct(own)))
    rows = (
        rows.withColumn("_pattern", F.xxhash64(F.to_json("_pattern_sources")))
        .withColumn("_size", F.coalesce(F.col(size), F.lit(0)).cast("long"))
        .withColumn("_hash", F.xxhash64(F.lit(seed), F.coalesce(F.col(row_id).cast("string"), F.lit(""))))
    )
    spark = df.sparkSession
    seen = rows.groupBy("_pattern").agg(F.first("_pattern_sources").alias("s"), F.sum("_size").alias("n")).collect()
    capacity = {tuple(r["s"]): int(r["n"]) for r in seen}
    number = {tuple(r["s"]): r["_pattern"] for r in seen}
    sizes: dict = {}
    for p, n in capacity.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(capacity.values())
    wanted = targets(sizes, weight, epochs)
    if sum(wanted.values()) > total:  # overlapping sources count their common rows several times
        wanted = {s: t * total / sum(wanted.values()) for s, t in wanted.items()}
    flow = min_cost_flow(capacity, {s: round(t) for s, t in wanted.items()}, epochs)
    # a level's sources take the pattern's rows one after the other: cut points in one hash order
    cuts, full = [], {}
    for p in capacity:
        for level in range(epochs):
            used = sum(flow.get((p, level, s), 0) for s in p)
            if used >= capacity[p] > 0:
                full[p] = full.get(p, 0) + 1
            elif used:
                cuts.append((number[p], level, used))
    schema = "_pattern long, _cut int, tokens long"
    plan = [(number[p], full.get(p, 0), [sizes[s] for s in p], [float(wanted[s]) for s in p]) for p in capacity]
    plan = spark.createDataFrame(plan, "_pattern long, _full int, source_size array<long>, target array<double>")
    if cuts:
        below = _cut_hashes(rows.select("_pattern", "_hash", "_size"), spark.createDataFrame(cuts, schema), few=len(cuts) <= _BROADCAST_PATTERNS)
        plan = plan.join(below.groupBy("_pattern").agg(F.collect_list("_below").alias("_cuts")), "_pattern", "left")
    else:
        plan = plan.withColumn("_cuts", F.lit(None).cast("array<long>"))
    cell = F.shiftrightunsigned("_hash", 64 - _LEVEL_BITS * _LEVELS)
    more = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<long>")), lambda c: F.col("_cell") < c))
    if len(capacity) <= _BROADCAST_PATTERNS:
        plan = F.broadcast(plan)
    return (
        rows.join(plan, "_pattern").withColumn("_cell", cell)
        .withColumn("repeats", (F.col("_full") + more).cast("int"))
        .withColumn("taken", F.col("_size") * F.col("repeats"))
        .drop("_pattern", "_pattern_sources", "_size", "_hash", "_full", "_cuts", "_cell")
    )


def words_in(text: str = "text"):
    """Number of runs of other characters than [\\x20\\x09-\\x0D]; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def document_sizes(docs: DataFrame, row_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(row_id, row_key, sources, size) of every row, written once, so that the passes of ``mix`` read no text.

    ``row_key`` is a hash of id and text: rows with a null or repeated id are drawn apart unless they are equal.
    """
    key = F.xxhash64(F.col(row_id), F.col(text))
    return stage(docs.select(row_id, key.alias("row_key"), F.array(source).alias("sources"), words_in(text).alias("size")))
