"""Ranked lexical search of many queries at once, with shared partial sums.

Queries of a block share terms. Sets of terms that several queries hold are found greedily, two nodes at a time, and
become nodes of a graph of sums: each is worked out once for a document and used by all queries above it. Documents
are read twice: for the words the block asks for, and, from that narrow table, for the scores.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalens.llm import tokens
from catalens.llm.tasks import map_batches
from catalens.staging import stage

_SLICE_BYTES = 8 << 20
_BLOCK_TERMS = 100_000  # words of the queries that are answered in one pass; a longer query is a block of its own
_CELLS = 4_000_000  # (node, document) sums held at a time
_PENDING = 200_000  # candidates a task holds before it drops those out of the first places
_SEGMENT = 48  # terms of a query among which pairs are counted
_TABLE = tokens.kinds(word=b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


@dataclass
class SharedSums:
    """Sums of terms as a graph. Nodes below ``len(terms)`` are terms with their number of occurrences in a query.

    ``steps`` holds, level by level, nodes that are the sum of two earlier ones; ``item_nodes`` the nodes that add up
    to each query, one after the other from ``item_first`` on.
    """

    terms: list[tuple[int, int]]
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    item_nodes: np.ndarray
    item_first: np.ndarray
    size: int

    def additions(self) -> int:
        """Sums a document takes."""
        return sum(len(s[0]) for s in self.steps) + len(self.item_nodes) - len(self.item_first)


def share_sums(items: Sequence[Counter]) -> SharedSums:
    """The graph of sums of ``items``, each a multiset of term numbers.

    A pair of nodes that most queries hold together becomes a node of its own, until no two queries share a pair.
    Pairs are counted within segments of a query's terms, the most shared terms first, so the work grows with the
    length of the queries and not with its square.
    """
    terms = sorted({p for item in items for p in item.items()})
    number = {p: i for i, p in enumerate(terms)}
    held = [sorted(number[p] for p in item.items()) for item in items]
    spread = Counter(n for nodes in held for n in nodes)
    segments: list[set[int]] = []
    owner: list[int] = []
    for q, nodes in enumerate(held):
        nodes = sorted(nodes, key=lambda n: (-spread[n], n))
        for lo in range(0, len(nodes), _SEGMENT):
            segments.append(set(nodes[lo : lo + _SEGMENT]))
            owner.append(q)
    where: dict[tuple[int, int], set[int]] = defaultdict(set)
    for s, nodes in enumerate(segments):
        for pair in combinations(sorted(n for n in nodes if spread[n] > 1), 2):
            where[pair].add(s)
    queue = [(-len(s), p) for p, s in where.items() if len(s) > 1]
    heapq.heapify(queue)
    size, level, steps = len(terms), {}, defaultdict(list)
    while queue:
        weight, (a, b) = heapq.heappop(queue)
        users = where[a, b]
        if len(users) != -weight:  # counted before a part of it was used up
            if len(users) > 1:
                heapq.heappush(queue, (-len(users), (a, b)))
            continue
        new, size = size, size + 1
        level[new] = 1 + max(level.get(a, 0), level.get(b, 0))
        steps[level[new]].append((new, a, b))
        met = Counter()
        for s in sorted(users):
            segments[s] -= {a, b}
            for other in segments[s]:
                for gone in (a, b):
                    pair = (min(gone, other), max(gone, other))
                    if pair in where:
                        where[pair].discard(s)
                where[other, new].add(s)
                met[other] += 1
            segments[s].add(new)
        where[a, b] = set()
        for other, n in met.items():
            if n > 1:
                heapq.heappush(queue, (-n, (other, new)))
    of_item: list[list[int]] = [[] for _ in items]
    for s, q in enumerate(owner):
        of_item[q].extend(sorted(segments[s]))
    first = np.cumsum([0] + [len(n) for n in of_item])[:-1]
    return SharedSums(
        terms, [tuple(np.array(c) for c in zip(*steps[k])) for k in sorted(steps)],
        np.array([n for nodes in of_item for n in nodes], dtype=np.int64), first, size,
    )


def term_lists(texts: pa.Array) -> list[list[str]]:
    """The terms of each text: runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased."""
    ids, known, row, _ = tokens.words(texts, _TABLE)
    spelt = known.cast(pa.large_string()).to_pylist()
    out: list[list[str]] = [[] for _ in range(len(texts))]
    for r, i in zip(row.tolist(), ids.tolist()):
        out[r].append(spelt[i])
    return out


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[object, Counter]]]:
    """(id, terms) of the queries that have terms, in blocks of bounded size, read one after the other."""
    block, size = [], 0
    for key, value in items.select(item_id, F.col(text).cast("string")).toLocalIterator():
        terms = Counter(term_lists(pa.array([value], pa.string()))[0])
        if block and size + len(terms) > _BLOCK_TERMS:
            yield block
            block, size = [], 0
        if terms:
            block.append((key, terms))
            size += len(terms)
    if block:
        yield block


def _asked(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """(id, n, terms, tf): of each document the number of all its terms, and those of the vocabulary with their counts."""
    known = docs.sparkSession.sparkContext.broadcast(pa.array([v.encode() for v in vocabulary], pa.large_binary()))

    def read(batches):
        asked, width = known.value, len(known.value)
        for b in batches:
            for lo, hi in tokens.slices(b.column(1), _SLICE_BYTES):
                ids, words, row, _ = tokens.words(b.column(1).slice(lo, hi - lo), _TABLE)
                n = np.bincount(row, minlength=hi - lo)
                term = pc.fill_null(pc.index_in(words, value_set=asked), -1).to_numpy(zero_copy_only=False)[ids] if len(ids) else ids
                mine = term >= 0
                cell, tf = np.unique(row[mine] * width + term[mine], return_counts=True)
                ends = pa.array(np.searchsorted(cell, np.arange(hi - lo + 1) * width), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(cell % width, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64())),
                ], names=["id", "n", "terms", "tf"])

    return map_batches(docs, read, f"id {dict(docs.dtypes)['id']}, n long, terms array<int>, tf array<long>")


def _best(held: list[pa.Table], top: int) -> pa.Table:
    """The first places of each item among candidates (item, score, id), nulls last among equal scores."""
    whole = pa.concat_tables(held).sort_by([("item", "ascending"), ("score", "descending"), ("id", "ascending")])
    item = whole["item"].to_numpy()
    first = np.searchsorted(item, item, "left")
    return whole.filter(pa.array(np.arange(len(item)) - first < top))


def _scores(read: DataFrame, weights: np.ndarray, shared: SharedSums, top: int) -> DataFrame:
    """(item, score, id): the first places among the documents of each task. ``read`` has m, terms, tf and id."""
    given = read.sparkSession.sparkContext.broadcast((weights, shared))

    def score(batches):
        weight, sums = given.value
        n_items, base = len(sums.item_first), len(sums.terms)
        term_of = np.array([t for t, _ in sums.terms], dtype=np.int64)
        times = np.array([k for _, k in sums.terms], dtype=np.int64)
        by_term = np.argsort(term_of, kind="stable")
        nodes_at = np.searchsorted(term_of[by_term], np.arange(len(weight) + 1))
        least = np.ones(n_items, dtype=np.int64)  # a score below cannot reach the first places
        held: list[pa.Table] = []
        pending = 0
        step = max(1, _CELLS // (sums.size + n_items))
        for b in batches:
            for lo in range(0, len(b), step):
                part = b.slice(lo, step)
                lists = part.column(2)
                count = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(part)), count)
                term = lists.flatten().to_numpy().astype(np.int64)
                tf = part.column(3).flatten().to_numpy()
                m = part.column(1).to_numpy()[doc]
                value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
                acc = np.zeros((sums.size, len(part)), dtype=np.int64)
                uses = nodes_at[term + 1] - nodes_at[term]
                place = np.repeat(nodes_at[term], uses) + np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses)
                node = by_term[place]
                acc[node, np.repeat(doc, uses)] = np.repeat(value, uses) * times[node]
                for new, x, y in sums.steps:
                    acc[new] = acc[x] + acc[y]
                total = np.add.reduceat(acc[sums.item_nodes], sums.item_first, axis=0)
                item, at = np.nonzero(total >= least[:, None])
                if not len(item):
                    continue
                held.append(pa.table({"item": pa.array(item, pa.int32()), "score": pa.array(total[item, at], pa.int64()), "id": part.column(0).take(pa.array(at))}))
                pending += len(item)
                if pending > _PENDING:
                    held = [_best(held, top)]
                    pending = len(held[0])
                    places = held[0]["item"].to_numpy()
                    full = np.bincount(places, minlength=n_items) >= top
                    last = np.searchsorted(places, np.arange(n_items), "right") - 1
                    least[full] = held[0]["score"].to_numpy()[last[full]]
        if held:
            yield from _best(held, top).combine_chunks().to_batches()

    return map_batches(read.select("id", "m", "terms", "tf"), score, f"item int, score long, id {dict(read.dtypes)['id']}")


def search(docs: DataFrame, items: DataFrame, top: int = 20, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank int, doc_id, score long): the ``top`` documents of each query with a score above 0.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))); a document adds weight * (10^9 tf div (1000 tf + 12 m))
    for each occurrence of the term in the query, with m = 75 + (25 n N div L); N documents have a term, L terms in
    all, n terms in the document. Equal scores rank by ascending id, a null id last; rows that repeat are documents
    of their own, and each row of ``items`` is a query of its own, also where ids repeat. Null texts have no terms;
    queries without terms, and empty tables, give no rows. Texts are read whole. Other columns may have any name, for
    they are not read. The queries are answered in blocks of bounded size, each reading the documents once.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = dict(items.dtypes)[item_id]
    out = None
    for block in _blocks(items, item_id, text):
        vocabulary = sorted({t for _, terms in block for t in terms})
        number = {t: i for i, t in enumerate(vocabulary)}
        read = stage(_asked(chosen, vocabulary))
        n_docs, length = read.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for t, c in read.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per term asked for
            df[t] = c
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
        shared = share_sums([Counter({number[t]: k for t, k in terms.items()}) for _, terms in block])
        measured = read.filter("size(terms) > 0").withColumn(
            "m", F.expr(f"75 + (CAST(n AS DECIMAL(20,0)) * CAST('{25 * n_docs}' AS DECIMAL(18,0))) DIV {max(length, 1)}L")
        )
        found = _scores(measured, weights, shared, top)
        names = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(block)], f"item int, item_id {kind}")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
        ranked = found.withColumn("rank", rank).filter(F.col("rank") <= top).join(names, "item")
        ranked = ranked.select(F.col("item_id").alias(item_id), "rank", F.col("id").alias(doc_id), "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = spark.createDataFrame([], f"`{item_id}` {kind}, rank int, `{doc_id}` {dict(chosen.dtypes)['id']}, score long")
    return out
