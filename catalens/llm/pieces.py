"""Sampled segmentation into the pieces of a SentencePiece model, and lossless decoding.

Forward filtering adds up the weight of all segmentations of each prefix of a chunk; backward sampling
draws a segmentation from the end with the probability of its weight. No piece crosses the start of a run
of spaces, so a text's lattice is the chain of its chunks' lattices and equal chunks share one.
"""

from __future__ import annotations

import math
import os
import re
import uuid
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.tasks import map_batches

SPACE = "▁"  # fixed value: how pieces write a space
_OWN_SPACE = "\udc81"  # that letter in a text: no valid text holds it, no piece holds it, so it becomes bytes
_CACHE_BYTES = 120 << 20  # lattices a worker keeps between blocks; one block adds less than a third to it
_CHUNK_BYTES = 190  # of a cached chunk beside its nodes and edges: its string, its place in the dict, its bounds
_BLOCK_CHARS = 500_000  # characters segmented at a time
_LEARN_CHUNKS = 16_384  # new lattices built at a time
_LONG = 2_000  # a chunk of more characters is walked by itself and not kept
_STRETCH = 16_384  # characters of a long chunk whose edges are held at a time

#: Path of the SentencePiece model; read on the driver, never copied here.
PIECE_MODEL = os.environ.get("CATALENS_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


@dataclass
class Pieces:
    """A model's pieces: ``weight`` is the log weight, ``raw`` the bytes each id decodes to."""

    text: list[str]
    weight: np.ndarray
    raw: list[bytes]
    byte_id: list[int]
    usable: np.ndarray
    fallback: float = 0.0
    width: np.ndarray = field(default=None)

    @staticmethod
    def load(model: bytes, alpha: float = 0.5) -> "Pieces":
        """``alpha``: exponent of the piece weights; smaller samples more evenly.

        Scores of a unigram model are log probabilities. Scores that are whole numbers are merge ranks; the
        weight is then that of Zipf's law, 1 / (rank + 2).
        """
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        text = [sp.id_to_piece(i) for i in range(n)]
        special = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
        is_byte = np.array([sp.is_byte(i) for i in range(n)])
        score = np.array([sp.get_score(i) for i in range(n)], dtype=float)
        usable = ~special & ~is_byte
        if np.all(score[usable] == np.round(score[usable])):
            score = -np.log(2 + np.abs(score))
        byte_id = [-1] * 256
        raw = []
        for i in range(n):
            if is_byte[i]:
                value = int(text[i][3:-1], 16)
                byte_id[value] = i
                raw.append(bytes([value]))
            else:
                raw.append(b"" if special[i] else text[i].replace(SPACE, " ").encode())
        if min(byte_id) < 0:
            raise ValueError("the model has no byte pieces, decoding could lose characters")
        for i in np.flatnonzero(usable):
            if SPACE in text[i].lstrip(SPACE):
                raise ValueError(f"piece {text[i]!r} crosses the start of a word")
        return Pieces(text, alpha * score, raw, byte_id, usable, float(alpha * score[usable].min()))


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a counter-based generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bounds(to: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first edge of each node, upper bound of each edge's draws) of edges in the order of their node.

    Shares are added up within their node alone, so a bound does not depend on what else is worked out with it.
    """
    node_first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.empty(0, np.int64)
    count = np.diff(np.append(node_first, len(to)))
    cum = share.copy()
    at = node_first
    for k in range(1, int(count.max(initial=0))):
        at = at[count > k] + 1
        count = count[count > k]
        cum[at] += cum[at - 1]
    cum[np.append(node_first[1:], len(to)) - 1 if len(to) else node_first] = 2
    return node_first, cum


class Segmenter:
    """Samples segmentations of many texts at a time; one per task, with the lattices of frequent chunks."""

    def __init__(self, pieces: Pieces, cache_bytes: int | None = None):
        import ahocorasick

        self.cache_bytes = cache_bytes
        self.pieces, self.n = pieces, len(pieces.text)
        self.automaton = ahocorasick.Automaton()
        for i in np.flatnonzero(pieces.usable):
            self.automaton.add_word(pieces.text[i], int(i))
        self.automaton.make_automaton()
        self.length = np.array([len(t) for t in pieces.text], dtype=np.int32)
        self.longest = int(self.length[pieces.usable].max())
        self.single = np.zeros(0x110000, dtype=bool)
        for i in np.flatnonzero(pieces.usable):
            if len(pieces.text[i]) == 1:
                self.single[ord(pieces.text[i])] = True
        inner_newline = any("\n" in pieces.text[i] for i in np.flatnonzero(pieces.usable))
        # where no piece holds a line break the lattice parts there too
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if inner_newline else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n", re.S)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.first = np.zeros(1 << 16, dtype=np.int32)  # per node: its first incoming edge
        self.cum = np.zeros(1 << 18, dtype=np.float32)  # per edge: cumulated probability at its node
        self.piece = np.zeros(1 << 18, dtype=np.int32)
        self.begin = np.zeros(1 << 14, dtype=np.int32)  # per chunk: its first node
        self.end = np.zeros(1 << 14, dtype=np.int32)
        self.edge_end = np.zeros(1 << 14, dtype=np.int32)  # per chunk: behind its last edge
        self.hits = np.zeros(1 << 14, dtype=np.int32)  # per chunk: how often it was met
        self.nodes = self.edges = 0

    def cached_bytes(self) -> int:
        """Size of the kept lattices, the spare room of their arrays included."""
        arrays = (self.first, self.cum, self.piece, self.begin, self.end, self.edge_end, self.hits)
        return sum(a.nbytes for a in arrays) + _CHUNK_BYTES * len(self.known)

    def _bound(self) -> int:
        return _CACHE_BYTES if self.cache_bytes is None else self.cache_bytes

    def _trim(self) -> None:
        """Keep the chunks met most often, up to a third of the bound."""
        n = len(self.known)
        nodes = self.end[:n] - self.begin[:n] + 1
        lo = self.first[self.begin[:n] + 1]
        edges = self.edge_end[:n] - lo
        order = np.argsort(-self.hits[:n], kind="stable")
        size = np.cumsum(_CHUNK_BYTES + 16 + 4 * nodes[order].astype(np.int64) + 8 * edges[order])
        kept = np.sort(order[size <= self._bound() // 3])
        nodes, edges, lo = nodes[kept].astype(np.int64), edges[kept].astype(np.int64), lo[kept].astype(np.int64)
        new_begin, new_lo = np.cumsum(nodes) - nodes, np.cumsum(edges) - edges
        node_at = np.repeat(self.begin[kept] - new_begin, nodes) + np.arange(nodes.sum())
        edge_at = np.repeat(lo - new_lo, edges) + np.arange(edges.sum())
        self.first = (self.first[node_at] - np.repeat(lo - new_lo, nodes)).astype(np.int32)
        self.cum, self.piece = self.cum[edge_at], self.piece[edge_at]
        self.begin, self.end = new_begin.astype(np.int32), (new_begin + nodes - 1).astype(np.int32)
        self.edge_end, self.hits = (new_lo + edges).astype(np.int32), self.hits[kept] // 2
        at = np.full(n, -1, dtype=np.int64)
        at[kept] = np.arange(len(kept))
        self.known = {c: k for c, k in zip(self.known, at.tolist()) if k >= 0}
        self.nodes, self.edges = len(self.first), len(self.cum)

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        if n <= len(a):
            return a
        return np.concatenate([a, np.zeros(max(n - len(a), len(a) // 3), dtype=a.dtype)])

    def _learn(self, chunks: list[str]) -> None:
        """Forward filtering of new chunks, all at once: a step per position in a chunk."""
        joined = "\n".join(chunks) + "\n"
        # a chunk may itself be a line break: bounds come from the lengths, and no match may cross them
        size = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        begin = np.cumsum(size + 1) - size - 1
        end = begin + size
        at, pid = np.fromiter(chain.from_iterable(self.automaton.iter(joined)), dtype=np.int64).reshape(-1, 2).T
        start = at + 1 - self.length[pid]
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        owner = np.repeat(np.arange(len(chunks)), size + 1)  # of every position
        inside = np.ones(len(code), dtype=bool)
        inside[end] = False
        crossing = np.searchsorted(end, start) != np.searchsorted(end, at)
        keep = ~crossing & inside[at]
        start, at, pid = start[keep], at[keep], pid[keep]
        bare = np.flatnonzero(inside & ~self.single[code])
        utf8 = np.where(code[bare] < 0x80, 1, np.where(code[bare] < 0x800, 2, np.where(code[bare] < 0x10000, 3, 4)))
        start = np.concatenate([start, bare])
        to = np.concatenate([at, bare]) + 1
        weight = np.concatenate([self.pieces.weight[pid], self.pieces.fallback * utf8])
        pid = np.concatenate([pid, self.n + code[bare].astype(np.int64)])
        # edges in the order of their end node, and a second order by the step in which they are met
        order = np.argsort(to, kind="stable")
        start, to, weight, pid = start[order], to[order], weight[order], pid[order]
        relative = to - begin[owner[to - 1]]
        longest = int(relative.max()) if len(to) else 0
        order = np.argsort(relative.astype(np.uint16) if longest < 1 << 16 else relative, kind="stable")
        s_start, s_to, s_weight = start[order], to[order], weight[order]
        alpha = np.full(len(code), -np.inf)
        alpha[begin] = 0
        s_share = np.empty(len(to))
        node_first = np.flatnonzero(np.r_[True, s_to[1:] != s_to[:-1]]) if len(to) else np.empty(0, np.int64)
        step = np.searchsorted(relative[order][node_first], np.arange(1, longest + 2))
        for lo, hi in zip(step[:-1], step[1:]):
            if lo == hi:
                continue
            a, b = node_first[lo], node_first[hi] if hi < len(node_first) else len(to)
            seg = node_first[lo:hi] - a
            value = alpha[s_start[a:b]] + s_weight[a:b]
            top = np.maximum.reduceat(value, seg)
            count = np.diff(np.append(seg, b - a))
            value = np.exp(value - np.repeat(top, count))
            whole = np.add.reduceat(value, seg)
            alpha[s_to[node_first[lo:hi]]] = top + np.log(whole)
            s_share[a:b] = value / np.repeat(whole, count)
        share = np.empty(len(to))
        share[order] = s_share
        node_first, cum = _bounds(to, share)
        base_n, base_e = self.nodes, self.edges
        self.first = self._room(self.first, base_n + len(code))
        self.first[base_n + to[node_first]] = base_e + node_first
        self.cum = self._room(self.cum, base_e + len(to))
        self.piece = self._room(self.piece, base_e + len(to))
        self.cum[base_e : base_e + len(to)] = cum
        self.piece[base_e : base_e + len(to)] = pid
        k = len(self.known)
        for name in ("begin", "end", "edge_end", "hits"):
            setattr(self, name, self._room(getattr(self, name), k + len(chunks)))
        self.begin[k : k + len(chunks)] = base_n + begin
        self.end[k : k + len(chunks)] = base_n + end
        self.edge_end[k : k + len(chunks)] = base_e + np.searchsorted(to, end, "right")
        self.hits[k : k + len(chunks)] = 0
        self.known.update(zip(chunks, range(k, k + len(chunks))))
        self.nodes, self.edges = base_n + len(code), base_e + len(to)

    def encode(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets). A text's ids depend on the text, its seed and the model alone."""
        if self.cached_bytes() > self._bound():
            self._trim()
        split = [
            self.chunks.findall(SPACE + t.replace(SPACE, _OWN_SPACE).replace(" ", SPACE)) if t else [] for t in texts
        ]
        counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        flat = [c for s in split for c in s]
        if not flat:
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        long = [i for i, c in enumerate(flat) if len(c) > _LONG]
        new = sorted({c for c in set(flat).difference(self.known) if len(c) <= _LONG})
        for lo in range(0, len(new), _LEARN_CHUNKS):
            self._learn(new[lo : lo + _LEARN_CHUNKS])
        short = np.delete(np.arange(len(flat)), long)
        chunk = np.fromiter((self.known.get(c, 0) for c in flat) if long else map(self.known.__getitem__, flat), dtype=np.int64, count=len(flat))
        self.hits[: len(self.known)] += np.bincount(chunk[short], minlength=len(self.known)).astype(np.int32)
        with np.errstate(over="ignore"):
            place = np.arange(len(flat), dtype=np.int64) - np.repeat(np.cumsum(counts) - counts, counts)
            stream = _mix(np.repeat(seeds.view(np.uint64), counts) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            live = short
            node, base = self.end[chunk[live]], self.begin[chunk[live]]
            drawn: list[tuple[np.ndarray, np.ndarray]] = []
            n_of = np.zeros(len(flat), dtype=np.int64)
            step = 0
            while len(live):
                step += 1
                u = (_mix(stream[live] + np.uint64(step)) >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)
                edge = self.first[node]
                late = np.flatnonzero(self.cum[edge] <= u)
                while len(late):
                    edge[late] += 1
                    late = late[self.cum[edge[late]] <= u[late]]
                pid = self.piece[edge]
                drawn.append((live, pid))
                n_of[live] += 1
                node = node - np.where(pid < self.n, self.length[np.minimum(pid, self.n - 1)], 1)
                on = node > base
                live, node, base = live[on], node[on], base[on]
            walked = [self._walk(flat[i], stream[i]) for i in long]
        n_of[long] = [len(w) for w in walked]
        offset = np.cumsum(n_of) - n_of
        ids = np.empty(int(n_of.sum()), dtype=np.int64)
        for i, w in zip(long, walked):
            ids[offset[i] : offset[i] + len(w)] = w
        for k, (who, pid) in enumerate(drawn):  # drawn from the end
            ids[offset[who] + n_of[who] - 1 - k] = pid
        size = np.ones(len(ids), dtype=np.int64)
        bare = np.flatnonzero(ids >= self.n)
        spelt = [self._bytes(int(c) - self.n) for c in ids[bare]]
        size[bare] = [len(b) for b in spelt]
        out = np.repeat(ids, size)
        at = np.cumsum(size) - size
        if len(bare):
            own = size[bare]
            where = np.repeat(at[bare], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            out[where] = [i for b in spelt for i in b]
        per_chunk = np.add.reduceat(size, offset)
        ends = np.append(0, np.cumsum(per_chunk))[np.append(0, np.cumsum(counts))]
        return out.astype(np.int32), ends

    def _edges(self, text: str, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, log weight, piece) of the edges of ``text`` that end in (lo, hi], by their end."""
        back = max(0, lo - self.longest + 1)
        at, pid = np.fromiter(chain.from_iterable(self.automaton.iter(text[back:hi])), dtype=np.int64).reshape(-1, 2).T
        at = at + back
        pid, at = pid[at >= lo], at[at >= lo]
        code = np.frombuffer(text[lo:hi].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        bare = np.flatnonzero(~self.single[code])
        utf8 = np.where(code[bare] < 0x80, 1, np.where(code[bare] < 0x800, 2, np.where(code[bare] < 0x10000, 3, 4)))
        start = np.concatenate([at + 1 - self.length[pid], lo + bare])
        to = np.concatenate([at, lo + bare]) + 1
        weight = np.concatenate([self.pieces.weight[pid], self.pieces.fallback * utf8])
        pid = np.concatenate([pid, self.n + code[bare].astype(np.int64)])
        order = np.argsort(to, kind="stable")
        return start[order], to[order], weight[order], pid[order]

    def _walk(self, text: str, stream: np.uint64) -> np.ndarray:
        """The pieces of one long chunk: filtered from the start, drawn from the end, a stretch of edges at a time.

        All that grows with the chunk is one number a character.
        """
        n = len(text)
        alpha = np.zeros(n + 1)
        for lo in range(0, n, _STRETCH):
            hi = min(n, lo + _STRETCH)
            start, to, weight, _ = self._edges(text, lo, hi)
            back = max(0, lo - self.longest)
            mass = np.exp(alpha[back : lo + 1] - alpha[lo]).tolist() + [0.0] * (hi - lo)
            scale, at = float(alpha[lo]), lo + 1
            logs = []
            for s, t, w in zip((start - back).tolist(), to.tolist(), np.exp(weight).tolist()):
                if t != at:
                    at = t
                    logs.append(math.log(mass[t - 1 - back]) + scale)
                    if mass[t - 1 - back] < 1e-100:
                        ratio = 1 / mass[t - 1 - back]
                        scale = logs[-1]
                        for i in range(max(0, t - back - self.longest), t - back):
                            mass[i] *= ratio
                mass[t - back] += mass[s] * w
            logs.append(math.log(mass[hi - back]) + scale)
            alpha[lo + 1 : hi + 1] = logs
        drawn, at, step = [], n, 0
        while at > 0:
            lo = max(0, at - _STRETCH)
            start, to, weight, pid = self._edges(text, lo, at)
            value = alpha[start] + weight - alpha[to]
            node_first, cum = _bounds(to, np.exp(value))
            first, bound = np.append(node_first, len(to)).tolist(), cum.astype(np.float32).tolist()
            begin, piece = start.tolist(), pid.tolist()
            draws = _mix(stream + np.arange(step + 1, step + at - lo + 1, dtype=np.uint64)) >> np.uint64(40)
            draws = (draws.astype(np.float32) / np.float32(1 << 24)).tolist()
            begun = step
            while at > lo:
                edge = first[at - lo - 1]
                while bound[edge] <= draws[step - begun]:
                    edge += 1
                drawn.append(piece[edge])
                at = begin[edge]
                step += 1
        return np.array(drawn[::-1], dtype=np.int64)

    def _bytes(self, code: int) -> list[int]:
        letter = SPACE if code == ord(_OWN_SPACE) else chr(code)
        return [self.pieces.byte_id[b] for b in letter.encode()]


#: A worker's segmenter and its lattices, kept from task to task; results don't depend on it.
_SEGMENTERS: dict = {}


def decode(pieces: Pieces, ids) -> str:
    """The text of a list of ids: the pieces' bytes without the space put in front."""
    raw = pieces.raw
    return b"".join([raw[i] for i in ids]).decode()[1:]


def _blocks(sizes: list[int]):
    """Runs of texts of about ``_BLOCK_CHARS`` characters."""
    lo = size = 0
    for i, n in enumerate(sizes):
        size += n
        if size >= _BLOCK_CHARS:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)


def load(path: str, alpha: float = 0.5) -> Pieces:
    with open(path, "rb") as f:
        return Pieces.load(f.read(), alpha)


def encode(df: DataFrame, model_path: str, row_id: str = "doc_id", text: str = "text", alpha: float = 0.5, seed: int = 0, with_decoded: bool = False, cache_bytes: int | None = None) -> DataFrame:
    """(row_id, ids array<int>): a sampled segmentation of each row, seeded by its id.

    ``with_decoded`` adds ``decoded``, the text that the ids give, for a check of the round trip.

    Equal ids and texts give equal segmentations, wherever and whenever they run. A null text has null ids,
    an empty one none; a null id has a seed of its own. Rows that repeat repeat their result. Long texts
    are whole; their chunks are segmented about half a million characters at a time, and no more texts are unpacked
    at once. ``cache_bytes`` bounds the lattices a worker keeps (120 MB unless given); results do not depend on it.
    """
    spark = df.sparkSession
    model = spark.sparkContext.broadcast((load(model_path, alpha), uuid.uuid4().hex))  # a vocabulary, read on the driver
    names = [row_id, "ids", "decoded"][: 3 if with_decoded else 2]
    kind = dict(df.dtypes)[row_id]

    def run(batches):
        loaded, name = model.value
        segment = _SEGMENTERS.get(name)
        if segment is None:
            _SEGMENTERS.clear()
            segment = _SEGMENTERS[name] = Segmenter(loaded, cache_bytes)
        for b in batches:
            seeds = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in _blocks(pc.fill_null(pc.utf8_length(b.column(2)), 0).to_pylist()):
                texts = b.column(2).slice(lo, hi - lo).to_pylist()
                ids, ends = segment.encode([t or "" for t in texts], seeds[lo:hi])
                none = np.array([t is None for t in texts] + [False])
                made = pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=none), pa.array(ids, pa.int32()))
                made = [b.column(0).slice(lo, hi - lo), made]
                if with_decoded:
                    made.append(pa.array([_decoded(loaded, x) for x in made[1]], pa.string()))
                yield pa.RecordBatch.from_arrays(made, names=names)

    chosen = df.select(row_id, F.xxhash64(F.lit(seed), F.col(row_id)).alias("_seed"), F.col(text).cast("string").alias("_text"))
    return map_batches(chosen, run, f"`{row_id}` {kind}, ids array<int>" + ", decoded string" * with_decoded)


def _decoded(pieces: Pieces, ids: pa.Scalar) -> str | None:
    if not ids.is_valid:
        return None
    return decode(pieces, ids.values.to_numpy().tolist()) if len(ids) else ""


def add_decoded(df: DataFrame, model_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids; null ids have null text."""
    from pyspark.sql.types import StringType, StructField, StructType

    model = df.sparkSession.sparkContext.broadcast(load(model_path))
    at = df.columns.index(ids)

    def run(batches):
        pieces = model.value
        for b in batches:
            made = pa.array([_decoded(pieces, x) for x in b.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, decoded])

    return map_batches(df, run, StructType([*df.schema.fields, StructField(decoded, StringType())]))
