"""Toxicity scores from non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.llm.fitting import weights_of
from catalens.llm.tasks import map_batches

_WORD = re.compile(r"\w+")
_PREFIXES = (4, 5, 6)
_CACHE = 200_000  # words whose weight a worker remembers
_BIAS = ""  # no feature has this name


def features(word: str) -> list[str]:
    """A lower-case word and its openings, which inflected forms share."""
    return ["=" + word, *(word[:n] for n in _PREFIXES if len(word) > n)]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of features; a text's score is the logistic of their sum over its distinct words."""

    weights: dict[str, float]
    bias: float

    def scorer(self):
        weights, bias, known = self.weights, self.bias, {}

        def weight(word: str) -> float:
            if len(known) > _CACHE:
                known.clear()
            w = known[word] = sum(weights.get(f, 0.0) for f in features(word))
            return w

        def score(text: str | None) -> float:
            total = bias
            for word in words_of(text):
                w = known.get(word)
                total += weight(word) if w is None else w
            return float(1 / (1 + np.exp(-np.clip(total, -60, 60))))

        return score


def nn_pu_risk(z_pos: np.ndarray, z_unl: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Non-negative risk with the logistic loss, and its gradient by the scores.

    prior * E_p[l(z)] + max(0, E_u[l(-z)] - prior * E_p[l(-z)]): the unlabelled texts hold a share
    ``prior`` of positives, so their risk as negatives is corrected by that of the positives. Where the
    corrected part falls below zero the step goes up in it instead, which stops the overfit.
    """
    def loss(z):
        return np.logaddexp(0, -z)

    def slope(z):
        return -1 / (1 + np.exp(np.clip(z, -60, 60)))

    n, m = len(z_pos), len(z_unl)
    negative = loss(-z_unl).mean() - prior * loss(-z_pos).mean()
    g_unl, g_pos_neg = -slope(-z_unl) / m, prior * slope(-z_pos) / n
    g_pos = prior * slope(z_pos) / n
    if negative >= 0:
        return prior * loss(z_pos).mean() + negative, g_pos + g_pos_neg, g_unl
    return prior * loss(z_pos).mean(), -g_pos_neg, -g_unl


def train(positive: list[str], unlabelled: list[str], prior: float, min_texts: int = 5, min_share: float = 0.005, steps: int = 300, rate: float = 0.05, decay: float = 1e-4) -> ToxicityModel:
    """Fit on texts. Features found in fewer positives than ``min_texts`` and ``min_share`` of them say little and are left out.

    Without positives or unlabelled texts the score is the prior for every text.
    """
    prior = min(max(prior, 1e-3), 0.5)
    base = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return ToxicityModel({}, base)
    seen = Counter(f for t in positive for f in {f for w in words_of(t) for f in features(w)})
    least = max(min(min_texts, len(positive) // 2), min_share * len(positive), 1)
    names = sorted(f for f, n in seen.items() if n >= least)
    column = {f: i for i, f in enumerate(names)}

    def sparse(texts):
        """Row, column and count arrays; one text's features are held at a time."""
        cols, vals = [], []
        for t in texts:
            bag = Counter(column[f] for w in words_of(t) for f in features(w) if f in column)
            cols.append(np.fromiter(bag.keys(), np.int32, len(bag)))
            vals.append(np.fromiter(bag.values(), np.float32, len(bag)))
        rows = np.repeat(np.arange(len(cols), dtype=np.int32), [len(c) for c in cols])
        return rows, np.concatenate(cols), np.concatenate(vals)

    p, u = sparse(positive), sparse(unlabelled)
    n, m, k = len(positive), len(unlabelled), len(names)
    # keep what tells the two samples apart; common words only add noise to long texts
    df_p, df_u = np.bincount(p[1], minlength=k) / n, np.bincount(u[1], minlength=k) / m
    telling = (df_p + 1e-3) / (df_u + 1e-3)
    use = (telling > 2) | (telling < 0.5)

    def narrowed(x):
        inside = use[x[1]]
        return x[0][inside], x[1][inside], x[2][inside]

    p, u = narrowed(p), narrowed(u)
    w, bias = np.zeros(k), base
    moment, scale = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, steps + 1):
        z_p = np.bincount(p[0], p[2] * w[p[1]], n) + bias
        z_u = np.bincount(u[0], u[2] * w[u[1]], m) + bias
        _, g_p, g_u = nn_pu_risk(z_p, z_u, prior)
        grad = np.bincount(p[1], p[2] * g_p[p[0]], k) + np.bincount(u[1], u[2] * g_u[u[0]], k) + decay * w
        grad = np.append(grad, g_p.sum() + g_u.sum())
        moment = 0.9 * moment + 0.1 * grad
        scale = 0.999 * scale + 0.001 * grad**2
        move = rate * (moment / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.999**step)) + 1e-8)
        w -= move[:-1]
        bias -= move[-1]
    return ToxicityModel({f: float(w[i]) for f, i in column.items() if abs(w[i]) > 1e-6}, float(bias))


def held_out(row_id: str = "doc_id") -> Column:
    """Rows no label is learned from: crc32 of the id as text is divisible by 5; never for a null id."""
    return F.coalesce(F.crc32(F.col(row_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(df: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text", label: str = "toxic", max_positive: int = 3000, max_unlabelled: int = 8000) -> ToxicityModel:
    """Learn from texts with label 1 and from unlabelled texts, held-out rows aside.

    ``max_positive`` and ``max_unlabelled`` bound the samples in expectation: rows whose hash lies below
    the share that gives so many. The class prior is the share of label 1 among all usable labels (the
    largest label counts where an id has several, null labels do not count).
    """
    known = labels.select(row_id, label).filter(F.col(row_id).isNotNull() & F.col(label).isNotNull() & ~held_out(row_id))
    known = known.groupBy(row_id).agg(F.max(label).alias("_label"))
    n_known, n_pos = known.agg(F.count("*"), F.count_if(F.col("_label") == 1)).first()
    if not n_pos:
        return train([], [], 0.01)
    unit = F.pmod(F.xxhash64(row_id), F.lit(1 << 30)) / (1 << 30)
    chosen = known.filter((F.col("_label") == 1) & (unit < max_positive / n_pos)).select(row_id).limit(2 * max_positive)
    ids = [r[0] for r in chosen.collect()]  # at most 2 * max_positive
    usable = df.select(row_id, F.col(text).cast("string").alias("_text")).filter(~held_out(row_id))
    total = usable.select(row_id).count()
    positive = F.broadcast(df.sparkSession.createDataFrame([(i,) for i in ids], known.select(F.col(row_id).alias("_id")).schema))
    sampled = F.coalesce(F.pmod(F.xxhash64(F.lit(3), row_id), F.lit(1 << 30)) / (1 << 30) < max_unlabelled / max(total, 1), F.lit(False))
    sample = (
        usable.join(positive, F.col(row_id) == F.col("_id"), "left")
        .select("_text", F.col("_id").isNotNull().alias("positive"), sampled.alias("sampled"))
        .filter("positive or sampled")
    )
    prior = n_pos / n_known

    def learn(table: pa.Table) -> dict[str, float]:
        texts, is_positive, is_sampled = (table.column(i).to_pylist() for i in range(3))
        # in the order of the texts, so that the fit doesn't depend on the order of the rows
        rows = sorted(zip((t or "" for t in texts), is_positive, is_sampled))
        model = train([t for t, y, _ in rows if y], [t for t, _, u in rows if u], prior)
        return {**model.weights, _BIAS: model.bias}

    found = weights_of(sample, learn)
    if not found:
        return train([], [], prior)
    bias = found.pop(_BIAS)
    return ToxicityModel(found, bias)


def score(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``df`` (text column first read, all others passed through) with ``score`` (double, 0 to 1); null counts as empty."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the fit sample
    names = df.columns

    def run(batches):
        of = shared.value.scorer()
        for b in batches:
            made = pa.array([of(t.as_py()) for t in b.column(len(names))], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], made], names=[*names, "score"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*df.schema.fields, StructField("score", DoubleType())])
    return map_batches(df.withColumn("_score_text", F.col(text).cast("string")), run, schema)


def predict(df: DataFrame, model: ToxicityModel, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_id, held_out, score, predicted): one row per row of ``df``, repeated rows included."""
    scored = score(df.select(row_id, F.col(text).alias("_text")), model, "_text").drop("_text")
    return scored.select(row_id, held_out(row_id).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``df`` without the rows whose text scores 0.5 or more; clean, empty and null texts stay. All columns are carried,
    whatever their names."""
    rows = df.select(F.struct("*").alias("doc"), F.col(text).cast("string").alias("text"))
    return score(rows, model, "text").filter("score < 0.5").select("doc.*")
