"""Quality classifier by positive-unlabelled learning.

A logistic model of whole-text statistics minimises the non-negative unbiased
risk  pi E_P[l(z)] + max(0, E_U[l(-z)] - pi E_P[l(-z)])  of trusted positives P
(labelled quality 1, outside the held-out fold) and unlabelled text U (all
documents outside that fold); no negative label is used.  The class prior pi is
estimated from P and U alone, by the upper tails of a first model's scores; the
second model uses it.

The statistics are computed once per text, in vectorised slices, and written as
a narrow table.  A step of the fit is one pass over that table: every task sums
gradients and curvatures, and a few numbers a task reach the driver.  All rows
take part; nothing is sampled.

Edge cases: null and empty texts have the statistics of no words and get a score
too; rows with a null doc_id are never held out; labels with a null id or class
are not learned from, and an id labelled both ways is no trusted positive; rows
that repeat a text get equal scores; without positives every score is 0.5; an
empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Slice, small_batches, text_slices, written
from .quality_rules import _repeats, text_stats

FOLDS = 5
CUT = 0.3
STEPS = 10
DECAY = 1e-3
PRIOR_START = 0.7
BINS = 200
_UPPER, _DIGIT, _MARK, _STOP, _BAR = (np.zeros(256, dtype=bool) for _ in range(5))
_UPPER[ord("A"):ord("Z") + 1] = True
_DIGIT[ord("0"):ord("9") + 1] = True
_MARK[[ord("!"), ord("?")]] = True
_STOP[[ord("."), ord("!"), ord("?")]] = True
_BAR[ord("|")] = True
N_STATS = 12


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows of N_STATS statistics of the texts of a slice: log length and mean
    word length, and square roots of shares that start from a few plain words."""
    s = Slice(data, offs)
    st = text_stats(data, offs)
    n = st["n_words"].astype(float)
    after = np.zeros(len(data), dtype=bool)
    after[1:] = data[:-1] == 0xC3
    upper = s.per_text(_UPPER[data] | (after & (data >= 0x80) & (data <= 0x9E)))
    w = s.hashes(s.starts, s.ends)
    text = np.repeat(np.arange(len(n)), st["n_words"])
    again = np.zeros(len(w), dtype=bool)
    again[1:] = (w[1:] == w[:-1]) & (text[1:] == text[:-1])
    later = _repeats(w, text, len(n))[0]

    def share(count: np.ndarray, per: np.ndarray = n, start: float = 10.0) -> np.ndarray:
        return np.sqrt(count / (per + start))

    return np.stack([
        np.log1p(n), np.log((st["word_chars"] + 50.0) / (n + 10)), share(st["n_symbols"]), share(upper, st["word_chars"], 20.0), share(s.per_text(_MARK[data])),
        share(s.per_text(_DIGIT[data]), st["word_chars"], 20.0), share(np.bincount(text[again], minlength=len(n))), share(st["n_repeat_words"]),
        share(st["n_dup_lines"]), share(s.per_text(_STOP[data])), share(s.per_text(_BAR[data])), share(later)], axis=1)


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, x) of every row, written."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in text_slices(batches, "text"):
            x = statistics(data, offs)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, N_STATS, dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], names=["doc_id", "held_out", "x"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", held.alias("held_out"), "text")
                   .mapInArrow(run, "doc_id long, held_out boolean, x array<double>"), "statistics")


class Model:
    """Weights over standardised statistics and their squares."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weight: np.ndarray | None = None):
        self.mean, self.scale = mean, scale
        self.weight = np.zeros(2 * len(mean) + 1) if weight is None else weight

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.square(z) / 4, np.ones((len(z), 1))], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.design(x) @ self.weight)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


def _sums(rows: DataFrame, of, size: int) -> np.ndarray:
    """The sum over all rows of the vectors that ``of(x, positive)`` gives; a task
    sends one row an entry, which Spark adds up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += of(_matrix(b.column(0)), b.column(1).to_numpy(zero_copy_only=False).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "v"])

    out = np.zeros(size)
    for r in rows.select("x", "positive").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():  # ``size`` rows
        out[r["at"]] = r["v"]
    return out


def pu_fit(rows: DataFrame, model: Model, prior: float, steps: int = STEPS) -> Model:
    """Damped Newton steps on the non-negative risk over ``rows`` (x, positive;
    every row is unlabelled text, the positive ones are trusted as well).  A step
    that does not lower the risk is halved from the best weights so far."""
    d = len(model.weight)

    def one_pass(weight: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """The risk, its gradient and the curvature."""
        def of(x: np.ndarray, pos: np.ndarray) -> np.ndarray:
            a = model.design(x)
            z = a @ weight
            p = sigmoid(z)
            curve = (a * (p * (1 - p))[:, None]).T @ a
            # Losses l(-z) = log(1 + e^z) and l(z), and the gradients of l(-z) and l(z).
            neg = np.logaddexp(0, z)
            return np.concatenate([[len(x), pos.sum(), neg.sum(), neg[pos].sum(), (neg - z)[pos].sum()], a.T @ p, a[pos].T @ p[pos], a[pos].T @ (p[pos] - 1), curve.ravel()])

        v = _sums(rows, of, 5 + 3 * d + d * d)
        n_u, n_p = max(v[0], 1), max(v[1], 1)
        g_u, g_p, g_pos = v[5:5 + d] / n_u, v[5 + d:5 + 2 * d] / n_p, v[5 + 2 * d:5 + 3 * d] / n_p
        negative = v[2] / n_u - prior * v[3] / n_p
        grad = prior * g_pos + DECAY * weight
        # Below zero the negative part of the risk is fitted noise and counts as 0.
        if negative > 0:
            grad = grad + g_u - prior * g_p
        return prior * v[4] / n_p + max(0.0, negative) + DECAY / 2 * weight @ weight, grad, v[5 + 3 * d:].reshape(d, d) / n_u

    weight = best = model.weight
    least, move, share = np.inf, np.zeros(d), 1.0
    for _ in range(steps):
        risk, grad, curve = one_pass(weight)
        if risk < least:
            move = np.linalg.solve(curve + (DECAY + 1e-6) * np.eye(d), grad)
            move = move * min(1.0, 3.0 / max(np.sqrt(move @ move), 1e-12))
            best, least, share = weight, risk, min(1.0, 2 * share)
        else:
            share /= 2
        if share * np.sqrt(move @ move) < 1e-3:
            break
        weight = best - share * move
    return Model(model.mean, model.scale, best)


def estimate_prior(rows: DataFrame, model: Model) -> float:
    """The share of positives in U: the ratio of the upper tails of U and P at
    the score where its upper confidence bound is least, less the margin for
    chance (a prior too low only lowers the sure scores a little; one too high
    keeps the non-negative risk from telling the rest apart)."""

    def of(x: np.ndarray, pos: np.ndarray) -> np.ndarray:
        b = np.minimum((model.scores(x) * BINS).astype(int), BINS - 1)
        return np.concatenate([np.bincount(b, minlength=BINS), np.bincount(b[pos], minlength=BINS)]).astype(float)

    v = _sums(rows, of, 2 * BINS)
    n_u, n_p = v[:BINS].sum(), v[BINS:].sum()
    u, p = np.cumsum(v[:BINS][::-1]) / n_u, np.cumsum(v[BINS:][::-1]) / n_p
    slack = np.sqrt(np.log(20) / (2 * n_u)) + np.sqrt(np.log(20) / (2 * n_p))
    ok = p > 0.1
    k = int(np.argmin((u[ok] + slack) / p[ok]))
    return float(np.clip((u[ok][k] - slack) / p[ok][k], 0.05, 0.98))


def fit(rows: DataFrame) -> Model | None:
    """The model of ``rows`` (x, positive), or None without positives."""
    def of(x: np.ndarray, pos: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x), pos.sum()], x.sum(0), np.square(x).sum(0)])

    v = _sums(rows, of, 2 + 2 * N_STATS)
    if not v[1]:
        return None
    mean = v[2:2 + N_STATS] / v[0]
    scale = np.sqrt(np.maximum(v[2 + N_STATS:] / v[0] - mean ** 2, 0)) + 0.02
    first = pu_fit(rows, Model(mean, scale), PRIOR_START)
    return pu_fit(rows, first, estimate_prior(rows, first))


def score_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = with_statistics(docs)
    trusted = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.min("quality").alias("q")).where("q = 1").select("doc_id", F.lit(True).alias("positive"))
    train = written(rows.where(~F.col("held_out")).join(trusted, "doc_id", "left").select("x", F.coalesce("positive", F.lit(False)).alias("positive")), "train")
    model = fit(train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.full(b.num_rows, 0.5) if model is None else model.scores(_matrix(b.column(2)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p), pa.array((p >= CUT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return rows.select("doc_id", "held_out", "x").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
