"""Quality rules: robust multivariate outliers (minimum covariance determinant).

Five statistics of every whole text, transformed to near-symmetric scales, form
a vector.  For each (lang, source) group a minimum-covariance-determinant
estimate of centre and scatter is found by concentration steps; a text whose
Mahalanobis distance from its group's estimate is beyond the cut-off is
rejected.  Fixed base rules reject very short and very repetitive texts first;
they take no part in the estimates.

How it runs: the statistics are computed once, in vectorised slices, and
written as a narrow table.  A concentration step is one aggregate over it:
counts, sums and cross products per (group, distance bin), combined in the map
side, so a group with a third of all rows costs no more than another; the
h-subset is the bins up to the one that reaches h rows.  The estimates (one row
a group) are joined back, with Spark choosing the join by measured size.

Edge cases: null text counts as empty (no words, base_failed, not kept); null
lang or source is a group of its own; groups of fewer than ``MIN_GROUP`` usable
rows take the estimate of all rows together, and below that number in total
nothing but the base rules rejects; equal rows are judged alike; an empty table
gives an empty result; other columns are ignored or passed through untouched.
"""
from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Slice, fresh, small_batches, text_slices, written

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
WINDOW = 5
DIM = 5
PRIOR_WORDS, PRIOR_CHARS = 20.0, 5.0
MIN_GROUP = 50
# Share of a group's rows that the estimate must cover (h = ceil(COVER * n)).
COVER = 0.75
STEPS = 6
# Cut-off: the chi-square quantile of DIM degrees of freedom at this tail,
# far out because the tails of text statistics are heavier than normal.
TAIL = 1e-6
# Standard deviation of each transformed statistic that is of no interest: its
# square is added to every variance (a ridge on the covariance), so constant
# statistics do not make every change an outlier.
FLOOR = [0.5, 0.06, 0.08, 0.06, 0.10]
# Width of a distance bin in log2(1 + d^2).
BINS_PER_OCTAVE = 16


def text_stats(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The five statistics of each text of a slice."""
    s = Slice(data, offs)
    n_words = np.diff(s.bounds)
    lead = (data & 0xC0) != 0x80
    word_chars = s.per_text(s.is_word & lead)
    n_symbols = s.per_text(_SYMBOL[data])
    # Lines: pieces between \n inside a text; only those with a word count.
    newline = np.flatnonzero(data == 10)
    line_s = np.unique(np.concatenate([offs[:-1], newline + 1]))
    line_s = line_s[line_s < len(data)]
    stops = np.append(newline, len(data))
    line_e = np.minimum(stops[np.searchsorted(newline, line_s)], offs[np.minimum(np.searchsorted(offs, line_s, "right"), len(offs) - 1)])
    words = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(s.is_word, out=words[1:])
    real = words[line_e] > words[line_s]
    ls, le = line_s[real], line_e[real]
    lt = np.searchsorted(offs, ls, "right") - 1
    n_dup_lines = _repeats(s.hashes(ls, le), lt, len(n_words))[0]
    grams, first = s.grams(WINDOW)
    word_text = np.repeat(np.arange(len(n_words)), n_words)
    twice = _repeats(grams, word_text[first] if len(first) else first, len(n_words))[1]
    cover = np.zeros(len(s.starts) + 1, dtype=np.int64)
    hit = first[twice]
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0
    n_repeat = np.bincount(word_text[covered], minlength=len(n_words))
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
            "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat}


def _repeats(h: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """How many items of each text equal an earlier one of it, and a mask of
    the items that occur twice or more in their text."""
    twice = np.zeros(len(h), dtype=bool)
    if not len(h):
        return np.zeros(n_texts, dtype=np.int64), twice
    key = h ^ (text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    k, t = key[order], text[order]
    same = (k[1:] == k[:-1]) & (t[1:] == t[:-1])
    twice[order[1:][same]] = True
    later = np.bincount(t[1:][same], minlength=n_texts)
    twice[order[:-1][same]] = True
    return later, twice


def transform(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Near-symmetric vectors: log length, log mean word length, and square
    roots of the shares of symbols, duplicate lines and repeated words.  Mean
    length and shares start from PRIOR_WORDS plain words, so that few words say
    little."""
    n = stats["n_words"] + PRIOR_WORDS
    return np.stack([
        np.log(np.maximum(stats["n_words"], 1)),
        np.log((stats["word_chars"] + PRIOR_WORDS * PRIOR_CHARS) / n),
        np.sqrt(stats["n_symbols"] / n),
        np.sqrt(stats["n_dup_lines"] / n),
        np.sqrt(stats["n_repeat_words"] / n),
    ], axis=1)


def with_stats(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with the five counts, ``base_failed`` and the vector, under
    names that clash with none of its columns (returned in that order)."""
    small_batches(docs.sparkSession)
    names = fresh(docs, *STATS, "base_failed", "vec")
    fields = ", ".join(f"`{n}` long" for n in names[:5]) + f", `{names[5]}` boolean, `{names[6]}` array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in text_slices(batches, text):
            st = text_stats(data, offs)
            n, rep = st["n_words"], st["n_repeat_words"]
            failed = (n < 10) | (100 * rep > 20 * n)
            vec = transform(st)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, vec.size + 1, DIM, dtype=np.int32)), pa.array(vec.ravel()))
            cols = [*part.columns, *[pa.array(st[k].astype(np.int64)) for k in STATS], pa.array(failed), lists]
            yield pa.RecordBatch.from_arrays(cols, names=[*part.schema.names, *names])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [fields])
    return docs.mapInArrow(run, schema), names


def _distance(vec, mean, prec):
    """Squared Mahalanobis distance as a Spark expression over array columns."""
    diff = [vec[i] - mean[i] for i in range(DIM)]
    out = F.lit(0.0)
    for i in range(DIM):
        for j in range(i, DIM):
            out = out + (1.0 if i == j else 2.0) * prec[i * DIM + j] * diff[i] * diff[j]
    return F.greatest(out, F.lit(0.0))


def _moments() -> list:
    v = F.col("vec")
    return [F.count("*").alias("n"), *[F.sum(v[i]).alias(f"s{i}") for i in range(DIM)],
            *[F.sum(v[i] * v[j]).alias(f"p{i}_{j}") for i in range(DIM) for j in range(i, DIM)]]


def _estimate(frame: pd.DataFrame) -> pd.DataFrame:
    """Centre and inverse scatter of one group from the moments of its distance
    bins, up to the bin that reaches h rows."""
    frame = frame.sort_values("bin")
    n = int(frame["n"].sum())
    inner = frame[frame["n"].cumsum().shift(fill_value=0) < int(np.ceil(COVER * n))]
    m = inner["n"].sum()
    mean = np.array([inner[f"s{i}"].sum() for i in range(DIM)]) / m
    cov = np.empty((DIM, DIM))
    for i in range(DIM):
        for j in range(i, DIM):
            cov[i, j] = cov[j, i] = inner[f"p{i}_{j}"].sum() / m - mean[i] * mean[j]
    cov *= consistency(COVER)
    cov[np.diag_indices(DIM)] = np.maximum(cov.diagonal(), 0) + np.square(FLOOR)
    return pd.DataFrame({"g": [frame["g"].iloc[0]], "n": [n], "mean": [mean.tolist()], "prec": [np.linalg.inv(cov).ravel().tolist()]})


def chi2_quantile(p: float, df: int) -> float:
    """Wilson-Hilferty approximation of the chi-square quantile."""
    z = NormalDist().inv_cdf(p)
    return df * (1 - 2 / (9 * df) + z * (2 / (9 * df)) ** 0.5) ** 3


def consistency(cover: float) -> float:
    """Factor that makes the covariance of the inner ``cover`` of a normal
    sample consistent: cover / P(chi2 with DIM + 2 <= quantile of cover)."""
    q, k = chi2_quantile(cover, DIM), DIM + 2
    z = ((q / k) ** (1 / 3) - (1 - 2 / (9 * k))) / (2 / (9 * k)) ** 0.5
    return cover / NormalDist().cdf(z)


def mcd(points: DataFrame, steps: int = STEPS, min_group: int = MIN_GROUP) -> DataFrame:
    """Estimates (lang, source, mean, prec) of every group and, with both names
    null and ``whole`` true, of all rows together.  ``points``: lang, source, vec.

    The start of a group is its coordinate-wise medians and scaled median
    absolute deviations, which outliers cannot move far; each step then keeps
    the h rows nearest to the estimate and estimates anew from them, which
    never enlarges the determinant."""
    small_batches(points.sparkSession)
    nobody = F.lit(None).cast("string")
    group = F.explode(F.array(
        F.struct("lang", "source", F.lit(False).alias("whole")),
        F.struct(nobody.alias("lang"), nobody.alias("source"), F.lit(True).alias("whole"))))
    both = points.select(group.alias("g"), "vec")

    def quantile(i: int, at: float):
        return F.percentile_approx(F.col("vec")[i], at, 2000)

    start = both.groupBy("g").agg(
        F.count("*").alias("n"), F.array(*[quantile(i, 0.5) for i in range(DIM)]).alias("mean"),
        F.array(*[quantile(i, 0.75) - quantile(i, 0.25) for i in range(DIM)]).alias("spread"))
    weight = [1 / (F.pow(F.col("spread")[i] / 1.349, 2) + F.lit(FLOOR[i] ** 2)) for i in range(DIM)]
    est = written(start.where(F.col("n") >= min_group).select("g", "n", "mean", F.array(
        *[weight[i] if i == j else F.lit(0.0) for i in range(DIM) for j in range(DIM)]).alias("prec")), "mcd")
    for _ in range(steps):
        d2 = _distance(F.col("vec"), F.col("mean"), F.col("prec"))
        near = both.join(est.select(F.col("g").alias("at"), "mean", "prec"), F.col("g").eqNullSafe(F.col("at"))) \
            .select("g", "vec", F.floor(BINS_PER_OCTAVE * F.log2(1 + d2)).alias("bin"))
        est = written(near.groupBy("g", "bin").agg(*_moments()).groupBy("g").applyInPandas(
            _estimate, "g struct<lang:string,source:string,whole:boolean>, n long, mean array<double>, prec array<double>"), "mcd")
    return est.select("g.*", "n", "mean", "prec")


def judge(rows: DataFrame, names: list[str], tail: float = TAIL, steps: int = STEPS,
          lang: str = "lang", source: str = "source") -> tuple[DataFrame, str, str]:
    """``rows`` (written, from ``with_stats``) with the verdict: adds a distance
    and a boolean column and returns their names."""
    failed, vec = names[5], names[6]
    points = rows.where(~F.col(f"`{failed}`")).select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{source}`").cast("string").alias("source"), F.col(f"`{vec}`").alias("vec"))
    est = mcd(points, steps)
    d_name, k_name, m, p, wm, wp, gl, gs = fresh(rows, "distance2", "kept", "mcd_mean", "mcd_prec", "mcd_wmean", "mcd_wprec", "mcd_lang", "mcd_source")
    own = est.where(~F.col("whole")).select(F.col("lang").alias(gl), F.col("source").alias(gs), F.col("mean").alias(m), F.col("prec").alias(p))
    every = est.where(F.col("whole"))
    out = rows.join(own, F.col(f"`{lang}`").cast("string").eqNullSafe(F.col(gl)) & F.col(f"`{source}`").cast("string").eqNullSafe(F.col(gs)), "left") \
        .withColumn(m, F.coalesce(F.col(m), every.select("mean").scalar())) \
        .withColumn(p, F.coalesce(F.col(p), every.select("prec").scalar()))
    d2 = _distance(F.col(f"`{vec}`"), F.col(m), F.col(p))
    out = out.withColumn(d_name, d2)
    out = out.withColumn(k_name, ~F.col(f"`{failed}`") & (F.coalesce(F.col(d_name), F.lit(0.0)) <= chi2_quantile(1 - tail, DIM)))
    return out.drop(m, p, gl, gs), d_name, k_name


def quality_table(docs: DataFrame) -> DataFrame:
    """One row per document: counts, base verdict, distance and verdict."""
    narrow, names = with_stats(docs.select("doc_id", "text", "lang", "source"))
    rows = written(narrow.drop("text"), "quality")
    out, d2, kept = judge(rows, names)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), *names[:6], F.col(kept).alias("kept"), F.col(d2).alias("distance2"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass the rules, with its own columns only."""
    wide, names = with_stats(docs)
    rows = written(wide, "quality-docs")
    out, _, kept = judge(rows, names)
    return out.where(F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])
