"""Soft-membership mixing of documents to target weights, in DataFrame and SQL
functions only.

1. A classifier learned from the ``labels`` table gives every document posterior
   probabilities of the domains (by default the four cases of quality and
   toxicity).  It is a Poisson naive Bayes over the hashed words and word
   shapes of the whole text, with the features that speak most for some domain;
   words that fail to come count by the text's length.
   It is fitted on at most ``LABELLED``
   labelled rows, chosen by the hash of their id; everything after covers all
   rows.
2. Nonnegative document rates are fitted so that the expected domain totals
   sum_d rate_d * tokens_d * p_dk match the targets: projected gradient on the
   least squares of the residuals, scaled by the second moments of the domains
   over the documents whose rate is not at zero, from all rates at 1.  The
   gradient of a document's rate is its posteriors times the K residuals, so the
   rates depend on the posteriors and one vector of K summed steps, projected on
   rate >= 0.  A step is one aggregate of K + K * K sums over a written narrow
   table; nothing per document ever moves.

Targets are shares of the documents' own token total; those of domains that no
labelled row has count as 0, and the rest are scaled to sum to 1.  If a target
cannot be reached (a domain without mass), the rates are the best
fit found within ``STEPS`` steps, and a warning gives the residual.

Edge cases: null and empty texts have no tokens and the prior as posteriors;
labels with a null id or a null class are not learned from, and of labels that
repeat an id the smallest counts; rows that repeat an id or a text get equal
rates; without any labelled row all rates are 1 and the posteriors empty; an
empty table gives an empty result; other columns are ignored or passed through.
"""
from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, written

BUCKETS = 1 << 15
LABELLED = 20_000
# A feature speaks for a domain if its log ratio among documents exceeds SURE
# standard errors and a quarter of the domain's most, and that among words EFFECT.
SURE = 4.5
EFFECT = 1.0
STEPS = 20
# A text with at least this part of a domain's prior as its posterior tells
# little against the domain.
UNSURE = 0.5
TOLERANCE = 1e-4
# A larger residual of some target's share is warned of.
MISSED = 0.01
# Most domains that a labels table may name.
DOMAINS = 64
#: Target share of each domain: mostly clean text, a little of the rest.
TARGETS = {"quality=1,toxic=0": 0.95, "quality=1,toxic=1": 0.03, "quality=0,toxic=0": 0.02, "quality=0,toxic=1": 0.0}


def quality_toxic_domain(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labels table."""
    return labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull()) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.concat(F.lit("quality="), F.col("quality"), F.lit(",toxic="), F.col("toxic")).alias("domain"))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def features(text: Column) -> Column:
    """Hash buckets of a text's lower-case words and of their shapes (runs of
    small letters as one ``a``, of capitals as one ``A``, of digits as 0)."""
    clean = F.coalesce(text.cast("string"), F.lit(""))
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(clean, r"[\p{Ll}]+", "a"), r"[\p{Lu}]+", "A"), r"[0-9]+", "0")
    return F.concat(F.transform(words(F.lower(clean)), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int")),
                    F.transform(words(shape), lambda w: F.pmod(F.xxhash64(F.lit("shape"), w), F.lit(BUCKETS)).cast("int")))


def _array(values) -> Column:
    """A literal array of doubles (folded by Spark when it plans)."""
    return F.expr("cast(split('" + ",".join(f"{v:.4g}" for v in values) + "', ',') as array<double>)")


class Classifier:
    """Domain names, log priors, log-ratio weights (domains x buckets) and the
    change of the log odds with every feature of a text, whatever it is."""

    def __init__(self, names: list[str], prior: np.ndarray, weight: np.ndarray, each: np.ndarray):
        self.names, self.prior, self.weight, self.each = names, prior, weight, each

    def logits(self, feats: Column, size: Column) -> Column:
        """Array of the domains' log odds, in the order of names, from the used
        features of a text and the number of all its features."""
        if not self.names:
            return F.array().cast("array<double>")

        def one(k: int) -> Column:
            w = _array(self.weight[k])
            return F.aggregate(feats, F.lit(float(self.prior[k])), lambda s, b: s + F.get(w, b)) - size * F.lit(float(self.each[k]))

        return F.array(*[one(k) for k in range(len(self.names))])

    def used(self, feats: Column) -> Column:
        """The features that have a weight in some domain."""
        marks = F.expr("cast(split('" + ",".join("1" if u else "0" for u in (self.weight != 0).any(0)) + "', ',') as array<boolean>)")
        return F.filter(feats, lambda b: F.get(marks, b))


def fit_classifier(docs: DataFrame, labelled: DataFrame, most: int = LABELLED) -> Classifier:
    """Counts of hashed features by domain over at most ``most`` labelled rows."""
    one = labelled.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    sample = written(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "labelled")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    # Written once: what follows reads bucket numbers, and no filter that Spark
    # infers from a generator computes features anew, for all documents at that.
    feats = written(rows.select("domain", features(F.col("text")).alias("f")), "labelled-features")
    shares = {r["domain"]: r["count"] for r in feats.groupBy("domain").count().limit(DOMAINS + 1).collect()}
    names = sorted(shares)
    if len(names) > DOMAINS:
        raise ValueError(f"labels name more than {DOMAINS} domains")

    def counts(f: Column) -> np.ndarray:
        out = np.zeros((len(names), BUCKETS))
        for r in feats.select("domain", F.explode(f).alias("bucket")).groupBy("domain", "bucket").count().collect():  # DOMAINS x BUCKETS at most
            out[names.index(r["domain"]), r["bucket"]] = r["count"]
        return out

    d, n = counts(F.array_distinct("f")), np.array([[shares[k]] for k in names], dtype=float).reshape(-1, 1)
    t = counts(F.col("f"))
    rest_d, rest_n, rest_t = d.sum(0) - d, n.sum() - n, t.sum(0) - t
    among = np.log((d + 1) / (n + 2)) - np.log((rest_d + 1) / (rest_n + 2))
    rate, rest = ((x + 1) / (x.sum(1, keepdims=True) + BUCKETS) for x in (t, rest_t))
    ratio = np.log(rate / rest)
    z = among / np.sqrt(1 / (d + 1) + 1 / (rest_d + 1))
    speaks = (ratio > EFFECT) & (z > np.maximum(SURE, z.max(1, keepdims=True) / 4)) if len(names) else z
    used = speaks.any(0)
    pooled = (t.sum(0) + 1) / (t.sum() + BUCKETS)
    return Classifier(names, np.log(n[:, 0] / n.sum()), np.where(used, np.log(rate / pooled), 0), np.where(used, rate - pooled, 0).sum(1))


def with_posteriors(docs: DataFrame, model: Classifier, tokens: str, post: str) -> DataFrame:
    """``docs`` with the number of words and the domains' posteriors."""
    f, u = fresh(docs, "mix_features", "mix_used")
    # Each word is one feature by itself and one by its shape.
    out = docs.withColumn(f, features(F.col("text"))).withColumn(tokens, (F.size(F.col(f)) / 2).cast("long"))
    # Staged columns: each logit is computed once, over the few features that
    # have a weight, then scaled to sum to 1.
    out = out.withColumn(u, model.used(F.col(f))).withColumn(post, model.logits(F.col(u), F.size(F.col(f)))).drop(f, u)
    out = out.withColumn(post, F.transform(F.col(post), lambda x: F.exp(x - F.array_max(F.col(post)))))
    total = F.aggregate(F.col(post), F.lit(0.0), lambda s, x: s + x)
    return out.withColumn(post, F.transform(F.col(post), lambda x: x / total))


def rate_of(shift: list[float], post: Column) -> Column:
    """The rate of a document: 1 moved by the summed steps, projected on >= 0."""
    move = F.lit(0.0)
    for k, x in enumerate(shift):
        move = move + post[k] * F.lit(float(x))
    return F.greatest(F.lit(0.0), F.lit(1.0) - move)


def fit_rates(rows: DataFrame, names: list[str], targets: dict[str, float], tokens: str, post: str,
              most: int = STEPS, tolerance: float = TOLERANCE) -> list[float]:
    """The summed steps of the projected gradient over ``rows`` (written)."""
    goal = np.array([max(0.0, targets.get(n, 0.0)) for n in names])
    p, t, n = F.col(post), F.col(tokens), len(names)
    if not n or goal.sum() <= 0:
        return []
    goal = goal / goal.sum()
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    shift = best = np.zeros(n)
    least, worse, size = np.inf, 0, 1.0
    for _ in range(most):
        rate = rate_of(shift.tolist(), p)
        free = F.when(rate > 0, t).otherwise(F.lit(0))
        now = rows.agg(F.sum(t).alias("t"), *[F.sum(rate * t * p[k]).alias(f"s{k}") for k in range(n)],
                       *[F.sum(free * p[i] * p[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
        if not now["t"]:
            return []
        off = np.array([now[f"s{k}"] for k in range(n)]) / now["t"] - goal
        error = float(np.abs(off).max())
        if error < 0.99 * least:
            least, best, worse = error, shift, 0
        else:
            # No better: half the step from the best so far, twice at most.
            worse, size = worse + 1, size / 2
        if least < tolerance or worse > 2:
            break
        moment = np.zeros((n, n))
        for i, j in pairs:
            moment[i, j] = moment[j, i] = now[f"c{i}_{j}"] / now["t"]
        shift = shift + size * np.linalg.solve(moment + 1e-6 * np.eye(n), off)
    if least > MISSED:
        warnings.warn(f"the rates miss a target by a share of {least:.3f}: some domain has too little mass", stacklevel=2)
    return best.tolist()


def _fitted(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> tuple[DataFrame, Classifier, list[float], str, str]:
    """Written rows with tokens and posteriors, the classifier, the summed steps
    and the names of the two columns."""
    t, p = fresh(docs, "tokens", "posteriors")
    model = fit_classifier(docs, labelled)
    rows = written(with_posteriors(docs, model, t, p), "mixing")
    return rows, model, fit_rates(rows, model.names, targets, t, p), t, p


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS) -> tuple[DataFrame, str, str, str]:
    """``docs`` with tokens, posteriors and rate; returns those columns' names."""
    rows, _, shift, t, p = _fitted(docs, labelled, targets)
    r = fresh(rows, "rate")[0]
    return rows.withColumn(r, rate_of(shift, F.col(p))), t, p, r


def mix_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, tokens, posteriors and rate."""
    out, t, p, r = mix(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), quality_toxic_domain(labels))
    return out.select("doc_id", F.col(t).alias("n_words"), F.col(p).alias("posteriors"), F.col(r).alias("rate"))


def keeping_rate(model: Classifier, shift: list[float], targets: dict[str, float], post: Column) -> Column:
    """The rate of a document, all scaled by one factor (targets are shares) such
    that one surely of the clean domain, that of the largest target, has at
    least 1.  A text that tells little against that domain (its posterior is at
    least ``UNSURE`` of the prior, or no other's is larger) has at least 1 too."""
    rate = rate_of(shift, post)
    if not shift:
        return rate
    k = max(range(len(model.names)), key=lambda i: targets.get(model.names[i], 0.0))
    sure = 1.0 - shift[k]
    scaled = rate / F.lit(sure) if 0 < sure < 1 else rate
    stays = (post[k] >= F.lit(UNSURE * float(np.exp(model.prior[k])))) | (post[k] >= F.array_max(post))
    return F.when(stays, F.greatest(scaled, F.lit(1.0))).otherwise(scaled)


def resample(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """``docs`` repeated by their rates: the whole part of a rate always, the
    rest by the hash of id and text.  Documents of the clean domain stay (see
    ``keeping_rate``), only the rest thins out.  Columns as in ``docs``; a row's
    copies are equal."""
    rows, model, shift, _, p = _fitted(docs, quality_toxic_domain(labels), targets)
    r = fresh(rows, "rate")[0]
    out = rows.withColumn(r, keeping_rate(model, shift, targets, F.col(p)))
    draw = F.pmod(F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = (F.floor(F.col(r)) + (draw < F.col(r) - F.floor(F.col(r))).cast("int")).cast("int")
    c = fresh(out, "mix_copy")[0]
    return out.withColumn(c, F.explode(F.array_repeat(F.lit(0), copies))).select(*[F.col(f"`{x}`") for x in docs.columns])
