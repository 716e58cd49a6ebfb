"""Mixing to target weights under soft membership.

A classifier trained on a labelled table (doc_id, domain) gives every document a posterior over
the domains: hashed-word log-odds and the text's shape go into a multinomial logistic
regression. Then every document gets a rate r >= 0, starting at 1, so that the expected tokens
of each domain, the sum of r * tokens * posterior, come to the targets: least squares by projected
gradient steps r = max(0, r - posterior . inverse(C) . error), in the metric of the curvature
C = sum of tokens * posterior * posterior' over the rows whose rate is not 0. Where such a step
makes the errors larger, the next one takes C over all rows, in whose metric the gradient's
Lipschitz constant is 1, so that whole steps converge. A step needs one pass, which brings sums
per domain to the driver; the rates themselves stay with the rows, as a fold over the steps. The
steps end when the errors come to ``CLOSE`` of all tokens, or stand still (``STILL``) because
rates of 0 and more cannot come nearer. What is left is the column ``residual``, the same in
every row; a residual beyond ``CLOSE`` is also a warning.

A rate becomes copies by hash: its whole part, and one more with the probability of the rest.
Null and blank texts have no tokens, a posterior like any other and the rate that follows from
it. Rows are treated one by one; equal rows get equal results. Of a document's labels the first
by name counts. Without labels all domains are equally likely; an empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.llm.common import written
from murmur.llm.tokens import SPACE, Words, pieces, words

BUCKETS = 1 << 16
#: Expected rows of the labelled sample; a third of it fits the regression.
SAMPLE_ROWS, HASH_RANGE = 20_000, 1 << 30
#: Documents' worth of prior in the odds of a word.
PRIOR_TEXTS = 5.0
#: Errors, and their change in one step, in units of all wanted tokens; most steps ever taken.
CLOSE, STILL, STEPS = 1e-4, 1e-8, 200


def bucket(w: Words) -> np.ndarray:
    return (w.hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def word_counts(sample: DataFrame, domains: list[str]) -> np.ndarray:
    """Documents of each domain that hold a word of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(domains), BUCKETS), np.int64)
        for batch in batches:
            own = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, _, data, bounds in pieces(batch.column(0)):
                w = words(data, bounds, SPACE)
                doc, at = w.document_of(), bucket(w)
                doc, at = np.divmod(np.unique(doc * BUCKETS + at), BUCKETS)
                np.add.at(total, (own[lo + doc], at), 1)
        domain, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(domain), pa.array(at), pa.array(total[domain, at])], ["domain", "at", "n"])

    out = np.zeros((len(domains), BUCKETS))
    # At most domains * BUCKETS rows.
    for r in sample.select("text", "domain").mapInArrow(
            run, "domain long, at long, n long").groupBy("domain", "at").agg(
            F.sum("n").alias("n")).collect():
        out[r["domain"], r["at"]] = r["n"]
    return out


def shapes(w: Words, raw: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Features of each document of a piece: mean and best word odds by domain, and the shape
    of the text."""
    n, size = np.diff(w.offsets), np.diff(w.bounds)
    at = bucket(w)

    def mean(values: np.ndarray, bounds: np.ndarray, by: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(by, 1)

    doc = w.document_of()
    held, times = np.unique(doc * BUCKETS + at, return_counts=True)
    distinct = np.bincount(held // BUCKETS, minlength=len(n))
    most = np.zeros(len(n))
    np.maximum.at(most, held // BUCKETS, times)
    upper, marks = (raw >= 65) & (raw <= 90), np.isin(raw, np.frombuffer(b"!#$%&*|@", np.uint8))
    digits = (raw >= 48) & (raw <= 57)
    best = np.zeros((len(odds), len(n)))
    for top, o in zip(best, odds):
        np.maximum.at(top, doc, o[at])
    return np.stack([
        *(mean(o[at], w.offsets, n) for o in odds), *best, np.log1p(n), distinct / np.maximum(n, 1),
        most / np.maximum(n, 1), *(mean(x, w.bounds, size) for x in (upper, marks, digits)),
        size / np.maximum(n, 1) / 10], axis=1)


@dataclass
class Classifier:
    odds: np.ndarray  # by domain and bucket
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # features and a constant, by domain

    def posteriors(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.centre) / self.scale, -8, 8)
        z = np.concatenate([x, np.ones((len(x), 1))], axis=1) @ self.weights
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fitted(features: np.ndarray, domain: np.ndarray, odds: np.ndarray) -> Classifier:
    """Multinomial logistic regression by gradient steps over the (bounded) sample."""
    k = len(odds)
    width = features.shape[1]
    out = Classifier(odds, np.zeros(width), np.ones(width), np.zeros((width + 1, k)))
    if len(domain):
        out.centre, out.scale = features.mean(axis=0), features.std(axis=0) + 1e-6
        x = np.clip((features - out.centre) / out.scale, -8, 8)
        x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        step = 2 / (np.linalg.norm(x, 2) ** 2 / len(x))
        wanted = np.eye(k)[domain]
        for _ in range(400):
            error = out.posteriors(features) - wanted
            out.weights -= step * (x.T @ error / len(x) + 1e-4 * out.weights)
    return out


def featured(rows: DataFrame, odds: np.ndarray, classifier: Classifier | None = None) -> DataFrame:
    """The rows' columns after the text, then tokens and features (or posteriors)."""
    shared = rows.sparkSession.sparkContext.broadcast((odds, classifier))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, classifier = shared.value
        for batch in batches:
            for lo, hi, data, bounds in pieces(batch.column(0)):
                w = words(data, bounds, SPACE)
                x = shapes(w, data, odds)
                if classifier is not None:
                    x = classifier.posteriors(x)
                ends = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, hi - lo).columns[1:], pa.array(np.diff(w.offsets)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(x.reshape(-1)))],
                    [*rest, "n_tokens", "values"])

    rest = rows.columns[1:]
    return rows.mapInArrow(run, T.StructType([
        *rows.schema.fields[1:], T.StructField("n_tokens", T.LongType()),
        T.StructField("values", T.ArrayType(T.DoubleType()))]))


def learn(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> Classifier:
    """A classifier from about SAMPLE_ROWS rows of ``labelled`` (doc_id, domain)."""
    known = labelled.where(F.col("domain").isin(*domains)).groupBy("doc_id").agg(
        F.min("domain").alias("domain"))
    rate = SAMPLE_ROWS / max(1, labelled.count())
    h = F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE))
    chosen = known.where(h < min(HASH_RANGE, int(rate * HASH_RANGE))).select(
        "doc_id", (F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1).alias(
            "domain"), (h % 3 == 0).alias("late"))
    # About SAMPLE_ROWS rows of two numbers, whatever the size of the tables.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    counts = word_counts(sample.where(~F.col("late")), domains)
    prior = (counts.sum(axis=1, keepdims=True) + 1) / (counts.sum() + len(domains))
    odds = np.log((counts + PRIOR_TEXTS * prior) / (counts.sum(axis=0) + PRIOR_TEXTS) / prior)
    rows = featured(sample.where("late").select("text", "domain"), odds).collect()
    width = len(rows[0]["values"]) if rows else 2 * len(domains) + 7
    features = np.array([r["values"] for r in rows]).reshape(-1, width)
    return fitted(features, np.array([r["domain"] for r in rows], np.int64), odds)


def rate(steps: list[np.ndarray]) -> Column:
    """The rate of a row after the given steps, by its posterior ``p``."""
    if not steps:
        return F.lit(1.0)
    wanted = F.array(*(F.array(*(F.lit(float(x)) for x in s)) for s in steps))

    def step(r: Column, s: Column) -> Column:
        move = F.aggregate(F.zip_with("p", s, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y)
        return F.greatest(F.lit(0.0), r - move)

    return F.aggregate(wanted, F.lit(1.0), step)


def fit_rates(rows: DataFrame, targets: list[float]) -> tuple[list[np.ndarray], float]:
    """Steps of the projected gradient for rows with n_tokens and posterior p, and the errors
    that they leave, in units of the targets' sum."""
    k = len(targets)
    wanted = np.array(targets)
    unit = max(wanted.sum(), 1e-12)
    steps: list[np.ndarray] = []
    whole, least, before = None, np.inf, np.full(k, np.inf)
    while True:
        rated = rows.select("n_tokens", "p", rate(steps).alias("r"))
        own = [F.sum(F.col("r") * F.col("n_tokens") * F.col("p")[i]) for i in range(k)]
        moving = F.when(F.col("r") > 0, F.col("n_tokens"))
        cells = [F.sum(moving * F.col("p")[i] * F.col("p")[j]) for i in range(k) for j in range(k)]
        sums = np.array([float(x or 0) for x in rated.agg(*own, *cells).first()])
        error, curvature = sums[:k] - wanted, sums[k:].reshape(k, k)
        whole = curvature if whole is None else whole  # all rates are 1 at first
        left = float(np.abs(error).sum() / unit)
        if left <= CLOSE or np.abs(error - before).sum() / unit <= STILL or len(steps) == STEPS:
            return steps, left
        steps.append(np.linalg.pinv(curvature if left < least else whole, hermitian=True) @ error)
        least, before = min(least, left), error


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float = 1.0,
        keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """row (a struct of the columns to ``keep``), n_tokens, p (posteriors), rate, copies, residual.

    ``targets`` are shares of the tokens by domain; p is in the order of their names. The mix
    shall have ``budget`` times the tokens there are.
    """
    domains = sorted(targets)
    classifier = learn(docs, labelled, domains)
    rows = written(featured(docs.select("text", F.struct(*keep).alias("row")), classifier.odds,
                            classifier), "posteriors").withColumnRenamed("values", "p")
    slim = rows.select("n_tokens", "p").persist(StorageLevel.MEMORY_AND_DISK)
    total = float(slim.agg(F.sum("n_tokens")).first()[0] or 0)
    weight = sum(targets.values())
    steps, residual = fit_rates(slim, [total * budget * targets[d] / weight for d in domains])
    slim.unpersist()
    if residual > CLOSE and total:
        warnings.warn(f"the mix misses its targets by {residual:.2g} of all tokens", stacklevel=2)
    chance = F.pmod(F.xxhash64("row", F.lit("copies")), F.lit(HASH_RANGE)) / HASH_RANGE
    return rows.withColumn("rate", rate(steps)).withColumn("copies", F.floor("rate") + (
        chance < F.col("rate") - F.floor("rate")).cast("long")).withColumn(
        "residual", F.lit(residual))


def mixed_rows(docs: DataFrame, labelled: DataFrame, targets: dict[str, float],
               budget: float = 1.0) -> DataFrame:
    """The rows that the mix takes at least once, then rate and copies (replaced if there)."""
    names = [c for c in docs.columns if c not in ("rate", "copies")]
    found = mix(docs.select(*names), labelled, targets, budget, tuple(names))
    return found.where("copies > 0").select(
        *(F.col("row")[c].alias(c) for c in names), "rate", "copies")


#: Domains of labelled documents, and the mix of the corpus.
TARGETS = {"good": 0.87, "low": 0.10, "toxic": 0.03}


def domains_of(labels: DataFrame) -> DataFrame:
    """doc_id and domain from the labels quality and toxic; rows that lack one have no domain."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(
        F.col("quality") == 0, "low").when(F.col("quality") == 1, "good").alias("domain"))
