"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, everything else is unlabelled. A linear classifier on
word and word-stem presence minimises the class-prior-corrected risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

and, where the bracket turns negative, steps back instead of fitting the unlabelled rows further.
Features are counted by Spark over the training sample; the fit itself is numpy on a bounded
number of short rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import picked, stored_copy, utf8

# Bounds of the training sample: rows are taken by a hash of their id, about so many of each kind.
MAX_POSITIVES = 20_000
MAX_UNLABELLED = 40_000
MIN_POSITIVES = 3  # training positives that must hold a feature
# A feature that only toxic texts hold has a lift of 1 / prior over the unlabelled rows, as these
# hold that share of toxic texts themselves; this part of it is asked for.
MIN_LIFT_SHARE = 0.3
# Least surprise (nats) of a feature's count among positives, given its share elsewhere.
MIN_SURPRISE = 9.0
STEM_LENGTHS = (4, 5, 6, 7, 8)
FOLDS = 5
_TOKEN = re.compile(r"\w+")
_CACHE_WORDS = 300_000


@dataclass(frozen=True)
class Model:
    """Weights by feature, the bias and the class prior the fit used."""

    weights: dict[str, float]
    bias: float
    prior: float


def word_features(word: str) -> tuple[str, ...]:
    """The word itself and its stems, marked with a trailing star."""
    return (word, *[word[:n] + "*" for n in STEM_LENGTHS if len(word) >= n])


def features(text: str) -> set[str]:
    return {f for w in set(_TOKEN.findall(text.lower())) for f in word_features(w)}


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; fold 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def nnpu_fit(
    rows: list[np.ndarray],
    positive: np.ndarray,
    n_features: int,
    prior: float,
    steps: int = 300,
    rate: float = 0.05,
    decay: float = 1e-3,
    slack: float = 0.0,
    back: float = 1.0,
) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on the non-negative risk with the logistic loss."""
    lengths = np.array([len(r) for r in rows])
    flat = np.concatenate(rows).astype(np.int64) if lengths.sum() else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), lengths)
    w, bias = np.zeros(n_features), np.log(prior / (1 - prior))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    n_p, n_u = positive.sum(), (~positive).sum()
    for step in range(1, steps + 1):
        z = bias + np.bincount(owner, weights=w[flat], minlength=len(rows))
        s = 1 / (1 + np.exp(-z))
        risk_u = np.logaddexp(0, z[~positive]).mean()
        risk_p = np.logaddexp(0, z[positive]).mean()
        # derivatives by z: the positive loss gives s - 1, the negative loss gives s
        if risk_u - prior * risk_p >= -slack:
            g = np.where(positive, prior * (s - 1) / n_p - prior * s / n_p, s / n_u)
        else:
            g = -back * np.where(positive, -prior * s / n_p, s / n_u)
        grad = np.append(
            np.bincount(flat, weights=g[owner], minlength=n_features) + decay * w, g.sum()
        )
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def _sampled(df: DataFrame, fraction: float) -> DataFrame:
    share = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) / F.lit(1_000_000.0)
    return df.where(share < fraction) if fraction < 1 else df


def _one_per_id(rows: DataFrame) -> DataFrame:
    """One text per id, the least by its hash: the sample is bounded by ids, not by their rows."""
    order = F.struct(F.xxhash64("text"), "text")
    return rows.groupBy("doc_id").agg(F.min_by("text", order).alias("text"))


def training_rows(
    docs: DataFrame, labels: DataFrame, max_positives: int, max_unlabelled: int
) -> tuple[DataFrame, float, int]:
    """(doc_id, text, positive) of the sample, the class prior, and the number of positives.

    Held-out ids take no part. The prior is the toxic share among labelled training ids.
    """
    named = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = named.agg(
        F.count(F.lit(1)).alias("all"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    ).first()
    rows = docs.where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    # The ids are as many as max_positives allows: only they move, the texts stay where they are.
    share = max_positives / max(1, n.toxic)
    wanted = stored_copy(_sampled(named.where("toxic = 1").select("doc_id"), share), "toxicity-ids")
    positives = _sampled(rows, share).join(F.broadcast(wanted), "doc_id", "left_semi")
    # The risk estimator needs unlabelled rows that hold toxic texts at the rate of the prior:
    # all training documents, their labels unseen.
    unlabelled = _sampled(rows, max_unlabelled / max(1, rows.count()))
    sample = _one_per_id(positives).withColumn("positive", F.lit(True)).unionByName(
        _one_per_id(unlabelled).withColumn("positive", F.lit(False))
    )
    return sample, (n.toxic + 0.5) / (n["all"] + 1.0), int(n.toxic)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, rows among positives, rows among the others), partial sums every so many entries."""
    seen = {True: Counter(), False: Counter()}

    def table():
        keys = list(set(seen[True]) | set(seen[False]))
        made = pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.string()),
                pa.array([seen[True][k] for k in keys], pa.int64()),
                pa.array([seen[False][k] for k in keys], pa.int64()),
            ],
            names=["feature", "p", "u"],
        )
        seen[True].clear()
        seen[False].clear()
        return made

    for batch in batches:
        texts, kinds = batch.column(0).cast(pa.binary()), batch.column(1)
        for i in range(batch.num_rows):
            seen[bool(kinds[i].as_py())].update(features(utf8(texts[i].as_py())))
            if len(seen[True]) + len(seen[False]) > 400_000:
                yield table()
    if seen[True] or seen[False]:
        yield table()


def _indexed(index: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            found = [
                sorted({index[f] for f in features(utf8(t.as_py())) if f in index}) for t in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["positive", "found"]
            )

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_positives: int = MAX_POSITIVES,
    max_unlabelled: int = MAX_UNLABELLED,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
) -> Model:
    """Train on at most about ``max_positives`` toxic and ``max_unlabelled`` other documents.

    Without a single toxic training document the model has no features and scores everything low.
    Null labels and null ids are left out; an id labelled twice is toxic if one label says so; of
    several texts of one id one is learnt from.
    """
    sample, prior, n_toxic = training_rows(
        picked(docs, doc_id=doc_id, text=text),
        picked(labels, doc_id=doc_id, toxic=toxic),
        max_positives, max_unlabelled,
    )
    if not n_toxic:
        return Model({}, -4.0, prior)
    sample = stored_copy(sample.select("text", "positive"), "toxicity-sample")
    counts = (
        sample.mapInArrow(_count_features, "feature string, p long, u long")
        .groupBy("feature")
        .agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
        .where(F.col("p") >= MIN_POSITIVES)
    )
    size = sample.groupBy("positive").count().collect()
    sizes = {r.positive: r["count"] for r in size}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return Model({}, -4.0, prior)
    expected = F.lit(float(n_p)) * (F.col("u") + 0.5) / (n_u + 1.0)
    surprise = F.col("p") * F.log(F.col("p") / F.col("expected")) - (F.col("p") - F.col("expected"))
    # The telling features: no more than the bounded sample holds.
    best = (
        counts.withColumn("expected", expected)
        .where(F.col("p") * prior >= MIN_LIFT_SHARE * F.col("expected"))
        .withColumn("surprise", surprise)
        .where(F.col("surprise") >= MIN_SURPRISE)
        .orderBy(F.desc("surprise"), "feature")
        .select("feature")
        .collect()
    )
    index = {r.feature: i for i, r in enumerate(best)}
    if not index:
        return Model({}, -4.0, prior)
    table = sample.mapInArrow(_indexed(index), "positive boolean, found array<int>").toArrow()
    rows = [np.asarray(x.as_py(), dtype=np.int64) for x in table.column("found")]
    positive = np.array(table.column("positive").to_pylist(), dtype=bool)
    w, bias = nnpu_fit(rows, positive, len(index), prior)
    return Model({f: float(w[i]) for f, i in index.items()}, bias, prior)


def _scores(texts: pa.Array, weights: dict[str, float], bias: float, known: dict) -> np.ndarray:
    """Scores of a batch of texts; ``known`` keeps the weighted features of words seen before."""
    made = np.empty(len(texts))
    for i, text in enumerate(texts):
        found: set[str] = set()
        for word in set(_TOKEN.findall(utf8(text.as_py()).lower())):
            hits = known.get(word)
            if hits is None:
                if len(known) >= _CACHE_WORDS:
                    known.clear()
                hits = known[word] = tuple(f for f in word_features(word) if f in weights)
            if hits:
                found.update(hits)
        made[i] = bias + sum(weights[f] for f in sorted(found))
    return 1 / (1 + np.exp(-np.clip(made, -500, 500)))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    A narrow map over whole texts. Null and empty texts have no features and get the bias alone;
    repeated rows are scored alike; a null id has a null ``held_out``; other columns are ignored.
    """
    weights, bias = dict(model.weights), model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            made = _scores(batch.column(1).cast(pa.binary()), weights, bias, known)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made)], names=["doc_id", "score"]
            )

    scored = picked(docs, doc_id=doc_id, text=text).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, all columns as they are, that score below one half."""
    weights, bias, place = dict(model.weights), model.bias, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            made = _scores(batch.column(place).cast(pa.binary()), weights, bias, known)
            yield batch.filter(pa.array(made < 0.5))

    return docs.mapInArrow(run, docs.schema)
