"""Logistic regression over hashed features, trained with FTRL-proximal updates.

Each coordinate has its own learning rate, alpha / (beta + sqrt(sum of squared
gradients)), and weights whose accumulated gradient stays within ``l1`` are
exactly zero, so a model is a short list of (bucket, weight) pairs.

Training takes a bounded sample of the labelled rows (``max_rows``, documented
by each classifier).  Their features are made in parallel; one task then makes
the sequential updates over the sparse rows, at most ``MAX_FEATURES`` of them
(160 MB) whatever the corpus.  Of
the corpus, only the model's weights ever reach the driver (at most
``2 ** bits`` of them).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Features that training holds in memory at most; rows beyond, in order of their ids' hashes, are not learnt from.
MAX_FEATURES = 40_000_000
BIAS = -1  # the bucket under which a model's bias is listed


@dataclass(frozen=True)
class FTRL:
    alpha: float
    l1: float
    l2: float = 0.0
    beta: float = 1.0
    epochs: int = 3
    bits: int = 20


@dataclass
class Model:
    weights: np.ndarray  # dense, 2 ** bits
    bias: float

    def score(self, buckets: np.ndarray) -> float:
        """Probability of label 1: the logistic of a sparse dot product."""
        x = float(self.weights[buckets].sum(dtype=np.float64)) + self.bias
        return 1.0 / (1.0 + np.exp(-min(max(x, -500.0), 500.0)))


def fit(rows: list[tuple[np.ndarray, int]], p: FTRL) -> dict[int, float]:
    """Non-zero weights by bucket (and the bias) after ``p.epochs`` passes over ``rows``."""
    z, n, bias_z, bias_n = np.zeros(1 << p.bits), np.zeros(1 << p.bits), 0.0, 0.0

    def weights(zi, ni):
        pull = np.maximum(np.abs(zi) - p.l1, 0.0)
        return -np.sign(zi) * pull / ((p.beta + np.sqrt(ni)) / p.alpha + p.l2)

    for _ in range(p.epochs):
        for buckets, label in rows:
            zi = z[buckets]
            live = np.abs(zi) > p.l1
            own = buckets[live]  # the others weigh nothing: only their sums change
            ni = n[own]
            w = weights(zi[live], ni)
            bias = -bias_z / ((p.beta + np.sqrt(bias_n)) / p.alpha)
            g = 1.0 / (1.0 + np.exp(-min(max(w.sum() + bias, -35.0), 35.0))) - label
            z[buckets] = zi + g
            z[own] -= (np.sqrt(ni + g * g) - np.sqrt(ni)) / p.alpha * w
            n[buckets] += g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / p.alpha * bias
            bias_n += g * g
    w = weights(z, n)
    kept = np.flatnonzero(w)
    return dict(zip(kept.tolist(), w[kept].tolist())) | {BIAS: float(-bias_z / ((p.beta + np.sqrt(bias_n)) / p.alpha))}


def sampled(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, allowed: Column, max_rows: int
) -> DataFrame:
    """``(id, text, label)`` of at most ``max_rows`` labelled documents, whole texts.

    Labels other than 0 and 1 and null ids are left out; an id labelled twice
    takes the larger label; the ids with the smallest hashes are taken; an id
    that ``docs`` holds several times counts once, with its smallest text.
    """
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & allowed)
    chosen = (
        usable.groupBy(id_col)
        .agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64(id_col), id_col)
        .limit(max_rows)
        .select(F.col(id_col).alias("id"), "label")
    )
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # At most max_rows ids and labels: bounded by the parameter.
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))


def featured(sample: DataFrame, features: Callable[[str], np.ndarray]) -> DataFrame:
    """``(id, label, features)``: the sample with the buckets that ``features`` gives for ``text``."""

    @F.pandas_udf("array<int>")
    def buckets(text: pd.Series) -> pd.Series:
        return text.map(features)

    return sample.select("id", "label", buckets("text").alias("features"))


def train(sample: DataFrame, features: Callable[[str], np.ndarray], p: FTRL) -> Model:
    """A model of the sample's ``label`` from the buckets that ``features`` gives for ``text``."""
    return train_featured(featured(sample, features), p)


def train_featured(rows: DataFrame, p: FTRL) -> Model:
    """A model of ``rows(id, label, features)``."""

    def learn(batches):
        rows, held = [], 0
        for b in batches:
            lists = b.column("features")
            flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
            for end, size, label in zip(ends, lists.value_lengths().to_numpy(), b.column("label").to_numpy()):
                held += size
                if held <= MAX_FEATURES:
                    rows.append((flat[end - size : end], int(label)))
        found = fit(rows, p) if rows else {}
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(list(found), pa.int64()), "weight": list(found.values())})

    # One task over a sample of bounded size: the updates are sequential.
    ordered = rows.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id")
    found = ordered.mapInArrow(learn, "bucket bigint, weight double").toArrow()
    bucket, weight = found["bucket"].to_numpy(), found["weight"].to_numpy()
    model = Model(np.zeros(1 << p.bits, dtype=np.float32), float(weight[bucket == BIAS].sum()))
    model.weights[bucket[bucket != BIAS]] = weight[bucket != BIAS]
    return model


def _shared(df: DataFrame, model: Model) -> Callable[[], Model]:
    """What gives the model in a task, from its non-zero weights."""
    kept = np.flatnonzero(model.weights)
    shared = df.sparkSession.sparkContext.broadcast((kept, model.weights[kept], model.bias, len(model.weights)))

    def whole() -> Model:
        at, weights, bias, size = shared.value
        dense = np.zeros(size, dtype=np.float32)
        dense[at] = weights
        return Model(dense, bias)

    return whole


def scorer(docs: DataFrame, model: Model, features: Callable[[str], np.ndarray]) -> Callable[[str], Column]:
    """A function from a text column's name to its score, with the sparse model broadcast."""
    of = _shared(docs, model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        whole = of()
        for texts in batches:
            yield pd.Series([whole.score(features(t or "")) for t in texts], dtype="float64")

    return lambda text_col: score(F.coalesce(F.col(text_col), F.lit("")))


def log_loss(rows: DataFrame, model: Model) -> float:
    """The mean of what the model's scores miss on ``rows(label, features)``; 0 for no rows."""
    of = _shared(rows, model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        whole = of()
        for lists in batches:
            yield pd.Series([whole.score(np.asarray(b, dtype=np.int32)) for b in lists], dtype="float64")

    scored = rows.select("label", score("features").alias("score"))
    right = F.greatest(F.when(F.col("label") == 1, F.col("score")).otherwise(1 - F.col("score")), F.lit(1e-9))
    return scored.agg(F.mean(-F.log(right))).first()[0] or 0.0
