"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm import ftrl
from rateweave.llm._common import MULTIPLIERS, WORDS, id_remainder, stored, token_hashes

#: Labelled documents that training takes at most.
MAX_TRAINING_ROWS = 20_000
#: Rates, and passes over the sample; the L1 term is chosen from ``L1`` by the sample's own labels.
PARAMS = ftrl.FTRL(alpha=1.0, l1=16.0, epochs=10)
#: L1 terms, strong ones first: all leave at most some thousand weights, small enough to broadcast anywhere.
L1 = (32.0, 16.0, 8.0, 4.0)
#: One in so many of the sample's rows judges the L1 terms, which are fitted on the others.
JUDGES = 4
#: Words left out between the two words of a skip-gram (0: a plain pair).
SKIPS = (0, 1)


def features(text: str, bits: int = PARAMS.bits) -> np.ndarray:
    """The distinct buckets of a text's lower-cased words, word pairs and pairs with a word left out."""
    words = token_hashes(text.lower(), WORDS)
    grams = [words]
    for skip in SKIPS:
        left, right = words[: -skip - 1], words[skip + 1 :]
        grams.append((left * np.uint64(MULTIPLIERS[0])) ^ (right * np.uint64(MULTIPLIERS[1 + skip])))
    buckets = (np.concatenate(grams) * np.uint64(MULTIPLIERS[3])) >> np.uint64(64 - bits)
    return np.unique(buckets).astype(np.int32)


def held_out(id_col: str = "doc_id"):
    """True for documents whose labels are never learnt from (false for a null id)."""
    return F.coalesce(id_remainder(id_col, 5) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> ftrl.Model:
    """A model of the labels of documents that are not held out.

    How strong an L1 term should be depends on how many labels there are: few
    of them give a rare word little weight to lose.  It is the one of ``L1``
    that, fitted on three quarters of the sample, loses least on the fourth
    (the stronger one of equals); the model is then fitted on all of it.
    """
    sample = ftrl.sampled(docs, labels, "toxic", id_col, text_col, ~held_out(id_col), MAX_TRAINING_ROWS)
    # Read once for each term; at most MAX_TRAINING_ROWS rows and, in training, ftrl.MAX_FEATURES features.
    rows = stored(ftrl.featured(sample, features), "toxicity-features")
    judges = F.pmod(F.xxhash64(F.lit("judge"), "id"), F.lit(JUDGES)) == 0
    judging, fitting = rows.where(judges), rows.where(~judges)

    def lost(l1: float) -> float:
        return ftrl.log_loss(judging, ftrl.train_featured(fitting, replace(PARAMS, l1=l1)))

    with ThreadPoolExecutor(len(L1)) as pool:  # one sequential task for each term: side by side
        chosen = min(zip(pool.map(lost, L1), (-l1 for l1 in L1)))
    return ftrl.train_featured(rows, replace(PARAMS, l1=-chosen[1]))


def score(docs: DataFrame, model: ftrl.Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with column ``into``: the probability that the whole text is toxic.

    A null text counts as empty; an empty text has the model's bias only.
    Without usable labels the model is empty and every score is 0.5.
    """
    return docs.withColumn(into, ftrl.scorer(docs, model, features)(text_col))
