"""Quality classifier: hashed word n-gram logistic regression with FTRL updates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm import ftrl
from rateweave.llm._common import MULTIPLIERS, WORDS_AND_SIGNS, free_name, id_remainder, token_hashes

#: Labelled documents that training takes at most.
MAX_TRAINING_ROWS = 12_000
PARAMS = ftrl.FTRL(alpha=0.1, l1=0.5, l2=1.0)
SAME = np.uint64(0x5A3E)  # stands for a token that repeats the one before it


def features(text: str, bits: int = PARAMS.bits) -> np.ndarray:
    """The distinct buckets of a text's tokens (words, cased as written, and runs
    of signs: how words are decorated tells junk from prose) and token pairs;
    a token equal to the one before becomes one common token."""
    plain = token_hashes(text, WORDS_AND_SIGNS)
    words = plain.copy()
    words[1:][plain[1:] == plain[:-1]] = SAME
    pairs = (words[:-1] * np.uint64(MULTIPLIERS[0])) ^ (words[1:] * np.uint64(MULTIPLIERS[1]))
    grams = np.concatenate([words, pairs]) * np.uint64(MULTIPLIERS[2])
    return np.unique(grams >> np.uint64(64 - bits)).astype(np.int32)


def held_out(id_col: str = "doc_id"):
    """True for documents whose labels are never learnt from (false for a null id)."""
    return F.coalesce(id_remainder(id_col, 3) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> ftrl.Model:
    sample = ftrl.sampled(docs, labels, "quality", id_col, text_col, ~held_out(id_col), MAX_TRAINING_ROWS)
    return ftrl.train(sample, features, PARAMS)


def score(docs: DataFrame, model: ftrl.Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with column ``into``: the probability that the whole text is good.

    A null text counts as empty; an empty text has the model's bias only.
    Without usable labels the model is empty and every score is 0.5.
    """
    return docs.withColumn(into, ftrl.scorer(docs, model, features)(text_col))


def keep_good(docs: DataFrame, model: ftrl.Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``."""
    name = free_name(docs, "score")
    return score(docs, model, text_col, name).where(F.col(name) >= threshold).drop(name)
