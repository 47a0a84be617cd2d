"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts per language and bucket are made in every task and summed by a shuffle;
their log-probability matrix (languages x buckets) is broadcast, and a text is
scored by summing the rows of its n-grams.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateweave.llm._common import MULTIPLIERS, Scratch, free_name, id_remainder

#: Documents of each language that training takes at most.
MAX_TRAINING_ROWS = 5_000
ORDERS = (1, 2, 3)
BUCKET_BITS = 16
#: Added to every count.
SMOOTHING = 0.1
#: N-grams handled at once, which bounds a task's memory on very long texts.
CHUNK = 200_000
UNDETERMINED = "und"
_tables = Scratch()


def _letter_table() -> np.ndarray:
    """For each code point: its lower-case letter, or a space if it is no letter."""
    if "letters" not in _tables:
        table = np.full(sys.maxunicode + 1, 32, dtype=np.uint32)
        for c in range(sys.maxunicode + 1):
            if chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _tables["letters"] = table
    return _tables["letters"]


def letters(text: str) -> np.ndarray:
    """Lower-case letters of a text, with one space around and between its runs of letters."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = _letter_table()[points]
    return low[np.concatenate([[True], (low[1:] != 32) | (low[:-1] != 32)])]


def buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text's letters, in arrays of bounded length;
    a single space is no n-gram, and a text without letters has none."""
    low = letters(text).astype(np.uint64)
    if len(low) < 3:
        return
    for n in ORDERS:
        for start in range(0, len(low) - n + 1, CHUNK):
            part = low[start : start + CHUNK + n - 1]
            h = np.full(len(part) - n + 1, n, dtype=np.uint64)
            for j in range(n):
                h = (h ^ part[j : len(part) - n + 1 + j]) * np.uint64(MULTIPLIERS[j])
                h ^= h >> np.uint64(31)
            h = (h * np.uint64(MULTIPLIERS[6])) >> np.uint64(64 - BUCKET_BITS)
            yield h[part != 32] if n == 1 else h


@dataclass
class Model:
    languages: list[str]
    priors: np.ndarray  # log, by language
    matrix: np.ndarray  # log-probabilities, bucket x language

    def predict(self, texts: Iterable[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text and its posterior; ``und`` and 0 without a letter or a model.

        N-grams of many texts are gathered, their matrix rows taken at once
        and summed by text.
        """
        texts = list(texts)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        totals, seen = np.tile(self.priors, (len(texts), 1)), np.zeros(len(texts), dtype=bool)
        owners: list[int] = []
        gathered: list[np.ndarray] = []
        size = 0

        def add() -> None:
            starts = np.cumsum([0] + [len(g) for g in gathered[:-1]])
            rows = self.matrix[np.concatenate(gathered)]
            np.add.at(totals, owners, np.add.reduceat(rows, starts, axis=0, dtype=np.float64))
            owners.clear()
            gathered.clear()

        for at, text in enumerate(texts):
            for found in buckets(text or ""):
                if len(found):
                    seen[at] = True
                    owners.append(at)
                    gathered.append(found)
                    size += len(found)
                if size >= CHUNK:
                    add()
                    size = 0
        if gathered:
            add()
        best = totals.argmax(axis=1)
        scores = 1.0 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.languages[b] if s else UNDETERMINED for b, s in zip(best, seen)], np.where(seen, scores, 0.0)


def held_out(id_col: str = "doc_id"):
    """True for documents that are never learnt from (false for a null id)."""
    return F.coalesce(id_remainder(id_col, 3) == 1, F.lit(False))


def train(
    docs: DataFrame,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = MAX_TRAINING_ROWS,
) -> Model:
    """A model from whole texts of at most ``max_rows`` documents of each language.

    Rows held out, or with a null id, text or language, are not used; rows
    equal in id, text and language count once.  Of each language the rows with
    the smallest hashes are taken: a share of them that its count tells, then,
    of those few, ``max_rows``.  Languages are listed in order, so ties go to
    the first.
    """
    usable = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = usable.where(~held_out(id_col)).select(
        F.col(lang_col).alias("lang"),
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.shiftrightunsigned(F.xxhash64(id_col, text_col), 1).alias("rank"),
        F.col(text_col).alias("text"),
    )
    share = F.lit(1.25 * max_rows * 2.0**63) / F.count("*")
    # One row for each language.
    shares = F.broadcast(rows.groupBy("lang").agg(share.alias("share")))
    near = rows.join(shares, "lang").where(F.col("rank") < F.col("share"))
    near = near.groupBy("lang", "id", "text_hash", "rank").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("rank", "id", "text_hash")
    sample = near.select("lang", "text", F.row_number().over(order).alias("n")).where(F.col("n") <= max_rows).drop("n")

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                into = counts.setdefault(lang, np.zeros(1 << BUCKET_BITS, dtype=np.int64))
                docs_of[lang] = docs_of.get(lang, 0) + 1
                for found in buckets(text):
                    into += np.bincount(found.astype(np.int64), minlength=1 << BUCKET_BITS)
        for lang, into in counts.items():
            at = np.flatnonzero(into)
            # Bucket -1 counts the language's documents.
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * (len(at) + 1), "bucket": np.append(at, -1), "n": np.append(into[at], docs_of[lang])}
            )

    counted = sample.mapInArrow(count, "lang string, bucket bigint, n bigint")
    # At most languages x buckets rows.
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    languages = sorted(set(rows["lang"]))
    matrix = np.full((1 << BUCKET_BITS, len(languages)), SMOOTHING)
    priors = np.zeros(len(languages))
    for at, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        grams = own[own["bucket"] >= 0]
        matrix[grams["bucket"].to_numpy(), at] += grams["n"].to_numpy()
        priors[at] = np.log(float(own[own["bucket"] < 0]["n"].iloc[0]))
    matrix = np.log(matrix) - np.log(matrix.sum(axis=0))
    return Model(languages, priors - np.log(np.exp(priors).sum()) if languages else priors, matrix.astype(np.float32))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the posterior), from the whole
    text alone; ``und`` and 0 for a null text or one without a letter.
    Columns with these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.priors, model.matrix))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model(*shared.value)
        for texts in batches:
            languages, scores = own.predict(texts)
            yield pd.DataFrame({"lang_pred": languages, "score": scores})

    own = free_name(docs, "found")
    found = docs.withColumn(own, predict(F.col(text_col)))
    return found.withColumns({c: F.col(f"{own}.{c}") for c in ("lang_pred", "score")}).drop(own)
