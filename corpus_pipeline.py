"""A corpus pipeline over ``documents``: quality, near-duplicates, leaked benchmarks, personal data, tokens.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.llm import containment_search, pii_surrogates, quality_ftrl, sentencepiece_codec, simhash_ball
from rateweave.llm._common import stored

#: The setting that holds the key of the stand-ins, and the key of runs over synthetic tables, which set none.
PII_KEY_SETTING, SYNTHETIC_KEY = "spark.rateweave.piiKey", "synthetic tables only"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, holds good."""
    model = quality_ftrl.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_ftrl.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within two bits of each other's SimHash: the one of the smallest id."""
    return simhash_ball.simhash_dedup(docs, size=simhash_ball.SHINGLE_WORDS, max_distance=simhash_ball.MAX_DISTANCE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return containment_search.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by stand-ins and its length counted anew."""
    key = spark.conf.get(PII_KEY_SETTING, SYNTHETIC_KEY)
    replaced = pii_surrogates.surrogates(docs, key.encode())
    counted = F.length("text").cast(docs.schema["n_chars"].dataType)
    return replaced.withColumn("n_chars", F.when(F.col("text").isNotNull(), counted).otherwise(F.col("n_chars")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its SentencePiece ids; ``round_trip`` tells that they decode to its text."""
    return sentencepiece_codec.encode(docs, decoded=True, keep=False).drop("decoded")


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII surrogates", pii),
    ("SentencePiece tokens", tokens),
]

#: The classifier, SimHash, stand-ins and tokens are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stored(docs, "pipeline-stage")
    return docs
