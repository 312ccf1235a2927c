"""A corpus pipeline over ``documents``: each stage works on all rows its predecessor kept.

Toxic documents go, of near duplicates the one with the smallest id stays, personal data is redacted, languages are
brought to target shares by using documents of some more than once (none less than once), and the result is packed.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestframe.llm.dart_minhash import keep_one
from nestframe.llm.packing import pack
from nestframe.llm.personal_data import redact_personal_data
from nestframe.llm.queries import LANGUAGES, language_model
from nestframe.llm.soft_mixing import mix_documents
from nestframe.llm.toxicity import drop_toxic, fit_toxicity
from nestframe.operators.durable import durable


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; empty ones stay."""
    return drop_toxic(docs, fit_toxicity(docs, _labels(spark, sf_dir)))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates; documents without words stay."""
    return keep_one(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, and ``n_chars`` counted anew."""
    clean = redact_personal_data(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once at least, and more often where its language is short of its share."""
    model = language_model(docs, docs, _labels(spark, sf_dir))
    return mix_documents(docs, model, LANGUAGES, lowest=1.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens, sources in proportion."""
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "source", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_near_duplicates),
    ("personal_data", redacted),
    ("mixing", mixed),
    ("packing", packed),
]
#: SQL can express none of the trained stages; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as Parquet and read again by the next."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        documents = durable(stage(spark, documents, sf_dir))
    return STAGES[-1][1](spark, documents, sf_dir)
