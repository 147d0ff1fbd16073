"""From raw documents to packed training sequences, one operator per stage.

Each function of ``STAGES`` takes (spark, docs, sf_dir) and returns a table with
the columns of ``docs``; the last returns packed pieces.  ``run`` writes each
result as Parquet to the shared folder and continues from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import credentials, decontaminate, langid, ngram_join, packing
from fleetlens.llm.common import configure, table, temporary
from fleetlens.llm.queries import RANKS, VOCABULARY
from fleetlens.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that are given a language, which becomes their ``lang``; null and letterless ones go."""
    configure(spark)
    return langid.recognized(docs, langid.fit(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    configure(spark)
    return ngram_join.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which no passage of ``benchmark`` occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, secrets in them replaced; ``n_chars`` follows the text."""
    configure(spark)
    clean = credentials.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    configure(spark)
    return packing.pack(packing.tokenize(docs, VOCABULARY, RANKS))


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark_free", benchmark_free),
    ("without_secrets", without_secrets),
    ("sequences", sequences),
]

#: SQL cannot express the language model; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        with temporary(spark):
            docs = stage(function(spark, docs, sf_dir), name)
    return docs
