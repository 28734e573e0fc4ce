"""The training-corpus pipeline: stages over `documents`, each written and read again.

Toxic documents go, one document of each group of near copies stays,
contaminated documents go, secrets are replaced inside texts, and what is left
is packed into sequences of token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbarn.llm.common import document_key, table, written
from signalbarn.llm.decontaminate import find_contamination
from signalbarn.llm.packing import pack_documents
from signalbarn.llm.queries import tokenizer_path
from signalbarn.llm.secrets import fit_markov, redacted, with_spans
from signalbarn.llm.simhash import keep_first, simhash_groups
from signalbarn.llm.toxicity import THRESHOLD, fit_toxicity, toxicity_scores


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    bad = toxicity_scores(docs, model).where(F.col("score") >= THRESHOLD)
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_hash")).distinct()
    key = document_key()
    return docs.join(bad, key["id"].eqNullSafe(F.col("bad_id")) & (key["hash"] == F.col("bad_hash")), "left_anti")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return keep_first(docs, simhash_groups(docs, shingle=3, bits=2))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    bad = find_contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    bad = bad.select(F.col("key.id").alias("bad_id"), F.col("key.hash").alias("bad_hash"))
    key = document_key()
    return docs.join(bad, key["id"].eqNullSafe(F.col("bad_id")) & (key["hash"] == F.col("bad_hash")), "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced and n_chars is counted anew."""
    found = with_spans(docs, fit_markov(docs), prefix="secrets_")
    clean = found.withColumn("text", redacted(F.col("text"), F.col("secrets_spans")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and places in sequences."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("simhash", near_copies),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]
#: Scores, trees and token ids cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each one's rows are written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
