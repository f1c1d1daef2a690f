"""A corpus pipeline: documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet below the shared folder and gives it to the next stage.  All stages
but the last return the columns of ``documents``.

* language_id: rows without text in a known language go (operator 7);
* exact_dedup: of rows with equal text the one with the largest id stays (operator 10);
* jaccard_join: of rows linked by five-word shingles at 0.8, the one with the smallest
  id stays (operator 9);
* decontaminate: rows of which a twentieth or more is benchmark text go (operator 2);
* sentencepiece: token ids of the rest (operator 5).

Nulls, empty tables and repeated rows: as each operator defines.  Rows with a null or
empty text go in the first stage, as they have no language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewash.llm import decontaminate, exact_dedup, jaccard_join, language_id, sentencepiece_codec
from tidewash.llm.common import doc_key, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(table(spark, sf_dir, "documents"), "text", "lang")
    none = F.lit(None).cast("string")
    found = language_id.identify(
        docs, model, F.col("doc_id"), doc_key("doc_id", "text"), F.col("text"), declared=F.col("lang"),
        host=F.col("source"), domain=none, suffix=none, path=none)
    gone = written(found.where("not accepted").select("key").distinct(), "language-rejected")
    rows = docs.select(F.struct("*").alias("doc"), doc_key("doc_id", "text").alias("key"))
    return rows.join(gone, "key", "left_anti").select("doc.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs, "doc_id", "text", keep="largest")


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_similar(docs, "doc_id", "text", shingle=5, num=4, den=5)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(docs, "doc_id", "text").withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", jaccard_stage),
    ("decontaminate", decontaminate_stage),
    ("sentencepiece", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Language likelihoods and subword merges are not SQL; tests compare with brute force.
ORACLE_SQL = None
