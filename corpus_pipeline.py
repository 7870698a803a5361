"""From raw documents to token ids: five stages, each over all that the one before it kept.

Cases: a null or empty text has fewer words than the base rule asks for, and goes with the first
stage, as do texts of white space alone; every later stage still has a result for them. Repeated rows and exact
copies are one group of near duplicates, of which one row stays, also where ids are null or repeated. Further
columns are kept to the end. An empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.jaccard_join import one_of_each
from linkloom.llm.line_dedup import dedup_lines
from linkloom.llm.mixing import mixed_documents
from linkloom.llm.quality_rules import filter_documents
from linkloom.llm.sentencepiece_codec import encode_documents, read_model
from linkloom.llm.tables import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return filter_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later copies of runs of lines deleted; ``n_chars`` is counted anew."""
    rows = dedup_lines(docs).select("row.*")
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode_documents(docs, read_model()).withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", mixing),
    ("SentencePiece encoding", encoding),
]

# The forest, the pivots and the tokenizer are beyond SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read back.

    A stage is therefore computed once, however often the next one reads it, and a lost executor
    costs none of the stages before. The last stage is left to the caller to run.
    """
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = f"{folder}/{number}"
            docs.write.option("compression", "zstd").parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
