"""From raw documents to packed training sequences.

Documents in no known language go, then those of low quality; boilerplate lines are dropped from what is left,
one document of each group of near-duplicates stays, and the rest is tokenised and packed. Every
stage reads what the one before it wrote to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pixsieve.llm import langid, lines, ngram_join, packing, quality
from pixsieve.llm.queries import vocabulary
from pixsieve.session import write_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.in_a_language(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.of_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_boilerplate(docs, "source")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_class(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language ID", language),
    ("quality classifier", good_quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("best-fit packing", packed),
]
#: Two stages are trained models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
