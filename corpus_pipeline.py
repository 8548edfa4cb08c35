"""From documents to training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm import langid, ngram_join, packing, quality, surrogates
from ladle.llm.queries import ship
from ladle.llm.tables import landed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counted rules or the model reject go."""
    ship(spark.sparkContext)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that can be told go."""
    ship(spark.sparkContext)
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    ship(spark.sparkContext)
    return ngram_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets get surrogates; the number of characters follows the text."""
    replaced = surrogates.replace_entities(docs, surrogates.session_key(spark))
    return replaced.withColumn("n_chars", F.length("text").cast("long"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    ship(spark.sparkContext)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("surrogates", personal_data),
    ("best-fit packing", sequences),
]

# Two stages are trained models, which SQL does not express; tests hold the pipeline against its parts instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what one returns is written as a table and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = landed(docs, f"stage-{number}")
    return docs
