"""A corpus pipeline of the operators in ``ledgerlens.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm.exact_dedup import drop_copies
from ledgerlens.llm.jaccard_join import drop_near_copies
from ledgerlens.llm.mixing import mixed_documents
from ledgerlens.llm.packing import pack_documents
from ledgerlens.llm.queries import tokenizer_path
from ledgerlens.llm.storage import new_path, ship_package
from ledgerlens.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go (operator 5)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, labels)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays (operator 10)."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays (operator 9)."""
    return drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated until the sources have their weights (operator 2)."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the training sequences (operator 1)."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("ngram_jaccard_join", near), ("mixing", mixture),
          ("best_fit_packing", packed)]
#: The first stage learns its model, the mix draws by hash and packing needs a tokenizer: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written and read again."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
