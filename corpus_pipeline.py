"""The corpus pipeline: quality, near copies, benchmark passages, personal data, pieces.

Counted as part of the ``llm`` subpackage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm import decontaminate, pii, quality, sentencepiece, simhash
from layerflow.llm.queries import PII_KEY
from layerflow.llm.training import scratch
from layerflow.sinks import stage_table
from layerflow.sources.tables import discard


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return simhash.drop_near_copies(docs, shingle=3, max_bits=2)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, items)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; ``n_chars`` follows the text."""
    changed = pii.replace_entities(docs, PII_KEY)
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their text's pieces."""
    return sentencepiece.encode(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("personal data", personal_data_stage),
    ("sentencepiece", pieces_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another; each one's rows are written and read again.

    What a stage has stored for itself is removed when its rows are written, and these are when
    the next stage's are.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            path = stage_table(made, f"layerflow-{name.replace(' ', '-')}")
        docs = spark.read.schema(made.schema).parquet(path)
        if before is not None:
            discard(spark, before)
        before = path
    return docs


# Two stages fit models and two more scan texts in Python, which SQL cannot express; the tests
# hold the stages against brute force.
ORACLE_SQL = None
