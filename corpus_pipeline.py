"""From raw documents to packed sequences, stage by stage.

Every stage takes what its predecessor kept and returns the columns of documents, in
their order, but the last, which returns the packed pieces. Where a stage changes a text,
`n_chars` follows it if the column is there. Null and repeated rows, empty tables and further columns are
handled as each operator states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotewise.llm import line_dedup, packing, pii, quality, simhash
from lotewise.session import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(changed: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        kind = changed.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.char_length("text").cast(kind))
    return changed.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that stand in an earlier document are deleted from the later ones."""
    return _counted(line_dedup.dedup(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return _counted(pii.mask_personal_data(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all documents in sequences of at most 2048."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Fingerprints, learnt classifiers and tokenisers are beyond SQL; the tests compare the
#: stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
