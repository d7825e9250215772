"""Reading tables, splitting words, and keeping one row of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotewise.operators.joins import many_to_one

#: Characters that part words: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket_of(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def let(value: Column, body) -> Column:
    """`body(value)` with `value` worked out once for each row.

    Catalyst may paste an expression wherever its name is used; a lambda variable is
    evaluated before the body.
    """
    return F.transform(F.array(value), body)[0]


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def keep_one(docs: DataFrame, winners: DataFrame) -> DataFrame:
    """The rows of `docs` named by `winners`, one for each of its rows.

    `winners` has `w_id`, `w_key` (`text_key` of the text) and `w_copies`, the number of
    rows that are equal in both; only rows that stand there more than once are compared
    with each other, the rest pass the join and no more.
    """
    keyed = docs.withColumns({"__id": F.col("doc_id"), "__key": text_key(F.col("text"))})
    named = winners.select(
        F.col("w_id").alias("__id"), F.col("w_key").alias("__key"), F.col("w_copies").alias("__copies")
    )
    kept = many_to_one(keyed, named, ["__id", "__key"])
    once = kept.filter("__copies = 1")
    again = kept.filter("__copies > 1").dropDuplicates(["__id", "__key"])
    return once.unionByName(again).select(*docs.columns)
