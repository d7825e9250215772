"""The gazetteer stored by key, so that look-ups never shuffle it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotewise.operators.coordinates import keyed_gazetteer

BUCKETS = 256


def store_places(gazetteer: DataFrame, table: str, path: str | None = None, buckets: int = BUCKETS) -> None:
    """Keys the gazetteer once and writes it as a catalog table, bucketed and sorted by (level, key).

    There is one row per key, so buckets are even. `path` puts the files into a folder of its own;
    statistics let Spark see how large the table is.
    """
    spark = gazetteer.sparkSession
    writer = (
        keyed_gazetteer(gazetteer)
        .repartition(buckets, "level", "key")
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "level", "key")
        .sortBy("level", "key")
    )
    (writer.option("path", path) if path else writer).saveAsTable(table)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def stored_places(spark: SparkSession, table: str) -> tuple[DataFrame, int]:
    """(level, key, lat, lon) as stored, and its number of buckets."""
    about = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    if about is None:
        raise ValueError(f"{table} is not stored by key")
    return spark.table(table).select("level", "key", "lat", "lon"), int(about["data_type"])
