"""The shortest whole run: printed samples to typed, gated, keyed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotewise.functions.numbers import unit_value
from lotewise.operators.load import Check, staged_gate, upsert
from lotewise.operators.normalise import normalise
from lotewise.session import shared_dir

SAMPLE_KEY = ["codigo_laudo", "numero_amostra"]


def printed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem and part as a report prints its comparables: all text."""
    part = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_type", "p_size")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    money = F.format_number(F.col("l_extendedprice").cast("decimal(18,2)"), 2)
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("string").alias("codigo_laudo"),
        F.col("l_linenumber").alias("numero_amostra"),
        F.date_format(F.to_date("l_shipdate"), "dd/MM/yyyy").alias("data"),
        F.concat(F.lit("R$ "), F.translate(money, ",.", ".,")).alias("valor"),
        F.col("l_quantity").cast("decimal(12,3)").cast("string").alias("area_privativa"),
        F.concat(F.col("p_size").cast("string"), F.lit(",00 m²")).alias("area_terreno"),
        F.col("p_type").alias("tipo"),
    )


def load_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Read (C1, C2), value per m² (C7), gate (D2), upsert."""
    typed, _ = normalise(
        printed_lines(spark, folder),
        {"data": "date", "valor": "money", "area_privativa": "area", "area_terreno": "area"},
    )
    is_lot = F.col("tipo") == "ECONOMY"
    valued = typed.withColumn(
        "valor_m2", unit_value(F.lit(None), "valor", "area_privativa", "area_terreno", is_lot)
    )
    batch, _ = staged_gate(
        valued,
        [
            Check("no value", F.col("valor").isNull(), 0.01),
            Check("no date", F.col("data").isNull(), 0.01),
            Check("no private area", F.col("area_privativa").isNull(), 0.05),
        ],
        shared_dir(spark, "first-load"),
    )
    return upsert(batch.limit(0), batch, SAMPLE_KEY, ["data"])
