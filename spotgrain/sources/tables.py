"""Readers of the driver's tables under the names of the engine's model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row is a molecule: (barcode, feature, library, umi, reads)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("barcode"),
        F.col("l_partkey").alias("feature"),
        F.col("l_suppkey").alias("library"),
        F.col("l_linenumber").alias("umi"),
        F.col("l_quantity").cast("long").alias("reads"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("feature"), F.col("p_name").alias("name"), F.col("p_brand").alias("feature_type"), F.col("p_type").alias("genome"))


def barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("barcode"), F.col("o_custkey").alias("sample"), (F.col("o_orderstatus") == "F").alias("is_cell"))
