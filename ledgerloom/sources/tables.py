"""Parquet tables of a folder, and the text feeds that registries publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.shipping import ship_package


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
