"""Reading the project's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Table `name` of the folder; naming columns keeps the scan to them."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
