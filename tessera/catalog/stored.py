"""Stored snapshots for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.session import fresh_path


def stored(spark: SparkSession, df: DataFrame, part: str) -> DataFrame:
    """``df`` written to the shared folder, partitioned by ``part``, and read back."""
    path = fresh_path(spark, "stored")
    df.write.partitionBy(part).parquet(path)
    return spark.read.parquet(path)
