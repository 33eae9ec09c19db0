"""Delimited files with a header row, read with an explicit schema.

Reading CSV without a schema makes every column a string, which turns numeric
ordering lexicographic ('9' sorts above '10'); a declared schema avoids that and
also skips the inference pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load_csv(spark: SparkSession, path: str, schema: StructType | str,
             header: bool = True, sep: str = ",") -> DataFrame:
    """``spark.read.csv`` with header and a declared schema (no inference)."""
    return (spark.read
            .option("header", str(header).lower())
            .option("sep", sep)
            .option("mode", "FAILFAST")
            # a header whose names or order differ from the schema is an error
            .option("enforceSchema", "false")
            .schema(schema)
            .csv(path))


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> str:
    """Write ``df`` as headed CSV (one file per task, no coalescing to one)."""
    (df.write.mode("overwrite")
       .option("header", str(header).lower())
       .option("sep", sep)
       .csv(path))
    return path
