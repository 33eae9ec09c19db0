"""Keys: duplicate detection, deduplication and constraint checks.

All three are single-shuffle aggregations on the key, with map-side partial
aggregation, so a hot key is collapsed on every mapper before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (``HAVING count > 1``)."""
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
          row_num_col: str = "row_num") -> DataFrame:
    """Keep the first row per key under ``order`` and all columns plus ``row_num``.

    ``order`` must end in a unique tie-break (an unordered ``row_number`` keeps
    an arbitrary row). Catalyst turns ``row_number() = 1`` into a
    WindowGroupLimit that also runs *before* the shuffle, so each mapper sends
    at most one row per key: a key holding a third of the data costs one row
    per map task on the wire.
    """
    if not order:
        raise ValueError("dedup needs an ordering ending in a unique tie-break")
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return (df.withColumn(row_num_col, F.row_number().over(w))
              .where(F.col(row_num_col) == 1))


def check_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-row report of primary-key health: rows, NULL-key rows, duplicate keys.

    Spark does not enforce PRIMARY KEY; this is the check a pipeline runs
    before publishing a table.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    per_key = (df.groupBy(*keys)
                 .agg(F.count(F.lit(1)).alias("_n"))
                 .withColumn("_null", any_null))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), F.lit(0))
         .cast("bigint").alias("n_null_key_rows"),
        F.count_if(F.col("_n") > 1).cast("bigint").alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0))
         .cast("bigint").alias("n_excess_rows"))


def check_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values of ``column`` outside ``allowed`` (enum membership), with counts.

    NULL is allowed (an enum column without NOT NULL holds NULL).
    """
    bad = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))
    return (bad.groupBy(F.col(column).alias("value"))
               .agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(column).alias("column"), "value", "n_rows"))
