"""Joins with a small side.

Which side is small is left to Spark: a stored side is broadcast when its size is
under ``spark.sql.autoBroadcastJoinThreshold``, a derived one when adaptive
execution has measured it; else the join is a shuffle join that adaptive
execution can split at hot keys. Nothing is run when a query is built.

``broadcast_if_small`` is the explicit way beyond the threshold: one distributed
aggregate measures the side's bytes, and only a side within the bound gets the hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed default bound of an explicit broadcast, in measured bytes
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# what a row costs in a broadcast relation besides its values
ROW_BYTES = 64


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``, from their JSON text; one aggregate, one row to the driver."""
    row = F.octet_length(F.to_json(F.struct(*df.columns)))
    return int(df.agg(F.sum(row.cast("long") + F.lit(ROW_BYTES))).first()[0] or 0)


def broadcast_if_small(small: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``small`` with a broadcast hint if its measured bytes are within the bound (runs ``small`` once)."""
    return F.broadcast(small) if measured_bytes(small) <= max_bytes else small


def enrich(fact: DataFrame, dim: DataFrame, on: str | Sequence[str],
           cols: Sequence[str], how: str = "left") -> DataFrame:
    """Add ``cols`` of a dimension to a fact (op 34); only the key and these columns are moved.

    Pass ``broadcast_if_small(dim)`` to broadcast a dimension above Spark's threshold.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return fact.join(dim.select(*keys, *[c for c in cols if c not in keys]), keys, how)
