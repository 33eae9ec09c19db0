"""Column-level helpers built from ``pyspark.sql.functions``."""

from tessera.functions.columns import (
    any_bits, bit_at, bit_count, bits_text, classify, col_of, concat_arrays, first_elem,
    join_values, json_get, json_object, last_elem, safe_ratio,
)

__all__ = [
    "any_bits", "bit_at", "bit_count", "bits_text", "classify", "col_of", "concat_arrays",
    "first_elem", "join_values", "json_get", "json_object", "last_elem", "safe_ratio",
]
