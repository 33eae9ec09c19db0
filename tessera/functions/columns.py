"""Column-level helpers. All return built-in Spark expressions (codegen-able)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- classify
def classify(value: str | Column, bins: Sequence[tuple[float, str]],
             else_label: str) -> Column:
    """Ordered thresholds to a label: first ``value > t`` wins, else ``else_label``.

    ``bins`` are checked in the given order (highest first for the usual
    star/good/average ladder). A NULL value falls to ``else_label``, as a
    searched CASE does.
    """
    v = col_of(value)
    expr = None
    for threshold, label in bins:
        cond = v > F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(else_label) if expr is None else expr.otherwise(F.lit(else_label))


# ---------------------------------------------------------------- arrays
def concat_arrays(*arrays: str | Column) -> Column:
    """Array concatenation where a NULL operand counts as empty.

    Spark's ``concat`` returns NULL when any input is NULL; the SQL the
    pipelines mirror treats ``arr || NULL`` as ``arr``.
    """
    parts = [F.coalesce(col_of(a), F.array()) for a in arrays]
    return F.concat(*parts)


def first_elem(arr: str | Column) -> Column:
    """1st element or NULL for empty/NULL arrays (no ANSI error)."""
    return F.try_element_at(col_of(arr), F.lit(1))


def last_elem(arr: str | Column) -> Column:
    """Last element or NULL for empty/NULL arrays (no ANSI error)."""
    return F.try_element_at(col_of(arr), F.lit(-1))


def join_values(arr: str | Column, sep: str = ",") -> Column:
    """Array of scalars to one text value (for flat exports and checks)."""
    return F.array_join(F.transform(col_of(arr), lambda x: x.cast("string")), sep)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` with a zero denominator replaced by 1 (as the reports do)."""
    d = col_of(den)
    return col_of(num).cast("double") / F.when(d == 0, F.lit(1.0)).otherwise(d.cast("double"))


# ---------------------------------------------------------------- JSON
def json_object(fields: dict[str, str | Column]) -> Column:
    """JSON object text from named fields, NULL members kept (``"k":null``)."""
    s = F.struct(*[col_of(v).alias(k) for k, v in fields.items()])
    return F.to_json(s, {"ignoreNullFields": "false"})


def json_get(js: str | Column, key: str, cast: str | None = None) -> Column:
    """``js ->> key`` with an optional (ANSI-safe) cast."""
    v = F.get_json_object(col_of(js), f"$.{key}")
    return v.try_cast(cast) if cast else v


# ---------------------------------------------------------------- bits
def bits_text(mask: str | Column, width: int = 32) -> Column:
    """Fixed-width binary text of the low ``width`` bits, most significant first."""
    m = col_of(mask).bitwiseAND(F.lit((1 << width) - 1))
    return F.lpad(F.bin(m), width, "0")


def bit_at(position: str | Column) -> Column:
    """``1L << position`` for a column position (``shiftleft`` on bigint)."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), col_of(position))


def bit_count(mask: str | Column) -> Column:
    return F.bit_count(col_of(mask)).cast("bigint")


def any_bits(mask: str | Column, pattern: int) -> Column:
    """True when ``mask`` shares a set bit with ``pattern``."""
    return col_of(mask).bitwiseAND(F.lit(pattern)) != 0
