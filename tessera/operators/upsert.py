"""Key-based upsert (INSERT ... ON CONFLICT DO UPDATE) without MERGE.

Parquet tables have no MERGE; the DataFrame form is an anti join on the key plus
a union. Written out with dynamic partition overwrite, only the partitions that
the updates touch are replaced, so a daily load rewrites one day
(``plans.versions`` publishes such a load atomically).

NULLs are values here: a NULL key meets a NULL key, and the NULL partition is a
partition like any other, so a load can be run again. The updates must hold a key
once: a repeated key fails the job before anything is committed, as does an update
outside the named partitions; both tests are part of the plan, so the updates are
evaluated no extra time for them. ``resolve`` gives an order instead, by which the first
row of a key wins.

A load usually knows which partitions it writes (the day it loads): pass them as
``partitions`` and the existing rows are selected by a static partition filter
(pruned at planning time, no extra job). Without it, the touched values are
derived from ``updates``, which evaluates them once more.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# how the errors that a plan raises begin
REFUSED = "[upsert refused]"


def named(partition_col: str, partitions: Sequence) -> Column:
    """Rows of the named partitions; ``None`` names the NULL partition."""
    c = F.col(partition_col)
    values = [v for v in partitions if v is not None]
    listed = F.coalesce(c.isin(values), F.lit(False)) if values else F.lit(False)
    return listed | c.isNull() if None in partitions else listed & c.isNotNull()


def _guard(df: DataFrame, fault: Column, message: Column) -> DataFrame:
    """``df``; the job fails with ``message`` at a row with ``fault``."""
    return df.where(F.when(fault, F.raise_error(F.concat(F.lit(f"{REFUSED} "), message))).otherwise(F.lit(True)))


def one_per_key(updates: DataFrame, keys: Sequence[str], resolve: Sequence[str | Column] | None = None) -> DataFrame:
    """``updates`` with one row per key: a repeated key is an error in the plan, or with ``resolve`` its first row stays."""
    same = Window.partitionBy(*keys)
    if resolve:
        return updates.withColumn("_turn", F.row_number().over(same.orderBy(*resolve))).where("_turn = 1").drop("_turn")
    counted = updates.withColumn("_same", F.count(F.lit(1)).over(same))
    shown = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    return _guard(counted, F.col("_same") > 1, F.concat(F.lit("the updates repeat the key "), shown)).drop("_same")


def covered(updates: DataFrame, partition_col: str, partitions: Sequence) -> DataFrame:
    """``updates``; a row outside the named partitions is an error in the plan."""
    text = F.lit(f"updates hold values of {partition_col} outside {list(partitions)}: ")
    return _guard(updates, ~named(partition_col, partitions), F.concat(text, F.coalesce(F.col(partition_col).cast("string"), F.lit("NULL"))))


def _without(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key (NULLs are equal) isn't in ``updates``."""
    other = updates.select(*(F.col(k).alias(f"_u_{k}") for k in keys))
    return target.join(other, reduce(and_, (F.col(k).eqNullSafe(F.col(f"_u_{k}")) for k in keys)), "left_anti")


def _split(target: DataFrame, updates: DataFrame, partition_col: str,
           partitions: Sequence | None) -> tuple[DataFrame, DataFrame]:
    """(rows of touched partitions, rows of untouched partitions) of ``target``."""
    c = F.col(partition_col)
    if partitions is not None:
        cond = named(partition_col, partitions)
        return target.where(cond), target.where(~cond)
    # values by equality, so that the scan is pruned at runtime; the NULL partition by a single row
    touched = updates.where(c.isNotNull()).select(partition_col).distinct()
    null = F.broadcast(updates.where(c.isNull()).select(F.lit(0).alias("_null")).limit(1))
    real, rest = target.where(c.isNotNull()), target.where(c.isNull()).withColumn("_null", F.lit(0))
    return tuple(real.join(touched, partition_col, how).unionByName(rest.join(null, "_null", how).drop("_null"))
                 for how in ("left_semi", "left_anti"))


def merged_partitions(existing: DataFrame, updates: DataFrame, keys: Sequence[str], partition_col: str,
                      partitions: Sequence | None = None, resolve: Sequence[str | Column] | None = None) -> DataFrame:
    """The new rows of the partitions that the updates touch (all that a load has to write)."""
    if partitions is not None:
        updates = covered(updates, partition_col, partitions)
    cur, _ = _split(existing, updates, partition_col, partitions)
    return (_without(cur, updates, keys).select(*existing.columns)
            .unionByName(one_per_key(updates, keys, resolve).select(*existing.columns)))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           partition_col: str | None = None,
           partitions: Sequence | None = None,
           resolve: Sequence[str | Column] | None = None) -> DataFrame:
    """Rows of ``target`` whose key is not in ``updates``, plus all ``updates``.

    With ``partition_col`` (a column that is part of ``keys``), target rows in
    partitions the updates do not touch pass through without joining: only the
    touched partitions are shuffled against the updates. ``partitions`` names
    the touched values when the caller knows them; an update outside them is an
    error when the result is computed, like a key that ``updates`` repeat (without ``resolve``).
    """
    keys = list(keys)
    if partition_col is None:
        kept = _without(target, updates, keys)
        return kept.select(*target.columns).unionByName(one_per_key(updates, keys, resolve).select(*target.columns))
    if partition_col not in keys:
        raise ValueError("partition_col must be one of the keys")
    _, miss = _split(target, updates, partition_col, partitions)
    return miss.select(*target.columns).unionByName(
        merged_partitions(target, updates, keys, partition_col, partitions, resolve).select(*target.columns))


def refusal(error: PySparkException) -> str | None:
    """What an upsert's plan objected to, if that is why a job failed."""
    text = str(error)
    return text[text.index(REFUSED) + len(REFUSED):].split("\n")[0].strip() if REFUSED in text else None


def write_upsert(updates: DataFrame, path: str, partition_col: str, keys: Sequence[str],
                 existing: DataFrame | None = None,
                 partitions: Sequence | None = None,
                 resolve: Sequence[str | Column] | None = None) -> None:
    """Persist an upsert into a ``partitionBy(partition_col)`` parquet table.

    The touched partitions are rebuilt (existing rows of those partitions minus
    updated keys, plus the updates) and written with dynamic partition
    overwrite; other partitions are not read or rewritten. ``existing`` defaults
    to the table at ``path`` (empty when there is none yet). With ``partitions``
    the read of ``existing`` is pruned statically; an update outside them is a
    ``ValueError``, like a repeated key: the job fails before it commits, and the table stays
    as it is. Without ``partitions``, the read is pruned by Dynamic Partition Pruning from
    the touched values.
    """
    if existing is None:
        existing = _table_at(updates, path)
    merged = merged_partitions(existing, updates, list(keys), partition_col, partitions, resolve)
    try:
        # no shuffle on the partition column: one day would land in one task;
        # sorting within tasks keeps one open file per task and partition
        (merged.sortWithinPartitions(partition_col)
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(partition_col).parquet(path))
    except PySparkException as e:
        if refusal(e):
            raise ValueError(refusal(e)) from e
        raise


def _table_at(updates: DataFrame, path: str) -> DataFrame:
    """The stored table, or no rows of the same columns when nothing is stored yet."""
    try:
        return updates.sparkSession.read.schema(updates.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return updates.limit(0)
