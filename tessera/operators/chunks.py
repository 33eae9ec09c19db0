"""Histories in chunks: rows (entity, chunk, at most N entries), so no row grows with the entity (ops 2, 3, 5).

A chunk row holds the entries ``chunk * per_chunk`` to ``(chunk + 1) * per_chunk - 1`` of its entity, in the order of periods and
of the entries inside a period; put one behind the other, an entity's chunks are the array of ``cumulate_step_multi``.
A period's step rewrites each entity's last chunk, if that has room, and adds new ones; full chunks are never touched, and
``unnest_history`` reads chunk rows as it reads whole histories.

Numbering a period's entries must not bring a busy entity into one task: rows are dealt by ranges of (entity, entry), counted
per entity and range, and numbered inside a range behind the entries of the ranges before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import fresh_path


def numbered(rows: DataFrame, key: str, order: Sequence[str], number: str = "_n") -> DataFrame:
    """``rows`` with their place (from 0) among the rows of their key, in ``order``; a key may hold any share of the rows."""
    spark = rows.sparkSession
    path = fresh_path(spark, "numbered")
    # written, so that a range is the same rows whoever reads it
    dealt = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), key, *order)
    dealt.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    counts = dealt.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_size"))
    so_far = Window.partitionBy(key).orderBy("_range")
    before = counts.select(F.col(key).alias("_key"), F.col("_range").alias("_of"),
                           (F.sum("_size").over(so_far) - F.col("_size")).alias("_before"))
    inside = Window.partitionBy(key, "_range").orderBy(*order)
    mine = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of"))
    placed = dealt.withColumn("_place", F.row_number().over(inside)).join(before, mine)
    return placed.withColumn(number, F.col("_before") + F.col("_place") - 1).select(*rows.columns, number)


def _chunks(entries: DataFrame, key: str, per_chunk: int, history_col: str) -> DataFrame:
    """(key, chunk, entries) of rows (key, _n, _entry)."""
    by = entries.withColumn("chunk", F.floor(F.col("_n") / per_chunk).cast("bigint"))
    held = F.sort_array(F.collect_list(F.struct("_n", "_entry")))
    return by.groupBy(key, "chunk").agg(F.transform(held, lambda e: e["_entry"]).alias(history_col))


def chunk_backfill(facts: DataFrame, key: str, period: str, entry_cols: Sequence[str], at: int, per_chunk: int = 1000,
                   history_col: str = "history") -> DataFrame:
    """(key, chunk, history, n_entries, last_period) of all rows up to period ``at``: ``chunk_step`` folded, computed directly."""
    rows = facts.where(F.col(period) <= at).select(key, F.col(period).alias("_period"), *entry_cols)
    found = numbered(rows, key, ["_period", *entry_cols])
    chunked = _chunks(found.select(key, "_n", F.struct("_period", F.struct(*entry_cols).alias("e")).alias("_entry")), key, per_chunk, "_h")
    return chunked.select(key, "chunk", F.transform("_h", lambda x: x["e"]).alias(history_col),
                          F.size("_h").cast("bigint").alias("n_entries"), F.element_at("_h", -1)["_period"].alias("last_period"))


def chunk_step(prev: DataFrame, facts: DataFrame, key: str, period: str, entry_cols: Sequence[str], at: int,
               per_chunk: int = 1000, history_col: str = "history") -> DataFrame:
    """The chunk rows that period ``at`` changes or adds: an upsert of the table by (key, chunk).

    ``prev`` is the table as of the period before (a table that holds the period already would take it twice: load
    it again from the version before). Only each entity's last chunk is read with its entries. A NULL key is an entity.
    """
    today = facts.where(F.col(period) == at).select(key, *entry_cols)
    found = numbered(today, key, list(entry_cols)).select(key, "_n", F.struct(*entry_cols).alias("_entry"))
    last = prev.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct("chunk", "n_entries")).alias("_last"))
    joined = found.join(last, F.col(key).eqNullSafe(F.col("_key")), "left")
    used = F.coalesce(F.col("_last.chunk") * per_chunk + F.col("_last.n_entries"), F.lit(0))
    new = _chunks(joined.select(key, (used + F.col("_n")).alias("_n"), "_entry"), key, per_chunk, "_new")
    room = prev.where(F.col("n_entries") < per_chunk).select(F.col(key).alias("_key"), F.col("chunk").alias("_chunk"),
                                                             F.col(history_col).alias("_old"))
    mine = F.col(key).eqNullSafe(F.col("_key")) & (F.col("chunk") == F.col("_chunk"))
    whole = F.when(F.col("_old").isNull(), F.col("_new")).otherwise(F.concat("_old", "_new"))
    return new.join(room, mine, "left").select(key, "chunk", whole.alias(history_col), F.size(whole).cast("bigint").alias("n_entries"),
                                               F.lit(at).alias("last_period"))


def whole_history(chunks: DataFrame, key: str, history_col: str = "history") -> DataFrame:
    """(key, history): the arrays that the chunks make (for entities whose history one row can hold)."""
    held = F.sort_array(F.collect_list(F.struct("chunk", F.col(history_col).alias("h"))))
    return chunks.groupBy(key).agg(F.flatten(F.transform(held, lambda x: x["h"])).alias(history_col))
