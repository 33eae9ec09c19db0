"""Operator 7: sharding by a Feistel permutation with cycle walking. DataFrame operations only.

Rows get global numbers 0 .. n-1: they are dealt to buckets by a hash, numbered within each, and a bucket's
offset is the rows of the buckets before it; rows equal in id, size and checksum are counted first and travel as
one, so no task sees more than its buckets, however many copies there are. The number x is
then permuted: as a pair (x div b, x mod b) with a * b >= n it goes through Feistel rounds that
add a keyed hash of one half to the other (modulo a or b), a bijection of 0 .. a*b - 1; a result of n or
more is permuted again until it is below n (cycle walking), a bijection of 0 .. n-1. The place y is
row y div k of shard y mod k: shard counts are at most one apart (law ``rows``), slots have no gaps, and shard and
slot of a row follow from its number, n, k and the seed alone.

Defined results: a null text counts no bytes; equal rows get different places; the numbering depends on the rows
alone, not on their files or order, but for rows equal in id, size and checksum, which are interchangeable; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import once

BUCKET_ROWS = 100_000
ROUNDS = 6
OFFSET_ROWS = 1_000_000          # bucket offsets (16 bytes each) are broadcast up to so many


def number_rows(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with their number, and how many there are.

    Equal rows are counted, not moved: a group of them takes the numbers from its first one on, so any number of
    copies is one row until it is written out, in chunks of ``BUCKET_ROWS``.
    """
    order = rows.columns
    n = rows.count()
    count = max(1, -(-n // BUCKET_ROWS))
    groups = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("same")).withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(count)))
    sizes = groups.groupBy("bucket").agg(F.sum("same").alias("count"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    up_to = F.sum("same").over(Window.partitionBy("bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    placed = groups.withColumn("up_to", up_to).join(F.broadcast(offsets) if count <= OFFSET_ROWS else offsets, "bucket")
    placed = placed.select(*order, "same", (F.col("offset") + F.col("up_to") - F.col("same")).alias("first"))
    few = placed.where(F.col("same") <= BUCKET_ROWS).select(*order, F.explode(_run(F.col("first"), F.col("same"))).alias("number"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("same") - 1, F.lit(BUCKET_ROWS)))).alias("chunk")
    many = placed.where(F.col("same") > BUCKET_ROWS).select(*order, "first", "same", chunk).repartition("first", "chunk")
    begin = F.col("chunk") * BUCKET_ROWS
    many = many.select(*order, F.explode(_run(F.col("first") + begin, F.least(F.col("same") - begin, F.lit(BUCKET_ROWS)))).alias("number"))
    return few.unionByName(many), n


def _run(first: Column, count: Column) -> Column:
    return F.sequence(first, first + count - 1)


def permuted(number: Column, n: int, seed: int) -> Column:
    """The place of ``number`` in a pseudo-random permutation of 0 .. n-1."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    halves, rounds = F.lit(b).cast("long"), F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def turn(s: Column, r: Column) -> Column:
        high, low = s["high"], s["low"]
        even = r % 2 == 0
        return F.struct(
            F.when(even, F.pmod(high + F.pmod(F.xxhash64(low, r, F.lit(seed)), F.lit(a)), F.lit(a))).otherwise(high).cast("long").alias("high"),
            F.when(even, low).otherwise(F.pmod(low + F.pmod(F.xxhash64(high, r, F.lit(seed)), F.lit(b)), F.lit(b))).cast("long").alias("low"))

    def once_through(x: Column) -> Column:
        low = F.pmod(x, halves)
        start = F.struct(F.call_function("div", x, halves).alias("high"), low.cast("long").alias("low"))
        return F.aggregate(rounds, start, turn, lambda s: s["high"] * halves + s["low"])

    # fewer than sqrt(n) + 1 of the a * b places lie at n or above: a walk as long as their count always
    # ends, and above that count one of 64 steps fails with a chance under n ** -32
    walk = F.sequence(F.lit(1), F.lit(max(1, min(a * b - n + 1, 64))))
    place = F.aggregate(walk, once_through(number), lambda x, _: F.when(x < n, x).otherwise(once_through(x)))
    return F.when(place < n, place).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def feistel_shards(docs: DataFrame, shards: int = 8, seed: int = 20240501, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, number, place, shard, slot) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = once(docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                            F.crc32(text.cast("binary")).cast("long").alias("text_crc32")))
    numbered, n = number_rows(rows)
    placed = numbered.withColumn("place", permuted(F.col("number"), n, seed))
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", "number", "place",
                         (F.col("place") % shards).cast("int").alias("shard"),
                         F.expr(f"place div {shards}").alias("slot"))
