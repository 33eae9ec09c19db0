"""Streaming over sorted partitions, and connected components by star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import once


def sorted_groups(batches, n_keys: int) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by its first ``n_keys`` (long) columns, one at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        begin = 0
        for end in [*cuts.tolist(), len(keys)]:
            key = tuple(keys[begin])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(begin, end - begin))
            last, begin = key, end
    if held:
        yield pa.Table.from_batches(held)


def partition_labels(spark: SparkSession, parts: int) -> np.ndarray:
    """One long per partition of ``repartition(parts, column)`` that hashes into it, so that buckets named
    after them are dealt one to a task. At most ``parts`` values reach the driver."""
    spread = spark.range(30 * parts).select("id", F.pmod(F.hash("id"), F.lit(parts)).alias("part"))
    return np.array(sorted(r[0] for r in spread.groupBy("part").agg(F.min("id")).select("min(id)").collect()), np.int64)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.join(low, "a").where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(low, "a")
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(a, b): every vertex of ``edges`` (a, b) that isn't the least of its component, with the least.

    Alternating large-star and small-star steps: each vertex is hung under the least
    neighbour it knows until nothing changes. A step is one min per vertex (combined before the
    shuffle) and one join that Spark can split at a hot vertex; rounds grow with the logarithm of
    the vertices.
    """
    now = once(_small_star(edges.where("a <> b")))
    mark = _fingerprint(now)
    while True:
        now = once(_small_star(_large_star(now)))
        new = _fingerprint(now)
        if new == mark:
            return now
        mark = new


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix: the least index of each row's component."""
    n = len(linked)
    root = np.arange(n)
    linked = linked | np.eye(n, dtype=bool)
    while True:
        low = np.where(linked, root[None, :], n).min(1)
        low = low[low]
        if (low == root).all():
            return root
        root = low
