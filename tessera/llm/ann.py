"""Operator 5: approximate nearest neighbours by cross-polytope hashing.

A table turns unit vectors by a pseudo-random rotation (three rounds of random signs and a fast Hadamard
transform, zero-padded to a power of two) and hashes each to its nearest signed axis. Every row is indexed in
all tables; a query looks into the buckets of its nearest ``probes`` axes of each (multiprobe). Distances in the
buckets are exact, in double precision on the original vectors; a bucket hands on a query's best ``k``
only. With ``hashes`` rotations per table a bucket is a tuple of axes. Their number follows from the counted
rows: the least one with at most ``BUCKET`` rows in a mean bucket; a table of several rotations finds a near row less often,
so the number of tables grows by the law of independent tables, for the same recall.

Rows with equal vectors differ in their id only, so the k + 1 least ids of each vector are indexed; no
other could be among k nearest. A bucket of more than ``SPLIT`` rows is dealt to several tasks, each with the
bucket's queries. A query that found fewer than k rows is compared with all rows of its length, in blocks.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
with a null id; vectors of different length are never near; rows that share an id are one
candidate, at its least distance; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import mix, once, shuffle_parts
from tessera.llm.groups import sorted_groups

SPLIT = 20_000
BUCKET = 20_000
RECALL = 0.95                    # what ``tables`` of one rotation are taken to reach


def plan_tables(n: int, axes: int, tables: int, probes: int) -> tuple[int, int, int]:
    """(hashes, tables, probes) for n rows whose rotations have so many signed axes."""
    hashes = 1
    while n / axes ** hashes > BUCKET:
        hashes += 1
    found = 1 - (1 - RECALL) ** (1 / tables)         # by one table of one rotation
    return hashes, tables if hashes == 1 else math.ceil(math.log(1 - RECALL) / math.log(1 - found ** hashes)), probes ** hashes


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (length a power of two), orthonormal."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


@lru_cache(maxsize=4096)
def _signs(table: int, part: int, d: int) -> np.ndarray:
    return np.random.default_rng([table, part, d]).choice([-1.0, 1.0], (3, d))


def rotate(x: np.ndarray, table: int, part: int) -> np.ndarray:
    d = 1 << max(1, (x.shape[1] - 1).bit_length())
    if d > x.shape[1]:
        x = np.concatenate([x, np.zeros((len(x), d - x.shape[1]))], 1)
    for s in _signs(table, part, d):
        x = hadamard(x * s)
    return x


def buckets(x: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """The ``probes`` best buckets of each unit vector in a table, best first: (rows, probes)."""
    axes, sizes = [], []
    wide = min(probes, 2 * (1 << max(1, (x.shape[1] - 1).bit_length())))
    for part in range(hashes):
        y = rotate(x, table, part)
        both = np.concatenate([y, -y], 1)
        top = np.argsort(-both, axis=1, kind="stable")[:, :wide]
        axes.append(top)
        sizes.append(np.take_along_axis(both, top, 1))
    combos = np.array(list(product(range(wide), repeat=hashes)))
    score = sum(sizes[p][:, combos[:, p]] for p in range(hashes))
    best = np.argsort(-score, axis=1, kind="stable")[:, :probes]
    key = np.full((len(x), best.shape[1]), np.uint64(table * 1_000_003 + x.shape[1]))
    for p in range(hashes):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.take_along_axis(axes[p], combos[best, p], 1).astype(np.uint64) + np.uint64(1))
    return key.view(np.int64)


def _matrix(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) per vector length of a list column."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    length = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(length)])
    return [(at, flat[start[at][:, None] + np.arange(d)[None]]) for d in np.unique(length)
            for at in [np.flatnonzero(length == d)]]


def _hash_batches(batches, tables: int, hashes: int, probes: int):
    for b in batches:
        for at, x in _matrix(b.column(1)):
            # the largest component becomes 1 first, so that squares neither overflow nor vanish
            x = x / np.abs(x).max(1, keepdims=True)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            for k in range(0, len(at), 2048):
                some = at[k:k + 2048]
                keys = np.concatenate([buckets(x[k:k + 2048], t, hashes, probes) for t in range(tables)], 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(some)), b.column(1).take(pa.array(some)),
                     pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * keys.shape[1], pa.array(keys.reshape(-1)))],
                    ["id", "vector", "keys"])


def _nearest_batches(batches, k: int):
    """Of each (bucket, part): every query's k nearest rows."""
    for t in sorted_groups(batches, 2):
        is_query = t.column("is_query").to_numpy()
        if not is_query.any() or is_query.all():
            continue
        ids = t.column("id").to_numpy()
        vectors = t.column("vector").combine_chunks()
        groups = {x.shape[1]: (at, x) for at, x in _matrix(vectors)}
        for at, x in groups.values():
            q, c = at[is_query[at] == 1], at[is_query[at] == 0]
            qx, cx, cid = x[is_query[at] == 1], x[is_query[at] == 0], ids[c]
            if not len(q) or not len(c):
                continue
            out_q, out_c, out_s = [], [], []
            order = np.argsort(cid, kind="stable")
            cx, cid = cx[order], cid[order]
            for i in range(len(q)):
                d = np.sqrt(((cx - qx[i]) ** 2).sum(1))
                d[cid == ids[q[i]]] = np.inf
                kth = np.partition(d, k - 1)[k - 1] if len(d) > k else np.inf
                near = np.flatnonzero((d <= kth) & np.isfinite(d))
                near = near[np.argsort(d[near], kind="stable")][:k]
                out_q.append(np.full(len(near), ids[q[i]]))
                out_c.append(cid[near])
                out_s.append(d[near])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_c)),
                                              pa.array(np.concatenate(out_s))], ["query_id", "id", "score"])


def _nearest(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Best k per query and bucket of rows (bucket, part, id, vector) and queries (same columns)."""
    both = rows.withColumn("is_query", F.lit(0).cast("long")).unionByName(queries.withColumn("is_query", F.lit(1).cast("long")))
    both = (both.select("bucket", "part", "is_query", "id", "vector")
            .repartition(shuffle_parts(rows), "bucket", "part").sortWithinPartitions("bucket", "part"))
    return both.mapInArrow(lambda it: _nearest_batches(it, k), "query_id long, id long, score double")


def nearest_neighbours(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
                       tables: int = 20, probes: int = 3, hashes: int | None = None) -> DataFrame:
    """(query_id, rank, id, score): each query's k nearest other rows found; ``is_query`` is a condition on ``vectors``.

    Without ``hashes`` the rows are counted, and the three numbers become those of ``plan_tables``.
    """
    flat = F.col("vector")
    usable = (flat.isNotNull() & F.col("id").isNotNull() & F.exists(flat, lambda v: v != 0)
              & F.forall(flat, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    # floats travel as floats; whatever they are, they are widened where they are computed with
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("vector"),
                          F.coalesce(is_query, F.lit(False)).alias("asks")).where(F.coalesce(usable, F.lit(False)))
    rows = once(rows)
    same = Window.partitionBy("vector").orderBy("id")
    index = rows.select("id", "vector").distinct().withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).select("id", "vector")
    queries = rows.where("asks").select("id", "vector").distinct()
    if hashes is None:
        n, length = rows.agg(F.count(F.lit(1)), F.min(F.size("vector"))).first()
        hashes, tables, probes = plan_tables(n, 2 << max(1, ((length or 1) - 1).bit_length()), tables, probes)
    schema = f"id long, vector {kind}, keys array<long>"
    indexed = index.mapInArrow(lambda it: _hash_batches(it, tables, hashes, 1), schema) \
        .select("id", "vector", F.explode("keys").alias("bucket"))
    asked = queries.mapInArrow(lambda it: _hash_batches(it, tables, hashes, probes), schema) \
        .select("id", "vector", F.explode("keys").alias("bucket"))
    # buckets too large for one task: their rows go to several, their queries to all of these
    large = once(indexed.groupBy("bucket").count().where(F.col("count") > SPLIT)
                 .select("bucket", F.ceil(F.col("count") / SPLIT).cast("long").alias("parts")))
    if not large.isEmpty():
        indexed, asked = indexed.join(large, "bucket", "left"), asked.join(large, "bucket", "left")
    else:
        indexed, asked = (x.withColumn("parts", F.lit(None).cast("long")) for x in (indexed, asked))
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    found = _nearest(indexed.withColumn("part", F.pmod(F.xxhash64("id"), parts)).drop("parts"),
                     asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts"), k)
    found = once(_best(found, k))
    # queries with too few found: against all rows, in blocks
    enough = found.groupBy("query_id").count().where(F.col("count") >= k)
    short = once(queries.join(enough, queries.id == enough.query_id, "left_anti").select("id", "vector"))
    if not short.isEmpty():
        blocks = max(1, -(-index.count() // SPLIT))
        block = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
        length = F.size("vector").cast("long")
        more = _nearest(index.withColumn("bucket", length).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(blocks))),
                        short.withColumn("bucket", length).withColumn("part", F.explode(block)), k)
        found = _best(found.select("query_id", "id", "score").unionByName(more), k)
    return found.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "id")
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
