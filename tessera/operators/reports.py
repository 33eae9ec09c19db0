"""Top-k reports and the three-way match view.

Every top-k ends in ``orderBy(...).limit(k)`` with a unique tie-break after the
measure; Spark plans it as TakeOrderedAndProject (a per-partition top-k, then a
merge of k rows per partition), so nothing but k rows per task moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.plans.joins import broadcast_if_small, enrich
from tessera.session import fresh_path


def top_k(df: DataFrame, measure: str, tie_break: Sequence[str], k: int = 1) -> DataFrame:
    """First ``k`` rows by ``measure`` descending, ties broken by ``tie_break`` ascending."""
    return df.orderBy(F.col(measure).desc_nulls_last(),
                      *[F.col(c).asc_nulls_last() for c in tie_break]).limit(k)


def top_by_count(df: DataFrame, key: str | Sequence[str], col: str, alias: str,
                 k: int = 1) -> DataFrame:
    """Most frequent ``key`` by ``count(col)`` (op 39)."""
    keys = [key] if isinstance(key, str) else list(key)
    g = df.groupBy(*keys).agg(F.count(col).alias(alias))
    return top_k(g, alias, keys, k)


def top_by_avg(df: DataFrame, key: str, col: str, alias: str, k: int = 1,
               as_int: bool = False) -> DataFrame:
    """Highest average of ``col`` per ``key`` (op 38); ``as_int`` truncates like
    ``CAST(AVG(x) AS INT)`` in the SQL form."""
    a = F.avg(col)
    g = df.groupBy(key).agg((a.cast("int") if as_int else a).alias(alias))
    return top_k(g, alias, [key], k)


def top_by_distinct(fact: DataFrame, dim: DataFrame, on: str, group: Sequence[str],
                    distinct_col: str, alias: str, k: int = 1) -> DataFrame:
    """Enrich with a dimension (left), count distinct, top-k (op 33).

    ``count(DISTINCT x)`` is planned as two aggregation levels; the first is
    keyed by (group, x), so a hot group is still spread over many tasks.
    """
    g = fact.join(dim, on, "left").groupBy(*group).agg(F.count_distinct(distinct_col).alias(alias))
    return top_k(g, alias, list(group), k)


def match_view(matches: DataFrame, details: DataFrame, medals: DataFrame, key: str, player: str,
               match_cols: Sequence[str], detail_cols: Sequence[str],
               medal_cols: Sequence[tuple[str, str]], how: str = "left") -> DataFrame:
    """Matches with their players' details and medals (op 37).

    A player's medals stand beside that player's detail row, so a match gives one
    row per detail or medal row, not details x medals. A medal row whose player
    has no detail row in the match is a row of its own, with NULL player columns;
    so every (match, medal) of the inputs is in the view. ``how='inner'`` keeps
    details that have medals, and medal rows of matches that have details.

    With the inputs bucketed on ``key`` no side is shuffled, provided the session
    sets ``spark.sql.requireAllClusterKeysForCoPartition`` to false (so that
    bucketing on ``key`` also serves joins on (key, player)); it is not set here.
    """
    medal = [F.col(c).alias(a) for c, a in medal_cols]
    m = matches.select(key, *match_cols)
    d = details.select(key, player, *detail_cols)
    x = medals.select(key, player, *medal)
    own = m.join(d, key, how).join(x, [key, player], how)
    lone = x.join(details.select(key, player), [key, player], "left_anti")
    if how == "inner":
        lone = lone.join(details.select(key), key, "left_semi")
    lone = m.join(lone.drop(player), key)
    for c in (player, *detail_cols):
        lone = lone.withColumn(c, F.lit(None).cast(d.schema[c].dataType))
    cols = [key, *match_cols, player, *detail_cols, *[a for _, a in medal_cols]]
    return own.select(*cols).unionByName(lone.select(*cols))


def hot_keys(tables: Sequence[DataFrame], keys: Sequence[str], max_rows: int) -> DataFrame:
    """(keys, n): the keys with more than ``max_rows`` rows in all tables together; at most rows / max_rows of them.

    One partial aggregate per table, over the keys alone; written once to the shared folder. The keys are counted as one
    struct: a bucketed table would else be counted bucket by bucket, a hot one in a single task. The few hot keys are
    shuffled to one file: ``coalesce(1)`` would merge the counts of all keys in a single task.
    """
    counts = [t.groupBy(F.struct(*keys).alias("_k")).agg(F.count(F.lit(1)).alias("n")) for t in tables]
    hot = reduce(DataFrame.unionByName, counts).groupBy("_k").agg(F.sum("n").alias("n")).select("_k.*", "n")
    path = fresh_path(hot.sparkSession, "hot")
    hot.where(F.col("n") > max_rows).dropna(subset=list(keys)).repartition(1).write.parquet(path)
    return hot.sparkSession.read.parquet(path)


def match_view_hot(matches: DataFrame, details: DataFrame, medals: DataFrame, key: str, player: str,
                   match_cols: Sequence[str], detail_cols: Sequence[str], medal_cols: Sequence[tuple[str, str]],
                   max_rows: int, how: str = "left", unbucketed: Sequence[DataFrame] | None = None) -> DataFrame:
    """``match_view`` where a match may hold any share of the rows (op 37).

    A bucketed join can't split a hot match, and a match with more than ``max_rows`` detail and medal rows would be one
    task. Such matches are measured and leave the bucketed join, which keeps the rest without an Exchange.
    Their rows meet by (match, player) instead, so that a match spreads over its players, and the medal rows of a player who
    has more than ``max_rows`` in one match are dealt over salts, with that player's detail rows copied to each. The
    hot matches' own rows (few) are broadcast when their measured size allows it.

    A scan by buckets reads a hot match in one task, which holds its rows for the shuffle. ``unbucketed`` are the three
    tables read as plain files, so that hot rows are read by splits; give it when the tables are bucketed.
    """
    plain = tuple(unbucketed or (matches, details, medals))
    few = broadcast_if_small(hot_keys(plain[1:], [key], max_rows).select(key))
    m, d, x = (t.join(few, key, "left_anti").select(*t.columns) for t in (matches, details, medals))
    rest = match_view(m, d, x, key, player, match_cols, detail_cols, medal_cols, how)
    m, d, x = (t.join(few, key, "left_semi").select(*t.columns) for t in plain)
    return rest.unionByName(_hot_view(m, d, x, key, player, match_cols, detail_cols, medal_cols, max_rows, how))


def _hot_view(matches: DataFrame, details: DataFrame, medals: DataFrame, key: str, player: str, match_cols: Sequence[str],
              detail_cols: Sequence[str], medal_cols: Sequence[tuple[str, str]], max_rows: int, how: str) -> DataFrame:
    pair = [key, player]
    m = broadcast_if_small(matches.select(key, *match_cols))
    d = details.select(*pair, *detail_cols)
    x = medals.select(*pair, *(F.col(c).alias(a) for c, a in medal_cols))
    labels = [a for _, a in medal_cols]
    cols = [key, *match_cols, player, *detail_cols, *labels]
    # players that one task shouldn't hold; at most rows / max_rows of them
    large = broadcast_if_small(hot_keys([x], pair, max_rows).select(*pair, F.ceil(F.col("n") / max_rows).alias("_salts")))
    salts, zero = F.coalesce("_salts", F.lit(1)), F.lit(0).cast("bigint")
    # the joins are on structs: bucketing on the match would satisfy a join on its columns, and keep a hot match in one task
    by = F.struct(*pair, "_salt").alias("_k")
    dealt = x.join(large, pair, "left").withColumn("_salt", F.pmod(F.xxhash64(*pair, *labels), salts)).select(*x.columns, by)
    copied = (d.where(F.col(player).isNotNull()).join(large, pair, "left")
              .withColumn("_salt", F.explode(F.sequence(zero, salts - 1))).select(*d.columns, by))
    lone = dealt.join(copied.select("_k"), "_k", "left_anti").drop(player, "_k")
    if how == "inner":
        lone = lone.join(broadcast_if_small(d.select(F.struct(key).alias("_k")).distinct().select("_k.*")), key, "left_semi")
    both = copied.join(dealt.drop(*pair), "_k").drop("_k")
    out = [both.join(m, key), _padded(lone.join(m, key), cols, d.schema)]
    if how == "left":
        some = x.where(F.col(player).isNotNull()).select(F.struct(*pair).alias("_k")).distinct()
        alone = d.withColumn("_k", F.struct(*pair)).join(some, "_k", "left_anti").drop("_k").join(m, key)
        kept = d.select(F.struct(key).alias("_k")).distinct()
        empty = matches.select(key, *match_cols).withColumn("_k", F.struct(key)).join(kept, "_k", "left_anti").drop("_k")
        out += [_padded(alone, cols, x.schema), _padded(_padded(empty, [*empty.columns, player, *detail_cols], d.schema), cols, x.schema)]
    return reduce(DataFrame.unionByName, (o.select(*cols) for o in out))


def _padded(df: DataFrame, cols: Sequence[str], schema) -> DataFrame:
    """``df`` with the missing columns of ``cols`` as NULLs of their type in ``schema``."""
    have = set(df.columns)
    return df.select(*df.columns, *(F.lit(None).cast(schema[c].dataType).alias(c) for c in cols if c not in have))


def top_for_label(rows: DataFrame, dim: DataFrame, dim_key: str, label_col: str, label: str,
                  enrich_with: DataFrame, enrich_key: str, enrich_cols: Sequence[str],
                  measure: str, tie_break: Sequence[str], k: int = 1,
                  select: Sequence[str | Column] | None = None) -> DataFrame:
    """Top-k rows for one dimension label (op 40).

    The dimension is filtered to the label *before* the join (so the small side
    is just the matching ids) and joined inner -- a left join followed by a
    filter on the dimension's column is an inner join anyway. When the order uses
    no enriched column the top-k is taken first and only k rows are enriched (left).
    """
    d = dim.where(F.col(label_col) == label).select(dim_key, F.col(label_col))
    j = rows.join(d, dim_key)
    if {measure, *tie_break} <= set(j.columns):
        j = top_k(j, measure, tie_break, k)
    j = enrich(j, enrich_with, enrich_key, enrich_cols)
    if select is not None:
        j = j.select(*select)
    return top_k(j, measure, tie_break, k)
