"""Hot matches and hot dates: the view splits them, files stay within their size, replaced tables leave no files."""

import collections
import datetime as dt
import os
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text, rows
from tessera.catalog import reports as R
from tessera.operators.reports import hot_keys, match_view, match_view_hot
from tessera.plans.layout import file_histogram, rows_per_file, write_bucketed, write_partitioned
from tessera.session import fresh_path, local_path
from tessera.sources import standins as S

ARGS = ("match_id", "player", ["mapid"], ["kills"], [("medal_id", "medal_id"), ("count", "medal_count")])


def tables(spark, n=3000):
    """A third of all details and medals in match 0; a third of its medals with one player; NULLs, lone and empty matches."""
    rng = random.Random(2)
    details, medals = [], []
    for i in range(n):
        match = 0 if i % 3 == 0 else rng.choice([None, *range(1, 60)])
        details.append((match, None if i % 50 == 0 else f"p{i if match == 0 else i % 7}", i))
        player = "p0" if i % 9 == 0 else f"p{i}" if i % 2 else None if i % 11 == 0 else f"lone{i}"
        medals.append((match if i % 5 else 100 + i % 3, player if match == 0 else f"p{i % 9}", i % 40, i))
    matches = [(k, (k or 0) % 5) for k in [*range(0, 103), None]]
    return (spark.createDataFrame(matches, "match_id int, mapid int"),
            spark.createDataFrame(details, "match_id int, player string, kills int"),
            spark.createDataFrame(medals, "match_id int, player string, medal_id int, count int"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [1, 100, 400, 10**9])
def test_hot_view_equals_plain_view(spark, how, limit):
    t = tables(spark)
    assert rows(match_view_hot(*t, *ARGS, max_rows=limit, how=how)) == rows(match_view(*t, *ARGS, how=how))


def test_hot_view_plans(spark):
    """The rest is joined by bucket without an Exchange; the hot match by (match, player, salt)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m, d, x = tables(spark)
        hot = hot_keys([d, x], ["match_id"], 400)
        assert [r.match_id for r in hot.collect()] == [0]
        stored = [write_bucketed(t, f"hot_view_{k}", "match_id", 4, fresh_path(spark, "hot-view")) for k, t in enumerate((m, d, x))]
        view = match_view_hot(*stored, *ARGS, max_rows=400)
        plan = plan_text(view)
        _, *parts = re.split(r"\n   [:+]- ", plan)                    # the branches of the union
        rest, split = "".join(parts[:2]), "".join(parts[2:])
        assert rest.count("SortMergeJoin") == 4 and "Exchange hashpartitioning" not in rest
        joins = [line for line in split.splitlines() if "SortMergeJoin" in line]
        exchanges = [line for line in split.splitlines() if "Exchange hashpartitioning" in line]
        assert joins and all(line.count("_k#") == 2 for line in joins)      # (match, player, salt)
        assert exchanges and all("_k#" in line for line in exchanges)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert rows(view) == rows(match_view(m, d, x, *ARGS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for k in range(3):
            spark.sql(f"DROP TABLE IF EXISTS hot_view_{k}")


def test_keys_are_counted_by_many_tasks(spark):
    """One task may write the hot keys, not merge the counts of all keys."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sc, group = spark.sparkContext, "hot-keys-test"
    sc.setJobGroup(group, group)
    try:
        t = spark.range(0, 3000, 1, 2).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
        assert [tuple(r) for r in hot_keys([t, t], ["k"], 100).collect()] == [(0, 2000)]
        tracker = sc.statusTracker()
        stages = {k for j in tracker.getJobIdsForGroup(group) for k in tracker.getJobInfo(j).stageIds}
        infos = [tracker.getStageInfo(k) for k in stages]
        assert 8 in [i.numTasks for i in infos if i]                        # the session's shuffle partitions
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_registered_hot_view_holds_no_hot_bucket_in_one_task(spark, monkeypatch, how):
    """A hot match's bucket is written by several tasks, and its rows are read by splits, not by bucket."""
    most = 500
    monkeypatch.setattr(R, "BUCKET_ROWS", most)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = R._hot_view(spark, SF_SMALL, how)
        for k in ("details", "medals"):
            t = spark.table(R._name(f"hot_{k}", SF_SMALL))
            sizes = [pq.read_metadata(local_path(f)).num_rows for f in t.inputFiles()]
            assert sum(sizes) == t.count() and max(sizes) <= most
        plan = plan_text(view)
        _, *parts = re.split(r"\n   [:+]- ", plan)                    # the branches of the union
        assert "Exchange hashpartitioning" not in "".join(parts[:2])
        assert "Bucketed: true" in "".join(parts[:2]) and "Bucketed: true" not in "".join(parts[2:])
        t = S.hot_matches(spark, SF_SMALL)
        args = ("match_id", "player_gamertag", ["mapid", "playlist_id"], ["player_total_kills"],
                [("medal_id", "medal_id"), ("count", "medal_count")])
        assert rows(view) == rows(match_view(*t, *args, how=how))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def files(path):
    return [os.path.join(r, f) for r, _, fs in os.walk(local_path(path)) for f in fs if f.endswith(".parquet")]


@pytest.mark.parametrize("buckets", [1, 3])
def test_hot_date_is_dealt_to_as_many_files_as_it_needs(spark, buckets):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(20)] + [None]
    df = spark.range(90_000).select(F.col("id").alias("match_id"), F.element_at(F.array(*(F.lit(d).cast("date") for d in days)),
                                    F.when(F.col("id") % 3 == 0, F.lit(3)).otherwise((F.floor(F.col("id") / 3) % 21 + 1)).cast("int")).alias("d"))
    most = 5_000
    p = fresh_path(spark, "hot-date")
    t = write_partitioned(df, "hot_date_test", "d", "match_id", buckets, p, tasks=4, max_rows=most)
    assert rows(t.select("match_id", "d")) == rows(df)
    sizes = collections.defaultdict(list)
    for f in files(p):
        sizes[os.path.basename(os.path.dirname(f))].append(pq.read_metadata(f).num_rows)
    assert len(sizes) == 21 and max(max(s) for s in sizes.values()) <= most
    per = {r[0]: r[1] for r in df.groupBy("d").count().collect()}
    for day, s in sizes.items():
        total = per[None if "HIVE" in day else dt.date.fromisoformat(day[2:])]
        assert sum(s) == total
        bucket = total / buckets
        assert len(s) <= buckets * -(-bucket * 1.06 * 10 // (most * 9)) if bucket > most else len(s) <= buckets
    assert len(file_histogram(df, "d", "match_id", buckets, most).collect()) == buckets
    spark.sql("DROP TABLE hot_date_test")


def test_hot_bucket_is_dealt_to_as_many_files_as_it_needs(spark):
    """A third of all rows under one key: its bucket takes several tasks and files, the others one."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    p = fresh_path(spark, "hot-bucket")
    t = write_bucketed(df, "hot_bucket_test", "k", 8, p, max_rows=6_000)
    assert rows(t.select("k", "v")) == rows(df)
    per = collections.defaultdict(list)
    for f in files(p):
        per[re.search(r"_(\d{5})\.", f).group(1)].append(pq.read_metadata(f).num_rows)
    assert len(per) == 8 and max(max(s) for s in per.values()) <= 6_000
    assert sorted(map(len, per.values()))[:7] == [1] * 7 and 4 <= max(map(len, per.values())) <= 6
    joined = t.join(spark.table("hot_bucket_test").groupBy("k").count(), "k")
    assert "Exchange hashpartitioning" not in plan_text(joined) and joined.count() == 60_000
    spark.sql("DROP TABLE hot_bucket_test")


def test_rows_per_file_bounds_bytes(spark):
    df = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"),
                                    F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("d"))
    p = fresh_path(spark, "bytes")
    write_partitioned(df, "bytes_test", "d", "id", 1, p, tasks=2, max_rows=rows_per_file(df, 200_000))
    assert max(os.path.getsize(f) for f in files(p)) <= 200_000 and len(files(p)) > 4
    assert rows_per_file(df.limit(0), 100) == 1
    spark.sql("DROP TABLE bytes_test")


def test_replaced_tables_leave_two_versions(spark):
    paths = [fresh_path(spark, f"replaced{k}") for k in range(4)]
    held = []
    for k, p in enumerate(paths):
        held.append(write_bucketed(spark.range(10 + k).withColumnRenamed("id", "k"), "replaced_test", "k", 2, p))
        assert [bool(files(q)) for q in paths[:k + 1]] == [j >= k - 1 for j in range(k + 1)]
    assert held[-1].count() == 13 and held[-2].count() == 12          # a reader of the replaced version still finds its files
    spark.sql("DROP TABLE replaced_test")


def test_bucketed_queries_keep_no_old_files(spark):
    root = os.path.dirname(local_path(fresh_path(spark, "x")))
    for _ in range(4):
        R.q_bucketed_matches(spark, SF_SMALL).count()
    assert len([n for n in os.listdir(root) if n.startswith("matches_bucketed-")]) <= 2
