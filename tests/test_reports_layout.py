import random

from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text, rows
from tessera.catalog import reports as R
from tessera.operators.reports import match_view, top_by_count
from tessera.plans.joins import broadcast_if_small, enrich, measured_bytes
from tessera.plans.layout import file_stats, write_bucketed
from tessera.session import fresh_path
from tessera.sources import standins as S


def test_tie_break_is_deterministic(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("a", 4)], "k string, v int")
    assert top_by_count(df, "k", "v", "n").collect()[0]["k"] == "a"


def test_small_side_is_left_to_spark(spark):
    """No job runs at query build; a side of long texts is broadcast by nobody."""
    small = spark.range(10).select(F.col("id").alias("k"))
    big = spark.range(1000).select(F.col("id").alias("k"))
    path = fresh_path(spark, "long-texts")
    rng = random.Random(1)
    spark.createDataFrame([(i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=300_000))) for i in range(10)],
                          "k long, text string").write.parquet(path)
    texts = spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        assert "BroadcastHashJoin" in plan_text(enrich(S.matches(spark, SF_SMALL), S.maps(spark, SF_SMALL), "mapid", ["name"]))
        joined = big.join(texts, "k", "left")
        joined.count()
        assert "BroadcastHashJoin" not in plan_text(joined)
        assert measured_bytes(texts) > 2_000_000 > measured_bytes(small)
        assert "BroadcastHashJoin" not in plan_text(big.join(broadcast_if_small(texts, 1_000_000), "k", "left"))
        assert "BroadcastHashJoin" in plan_text(big.join(broadcast_if_small(texts, 10_000_000), "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _view(m, md, mmp, how):
    return match_view(m, md, mmp, "match_id", "player_gamertag", ["mapid", "playlist_id"], ["player_total_kills"],
                      [("medal_id", "medal_id"), ("count", "medal_count")], how)


def test_bucketed_view_has_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m, md, mmp = R.bucketed(spark, SF_SMALL)
        for how in ("left", "inner"):
            plan = plan_text(_view(m, md, mmp, how))
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_view_keeps_medal_rows_without_details(spark):
    m = spark.createDataFrame([(1, 0, "p"), (2, 0, "p"), (3, 0, "p")], "match_id int, mapid int, playlist_id string")
    md = spark.createDataFrame([(1, "a", 5)], "match_id int, player_gamertag string, player_total_kills int")
    mmp = spark.createDataFrame([(1, "a", 7, 1), (1, "z", 7, 9), (2, "b", 7, 50)],
                                "match_id int, player_gamertag string, medal_id int, count int")
    cols = ("match_id", "player_gamertag", "medal_count")
    assert rows(_view(m, md, mmp, "left"), *cols) == [(1, "a", 1), (1, None, 9), (2, None, 50), (2, None, None), (3, None, None)]
    assert rows(_view(m, md, mmp, "inner"), *cols) == [(1, "a", 1), (1, None, 9)]


def test_conf_is_left_alone(spark):
    old = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
    try:
        R.q_match_view_left(spark, SF_SMALL)
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    finally:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", old)


def test_fact_and_devices_shuffle_once(spark):
    from tessera.catalog import devices as V
    from tessera.catalog import facts as T
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(T.q_fact_build(spark, SF_SMALL))
        # details by game, headers by game, and the two sides of the supplier look-up
        assert plan.count("Exchange hashpartitioning") <= 4, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = plan_text(V.q_device_datelist(spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning(user_id") <= 2, plan


def test_view_distinct_counts_equal_direct_report(spark):
    direct = R.q_top_map_by_matches(spark, SF_SMALL).collect()
    view = R.q_top_map_from_view(spark, SF_SMALL).collect()
    assert direct == view


def test_bucketed_write_one_file_per_bucket(spark):
    p = fresh_path(spark, "bucket-test")
    write_bucketed(S.match_details(spark, SF_SMALL), "bucket_test_md", "match_id", 4, p)
    st = file_stats(spark, p).collect()[0]
    assert st["n_files"] == 4


def test_bucket_count_follows_bytes_and_tables_are_replaced(spark):
    from tessera.plans.layout import bucket_count
    assert bucket_count(10 << 30) == 10 and bucket_count(5, at_least=16) == 16
    before = len(spark.catalog.listTables())
    R.q_bucketed_matches(spark, SF_SMALL).count()
    once = len(spark.catalog.listTables())
    R.q_bucketed_matches(spark, SF_SMALL).count()
    assert once == len(spark.catalog.listTables()) <= before + 1
    p = fresh_path(spark, "spread")
    t = write_bucketed(S.match_details(spark, SF_SMALL), "spread_md", "match_id", 2, p, spread=3)
    assert t.count() == S.match_details(spark, SF_SMALL).count() and file_stats(spark, p).first()["n_files"] > 2
    spark.sql("DROP TABLE spread_md")


def test_partitioned_bucketed_write(spark):
    import datetime as dt
    import os

    from tessera.plans.layout import write_partitioned
    from tessera.session import local_path
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    df = spark.createDataFrame([(i, days[i % 3]) for i in range(300)], "match_id long, d date")
    p = fresh_path(spark, "part-bucket")
    t = write_partitioned(df, "part_bucket_test", "d", "match_id", 4, p)
    assert rows(t.select("match_id", "d")) == rows(df)
    parts = sorted(x for x in os.listdir(local_path(p)) if x.startswith("d="))
    assert parts == ["d=2024-01-01", "d=2024-01-02", "d=2024-01-03"]
    for part in parts:
        files = [f for f in os.listdir(os.path.join(local_path(p), part)) if f.endswith(".parquet")]
        assert 1 <= len(files) <= 4          # at most one file per bucket in each day
    # a filter on the partition column prunes the scan to one directory
    plan = plan_text(t.where(F.col("d") == dt.date(2024, 1, 2)))
    assert "PartitionFilters: [isnotnull(d" in plan
