"""Chunked histories, Parquet footers, visitor bitmaps, VARIANT properties, NULL keys in cumulative steps."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text, rows
from tessera.catalog import graph as G
from tessera.operators.chunks import chunk_backfill, chunk_step, numbered, whole_history
from tessera.operators.cumulative import (cumulate_step, cumulate_step_multi, cumulate_step_rows, rows_summary_as_of,
                                          snapshot_multi_as_of, unnest_history)
from tessera.operators.graph import edge_property_max, variant_properties
from tessera.operators.month_arrays import (host_visitor_bitmaps_as_of, host_visitor_bitmaps_of_day, merge_visitor_bitmaps,
                                            month_visitor_counts)
from tessera.operators.upsert import upsert
from tessera.plans.footers import column_report, parquet_footers, skipped
from tessera.session import fresh_path, local_path
from tessera.sources import standins as S

ENTRY = ["film", "rating"]


def films(spark, n=900):
    """A third of all rows are one actor's; one actor is NULL; equal entries; periods without rows."""
    rng = random.Random(4)
    r = [("star" if i % 3 == 0 else None if i % 31 == 0 else f"a{rng.randrange(40)}", rng.choice([2000, 2001, 2003]), f"f{rng.randrange(300)}",
          float(rng.randrange(10))) for i in range(n)]
    return spark.createDataFrame(r, "actor string, year int, film string, rating double").repartition(5)


def fold(spark, facts, per_chunk):
    table = chunk_backfill(facts, "actor", "year", ENTRY, 2000, per_chunk)
    for year in (2001, 2002, 2003):
        path = fresh_path(spark, "chunks")
        upsert(table, chunk_step(table, facts, "actor", "year", ENTRY, year, per_chunk), ["actor", "chunk"]).write.parquet(path)
        table = spark.read.parquet(path)
    return table


@pytest.mark.parametrize("per_chunk", [1, 7, 50, 10**6])
def test_chunks_folded_equal_whole_histories(spark, per_chunk):
    facts = films(spark)
    table = fold(spark, facts, per_chunk)
    want = snapshot_multi_as_of(facts, "actor", "year", ENTRY, "rating", 2003, [], "x").select("actor", "history")
    assert rows(whole_history(table, "actor")) == rows(want)
    sizes = table.select(F.size("history") == F.col("n_entries"), "n_entries").distinct().collect()
    assert all(ok and 0 < n <= per_chunk for ok, n in sizes)
    # all chunks of an actor but the last are full, and numbered without a gap
    last = table.groupBy("actor").agg(F.max("chunk").alias("last"), F.count("*").alias("n"))
    assert last.where("last + 1 <> n").isEmpty()
    assert table.join(last.withColumnRenamed("actor", "b"), F.expr("actor <=> b")).where(f"chunk < last AND n_entries < {per_chunk}").isEmpty()
    assert rows(unnest_history(table, "actor")) == rows(facts.select("actor", *ENTRY))
    assert rows(chunk_backfill(facts, "actor", "year", ENTRY, 2003, per_chunk).drop("last_period")) == rows(table.drop("last_period"))


def test_chunk_step_touches_the_last_chunk_only(spark):
    facts = films(spark)
    prev = chunk_backfill(facts, "actor", "year", ENTRY, 2001, 7)
    step = chunk_step(prev, facts, "actor", "year", ENTRY, 2003, 7)
    full = prev.where("n_entries = 7").select(F.col("actor").alias("b"), F.col("chunk").alias("c"))
    assert step.join(full, F.expr("actor <=> b AND chunk = c")).isEmpty()
    one = cumulate_step_multi(snapshot_multi_as_of(facts, "actor", "year", ENTRY, "rating", 2001, [], "x").withColumn("current_period", F.lit(2002)),
                              facts, "actor", "year", ENTRY, "rating", 2003, [], "x")
    assert rows(whole_history(upsert(prev, step, ["actor", "chunk"]), "actor")) == rows(one.select("actor", "history"))
    assert chunk_step(prev, facts, "actor", "year", ENTRY, 2002, 7).isEmpty()


def test_numbers_of_a_hot_key_come_from_many_ranges(spark):
    facts = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("k"), F.col("id").alias("v")).repartition(6)
    got = numbered(facts, "k", ["v"])
    by = {}
    for r in got.orderBy("k", "v").collect():
        assert r["_n"] == by.get(r.k, 0)
        by[r.k] = r["_n"] + 1
    assert "hashpartitioning(k#" in plan_text(got) and "_range#" in plan_text(got)


def test_null_key_is_one_entity(spark):
    facts = spark.createDataFrame([(None, 2000, 1.0), (None, 2001, 2.0), ("a", 2000, 3.0)], "name string, season int, pts double")
    args = ("name", "season", ["season", "pts"])
    prev = None
    for year in (2000, 2001, 2002):
        if prev is None:
            prev = spark.createDataFrame([], "name string, history array<struct<season:int,pts:double>>, class string, "
                                             "years_since_last_active int, is_active boolean, current_period int")
        prev = cumulate_step(prev, facts, *args, year, "pts", [], "x")
        assert prev.where("name IS NULL").count() == 1
    assert [len(r.history) for r in prev.where("name IS NULL").collect()] == [2]
    seed = rows_summary_as_of(facts, "name", "season", "pts", 2000, [], "x")
    step = cumulate_step_rows(seed, facts, "name", "season", "pts", 2001, [], "x")
    assert rows(step, "name", "n_entries") == [("a", 1), (None, 2)]
    assert rows(step) == rows(rows_summary_as_of(facts, "name", "season", "pts", 2001, [], "x").select(*step.columns))


# ---- footers -------------------------------------------------------------------------------------

def test_footers_equal_duckdbs(spark):
    p = fresh_path(spark, "footers")
    S.match_details(spark, SF_SMALL).withColumn("t", F.when(F.col("match_id") % 7 > 0, F.concat(F.lit("né "), "match_id"))) \
        .withColumn("d", F.date_add(F.lit("2024-01-01"), F.col("match_id").cast("int") % 90)).repartition(3).write.parquet(p)
    got = sorted((r.file.split("/")[-1], r.row_group, r.column, r.row_group_rows, r.compressed_bytes, r.uncompressed_bytes, r.codec, r.min, r.max, r.n_nulls)
                 for r in parquet_footers(spark, p).collect())
    want = duckdb.sql(f"""
        SELECT parse_filename(file_name), row_group_id, path_in_schema, row_group_num_rows, total_compressed_size, total_uncompressed_size,
               compression, stats_min_value, stats_max_value, stats_null_count FROM parquet_metadata('{local_path(p)}/*.parquet')""").fetchall()
    assert got == sorted(want) and len(got) == 3 * 6


def test_sort_order_shows_in_what_is_skipped(spark):
    df = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("k"), F.when(F.col("id") % 2 == 0, F.lit(None).cast("long")).otherwise(1).alias("v"))
    loose, sorted_ = fresh_path(spark, "loose"), fresh_path(spark, "sorted")
    df.repartition(8).write.parquet(loose)
    df.repartitionByRange(8, "k").sortWithinPartitions("k").write.parquet(sorted_)
    a, b = (skipped(parquet_footers(spark, p), "k", 100, 200).first() for p in (loose, sorted_))
    assert a.skipped_row_groups == 0 and b.skipped_row_groups == 7 and b.n_row_groups == 8
    assert b.skipped_rows > 30_000 and 0 < b.skipped_bytes < b.n_bytes and a.n_rows == b.n_rows == 40_000
    report = {r.column: r for r in column_report(parquet_footers(spark, sorted_)).collect()}
    assert (report["k"].min_number, report["k"].max_number, report["k"].n_nulls) == (0, 39_999, 0)
    assert report["v"].n_nulls == 20_000 and report["v"].n_rows == 40_000
    assert skipped(parquet_footers(spark, sorted_), "v", 5, 9).first().skipped_row_groups == 8


def test_footers_of_empty_and_textual_tables(spark):
    p = fresh_path(spark, "empty-footers")
    spark.createDataFrame([], "a int, b string").write.parquet(p)
    assert parquet_footers(spark, p).collect() == []
    q = fresh_path(spark, "nulls-footers")
    spark.createDataFrame([(None, "x"), (None, None)], "a int, b string").coalesce(1).write.parquet(q)
    got = {r.column: r for r in parquet_footers(spark, q).collect()}
    assert (got["a"].n_nulls, got["a"].has_range, got["a"].min) == (2, False, None)
    assert (got["b"].n_nulls, got["b"].min, got["b"].min_number) == (1, "x", None)


# ---- bitmaps and variants ------------------------------------------------------------------------

def test_bitmaps_count_visitors_exactly(spark):
    rng = random.Random(7)
    day = dt.date(2024, 3, 5)
    ids = [rng.choice([rng.randrange(40), rng.randrange(10**6), -rng.randrange(10**5), 2**40 + rng.randrange(9)]) for _ in range(4000)]
    data = [(None if i % 97 == 0 else f"h{i % 5}" if i % 3 else "hot", None if i % 89 == 0 else u,
             dt.datetime(2024, 3, 1) + dt.timedelta(days=i % 5, seconds=i)) for i, u in enumerate(ids)]
    ev = spark.createDataFrame(data, "host string, user_id long, ts timestamp_ntz")
    want = {}
    for h, u, _ in data:
        if h is not None and u is not None:
            want.setdefault(h, set()).add(u)
    table = host_visitor_bitmaps_as_of(ev, day - dt.timedelta(days=3))
    for d in (2, 1, 0, 1):                                   # the fourth is a re-run
        table = merge_visitor_bitmaps(table, host_visitor_bitmaps_of_day(ev, day - dt.timedelta(days=d)))
    got = {r.host: r.n_visitors for r in month_visitor_counts(table).collect()}
    assert got == {h: len(s) for h, s in want.items()}
    assert rows(table) == rows(host_visitor_bitmaps_as_of(ev, day).select(*table.columns))
    assert {r[0] for r in table.select(F.length("bitmap")).collect()} == {4096}


def test_variant_reports_parse_no_text(spark):
    v, e = G.player_vertices(spark, SF_SMALL), G.plays_in_edges(spark, SF_SMALL)
    vv, ev = variant_properties(v), variant_properties(e)
    a, b = fresh_path(spark, "vv"), fresh_path(spark, "ve")
    vv.write.parquet(a)
    ev.write.parquet(b)
    vv, ev = spark.read.parquet(a), spark.read.parquet(b)
    out = edge_property_max(vv, ev, "player_name", "pts")
    assert rows(out) == rows(edge_property_max(v, e, "player_name", "pts"))
    plan = plan_text(out)
    assert "get_json_object" not in plan and "parse_json" not in plan
    odd = spark.createDataFrame([("1", "t", '{"n": null, "x": "12", "y": "abc"}'), ("2", "t", "{}")], "identifier string, type string, properties string")
    edges = spark.createDataFrame([("1", "t", "9", "g", '{"pts": "7"}'), ("1", "t", "8", "g", '{"pts": null}'), ("2", "t", "8", "g", '{}')],
                                  "subject_identifier string, subject_type string, object_identifier string, object_type string, properties string")
    for name in ("n", "x", "y", "z"):
        assert rows(edge_property_max(variant_properties(odd), variant_properties(edges), name, "pts")) == rows(edge_property_max(odd, edges, name, "pts"))
