"""Upserts with NULL and repeated keys; tables that are published atomically; checks as a gate."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import plan_text, rows
from tessera.operators.upsert import upsert, write_upsert
from tessera.plans.versions import Checks, ConcurrentLoad, DirtyLoad, VersionedTable
from tessera.session import fresh_path

SCHEMA = "k int, d int, v string"


def table(spark, *r):
    return spark.createDataFrame(list(r), SCHEMA)


@pytest.mark.parametrize("partitions", [None, [None], [None, 1]])
def test_null_partition_keeps_its_other_keys(spark, partitions):
    t = table(spark, (1, None, "old"), (2, None, "old"), (1, 1, "old"), (1, 2, "old"))
    u = table(spark, (1, None, "new"))
    want = rows(table(spark, (1, None, "new"), (2, None, "old"), (1, 1, "old"), (1, 2, "old")))
    assert rows(upsert(t, u, ["k", "d"], "d", partitions)) == want
    p = fresh_path(spark, "null-partition")
    t.write.partitionBy("d").parquet(p)
    for _ in range(2):
        write_upsert(u, p, "d", ["k", "d"], partitions=partitions)
    assert rows(spark.read.parquet(p).select("k", "d", "v")) == want


def test_null_part_is_pruned_by_name(spark):
    p = fresh_path(spark, "null-pruned")
    table(spark, (1, None, "old"), (2, 1, "old"), (3, 2, "old")).write.partitionBy("d").parquet(p)
    out = upsert(spark.read.schema(SCHEMA).parquet(p), table(spark, (1, None, "new")), ["k", "d"], "d", [None])
    assert "PartitionFilters: [isnull(d" in plan_text(out) and "CartesianProduct" not in plan_text(out)


def test_uncovered_update_is_an_error_of_the_plan(spark):
    t, u = table(spark, (1, 1, "a"), (2, 2, "b")), table(spark, (2, 2, "NEW"))
    with pytest.raises(PySparkException, match="outside"):
        upsert(t, u, ["k", "d"], "d", [1]).collect()
    with pytest.raises(PySparkException, match="outside"):
        upsert(t, table(spark, (2, None, "NEW")), ["k", "d"], "d", [1]).collect()
    assert rows(upsert(t, u, ["k", "d"], "d", [2])) == rows(table(spark, (1, 1, "a"), (2, 2, "NEW")))


def test_null_key_is_updated_not_added_again(spark):
    t, u = table(spark, (None, 1, "old"), (5, 1, "old")), table(spark, (None, 1, "new"))
    want = rows(table(spark, (None, 1, "new"), (5, 1, "old")))
    for args in ((["k"],), (["k", "d"],), (["k", "d"], "d"), (["k", "d"], "d", [1])):
        once = upsert(t, u, *args)
        assert rows(once) == want and rows(upsert(once, u, *args)) == want


def test_repeated_key_is_refused_or_resolved(spark):
    t, u = table(spark, (1, 1, "old"), (2, 1, "old")), table(spark, (1, 1, "x"), (1, 1, "y"), (3, 1, "z"))
    with pytest.raises(PySparkException, match="repeat the key"):
        upsert(t, u, ["k", "d"]).collect()
    with pytest.raises(PySparkException, match="repeat the key"):
        upsert(table(spark), u, ["k", "d"], "d").count()
    want = rows(table(spark, (1, 1, "y"), (2, 1, "old"), (3, 1, "z")))
    for args in ((["k", "d"],), (["k", "d"], "d"), (["k", "d"], "d", [1])):
        assert rows(upsert(t, u, *args, resolve=[F.desc("v")])) == want
    p = fresh_path(spark, "repeated")
    t.write.partitionBy("d").parquet(p)
    with pytest.raises(ValueError, match="repeat the key"):
        write_upsert(u, p, "d", ["k", "d"])
    assert rows(spark.read.parquet(p).select("k", "d", "v")) == rows(t)
    write_upsert(u, p, "d", ["k", "d"], resolve=[F.desc("v")])
    assert rows(spark.read.parquet(p).select("k", "d", "v")) == want


def test_updates_from_the_target_itself(spark):
    t = table(spark, (1, 1, "a"), (2, 1, "b"), (3, None, "c"))
    u = t.where("k <> 2").withColumn("v", F.upper("v"))
    assert rows(upsert(t, u, ["k", "d"], "d")) == rows(table(spark, (1, 1, "A"), (2, 1, "b"), (3, None, "C")))


# ---- published tables ----------------------------------------------------------------------------

def published(spark, name="published"):
    t = VersionedTable(spark, fresh_path(spark, name), "d")
    t.replace(table(spark, (1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, None, "n")))
    return t


def broken(df):
    """Rows that fail after some were written."""
    return df.unionByName(df.limit(1).withColumn("v", F.when(F.rand() < 2, F.raise_error(F.lit("killed"))).cast("string"))).repartition(2)


def test_versions_share_partitions_and_stay_readable(spark):
    t = published(spark)
    first = rows(t.read())
    assert t.upsert(table(spark, (2, 1, "B"), (9, 3, "new")), ["k", "d"]) == 2
    assert rows(t.read()) == rows(table(spark, (1, 1, "a"), (2, 1, "B"), (3, 2, "c"), (4, None, "n"), (9, 3, "new")))
    assert rows(t.read(1)) == first
    one, two = t.manifest(1)["partitions"], t.manifest()["partitions"]
    assert {p for p in one if one[p] == two[p]} == {"d=2", "d=__HIVE_DEFAULT_PARTITION__"}
    assert t.upsert(table(spark, (4, None, "N")), ["k", "d"], partitions=[None]) == 3
    assert rows(t.read().where("d IS NULL")) == [(4, None, "N")]
    assert t.rollback(1) == 4 and rows(t.read()) == first
    with pytest.raises(ValueError, match="no version"):
        t.read(9)


def test_killed_load_leaves_the_old_version(spark):
    t = published(spark)
    before = rows(t.read())
    with pytest.raises(PySparkException, match="killed"):
        t.replace(broken(table(spark, (1, 1, "x"), (3, 2, "x"), (7, 7, "x"))))
    with pytest.raises(PySparkException, match="killed"):
        t.upsert(broken(table(spark, (1, 1, "x"))), ["k", "d"], resolve=["v"])
    # a load that ends between its last file and its manifest
    t.spark.createDataFrame([(1, 1, "half")], SCHEMA).write.partitionBy("d").parquet(f"{t.path}/data/load_id=dead")
    assert t.versions() == [1] and rows(t.read()) == before
    assert rows(VersionedTable(spark, t.path, "d").read()) == before
    t.upsert(table(spark, (1, 1, "x")), ["k", "d"])
    assert "load_id=dead" in t.vacuum(keep=1)
    assert t.versions() == [2] and len(rows(t.read())) == len(before)


def test_second_of_two_loads_is_refused(spark):
    t = published(spark)
    base = t.manifest()
    t.upsert(table(spark, (1, 1, "first")), ["k", "d"])
    with pytest.raises(ConcurrentLoad):
        t._load(table(spark, (1, 1, "second")), base, None, False)
    assert "first" in {r.v for r in t.read().collect()} and t.versions() == [1, 2]
    assert not [n for n in t._names("manifest") if n.startswith(".") and not n.endswith(".crc")]


def test_first_load_by_upsert_and_empty_tables(spark):
    t = VersionedTable(spark, fresh_path(spark, "first"), "d")
    with pytest.raises(ValueError, match="nothing is published"):
        t.read()
    assert t.upsert(table(spark), ["k", "d"]) == 1 and t.read().columns == ["k", "d", "v"] and t.read().count() == 0
    assert t.upsert(table(spark, (1, 1, "a")), ["k", "d"]) == 2 and rows(t.read()) == [(1, 1, "a")]
    assert t.replace(table(spark, (5, 5, "e")), whole=True) == 3 and rows(t.read()) == [(5, 5, "e")]
    with pytest.raises(ValueError, match="repeat the key"):
        t.upsert(table(spark, (1, 1, "x"), (1, 1, "y")), ["k", "d"])


def test_partition_values_keep_type_and_signs(spark):
    t = VersionedTable(spark, fresh_path(spark, "signs"), "p")
    df = spark.createDataFrame([(1, "01"), (2, "a/b c=%{x}*"), (3, None), (4, "é")], "k int, p string")
    t.replace(df)
    assert rows(t.read()) == rows(df)
    days = VersionedTable(spark, fresh_path(spark, "days"), "day")
    days.replace(spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 3)) for i in range(9)], "k int, day date"))
    plan = plan_text(days.read().where(F.col("day") == dt.date(2024, 1, 2)))
    assert "PartitionFilters: [isnotnull(day" in plan and days.read().where(F.col("day") == dt.date(2024, 1, 2)).count() == 3


def test_dirty_load_changes_nothing(spark):
    t = published(spark)
    before = rows(t.read())
    gate = Checks(keys=["k", "d"], not_null=["d"], values={"v": ["a", "b", "c", "n"]})
    bad = table(spark, (1, 3, "a"), (1, 3, "a"), (None, 3, "zzz"), (6, None, None))
    with pytest.raises(DirtyLoad) as e:
        t.replace(bad, gate)
    assert e.value.faults == {"null_keys": 2, "repeated_keys": 1, "null:d": 1, "value:v": 1}
    assert t.versions() == [1] and rows(t.read()) == before and len(t._names("data")) == 1
    assert t.replace(table(spark, (1, 3, "a"), (2, 3, None)), gate) == 2
    with pytest.raises(DirtyLoad):
        t.upsert(table(spark, (9, 9, "bad")), ["k", "d"], checks=gate)
    assert t.versions() == [1, 2]


def test_gate_takes_one_pass(spark):
    seen = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(spark.sparkContext.parallelize(range(50), 3).map(lambda i: (seen.add(1), (i, i % 4, "a"))[1]), SCHEMA)
    t = VersionedTable(spark, fresh_path(spark, "pass"), "d")
    t.replace(df, Checks(keys=["k"], values={"v": ["a"]}))
    assert seen.value == 50 and t.read().count() == 50
