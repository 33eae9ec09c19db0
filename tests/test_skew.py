"""One key holds a third of all rows: results must equal a brute-force pandas
computation, with AQE's skew handling forced on (tiny thresholds)."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators.cumulative import cumulate_step_rows, rows_summary_as_of
from tessera.operators.datelist import activity_mask_from_events, datelist_as_of
from tessera.operators.graph import edge_property_max, edge_ratio_report
from tessera.operators.keys import dedup
from tessera.operators.month_arrays import host_month_as_of, host_visitors_as_of, month_visitors

N = 30_000
DAY = dt.date(2024, 1, 30)
SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    # key 0 gets every third row; the rest spread over 500 keys
    pdf = pd.DataFrame({
        "i": range(N),
        "k": [0 if i % 3 == 0 else 1 + i % 500 for i in range(N)],
        "day": [DAY - dt.timedelta(days=(i * 7) % 40) for i in range(N)],
        "v": [(i * 13) % 101 for i in range(N)],
    })
    pdf["ts"] = pd.to_datetime(pdf["day"]) + pd.to_timedelta(pdf["i"] % 86400, unit="s")
    df = spark.createDataFrame(pdf[["i", "k", "ts", "v"]]).withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")).repartition(8)
    yield pdf, df
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_dedup_hot_key(skewed):
    pdf, df = skewed
    got = {r["k"]: r["i"] for r in dedup(df, ["k"], [F.col("v").desc(), "i"]).collect()}
    want = pdf.sort_values(["v", "i"], ascending=[False, True]).groupby("k")["i"].first()
    assert got == want.to_dict()


def test_datelist_and_mask_hot_key(skewed):
    pdf, df = skewed
    snap = {r["k"]: r["dates_active"] for r in datelist_as_of(df, "k", DAY, ts="ts").collect()}
    want = pdf.groupby("k")["day"].apply(lambda s: sorted(set(s), reverse=True)).to_dict()
    assert snap == want
    m = {r["k"]: r["bitmask"] for r in activity_mask_from_events(df, "k", DAY, ts="ts").collect()}
    for k, days in want.items():
        bits = 0
        for d in days:
            age = (DAY - d).days
            if 0 <= age <= 31:
                bits |= 1 << (31 - age)
        assert m.get(k, 0) == bits


def test_month_arrays_hot_host(skewed):
    pdf, df = skewed
    ev = df.withColumn("host", F.concat(F.lit("h"), F.col("k").cast("string"))) \
           .withColumnRenamed("v", "user_id")
    hits = {r["host"]: r["hit_array"] for r in host_month_as_of(ev, DAY).collect()}
    visitors = {}
    for r in month_visitors(host_visitors_as_of(ev, DAY)).collect():
        visitors.setdefault(r["host"], []).append(r["visitor"])
    jan = pdf[pd.to_datetime(pdf["day"]) >= pd.Timestamp("2024-01-01")]
    for k, g in jan.groupby("k"):
        counts = g.groupby("day").size()
        arr = [int(counts.get(dt.date(2024, 1, 1) + dt.timedelta(days=i), 0)) for i in range(30)]
        vis = sorted({str(u) for u in g["v"]})
        assert (hits[f"h{k}"], sorted(visitors[f"h{k}"])) == (arr, vis)


def test_rows_step_hot_entity(skewed):
    pdf, df = skewed
    f = df.withColumn("p", F.when(F.col("i") % 2 == 0, 1).otherwise(2))
    prev = rows_summary_as_of(f, "k", "p", "v", 1, [(50, "hi")], "lo")
    got = {r["k"]: (r["n_entries"], r["class"], r["is_active"])
           for r in cumulate_step_rows(prev, f, "k", "p", "v", 2, [(50, "hi")], "lo").collect()}
    two = pdf[pdf["i"] % 2 == 1].groupby("k")["v"].mean()
    one = pdf[pdf["i"] % 2 == 0].groupby("k")["v"].mean()
    want = {k: (int(n), "hi" if two.get(k, one.get(k)) > 50 else "lo", k in two.index)
            for k, n in pdf.groupby("k").size().items()}
    assert got == want


def test_graph_reports_hot_subject(spark, skewed):
    pdf, df = skewed
    edges = df.select(F.col("k").cast("string").alias("subject_identifier"),
                      F.lit("player").alias("subject_type"),
                      F.col("i").cast("string").alias("object_identifier"),
                      F.lit("game").alias("object_type"),
                      F.to_json(F.struct(F.col("v").alias("pts"))).alias("properties"))
    verts = spark.range(0, 501).select(
        F.col("id").cast("string").alias("identifier"), F.lit("player").alias("type"),
        F.to_json(F.struct(F.concat(F.lit("p"), (F.col("id") % 50).cast("string"))
                            .alias("player_name"),
                           F.lit(2).alias("g"), F.lit(4).alias("pts"))).alias("properties"))
    mx = {r["player_name"]: r["max_pts"]
          for r in edge_property_max(verts, edges, "player_name", "pts").collect()}
    want = pdf.assign(name="p" + (pdf["k"] % 50).astype(str)).groupby("name")["v"].max()
    assert mx == want.to_dict()
    rr = edge_ratio_report(verts, edges, "game", "player_name", "g", "pts", ["pts"])
    assert rr.count() == N
    assert rr.where(F.col("ratio") != 0.5).count() == 0


def test_devices_of_a_hot_user(spark, skewed):
    """One user with a third of all rows and very many devices: both forms give the same maps, the two-shuffle one by partial aggregates."""
    from tessera.operators.devices import device_datelist, device_datelist_int, explode_map
    _, df = skewed
    events = df.select(F.col("k").alias("user_id"), (F.col("i") % 4000).alias("device_id"), "ts")
    devices = spark.range(4000).select(F.col("id").alias("device_id"), F.concat(F.lit("b"), (F.col("id") % 3).cast("string")).alias("browser_type"))
    for build, args in ((device_datelist, (DAY,)), (device_datelist_int, (DAY.replace(day=1), DAY))):
        one, two = (build(events, devices, *args, one_shuffle=flag) for flag in (True, False))
        name = [c for c in one.columns if c not in ("user_id", "date")][0]
        flat = [sorted(map(tuple, explode_map(x, "user_id", name, "b", "v").withColumn("v", F.to_json(F.array("v"))).collect())) for x in (one, two)]
        assert flat[0] == flat[1] and len(flat[0]) > 500
        plan = two._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(user_id" in plan and "REPARTITION_BY_COL" not in plan
