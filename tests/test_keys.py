import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators.keys import check_keys, check_values, dedup, duplicate_keys
from tessera.sources import load_csv, write_csv
from tessera.session import fresh_path


def test_dedup_keeps_first_by_order_and_row_num(spark):
    df = spark.createDataFrame(
        [(1, 1, "b"), (1, 1, "a"), (1, 2, "z"), (2, 1, "c"), (2, 1, "c")], "g long, t int, v string")
    out = dedup(df, ["g", "t"], ["v"])
    assert rows(out) == [(1, 1, "a", 1), (1, 2, "z", 1), (2, 1, "c", 1)]
    assert out.columns == ["g", "t", "v", "row_num"]


def test_dedup_requires_order(spark):
    df = spark.createDataFrame([(1, 1)], "a int, b int")
    try:
        dedup(df, ["a"], [])
    except ValueError:
        return
    raise AssertionError("unordered dedup must be rejected")


def test_duplicate_keys_and_check_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, 1), (None, 3), (None, 3)],
                               "a int, b int")
    assert rows(duplicate_keys(df, ["a", "b"])) == [(1, 1, 3), (None, 3, 2)]
    r = check_keys(df, ["a", "b"]).collect()[0].asDict()
    assert r == {"n_rows": 6, "n_null_key_rows": 2, "n_duplicate_keys": 2, "n_excess_rows": 3}


def test_check_values_enum(spark):
    df = spark.createDataFrame([("star",), ("bad",), ("oops",), (None,), ("oops",)], "c string")
    assert rows(check_values(df, "c", ["star", "good", "average", "bad"])) == [("c", "oops", 2)]


def test_csv_numeric_order_with_schema(spark):
    # counts '9' and '10': typed, 10 sorts above 9 (as text, '9' would win)
    df = spark.createDataFrame([("a", 9), ("b", 10)], "k string, count int")
    p = fresh_path(spark, "csv-test")
    write_csv(df, p)
    back = load_csv(spark, p, "k string, count int")
    top = back.orderBy(F.col("count").desc()).limit(1).collect()[0]
    assert top["k"] == "b"
    as_text = load_csv(spark, p, "k string, count string")
    assert as_text.orderBy(F.col("count").desc()).limit(1).collect()[0]["k"] == "a"


def test_csv_roundtrip_types(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 2), 1.25)], "i long, d date, x double")
    p = fresh_path(spark, "csv-rt")
    write_csv(df, p)
    assert rows(load_csv(spark, p, "i long, d date, x double")) == [(1, dt.date(2024, 1, 2), 1.25)]


def test_csv_header_must_match_the_schema(spark):
    p = fresh_path(spark, "csv-order")
    write_csv(spark.createDataFrame([(1, 2)], "b int, a int"), p)
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE|CSV"):
        load_csv(spark, p, "a int, b int").collect()
    assert rows(load_csv(spark, p, "b int, a int")) == [(1, 2)]
