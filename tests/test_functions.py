from pyspark.sql import functions as F

from tessera.functions import (any_bits, bit_at, bit_count, bits_text, first_elem, join_values,
                               json_get, json_object, last_elem, safe_ratio)


def test_array_ends_are_safe_on_empty_and_null(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), (None,)], "a array<int>")
    got = [(r[0], r[1]) for r in df.select(first_elem("a"), last_elem("a")).collect()]
    assert got == [(1, 3), (None, None), (None, None)]
    assert df.select(join_values("a")).collect()[0][0] == "1,2,3"


def test_json_roundtrip_and_bad_cast(spark):
    df = spark.createDataFrame([(1, "x", None)], "a int, b string, c double")
    js = df.select(json_object({"a": "a", "b": "b", "c": "c"}).alias("j"))
    assert js.collect()[0]["j"] == '{"a":1,"b":"x","c":null}'
    r = js.select(json_get("j", "a", "int").alias("a"), json_get("j", "b", "int").alias("b"),
                  json_get("j", "missing").alias("m")).collect()[0]
    assert (r["a"], r["b"], r["m"]) == (1, None, None)     # ANSI-safe cast, missing key


def test_bits(spark):
    df = spark.createDataFrame([(0,), (31,), (5,)], "p int")
    out = df.select(bit_at("p").alias("m")).select(
        "m", bits_text("m").alias("t"), bit_count("m").alias("n"),
        any_bits("m", 0x80000000).alias("top")).collect()
    assert [r["m"] for r in out] == [1, 1 << 31, 32]
    assert out[0]["t"] == "0" * 31 + "1" and out[1]["t"] == "1" + "0" * 31
    assert [r["n"] for r in out] == [1, 1, 1] and [r["top"] for r in out] == [False, True, False]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(3, 0), (3, 4), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [3.0, 0.75, None]
    assert df.select(F.lit(1)).count() == 3
