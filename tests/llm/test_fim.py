"""Fill-in-middle against a plain version: nulls, marks, long texts, characters outside the basic plane."""

import random

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm.fim import fill_in_middle, restore

SCHEMA = "doc_id long, text string, n string, form string, output string, hash string"


def outcome(df, **kw):
    out = fill_in_middle(df, carry=("text",), **kw)
    marks = {"marks": kw["marks"]} if "marks" in kw else {}
    return out.withColumn("back", restore(F.col("output"), F.col("form"), **marks)).collect()


def check(rows, want):
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want(r.doc_id, r.row.text)
        assert r.back == (r.row.text or "")


def test_fill_in_middle_matches_plain_version(spark, docs, no_docs):
    rows = outcome(docs)
    assert len(rows) == docs.count()
    check(rows, brute.fill_in_middle)
    assert outcome(no_docs) == []


def test_all_forms_marks_and_odd_characters(spark):
    rng = random.Random(8)
    parts = ["<P>", "<S>", "<M>", "<", ">", "P>", "<S", "word", "Ünï", "漢", "😀", "\n", "\r\n", " ", "$1", "\\", "\0", "x" * 70]
    rows = [(i if i % 17 else None, "".join(rng.choices(parts[3:] if i % 4 else parts, k=rng.randint(0, 30))), "c", "c", "c", "c")
            for i in range(600)]
    got = outcome(spark.createDataFrame(rows, SCHEMA).repartition(4))
    check(got, brute.fill_in_middle)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_very_long_text_and_repeated_ids(spark):
    rng = random.Random(9)
    long = "".join(rng.choices(["a", "bcd", " ", "é", "\n", "9"], k=1_500_000))
    rows = [(i, t, None, None, None, None) for i in (3, 4, 5) for t in (long, long[:50], long)]
    check(outcome(spark.createDataFrame(rows, SCHEMA)), brute.fill_in_middle)


def test_other_marks_and_rates(spark):
    marks = ("[a$1]", "[b\\]", "[c]")
    rows = [(i, f"some {i} words [c" + "]" * (i % 3 == 0), None, None, None, None) for i in range(200)]
    got = outcome(spark.createDataFrame(rows, SCHEMA), marks=marks, plain_percent=0, spm_percent=100, seed="x")
    assert {r.form for r in got if "[c]" not in r.row.text} == {"spm"}
    assert all(r.back == r.row.text for r in got)
    for bad in (("<P>", "<S>", "<S>"), ("aba", "x", "y"), ("xy", "yx", "z"), ("", "a", "b"), ("abc", "b", "z")):
        with pytest.raises(ValueError):
            fill_in_middle(spark.createDataFrame(rows, SCHEMA), marks=bad)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aZ <PSM>é\n😀$\\")), max_size=25), min_size=1, max_size=40))
def test_round_trip_of_any_texts(spark, texts):
    rows = [(i, t, None, None, None, None) for i, t in enumerate(texts)]
    check(outcome(spark.createDataFrame(rows, SCHEMA)), brute.fill_in_middle)
