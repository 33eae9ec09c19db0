"""Suffix dedup: which buckets are merged, and many copies of one row."""

import hashlib
import random
import time

import brute
from pyspark.sql import functions as F

from tessera.llm import suffixdedup
from tessera.llm.suffixdedup import bucketed_runs, suffix_dedup


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n))


def corpus(seed=3):
    """Copies in pairs, and a passage under ever new contexts: its edges are one hot substring each."""
    rng = random.Random(seed)
    rows = [(i, words(rng, 120)) for i in range(60)]
    rows += [(100 + i, words(rng, 5) + rows[i][1] + words(rng, 5)) for i in range(60)]
    passage = words(rng, 60)
    return rows, rows + [(1000 + i, words(rng, 30) + passage + words(rng, 30)) for i in range(150)]


def test_ordinary_buckets_are_merged_at_any_partition_size(spark, monkeypatch):
    """One shuffle partition for everything, small bounds: buckets grow in number, and none but the hot ones leaves the merge."""
    monkeypatch.setattr(suffixdedup, "ANCHORS", 20)
    monkeypatch.setattr(suffixdedup, "BUCKET", 100)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        plain, hot = corpus()
        for rows, most in ((plain, 0.0), (hot, 0.6)):
            df = spark.createDataFrame(rows, "id long, text string").repartition(3)
            runs = bucketed_runs(df).where("n > 0").select("bucket", "n", "total").collect()
            total = sum(r.n for r in runs)
            beyond = sum(r.n for r in runs if r.total > 100)
            assert total > 400 and beyond <= most * total and (beyond > 0) == (most > 0)
            assert len({r.bucket for r in runs}) > 10
            want = brute.repeats(rows)
            for r in suffix_dedup(df, "id").collect():
                kept = bytes(r.kept)
                assert (r.n_bytes, r.n_bytes - len(kept), len(r.span_starts), hashlib.sha256(kept).hexdigest()) == want[r.id]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_copies_of_one_row_cost_alike(spark):
    """Eight times the copies of a row take no more than their share longer, and no list grows with them."""
    rng = random.Random(5)
    text = words(rng, 300)
    text = text + " " + text

    def run(n):
        df = spark.range(n).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text")).repartition(4)
        t = time.time()
        out = suffix_dedup(df).agg(F.count("*").alias("n"), F.max(F.size("span_starts")).alias("spans"), F.count_distinct("kept").alias("kept")).first()
        return out, time.time() - t

    run(50)
    (small, a), (large, b) = run(500), run(4000)
    assert (small.n, large.n) == (500, 4000) and small.spans == large.spans == 1 and small.kept == large.kept == 1
    assert b < 8 * a
