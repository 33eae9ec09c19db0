"""Language model against finite differences, rejected languages, split articles, sublinear search, hot rows, a plain Feistel."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import ann, sharding
from tessera.llm.html import extract, extract_main_text
from tessera.llm.langid import (WIDTHS, WINDOW, ByteCNN, accepted, coverage, cutoffs, held_out, identify_language, known_triples,
                                learn_languages, predict_languages, predict_windows)

SF = "/root/testdata/sf0.01"


# ---- language ------------------------------------------------------------------------------------

def batch(n=6, outs=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 256, (n, WINDOW)).astype(np.uint8)
    x[0, 100:] = 0
    return x, rng.integers(0, outs, n)


def test_tables_compute_the_network():
    """The table form of the convolutions gives the loss of the training form, and the probabilities of a plain loop."""
    x, y = batch()
    net = ByteCNN(3)
    prob = predict_windows(x, net.tables(), net.p["V"], net.p["c"])
    loss, _ = net.step(x, y)
    assert loss == pytest.approx(float(-np.log(prob[np.arange(len(y)), y] + 1e-9).mean()), rel=1e-5)
    for i in range(len(x)):
        e, pooled = net.p["E"][x[i]], []
        for w in WIDTHS:
            z = [np.concatenate(e[t:t + w]) @ net.p[f"W{w}"] + net.p[f"b{w}"] for t in range(WINDOW - w + 1)]
            pooled.append(np.maximum(np.max(z, axis=0), 0))
        out = np.exp(np.concatenate(pooled) @ net.p["V"] + net.p["c"])
        assert prob[i] == pytest.approx(out / out.sum(), rel=1e-4)


def test_gradients_match_finite_differences():
    x, y = batch(seed=4)
    net = ByteCNN(3)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    _, g = net.step(x, y)
    rng = np.random.default_rng(1)
    for k, v in net.p.items():
        used = np.argwhere(np.abs(g[k]) > 1e-6)
        for at in map(tuple, used[rng.permutation(len(used))[:6]]):
            old, eps = v[at], 1e-6
            v[at] = old + eps
            up, _ = net.step(x, y)
            v[at] = old - eps
            down, _ = net.step(x, y)
            v[at] = old
            assert g[k][at] == pytest.approx((up - down) / (2 * eps), rel=2e-3, abs=1e-7)


def test_coverage_counts_known_triples():
    rng = random.Random(3)
    known = "".join(rng.choices("abcd ", k=WINDOW))
    table = known_triples(np.frombuffer(known.encode(), np.uint8)[None])
    texts = [known, known[10:90], "", "a", "ab", "zzzzz", known[:50] + "ZZZ" + known[50:100], "é" * 9]
    data, sizes = "".join(texts).encode(), [len(t.encode()) for t in texts]
    got = coverage(np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(sizes)]), table)
    triples = {known[i:i + 3] for i in range(len(known) - 2)}
    for t, c in zip(texts, got):
        b = t.encode().decode("latin-1")
        n = max(len(b) - 2, 0)
        assert c == pytest.approx(sum(b[i:i + 3] in triples for i in range(n)) / n if n else 0)


FOREIGN = ["Η γλώσσα είναι ένα σύστημα επικοινωνίας που χρησιμοποιούν οι άνθρωποι για να εκφράσουν σκέψεις " * 3,
           "これは日本語の文章です。言語を判定するためのテストです。" * 5, "Это русский текст для проверки определения языка " * 4,
           "xq zzv kkw qqj vvx zzk wwq xxj kqz jjv xkq zvw " * 8, "aaaaaaaa bbbb cccccc dddd " * 10]


def test_language_stage_rejects_foreign_text_and_junk(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").select(corpus_pipeline.COLUMNS)
    ids = real.agg(F.max("doc_id")).first()[0]
    odd = [(ids + 1 + i, t, None, "s", len(t or "")) for i, t in enumerate([*FOREIGN, None, "", "12 ## 34"])]
    docs = corpus_pipeline.quality_stage(spark, real, SF).unionByName(spark.createDataFrame(odd, real.schema))
    clean = docs.where(F.col("doc_id") <= ids).count()
    kept = corpus_pipeline.language_stage(spark, docs, SF)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert kept.where(F.col("doc_id") > ids).isEmpty() and kept.count() >= 0.99 * clean


def test_stages_take_odd_rows_and_empty_tables(spark, docs, no_docs):
    labels = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, labels)
        rows = out.collect()
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS and len(rows) <= docs.count()
        else:
            assert len({r.doc_id for r in rows}) == len({r.doc_id for r in docs.select("doc_id").collect()})
        assert stage(spark, no_docs, labels).count() == 0
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, labels).collect()}
    assert 5 in kept and not kept & {0, 1, 2, 3, 4, 19, 20}
    found = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, labels).collect()}
    assert not found & {0, 1, 2, 3}
    nobody = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_stage(spark, nobody, labels).count() == 0


def test_cutoffs_hold_the_stated_rate(spark):
    rng = random.Random(6)
    rows = [("aa" if i % 2 else "bb", rng.random(), 0.8 + 0.2 * rng.random()) for i in range(5000)] + [("und", 0.0, 0.0)] * 50
    df = spark.createDataFrame(rows, "lang_pred string, score double, coverage double")
    cuts = cutoffs(df, 0.1)
    assert set(cuts) == {"aa", "bb"}
    kept = df.where(accepted(cuts)).groupBy("lang_pred").count().collect()
    assert all(0.9 * 2500 <= r["count"] <= 0.92 * 2500 for r in kept) and len(kept) == 2
    odd = df.unionByName(spark.createDataFrame([("aa", 0.0, 0.01)] * 500, df.schema))      # with a wrong label
    assert cutoffs(odd, 0.1)["aa"][1] > 0.6


def test_model_and_prediction_apart(spark, docs):
    model = learn_languages(docs, ~held_out())
    a = sorted(map(str, predict_languages(docs, model).collect()))
    assert a == sorted(map(str, identify_language(docs, ~held_out()).collect()))
    assert all(0 <= r.coverage <= 1 for r in predict_languages(docs, model).collect())


# ---- extraction ----------------------------------------------------------------------------------

def prose(word, n=30):
    return " ".join(f"{word}{i} of the article," for i in range(n))


def test_split_containers_are_one_article(spark):
    """Title, introduction and body in containers of their own, on a host with votes: nothing of them is lost."""
    page = ("<body><div class='menu'><a href=/>Home</a></div><div class='content'><h1>Title %d</h1><div class='intro'><p>" + prose("intro", 8)
            + "</p></div><div class='body'><p>" + prose("long", 60) + "</p></div></div><div class='sidebar'><p>" + prose("side", 9) + "</p></div>"
            "<div class='footer'>foot</div></body>")
    df = spark.createDataFrame([(i, f"http://split.example/{i}", page % i) for i in range(20)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_main_text(df).collect()}
    assert got == {i: "\n".join([f"Title {i}", prose("intro", 8), prose("long", 60)]) for i in range(20)}


def test_sibling_articles_are_all_taken(spark):
    page = "<body><main><article class='a'><p>%s</p></article><article class='b'><p>%s</p></article><article class='card'><a href=x>%s</a></article></main></body>"
    one, two, links = prose("one"), prose("two", 25), prose("link")
    assert extract(page % (one, two, links), []) == f"{one}\n{two}"
    df = spark.createDataFrame([(i, f"http://parts.example/{i}", page % (one, two, links)) for i in range(9)], "page_id long, url string, html string")
    assert {r.text for r in extract_main_text(df).collect()} == {f"{one}\n{two}"}


def test_weak_words_spare_headings_and_paragraphs(spark):
    page = ("<body><article><h2 class='header'>Heading</h2><p class='share-price'>The price of a share rose.</p><p>" + prose("text")
            + "</p><p class='share'><a href=a>Share this</a> <a href=b>Tweet this</a></p><div class='share-bar'>Share</div><p class='ad'>Buy</p></article></body>")
    want = f"Heading\nThe price of a share rose.\n{prose('text')}"
    assert extract(page, []) == want
    df = spark.createDataFrame([(i, f"http://words.example/{i}", page) for i in range(9)], "page_id long, url string, html string")
    assert {r.text for r in extract_main_text(df).collect()} == {want}


def test_climbing_stops_at_boilerplate():
    body = "<div class='text'><p>" + prose("text", 40) + "</p></div>"
    assert extract(f"<body><div>{body}<div class='related'><p>{prose('more')}</p></div><ul><li><a href=x>link words here</a></ul></div></body>", []) == prose("text", 40)
    assert extract(f"<body><h1>Title</h1>{body}<footer>foot</footer></body>", []) == f"Title\n{prose('text', 40)}"
    assert extract(f"<body><div><p>tiny</p></div>{body}</body>", []) == prose("text", 40)


# ---- search --------------------------------------------------------------------------------------

def test_plan_grows_with_the_rows():
    assert ann.plan_tables(10_000, 128, 20, 3) == (1, 20, 3)
    assert ann.plan_tables(128 * ann.BUCKET, 128, 20, 3)[0] == 1
    hashes, tables, probes = ann.plan_tables(10 ** 9, 128, 20, 3)
    assert (hashes, probes) == (3, 27) and 10 ** 9 / 128 ** hashes <= ann.BUCKET
    # the chance that one of the tables finds a row stays what it was
    found = 1 - 0.05 ** (1 / 20)
    assert 1 - (1 - found ** hashes) ** tables >= 0.95 > 1 - (1 - found ** hashes) ** (tables - 1)


@pytest.mark.parametrize("n", [2_000, 16_000])
def test_search_compares_a_part_and_finds_the_near(spark, n):
    """Recall of 0.9 with well under n comparisons a query, at two sizes of the same kind of data."""
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(n // 10, 32))
    x = centres[rng.integers(0, len(centres), n)] + 0.35 * rng.normal(size=(n, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ask = np.arange(0, n, 100)
    keys = np.stack([ann.buckets(x, t, 1, 1)[:, 0] for t in range(20)])
    compared = sum(int(np.isin(keys[t], row).sum()) for t in range(20) for row in ann.buckets(x[ask], t, 1, 3))
    assert compared / len(ask) < 1.1 * n
    df = spark.createDataFrame([(int(i), r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    found = collections.defaultdict(set)
    for r in ann.nearest_neighbours(df, F.col("vec_id") % 100 == 0).collect():
        found[r.query_id].add(r.vec_id)
    hits = 0
    for q in ask:
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        hits += len(found[int(q)] & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits >= 0.9 * 10 * len(ask)


def test_short_queries_meet_their_length_only(spark):
    rows = [(i, [1.0, float(i)]) for i in range(6)] + [(10 + i, [1.0, 0.0, float(i)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = ann.nearest_neighbours(df, F.col("vec_id") == 2).collect()
    assert sorted(r.vec_id for r in out) == [0, 1, 3, 4, 5]


# ---- sharding ------------------------------------------------------------------------------------

def test_permutation_equals_a_plain_feistel(spark):
    """Number to place, by loops over the same keyed hash."""
    n, seed = 137, 9
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    table = {(r.x, r.r): r.h for r in spark.range(max(a, b)).select(F.col("id").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(sharding.ROUNDS - 1))).alias("r"))
             .select("x", "r", F.xxhash64("x", "r", F.lit(seed)).alias("h")).collect()}

    def once(x):
        high, low = divmod(x, b)
        for r in range(sharding.ROUNDS):
            if r % 2 == 0:
                high = (high + table[low, r]) % a
            else:
                low = (low + table[high, r]) % b
        return high * b + low

    def place(x):
        x = once(x)
        while x >= n:
            x = once(x)
        return x

    got = {r.id: r.y for r in spark.range(n).select("id", sharding.permuted(F.col("id"), n, seed).alias("y")).collect()}
    assert got == {x: place(x) for x in range(n)}


def test_copies_are_numbered_without_meeting(spark, monkeypatch):
    """A third of all rows are one text without id: counted, numbered in chunks, shards even, no task holds them."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 500)
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
                                  F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), "id")).otherwise(F.lit("copy")).alias("text")).repartition(7)
    out = sharding.feistel_shards(df).collect()
    assert sorted(r.number for r in out) == list(range(9000)) and sorted(r.place for r in out) == list(range(9000))
    sizes = collections.Counter(r.shard for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert sum(r.doc_id is None for r in out) == 3000 and len({r.doc_id for r in out}) == 6001
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered, n = sharding.number_rows(df)
        most = numbered.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert n == 9000 and most < 3000
