"""Operators on documents against plain versions, with nulls, copies, long texts, clashing columns, empty tables."""

import hashlib
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import packing, quality
from tessera.llm.bpe import bpe_decode, bpe_digests, bpe_encode, read_ranks
from tessera.llm.jaccard import jaccard_join, one_per_class, runs_needed
from tessera.llm.langid import held_out, identify_language
from tessera.llm.sharding import feistel_shards
from tessera.llm.suffixdedup import merge_runs, suffix_dedup

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_suffix_dedup_matches_brute_force(docs, plain):
    got = suffix_dedup(docs).collect()
    want = brute.repeats(plain)
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert not r.span_starts
            continue
        kept = bytes(r.kept)
        assert (r.n_bytes, r.n_bytes - len(kept), len(r.span_starts), hashlib.sha256(kept).hexdigest()) == want[r.doc_id]


def test_suffix_dedup_null_bytes_and_spread_copies(spark):
    tail = "\0" * 40 + "ab" * 40
    rows = [(i, "\0" * (90 + i % 25) + tail + chr(97 + i % 26) * (i % 7)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r for r in suffix_dedup(df).collect()}
    for d, want in brute.repeats(rows).items():
        kept = bytes(got[d].kept)
        assert (got[d].n_bytes - len(kept), hashlib.sha256(kept).hexdigest()) == (want[1], want[3])


def test_suffix_dedup_large_buckets(spark, docs, plain, monkeypatch):
    """Buckets beyond the bound give the same result by grouping windows."""
    import random

    from tessera.llm import suffixdedup
    monkeypatch.setattr(suffixdedup, "BUCKET", 0)
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefgh ", k=400))
    extra = [(1000 + i, "".join(rng.choices("abcdefgh ", k=150)) + passage[i % 40:] + "".join(rng.choices("xyz", k=130))) for i in range(60)]
    rows = plain + extra
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string").repartition(5)
    want = brute.repeats(rows)
    for r in suffix_dedup(df).collect():
        kept = bytes(r.kept)
        assert (r.n_bytes, r.n_bytes - len(kept), len(r.span_starts), hashlib.sha256(kept).hexdigest()) == want[r.doc_id]


@pytest.mark.parametrize("kept", [1, 4_000_000])
def test_repeats_are_known_or_exchanged(monkeypatch, kept):
    """Every anchor that repeats is sure or meets another row of its key, however few hashes a task keeps."""
    import collections
    import random

    import pyarrow as pa

    from tessera.llm import suffixdedup
    monkeypatch.setattr(suffixdedup, "SEEN", kept)
    rng = random.Random(2)
    parts = ["".join(rng.choices("abcdef ", k=300)) for _ in range(12)]
    rows = [(i, "".join(rng.choices(parts, k=4))) for i in range(40)]
    tasks = [[pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows[k:k + 5]]), pa.array([t for _, t in rows[k:k + 5]])],
                                         ["id", "text"]) for k in range(a, a + 20, 5)] for a in (0, 20)]
    out = [r for t in tasks for b in suffixdedup._anchor_batches(t) for r in b.to_pylist()]
    n = collections.Counter(r["key"] for r in out)
    known = {(r["id"], r["place"] >> 16) for r in out if r["id"] is not None and (r["sure"] or n[r["key"]] > 1)}
    spots = collections.defaultdict(set)
    for d, t in rows:
        data = np.frombuffer(t.encode(), np.uint8)
        for q in suffixdedup.anchors(data, np.array([0, len(data)]))[1].tolist():
            spots[t[q:q + suffixdedup.GRAM]].add((d, q))
    assert known == {x for xs in spots.values() if len(xs) > 1 for x in xs}


def test_suffix_dedup_carries_columns_and_text(docs, no_docs):
    out = suffix_dedup(docs, as_text=True, carry=("lang", "key"))
    assert out.columns[-1] == "row" and out.count() == docs.count()
    assert suffix_dedup(no_docs).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = np.random.default_rng(1)
    for _ in range(50):
        runs, everything = [], []
        for _ in range(rng.integers(1, 7)):
            run = sorted(bytes(rng.integers(97, 99, rng.integers(0, 6)).astype(np.uint8)) for _ in range(rng.integers(1, 9)))
            lcp, rests = [0], run[0]
            for a, b in zip(run, run[1:]):
                n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                lcp.append(n)
                rests += b[n:]
            runs.append((np.array(lcp), np.array([len(x) for x in run]), rests))
            everything += run
        order, shared = merge_runs(runs)
        merged = [everything[i] for i in order]
        assert merged == sorted(everything) and sorted(order) == list(range(len(everything)))
        for a, b, n in zip(merged, merged[1:], shared[1:]):
            assert n == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_jaccard_join_matches_brute_force(docs, plain, no_docs):
    # the repeated row is one more document with its id
    want = brute.classes(plain)
    copies = {r.doc_id: r.n for r in docs.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    for r in jaccard_join(docs).collect():
        if r.doc_id is None:
            assert (r.class_id, r.n_links) == (None, 0)
        else:
            extra = sum(1 for d, n in copies.items() if d is not None and n > 1 and want[d][0] == want[r.doc_id][0])
            assert r.class_id == want[r.doc_id][0]
            assert want[r.doc_id][1] <= r.n_links <= want[r.doc_id][1] + extra
    assert jaccard_join(no_docs).count() == 0


@pytest.mark.parametrize("leaf", [1024, 60])
def test_jaccard_join_large_group_of_near_copies(spark, monkeypatch, leaf):
    """More near copies than a leaf and a block hold, and a line shared by many: splits, blocks, exact link counts."""
    from tessera.llm import jaccard
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    import random
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(700):
        w = list(base)
        if i % 5:
            w[rng.randrange(80)] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, "a line that very many texts share " + " ".join(f"v{rng.randrange(5000)}" for _ in range(30))) for i in range(300)]
    rows += [(2000 + i, rows[700 + i][1] + " end") for i in range(0, 300, 7)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.classes(rows)


def test_two_unlike_texts_of_one_id(spark):
    """Each text of a shared id finds its near copy; of unlike texts none is dropped."""
    import random
    rng = random.Random(9)
    one, two, three = (" ".join(f"{c}{rng.randrange(9000)}" for _ in range(80)) for c in "abc")
    rows = [(1, one), (1, two), (1, two), (1, ""), (2, one + " end"), (3, two + " end"), (4, three), (5, three + " end"), (5, two + " last"), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.class_id, r.n_links) for r in jaccard_join(df).collect()}
    # 5 joins the class of ``three`` to that of ``two``, as 1 joins that of ``two`` to that of ``one``
    assert got == {(1, 1, 1), (1, 1, 3), (1, 1, 0), (2, 1, 1), (3, 1, 3), (4, 1, 1), (5, 1, 1), (5, 1, 3), (6, 6, 0)}
    kept = sorted((r.doc_id, r.text) for r in one_per_class(df.where("text IS NOT NULL")).collect())
    assert kept == sorted([(1, one), (1, two), (1, ""), (4, three)])
    # a passage of one text of an id is not cut out of the other
    import corpus_pipeline
    rows = [(0, one), (1, one + " " + two), (1, three), (None, one)]
    docs = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    cut = {(r.doc_id, r.text) for r in corpus_pipeline.passage_stage(spark, docs, None).collect()}
    assert cut == {(0, one), (1, " " + two), (1, three), (None, one)}


def test_runs_follow_the_target():
    assert runs_needed(0.8, 0.9) <= runs_needed(0.8, 0.999) <= runs_needed(0.8, 0.999999)


def test_one_per_class(docs):
    kept = one_per_class(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and 5 in ids and 6 not in ids and 7 not in ids
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})


def test_quality_counts(docs, spark, no_docs):
    labels = spark.createDataFrame([(5, 1, "x"), (5, 0, "x"), (None, 1, None), (7, None, None)], "doc_id long, quality int, lang string")
    got = quality.quality_rules(docs, labels).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.counts(texts[r.doc_id])
    assert quality.quality_rules(no_docs, labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_cutoffs_are_certified(spark):
    """2,000 good texts without symbols, 200 bad ones full of them, 3 good ones with some: the rule must spare the good."""
    def text(i, sign):
        return " ".join(f"word{(i * 31 + j) % 997}{sign if j % 2 else ''}" for j in range(60))
    rows = [(i, text(i, "")) for i in range(2000)] + [(i, text(i, "####")) for i in range(2000, 2200)] + [(i, text(i, "#")) for i in range(2200, 2203)]
    docs = spark.createDataFrame([(i, t, "aa") for i, t in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 0 if 2000 <= i < 2200 else 1) for i, _ in rows], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality.quality_rules(docs, labels).collect()}
    assert not any(out[i].kept for i in range(2000, 2200))
    assert all(out[i].kept for i in range(2000)) and all(out[i].kept for i in range(2200, 2203))


def test_upper_bound_is_exact():
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** 0.01, abs=1e-9)
    assert quality.upper_bound(5, 5, 0.05) == 1.0
    # the binomial tail at the bound is delta
    from math import comb
    p = quality.upper_bound(3, 50, 0.01)
    assert sum(comb(50, i) * p ** i * (1 - p) ** (50 - i) for i in range(4)) == pytest.approx(0.01, abs=1e-9)
    assert quality.certified([(0, 5), (0, 9), (40, 50)], 1000, 0.01, 0.01) == 1
    assert quality.certified([(0, 5)], 10, 0.01, 0.01) is None


def test_language_edges(docs, no_docs):
    out = {(r.doc_id, r.lang_pred, r.score) for r in identify_language(docs, ~held_out()).collect()}
    by = {d: (p, s) for d, p, s in out if d is not None}
    assert by[0] == by[1] == by[2] == by[3] == ("und", 0.0)
    assert by[13][0] in ("aa", "bb") and all(0 <= s <= 1 for _, s in by.values())
    assert identify_language(no_docs, ~held_out()).count() == 0
    none = identify_language(docs, F.lit(False)).collect()
    assert {r.lang_pred for r in none} == {"und"} and len(none) == docs.count()


def test_language_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_language(d, ~held_out()).join(d.select("doc_id", "lang"), "doc_id").where(held_out())
    right, total = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 300 and right > 0.98


def test_bpe_matches_tiktoken_and_round_trips(docs, no_docs):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    tokens = bpe_encode(docs, RANKS)
    for r in tokens.collect():
        if r.doc_id is not None:
            assert r.ids == enc.encode_ordinary(texts[r.doc_id])
    for r in bpe_decode(tokens, RANKS).collect():
        if r.doc_id is not None:
            assert bytes(r.bytes).decode() == texts[r.doc_id]
    for r in bpe_digests(docs, RANKS).collect():
        if r.doc_id is not None:
            ids = enc.encode_ordinary(texts[r.doc_id])
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
                len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
    assert bpe_digests(no_docs, RANKS).count() == 0 and bpe_encode(no_docs, RANKS).count() == 0


def test_packing_holds_every_token(docs, no_docs):
    out = packing.pack_documents(docs, JSON).collect()
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    tok = Tokenizer.from_file(JSON)
    want = []
    for d, t in texts:
        ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
        start = 0
        for k, n in enumerate(packing.piece_lengths(len(ids), 1024)):
            want.append((d, k, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())))
            start += n
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in out)
    fill = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 1024
    assert len(fill) >= packing.lower_bound(np.array([r.length for r in out]), 1024)
    assert packing.pack_documents(no_docs, JSON).count() == 0


def test_packing_rounds_exchange_between_partitions(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 40)
    rng = np.random.default_rng(2)
    pieces = [(int(i), 0, 0, int(n), 0) for i, n in enumerate(rng.integers(200, 700, 400))]
    df = spark.createDataFrame(pieces, "id long, piece long, start long, length long, ids_crc32 long")
    one = packing._pack_round(df.withColumn("row", F.monotonically_increasing_id()), 0, 1024)
    single = one.select("group", "sequence").distinct().count()
    out = packing.pack_pieces(df).collect()
    assert sorted(r.id for r in out) == list(range(400))
    assert packing.lower_bound(np.array([p[3] for p in pieces]), 1024) <= len({r.sequence_id for r in out}) <= single


def test_bounds_hold_on_small_cases():
    rng = np.random.default_rng(4)
    for _ in range(100):
        room = int(rng.integers(5, 25))
        sizes = rng.integers(1, room + 1, rng.integers(1, 8))
        best = [len(sizes)]

        def place(k, bins):
            if len(bins) >= best[0] and k < len(sizes):
                return
            if k == len(sizes):
                best[0] = min(best[0], len(bins))
                return
            for i in range(len(bins)):
                if bins[i] + sizes[k] <= room:
                    bins[i] += sizes[k]
                    place(k + 1, bins)
                    bins[i] -= sizes[k]
            place(k + 1, bins + [sizes[k]])

        place(0, [])
        assert packing.lower_bound(sizes, room) <= best[0] <= len(packing.best_fit(sizes, room)[2])


def test_sharding_law_rows(docs, no_docs):
    out = feistel_shards(docs, shards=5).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
        if r.doc_id is not None:
            b = texts[r.doc_id].encode()
            assert (r.size, r.text_crc32) == (len(b) + 1, zlib.crc32(b))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and len(out) == docs.count()
    assert sorted(r.number for r in out) == list(range(len(out)))
    again = feistel_shards(docs.repartition(5), shards=5).collect()
    assert sorted((str(r.doc_id), r.size, r.place) for r in out) == sorted((str(r.doc_id), r.size, r.place) for r in again)
    assert feistel_shards(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1001])
def test_permutation_is_a_bijection(spark, n):
    from tessera.llm.sharding import permuted
    got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), n, 9)).collect()]
    assert sorted(got) == list(range(n))
    assert n < 50 or got != list(range(n))
