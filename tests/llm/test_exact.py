"""Equal hashes are not equal texts: two words that share a polynomial hash, as documents, words, lines and pre-tokens."""

import hashlib
import zlib

import brute
import numpy as np
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import quality
from tessera.llm.bpe import bpe_digests, read_ranks
from tessera.llm.common import exact_codes, joined_codes, prefix_sums, span_hash, word_keys, word_spans
from tessera.llm.jaccard import jaccard_join, one_per_class
from tessera.llm.packing import pack_documents
from tessera.llm.passages import passage_dedup
from tessera.llm.suffixdedup import suffix_dedup

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ONE, TWO = brute.alike()


def texts():
    """The words alone, side by side, as lines, in three-word windows, inside other text."""
    filler = " ".join(f"w{i}" for i in range(60))
    return [ONE, TWO, f"{ONE} {TWO}", f"{ONE}\n{TWO}", f"{ONE}\n{TWO}\n{ONE}", f"a {ONE} b a {TWO} b", f"a {ONE} b a {ONE} b",
            f"{filler} {ONE}", f"{filler} {TWO}", f"{ONE} {filler}\n{TWO} {filler}", " ".join([ONE] * 14), " ".join([TWO] * 14)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").repartition(2)


def test_the_words_share_a_hash_and_no_key():
    data = np.frombuffer(f"{ONE} {TWO}".encode(), np.uint8)
    starts, ends, first = word_spans(data, np.array([0, len(data)]))
    a, b = span_hash(prefix_sums(data), starts, ends)
    assert a == b and ONE != TWO
    x, y = word_keys(data, starts, ends)
    assert x != y


def test_codes_are_equal_where_strings_are():
    rng = np.random.default_rng(1)
    strings = [bytes(rng.integers(97, 99, rng.integers(0, 4)).astype(np.uint8)) for _ in range(500)]
    code, names = exact_codes(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]))
    assert [names[int(c)].as_py() for c in code] == strings and len(names) == len(set(strings))
    wide = rng.integers(0, 1 << 40, 300)
    columns = [wide[rng.integers(0, 20, 1000)], rng.integers(0, 1 << 30, 40)[rng.integers(0, 40, 1000)], rng.integers(0, 3, 1000)]
    key = joined_codes(*columns)
    rows = list(zip(*(c.tolist() for c in columns)))
    assert len(set(zip(key.tolist(), rows))) == len(set(rows)) == len(set(key.tolist()))


def test_bpe_decodes_to_the_text(frame):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    for r in bpe_digests(frame, RANKS).collect():
        t = texts()[r.doc_id]
        ids = enc.encode_ordinary(t)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_packing_has_the_tokenizers_ids(spark):
    rows = texts() + ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n b", "<|endoftext", ONE + "<|endoftext|>" + TWO, None]
    tok = Tokenizer.from_file(JSON)
    assert tok.encode("one <|endoftext|> two", add_special_tokens=False).ids == [505, 220, 50256, 734]
    out = pack_documents(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), JSON).collect()
    got = {}
    for r in out:
        got[r.doc_id, r.piece] = (r.start, r.length, r.ids_crc32)
    for d, t in enumerate(rows):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for k in range(len([x for x in got if x[0] == d])):
            start, n, crc = got[d, k]
            assert start == at and crc == zlib.crc32(ids[start:start + n].tobytes())
            at += n
        assert at == len(ids)


def test_sets_of_unlike_words_are_apart(frame):
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join(frame).collect()}
    assert got == brute.classes(list(enumerate(texts())))
    assert got[0] == (0, 0) and got[1] == (1, 0)
    assert {r.doc_id for r in one_per_class(frame).collect()} >= {0, 1, 7}


def test_lines_and_windows_are_counted_by_their_bytes(spark, frame):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for r in quality.quality_rules(frame.withColumn("lang", F.lit("aa")), labels).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.counts(texts()[r.doc_id])


def test_removal_is_by_bytes(frame):
    want = brute.repeats(list(enumerate(texts())))
    for r in suffix_dedup(frame).collect():
        assert (r.n_bytes, r.n_bytes - len(r.kept), len(r.span_starts), hashlib.sha256(bytes(r.kept)).hexdigest()) == want[r.doc_id]
    want = brute.passages(list(enumerate(texts())))
    for r in passage_dedup(frame).collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == want[r.doc_id, texts()[r.doc_id]][2]


def test_verdicts_match_plain_version(spark):
    """Three strata, one of them null and one named by the empty string; repeated rows and labels count once."""
    import random
    rng = random.Random(12)
    rows, labels = [], {}
    for i in range(5200):
        bad = rng.random() < 0.2
        words = [f"{'W' if rng.random() < (0.7 if bad else 0.05) else 'w'}{rng.randrange(900)}{'#' * rng.randrange(4) if bad and rng.random() < 0.8 else ''}"
                 for _ in range(rng.randint(45, 70))]
        rows.append((i, " ".join(words), [None, "", "en", "few"][0 if i % 3 == 0 else 1 if i % 3 == 1 else 3 if i % 53 == 0 else 2]))
        if rng.random() < 0.95:
            labels[i] = int(not bad)
    want = brute.kept(rows, labels, quality.RULES, quality.LADDER, quality.COST)
    docs = spark.createDataFrame(rows + rows[:700], "doc_id long, text string, lang string")
    told = spark.createDataFrame([*labels.items(), *list(labels.items())[:400]], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality.quality_rules(docs, told).collect()}
    assert got == want and 200 < sum(not v for v in want.values()) < 4000


def test_bound_of_many_rejections_is_quick_and_exact():
    import time
    from fractions import Fraction
    from math import comb
    t = time.time()
    p = quality.upper_bound(3000, 100_000, 1e-4)
    assert time.time() - t < 0.2 and 0.03 < p < 0.034
    for k, n in ((0, 7), (6, 7), (13, 400), (120, 150)):
        p = Fraction(quality.upper_bound(k, n, 0.02))
        assert float(sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))) == pytest.approx(0.02, rel=1e-9)
