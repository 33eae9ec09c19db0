"""Phrase collocations against a plain version, and the FM-index against plain counting."""

import collections
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import phrases
from tessera.llm.phrases import BidirectionalIndex, FMIndex, collocations, phrase_counts


def listed(df, **kw):
    return {(r.stratum, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations(df, **kw).collect()}


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    names = ["new york city", "New York", "à la carte", "a a a a", "of the", "漢 字", "x y z"]
    vocabulary = ["of", "the", "a", "b'c", "É", "é", "new", "york", "city", "q"] + [f"v{i}" for i in range(30)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 25)):
            words += [rng.choice(names) if rng.random() < 0.3 else rng.choice(vocabulary), rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "; ", "!"])]
        rows.append((i % 50, "".join(words), [None, "und", "en", "en", "fr"][i % 5], "stratum", 1, 2))
    rows += [(None, None, None, None, None, None), (1, "", "de", None, None, None), (2, "to be or not " * 3000, "la", None, None, None)]
    return rows


SCHEMA = "doc_id long, text string, lang string, stratum string, f long, gid long"


@pytest.mark.parametrize("depth,least,top", [(3, 10, 2000), (2, 3, 2000), (4, 5, 25)])
def test_collocations_match_plain_version(spark, depth, least, top):
    rows = corpus()
    got = listed(spark.createDataFrame(rows, SCHEMA).repartition(5), depth=depth, min_count=least, top=top)
    assert got == brute.phrase_lists([(r[2], r[1]) for r in rows], depth, least, top)
    assert any(len(v[0].split(" ")) == depth for v in got.values())


def test_documents_and_empty_table(spark, docs, no_docs):
    want = brute.phrase_lists([(r.lang, r.text) for r in docs.collect()])
    assert listed(docs) == want and want
    assert listed(no_docs) == {}


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits."""
    a, l, r = 3_037_000_501, 9_000_000_007, 3_037_000_507
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(phrases._floor_score("l", "r").alias("s"))
    assert df.first().s == 10 ** 6 * a * a // (l * r)


def naive(text, n):
    """Phrases of n symbols without 0 of a circular text."""
    t = text.tolist()
    c = collections.Counter(tuple(t[(i + j) % len(t)] for j in range(n)) for i in range(len(t)))
    return {k: v for k, v in c.items() if 0 not in k}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60), st.integers(2, 5))
def test_bidirectional_extension(symbols, depth):
    text = np.array([0, *symbols])
    index = BidirectionalIndex(text, depth)
    for n, (words, count) in enumerate(index.phrases(depth), 2):
        assert {tuple(w): c for w, c in zip(words.tolist(), count.tolist())} == naive(text, n)
    # to the left and to the right in turns: the same phrases with the same intervals
    alphabet = np.unique(text[text > 0])
    fore, back, size = index.single(alphabet)
    words = alphabet[:, None]
    for k in range(depth - 1):
        if k % 2:
            owner, symbol, fore, back, size = index.extend_right(fore, back, size)
            words = np.concatenate([words[owner], symbol[:, None]], 1)
        else:
            owner, symbol, fore, back, size = index.extend_left(fore, back, size)
            words = np.concatenate([symbol[:, None], words[owner]], 1)
        assert {tuple(w): c for w, c in zip(words.tolist(), size.tolist())} == naive(text, k + 2)
        order = [tuple(np.roll(text, -i)[:k + 2]) for i in phrases._context_order(text, depth)]
        for w, f, c in zip(words.tolist(), fore.tolist(), size.tolist()):
            assert order[f:f + c] == [tuple(w)] * c and order.count(tuple(w)) == c


def test_wide_alphabets_are_renamed():
    rng = np.random.default_rng(2)
    text = np.concatenate([[0], rng.integers(0, 1 << 30, 400), rng.integers(0, 3, 300)])
    order = phrases._context_order(text, 4)
    keys = [tuple(np.roll(text, -i)[:4]) for i in order]
    assert keys == sorted(keys)
    assert FMIndex(text, 3).n == len(text)


def test_shards_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "SHARD", 10)
    rng = random.Random(3)
    text = "".join(rng.choice(["a ", "b ", "c ", "d. "]) for _ in range(400)) + ". " + "z " * 50
    data = np.frombuffer(text.encode(), np.uint8)
    words, fresh = phrases.words_of(data, np.array([0, len(data)]))
    held = phrases._Held()
    held.add(words, fresh)
    back, sizes = [], []
    for names, counts, size, row in held.shards():
        ids = np.frombuffer(pa.decompress(row, decompressed_size=size, codec="zstd"), np.int32)
        assert ids[0] == 0 and counts.sum() == (ids > 0).sum()
        sizes.append(int(counts.sum()))
        back += [None if i == 0 else names[int(i) - 1].as_py() for i in ids]
    pieces = [p.split() for p in text.split(".") if p.split()]
    assert back == [x for p in pieces for x in [None, *p]]
    assert max(sizes[:-1]) <= 20 and sizes[-1] >= 50


def test_counts_and_totals(spark):
    rows = corpus(60, 4)
    words, found, totals = phrase_counts(spark.createDataFrame(rows, SCHEMA).repartition(4), min_count=4)
    plain = collections.Counter()
    for r in rows:
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
        for piece in brute.re.split(r"[.,;:!?\n\x0b\x0c\r]", t):
            w = brute.re.findall(r"[^ \t]+", piece)
            for k in (1, 2, 3):
                plain.update((r[2] or "und", *w[i:i + k]) for i in range(len(w) - k + 1))
    name = {r.gid: (r.stratum, r.word) for r in words.collect()}
    got = {(name[r.w1][0], *(name[g][1] for g in (r.w1, r.w2, r.w3) if g >= 0)): r.f for r in found.collect()}
    assert got == {k: v for k, v in plain.items() if len(k) > 2 and v >= 4}
    assert {r.stratum: r.n for r in totals.collect()} == dict(sum((collections.Counter({k[0]: v}) for k, v in plain.items() if len(k) == 2), collections.Counter()))
