"""Passage dedup against a plain version, and its automata against plain search."""

import collections
import hashlib
import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import passages
from tessera.llm.passages import passage_dedup


def agrees(got, rows):
    want = brute.passages([(d, t) for d, t in rows if d is not None])
    for r in got:
        removed = sum(b - a for a, b in zip(r.span_starts, r.span_ends))
        if r.doc_id is None:
            assert removed == 0
            continue
        assert (r.n_words, removed, hashlib.sha256(r.kept.encode()).hexdigest()) == want[r.doc_id, r.row.text]
        words = brute.WORD.findall(r.row.text or "")
        gone = {i for a, b in zip(r.span_starts, r.span_ends) for i in range(a, b)}
        assert r.kept == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_matches_brute_force(docs, no_docs, plain):
    got = passage_dedup(docs, carry=("text", "key")).collect()
    assert len(got) == docs.count()
    agrees(got, [*plain, (None, None)])
    assert passage_dedup(no_docs).count() == 0


def corpus(n=150, seed=5):
    """Passages under changing contexts, inner repeats, one very common passage, ids with two texts, copies of rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é漢", "a.b", "x,"]
    parts = [rng.choices(vocabulary, k=rng.randint(8, 40)) for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choices(vocabulary, k=rng.randint(0, 20)) + (parts[0] if i % 3 == 0 else rng.choice(parts))
        rows.append((rng.randint(0, n), rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(n + 1, "la " * 200), (n + 2, "la " * 14), (n + 2, "la " * 30), (n + 3, " ".join("abcdefghijklmnop"))]
    return rows + rows[:9]


@pytest.mark.parametrize("hot", [passages.HOT, 0])
def test_changing_contexts_and_hot_grams(spark, monkeypatch, hot):
    """With HOT 0 every gram is hot: all windows go to shards of their own; the result is the same."""
    monkeypatch.setattr(passages, "HOT", hot)
    rows = corpus()
    agrees(passage_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), carry=("text",)).collect(), rows)


def test_numerous_copies_of_a_passage(spark):
    """More copies in one task than NUMEROUS, each with its own neighbours, and a gram that is hot by its number alone."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices("abcdefghij", k=i % 15) + passage[i % 7:] + rng.choices("klmnop", k=i % 11))) for i in range(400)]
    for parts in (1, 9):
        agrees(passage_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), carry=("text",)).collect(), rows)


@pytest.mark.parametrize("seed", range(4))
def test_tasks_of_any_bounds(monkeypatch, seed):
    """The steps in one process, with small bounds: runs, flushes and shards of a few rows."""
    rng = random.Random(seed)
    for name, most in (("FLUSH", 60), ("NUMEROUS", 4), ("RUN", 30), ("SHARD", 12), ("HELD", 50)):
        monkeypatch.setattr(passages, name, rng.randint(1, most))
    rows = sorted(set(corpus(60, seed)))
    batches = [pa.RecordBatch.from_pydict({"id": [d for d, _ in rows[k:k + 7]], "text": [t for _, t in rows[k:k + 7]]}) for k in range(0, len(rows), 7)]
    found = [r for half in (batches[::2], batches[1::2]) for b in passages._anchor_batches(iter(half)) for r in b.to_pylist()]
    top, among = collections.Counter(), collections.defaultdict(set)
    for r in found:
        top[r["key"]] = max(top[r["key"]], r["n"])
        among[r["key"]] |= {r["id"]} - {None}
    places = collections.defaultdict(set)
    for r in found:
        if r["id"] is not None and (r["n"] == 0 or top[r["key"]] > 1 or len(among[r["key"]]) > 1):
            places[r["id"]].add(r["place"] + (r["n"] == 0 or top[r["key"]] > passages.NUMEROUS))
    withs = [pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([sorted(places[i]) for i in b.column(0).to_pylist()], pa.list_(pa.int64()))],
                                        ["id", "text", "places"]) for b in batches]
    labels = np.arange(rng.randint(1, 4))
    made = pa.Table.from_batches([b for half in (withs[::2], withs[1::2]) for b in passages._segment_batches(iter(half), labels)])
    spans = collections.defaultdict(set)
    for b in passages._span_batches(iter(made.sort_by("part").to_batches(max_chunksize=5))):
        for r in b.to_pylist():
            spans[r["id"]].add(r["span"])
    cut = pa.Table.from_batches(list(passages._cut_batches(
        pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([sorted(spans[i]) for i in b.column(0).to_pylist()], pa.list_(pa.int64()))],
                                   ["id", "text", "spans"]) for b in batches)))
    want = brute.passages(rows)
    for (d, t), r in zip(rows, cut.to_pylist()):
        removed = sum(b - a for a, b in zip(r["span_starts"], r["span_ends"]))
        assert (r["n_words"], removed, hashlib.sha256(r["kept"].encode()).hexdigest()) == want[d, t]


def test_equal_hashes_are_not_equal_words(monkeypatch):
    """Candidates that only share hashes are told apart by their words."""
    texts = pa.array([" ".join("abcdefghijklm"), " ".join("abcdefghijklm"), " ".join("abcdefghijklX"), " ".join("nopqrstuvwxyz")])
    segment, word, size = passages.shard_spans(np.array([1, 2, 3, 4]), texts)
    assert (segment.tolist(), word.tolist(), size.tolist()) == ([1], [0], [13])


def test_phrases_are_maximal_and_located():
    """Windows that always occur together are one phrase; an automaton finds it wherever it is."""
    a = [f"a{i}" for i in range(20)]
    texts = pa.array([" ".join(x) for x in (a, ["x"] + a, a[:15] + ["y"], a[3:] + a)])
    codes, first = passages._coded(texts)
    begin, end, low = passages.confirm(codes, first, np.array([5, 6, 7, 4]))
    found = sorted((b - s, int(x)) for s, b, x in zip(begin.tolist(), end.tolist(), low))
    assert found == [(15, 4), (17, 4)]                   # windows 0 to 2 are in all four texts, 3 to 7 not in the third
    segment, word, size = passages.shard_spans(np.array([5, 6, 7, 4]), texts)
    covered = collections.defaultdict(set)
    for s, w, n in zip(segment.tolist(), word.tolist(), size.tolist()):
        covered[s] |= set(range(w, w + n))
    assert covered == {0: set(range(20)), 1: set(range(1, 21)), 2: set(range(15))}
