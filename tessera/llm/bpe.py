"""Operator 9: byte-level BPE encoding and decoding with a segment tree.

A pre-token starts as its bytes, one token each. A segment tree over the byte positions holds, per
position, the rank of the pair that the live token there makes with the next one; inner nodes hold
the least rank of their half and, among equals, the leftmost position. The root says what to merge; a merge changes
three leaves (the merged token, its swallowed neighbour, the live token before it) and their paths to the
root: logarithmic work. Trees of pre-tokens of about equal length are kept side by
side in one array and step together, so that a step costs a few numpy operations for thousands
of pre-tokens. Each distinct pre-token of a slice is encoded once; a bounded memory of the
task keeps earlier ones.

Any two neighbours merge whose joined bytes are a token, least rank first, so all splits of every token
into two tokens make the pair table.

Defined results: a null text is empty (no tokens); every row comes out, also with a null or repeated id; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_slices
from tessera.llm.pretokens import distinct, split

NEVER = np.int64(1) << 62        # no pair here
POSITION = np.int64(32)          # bits of a leaf that hold its position
CELLS = 1 << 20                  # tree cells that step together
REMEMBERED = 400_000             # pre-tokens that a task keeps


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 and rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class Vocabulary:
    """Ranks, token bytes and the table of mergeable pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        left, right, merged = [], [], []
        for t, r in ranks.items():
            for cut in range(1, len(t)):
                a, b = ranks.get(t[:cut]), ranks.get(t[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(r)
        self.shift = np.int64(max(ranks.values()).bit_length() + 1)
        key = (np.array(left, np.int64) << self.shift) | np.array(right, np.int64)
        order = np.argsort(key)
        self.key, self.merged = key[order], np.array(merged, np.int64)[order]

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that a and b make; NEVER if none."""
        key = (a << self.shift) | b
        i = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[i] == key, self.merged[i], NEVER)

    def merge_all(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> list[np.ndarray]:
        """Tokens of pre-tokens of at most ``width`` (a power of two, over 1) bytes."""
        n = len(start)
        spot = np.arange(width)
        live = spot[None] < length[:, None]
        raw = data[np.where(live, start[:, None] + spot[None], 0)]
        token = np.where(live, self.byte_rank[raw], 0).reshape(-1)
        after = np.tile(spot + 1, n)
        before = np.tile(spot - 1, n)
        tree = np.full((n, 2 * width), NEVER, np.int64)
        pairs = self.pair(token.reshape(n, width)[:, :-1], token.reshape(n, width)[:, 1:])
        ok = live[:, 1:] & (pairs != NEVER)
        tree[:, width:-1] = np.where(ok, (pairs << POSITION) | spot[:-1], NEVER)
        level = width
        while level > 1:
            tree[:, level // 2:level] = tree[:, level:2 * level].reshape(n, -1, 2).min(2)
            level //= 2
        tree = tree.reshape(-1)
        alive = live.reshape(-1).copy()
        todo = np.arange(n)
        while True:
            root = tree[todo * 2 * width + 1]
            todo, root = todo[root < NEVER], root[root < NEVER]
            if not len(todo):
                break
            at, base, tall = root & ((np.int64(1) << POSITION) - 1), todo * width, todo * 2 * width
            size = length[todo]
            gone = after[base + at]                       # the swallowed neighbour
            then = after[base + gone]
            token[base + at] = root >> POSITION
            alive[base + gone] = False
            after[base + at] = then
            has_next = then < size
            before[(base + then)[has_next]] = at[has_next]
            prior = before[base + at]
            has_prior = prior >= 0
            new = np.where(has_next, self.pair(token[base + at], token[base + np.where(has_next, then, at)]), NEVER)
            old = np.where(has_prior, self.pair(token[base + np.maximum(prior, 0)], token[base + at]), NEVER)
            tree[tall + width + gone] = NEVER
            tree[tall + width + at] = np.where(new < NEVER, (new << POSITION) | at, NEVER)
            p = np.maximum(prior, 0)[has_prior]
            tree[tall[has_prior] + width + p] = np.where(old[has_prior] < NEVER, (old[has_prior] << POSITION) | p, NEVER)
            node = np.concatenate([width + at, width + gone, (width + p)])
            where = np.concatenate([tall, tall, tall[has_prior]])
            while node[0] > 1:
                node = node >> 1
                tree[where + node] = np.minimum(tree[where + 2 * node], tree[where + 2 * node + 1])
        token, alive = token.reshape(n, width), alive.reshape(n, width)
        flat = token[alive]
        return np.split(flat, np.cumsum(alive.sum(1))[:-1])

    def encode_words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        """Tokens of each pre-token data[start:end]."""
        length = end - start
        out: list[np.ndarray | None] = [None] * len(start)
        rung = np.maximum(1, np.ceil(np.log2(np.maximum(length, 2))).astype(int))
        for r in np.unique(rung):
            mine = np.flatnonzero(rung == r)
            width = 1 << int(r)
            each = max(1, CELLS // (2 * width))
            for k in range(0, len(mine), each):
                some = mine[k:k + each]
                for i, ids in zip(some.tolist(), self.merge_all(data, start[some], length[some], width)):
                    out[i] = ids
        return out


class Coder:
    """Encodes slices of texts; remembers pre-tokens up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids: list[list[int]] = []
        self.size = np.zeros(0, np.int64)
        self.text: list[bytes] = []
        self.raw: list[bytes] = []

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index into the memory of every pre-token of a slice, and each row's first."""
        begin, first = split(data, offsets)
        key, start, end, which = distinct(data, begin)
        if len(self.ids) > REMEMBERED:
            self.clear()
        known = np.array([self.index.get(k, -1) for k in key], np.int64)
        new = np.flatnonzero(known < 0)
        if len(new):
            known[new] = np.arange(len(self.ids), len(self.ids) + len(new))
            self.index.update((key[i], int(known[i])) for i in new.tolist())
            look = self.v.bytes_of
            for ids in self.v.encode_words(data, start[new], end[new]):
                ids = ids.tolist()
                self.ids.append(ids)
                self.text.append(b" ".join([b"%d" % i for i in ids]))
                self.raw.append(b"".join([look[i] for i in ids]))
            self.size = np.concatenate([self.size, np.array([len(x) for x in self.ids[len(self.size):]], np.int64)])
        return known[which], first


def _take(memory: list, index: np.ndarray) -> list:
    return [memory[i] for i in index.tolist()]


def _coder(path: str) -> Coder:
    return Coder(Vocabulary(read_ranks(path)))


def bpe_encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row; ``ranks_path`` is read where the tasks run."""
    def run(batches):
        coder = _coder(ranks_path)
        for b in batches:
            out = []
            for _, _, data, offsets in text_slices(b.column(1)):
                words, first = coder.words(data, offsets)
                out += [[i for w in words[x:y].tolist() for i in coder.ids[w]] for x, y in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], ["id", "ids"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def bpe_decode(tokens: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes) of every row of token ids; a null list is empty, an unknown id an error."""
    def run(batches):
        look = {r: t for t, r in read_ranks(ranks_path).items()}
        for b in batches:
            out = [b"".join([look[i] for i in ids or []]) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["id", "bytes"])

    narrow = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, bytes binary").withColumnRenamed("id", id_col)


def bpe_digests(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): the same encoding, then decoding, as digests.

    The ids and the decoded bytes are digested where they are made, so they need not travel.
    """
    def run(batches):
        coder = _coder(ranks_path)
        for b in batches:
            count, ids, raw = [], [], []
            for _, _, data, offsets in text_slices(b.column(1)):
                words, first = coder.words(data, offsets)
                total = np.concatenate([[0], np.cumsum(coder.size[words])])
                count.append(total[first[1:]] - total[first[:-1]])
                for x, y in zip(first[:-1].tolist(), first[1:].tolist()):
                    mine = words[x:y]
                    ids.append(hashlib.sha256(b" ".join(_take(coder.text, mine))).hexdigest())
                    raw.append(hashlib.sha256(b"".join(_take(coder.raw, mine))).hexdigest())
            if count:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.concatenate(count)), pa.array(ids), pa.array(raw)],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return (narrow.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))
