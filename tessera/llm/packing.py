"""Operator 8: best-fit packing with certified bounds.

Texts become token ids (a public tokenizer file and one closing id); a longer text than a sequence is
cut into whole sequences, its first piece taking the remainder. Pieces are dealt evenly to partitions of
bounded size; each packs its own by best-fit decreasing and certifies the number of
its sequences with dual feasible functions: functions f of a relative size with sum f <= 1 for
every set that fits a sequence, so the sum of f over all pieces is a lower bound. Where the two numbers
are equal no packing of that partition is better. Partitions with a gap give up their unfilled
sequences, and every partition those less than half full; these pieces are dealt anew, over
partition borders, and packed again. A round that saves no sequence is undone and ends the work, as do ``rounds`` (3) of them.

Ids are those that the tokenizer gives without special tokens added: a text that holds the string of one of
the file's own added tokens gets that token's id there.

Defined results: a null or empty text is the closing id alone; every row is packed, also rows with a null or
repeated id, each on its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import once, text_slices
from tessera.llm.groups import sorted_groups
from tessera.llm.pretokens import distinct, split

GROUP = 50_000                   # pieces that one partition packs
REMEMBERED = 400_000             # pre-tokens that a task keeps


def byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = (b for b in range(256) if b not in plain)
    letter = dict(zip(other, range(256, 512))) | dict(zip(plain, plain))
    return "".join(chr(letter[b]) for b in range(256))


class _Ids:
    """Token ids of slices of texts: each distinct pre-token goes to the tokenizer's model once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.pool = np.zeros(0, np.uint32)
        self.bounds = np.zeros(1, np.int64)

    def marked(self, texts: pa.Array) -> np.ndarray:
        """Where a text holds one of the file's added tokens, which the tokenizer looks for before it splits anything."""
        found = np.zeros(len(texts), bool)
        for mark in self.added:
            found |= pc.fill_null(pc.match_substring(texts, mark), False).to_numpy(zero_copy_only=False)
        return found

    def whole(self, text: str) -> np.ndarray:
        """Token ids of one text as the tokenizer gives them."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, and each row's range."""
        begin, first = split(data, offsets)
        key, start, end, which = distinct(data, begin)
        if len(self.index) > REMEMBERED:
            self.clear()
        known = np.array([self.index.get(k, -1) for k in key], np.int64)
        new = np.flatnonzero(known < 0)
        if len(new):
            letters = data.tobytes().decode("latin-1").translate(self.letters)
            tokens = self.tokenizer.model.tokenize
            ids = [[t.id for t in tokens(letters[s:e])] for s, e in zip(start[new].tolist(), end[new].tolist())]
            known[new] = np.arange(len(self.bounds) - 1, len(self.bounds) - 1 + len(new))
            self.index.update((key[i], int(known[i])) for i in new.tolist())
            size = np.array([len(x) for x in ids], np.int64)
            self.pool = np.concatenate([self.pool, np.fromiter((i for x in ids for i in x), np.uint32, size.sum())])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(size)])
        words = known[which]
        size = self.bounds[words + 1] - self.bounds[words]
        place = np.concatenate([[0], np.cumsum(size)])
        flat = self.pool[np.repeat(self.bounds[words] - place[:-1], size) + np.arange(place[-1])]
        return flat, place[first]


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of n ids: whole sequences, the first one taking what is over."""
    if n <= capacity:
        return [n]
    over = n % capacity
    return ([over] if over else []) + [capacity] * (n // capacity)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, closing_id: int = 2,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of the pieces of every row."""
    def run(batches):
        coder = _Ids(tokenizer_path)
        for b in batches:
            out: list[tuple[int, int, int, int, int]] = []
            marked = coder.marked(b.column(1))
            for i, j, data, offsets in text_slices(b.column(1)):
                flat, bounds = coder.slice(data, offsets)
                for r in range(j - i):
                    ids = coder.whole(b.column(1)[i + r].as_py()) if marked[i + r] else flat[bounds[r]:bounds[r + 1]]
                    row = np.append(ids, np.uint32(closing_id)).astype("<u4").tobytes()
                    start = 0
                    for k, n in enumerate(piece_lengths(len(row) // 4, capacity)):
                        out.append((i + r, k, start, n, zlib.crc32(row[4 * start:4 * (start + n)])))
                        start += n
            if out:
                row, *rest = zip(*out)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), *(pa.array(x, pa.int64()) for x in rest)],
                                                 ["id", "piece", "start", "length", "ids_crc32"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, piece long, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, by three families of dual feasible functions."""
    size, count = np.unique(lengths, return_counts=True)
    total = int((size * count).sum())
    best = -(-total // capacity)
    for k in range(1, 51):                                   # rounding to k parts
        whole = (k + 1) * size % capacity == 0
        f = np.where(whole, size * k, (k + 1) * size // capacity * capacity)       # in 1 / (k * capacity)
        best = max(best, -(-int((f * count).sum()) // (k * capacity)))
    for cut in np.unique(np.minimum(size, capacity - size)):  # small pieces count nothing, large ones all
        if 0 < cut <= capacity // 2:
            f = np.where(size > capacity - cut, capacity, np.where(size < cut, 0, size))
            best = max(best, -(-int((f * count).sum()) // capacity))
            big = size > capacity // 2                       # two-sided rounding to multiples of the cut
            parts = capacity // cut
            g = np.where(big, 2 * (parts - (capacity - size) // cut), np.where(2 * size == capacity, parts, 2 * (size // cut)))
            best = max(best, -(-int((g * count).sum()) // (2 * parts)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each piece's sequence and offset, and each sequence's fill."""
    order = np.argsort(-lengths, kind="stable")
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fill = 0, []                                       # bit r: a sequence with room r is open
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            s = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, s = capacity, len(fill)
            fill.append(0)
        sequence[i], offset[i] = s, fill[s]
        fill[s] += n
        if room - n:
            open_by_room[room - n].append(s)
            rooms |= 1 << (room - n)
    return sequence, offset, np.array(fill, np.int64)


def _pack_groups(batches, capacity: int):
    for t in sorted_groups(batches, 1):
        lengths = t.column("length").to_numpy()
        sequence, offset, fill = best_fit(lengths, capacity)
        gap = len(fill) - lower_bound(lengths, capacity)
        t = t.append_column("sequence", pa.array(sequence)).append_column("offset", pa.array(offset)) \
             .append_column("fill", pa.array(fill[sequence])).append_column("gap", pa.array(np.full(len(lengths), gap)))
        yield from t.to_batches()


def _pack_round(pieces: DataFrame, turn: int, capacity: int) -> DataFrame:
    """One packing of (row, id, piece, start, length, ids_crc32), dealt by a hash of the row and the turn."""
    groups = max(1, -(-pieces.count() // GROUP))
    fields = ["row", "id", "piece", "start", "length", "ids_crc32"]
    dealt = pieces.select(F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)).alias("group"), *fields)
    dealt = dealt.repartition(groups, "group").sortWithinPartitions("group")
    kind = pieces.schema["id"].dataType.simpleString()
    packed = dealt.mapInArrow(lambda it: _pack_groups(it, capacity),
                              f"group long, row long, id {kind}, piece long, start long, length long, ids_crc32 long, "
                              "sequence long, offset long, fill long, gap long")
    return once(packed.withColumn("turn", F.lit(turn)))


def pack_pieces(pieces: DataFrame, capacity: int = 1024, rounds: int = 3) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces (id, piece, start, length, ids_crc32)."""
    pieces = once(pieces).withColumn("row", F.monotonically_increasing_id())
    now = _pack_round(pieces, 0, capacity)
    kept = None
    for turn in range(1, rounds + 1):
        loose = (F.col("gap") > 0) & (F.col("fill") < capacity) | (F.col("fill") * 2 < capacity)
        out = now.where(loose)
        before = out.select("group", "sequence").distinct().count()
        if before < 2:
            break
        again = _pack_round(out, turn, capacity)
        if again.select("group", "sequence").distinct().count() >= before:
            break
        firm = now.where(~loose)
        kept = firm if kept is None else kept.unionByName(firm)
        now = again
    packed = now if kept is None else kept.unionByName(now)
    number = (F.shiftleft(F.col("turn").cast("long"), 56) + F.shiftleft(F.col("group"), 20) + F.col("sequence"))
    return packed.select("id", "piece", "start", "length", "ids_crc32", number.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, closing_id: int = 2,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens, pieces and packing of every row of ``docs``."""
    return pack_pieces(token_pieces(docs, tokenizer_path, capacity, closing_id, id_col, text_col),
                       capacity).withColumnRenamed("id", id_col)
