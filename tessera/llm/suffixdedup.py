"""Operator 1: exact substring deduplication by a distributed suffix merge sort.

A byte is removed when it lies in a ``LENGTH``-byte string that also starts earlier (smaller id, or same
text and earlier start). Texts are UTF-8 bytes; matches never cross texts; overlaps count; strings are judged
on the input.

1. Anchors. Every ``LENGTH``-byte window picks the least of its ``GRAM``-byte substrings (a hash
   orders them), so equal windows pick it at the same place. Consecutive windows share an anchor, about one
   position in 35; an anchor stands for all windows that picked it, and each window has one anchor.
2. Fingerprints. Only anchors whose substring occurs twice can have equal windows. What repeats inside a
   task is known on the spot; of each such substring only the first place and one witness row go to the
   exchange, so a passage in a third of all texts sends two rows per task, not one per text.
3. Sorted runs. The suffixes at the remaining anchors (to the end of the last window) are sorted per
   task with what precedes them. Anchors with equal context collapse: all but the first are
   duplicates already. What is left goes, front-coded (length of the common prefix with its predecessor,
   then the rest), to the bucket of its substring.
4. Merge. A bucket combines its runs with a loser tree that keeps, per run, the length of the
   prefix known to be common with the last suffix put out; it compares bytes only where two such lengths
   are equal, from there on. The lengths come out with the merged suffixes.
5. Windows. Two anchors have an equal window at distance ``a`` when the suffixes agree on LENGTH - a
   bytes (merged lengths) and what precedes on ``a`` bytes (ranks of the reversed contexts): an exact
   test per distance, one grouping for all anchors of the bucket. All but the first of a group are duplicates.

Texts are shuffled once, by id, and serve steps 3 and the removal. There are as many buckets as the
counted anchors fill at ``ANCHORS`` each, so an ordinary bucket is merged whatever the size of a shuffle partition. Only a
bucket that one very frequent substring fills beyond ``BUCKET`` (a third of all texts may share a passage; at its edges their
contexts differ) isn't held by one task: its runs are streamed and give one row per window, with the digest
(BLAKE2, 128 bits) of its whole string, which Spark groups evenly; all but the first of a group are duplicates.

Defined results: a null text is empty (0 bytes, nothing removed); rows with a null id come out whole and
serve no other row; rows that repeat id and text are one text, each row is returned; rows that share an id but
not the text are cut by the spans found for that id, within their length; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import mix, once, prefix_sums, shuffle_parts, span_hash, text_slices
from tessera.llm.groups import partition_labels, sorted_groups

LENGTH = 100
GRAM = 32
REACH = LENGTH - GRAM            # furthest an anchor lies behind its window's start
RUN = 100_000                    # anchors in a sorted run
SEEN = 4_000_000                 # substring hashes that a task keeps to know its repeats
BUCKET = 400_000                 # anchors that one task merges
ANCHORS = 150_000                # anchors for which a bucket is made


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(row, anchor, least distance, greatest distance, substring hash) of a slice, in order."""
    n, w = len(data), REACH + 1
    m = n - GRAM + 1
    if m < w:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, np.uint64)
    at = np.arange(m)
    h = span_hash(prefix_sums(data), at, at + GRAM)
    padded = np.full(-(-m // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = (h & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    block = padded.reshape(-1, w)
    head = np.minimum.accumulate(block, axis=1).reshape(-1)
    tail = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    best = np.minimum(tail[:m - w + 1], head[w - 1:m])
    lengths = np.diff(offsets)
    room = np.repeat(offsets[1:], lengths)[:len(best)]
    p = np.flatnonzero(at[:len(best)] + LENGTH <= room)
    if not len(p):
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, np.uint64)
    q = (best[p] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero((np.diff(q) != 0) | (np.diff(p) != 1)) + 1
    first, last = np.concatenate([[0], new]), np.concatenate([new - 1, [len(p) - 1]])
    q, low, high = q[first], p[first], p[last]
    row = np.searchsorted(offsets, low, "right") - 1
    return row, q - offsets[row], q - high, q - low, h[q]


def _anchor_batches(batches):
    """(key, id, place, sure): sure rows are known to repeat; a null id is a witness."""
    told: set[int] = set()
    seen = np.zeros(0, np.uint64)
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        for i, j, data, offsets in text_slices(b.column(1)):
            row, q, least, most, h = anchors(data, offsets)
            if not len(row):
                continue
            owner = ids[i:j][row].astype(np.int64)
            place = (q << 16) | (most << 8) | least
            order = np.argsort(h, kind="stable")
            same = h[order][1:] == h[order][:-1]
            sure = np.zeros(len(h), bool)
            sure[order[1:][same]] = True
            sure[order[:-1][same]] = True
            if len(seen):
                sure |= seen[np.minimum(np.searchsorted(seen, h), len(seen) - 1)] == h
            if len(seen) > SEEN:                       # forgotten ones are told again, no more
                seen, told = np.zeros(0, np.uint64), set()
            seen = np.concatenate([seen, h[order]])
            seen.sort(kind="stable")
            seen = seen[np.concatenate([[True], seen[1:] != seen[:-1]])]
            key = np.where(sure, mix(owner.view(np.uint64) * np.uint64(31) + place.astype(np.uint64)), h)
            fresh = [x for x in np.unique(h[sure]).tolist() if x not in told]
            told.update(fresh)
            none = len(fresh)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([key, np.array(fresh, np.uint64)]).view(np.int64)),
                 pa.array(np.concatenate([owner, np.zeros(none, np.int64)]), mask=np.arange(len(owner) + none) >= len(owner)),
                 pa.array(np.concatenate([place, np.zeros(none, np.int64)])),
                 pa.array(np.concatenate([sure, np.zeros(none, bool)]))], ["key", "id", "place", "sure"])


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """(id, places): anchors of (id, text) whose substring occurs elsewhere too."""
    found = docs.select("id", "text").where("id IS NOT NULL AND text IS NOT NULL").mapInArrow(
        _anchor_batches, "key long, id long, place long, sure boolean")
    found = found.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    return found.where("(sure OR n > 1) AND id IS NOT NULL").groupBy("id").agg(F.collect_set("place").alias("places"))


# ---- sorted runs -------------------------------------------------------------------------------

def encode_run(ids, q, right, right_len, left, left_len) -> bytes:
    """A front-coded run of sorted suffixes: shared prefix lengths, rests, contexts."""
    lcp = np.zeros(len(ids), np.uint8)
    if len(ids) > 1:
        differ = right[1:] != right[:-1]
        at = np.where(differ.any(1), differ.argmax(1), LENGTH)
        lcp[1:] = np.minimum(at, np.minimum(right_len[1:], right_len[:-1]))
    col = np.arange(LENGTH)[None]
    rest = right[(col >= lcp[:, None]) & (col < right_len[:, None])]
    before = left[np.arange(REACH)[None] < left_len[:, None]]
    raw = b"".join([np.int64([len(ids), len(rest)]).tobytes(), ids.tobytes(), q.tobytes(), lcp.tobytes(),
                    right_len.astype(np.uint8).tobytes(), left_len.astype(np.uint8).tobytes(),
                    rest.tobytes(), before.tobytes()])
    return np.int64([len(raw)]).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def decode_run(blob: bytes):
    """(ids, q, lcp, right_len, left_len, rests, left matrix)."""
    size = int(np.frombuffer(blob, np.int64, 1)[0])
    raw = pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True)
    n, rest = np.frombuffer(raw, np.int64, 2).tolist()
    at = 16
    ids, q = np.frombuffer(raw, np.int64, n, at), np.frombuffer(raw, np.int64, n, at + 8 * n)
    at += 16 * n
    lcp, right_len, left_len = (np.frombuffer(raw, np.uint8, n, at + k * n).astype(np.int64) for k in range(3))
    at += 3 * n
    rests = raw[at:at + rest]
    left = np.zeros((n, REACH), np.uint8)
    left[np.arange(REACH)[None] < left_len[:, None]] = np.frombuffer(raw, np.uint8, -1, at + rest)
    return ids, q, lcp, right_len, left_len, rests, left


def _emit_runs(held: list, labels: np.ndarray):
    """Rows (bucket, n, blob) of the anchors held: a run of n, or known duplicates where n is 0."""
    ids, q, least, most, h, right, left = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((q, ids))
    width = LENGTH + REACH + 2
    rows = np.empty((len(ids), width), np.uint8)
    rows[:, :LENGTH] = right
    rows[:, LENGTH] = LENGTH - least
    rows[:, LENGTH + 1:-1] = left
    rows[:, -1] = most
    order = order[np.argsort(rows.view(f"S{width}")[:, 0][order], kind="stable")]
    bucket = labels[(h % np.uint64(len(labels))).astype(np.int64)]
    order = order[np.argsort(bucket[order], kind="stable")]
    ids, q, bucket, rows = ids[order], q[order], bucket[order], rows[order]
    again = np.zeros(len(ids), bool)
    again[1:] = (rows[1:] == rows[:-1]).all(1) & (bucket[1:] == bucket[:-1]) & ((ids[1:] != ids[:-1]) | (q[1:] != q[:-1]))
    # a repeat of the very same anchor (a row that occurs twice) is dropped, not a duplicate of itself
    itself = np.zeros(len(ids), bool)
    itself[1:] = (ids[1:] == ids[:-1]) & (q[1:] == q[:-1]) & (bucket[1:] == bucket[:-1])
    out = []
    if again.any():
        a = again
        right_len, most = rows[a, LENGTH].astype(np.int64), rows[a, -1].astype(np.int64)
        start = q[a] - most
        out.append((int(labels[int(ids[a].sum()) % len(labels)]), 0,
                    np.concatenate([ids[a], (start << 8) | (q[a] + right_len - start)]).tobytes()))
    keep = np.flatnonzero(~again & ~itself)
    cuts = np.flatnonzero(np.diff(bucket[keep])) + 1
    for part in np.split(keep, cuts):
        if len(part):
            r = rows[part]
            out.append((int(bucket[part[0]]), len(part), encode_run(
                ids[part], q[part], r[:, :LENGTH], r[:, LENGTH], r[:, LENGTH + 1:-1], r[:, -1])))
    return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                                       pa.array([o[2] for o in out], pa.binary())], ["bucket", "n", "blob"])


def _run_batches(batches, labels: np.ndarray):
    held, count = [], 0
    for b in batches:
        place_col = b.num_columns - 1
        keep = np.flatnonzero(b.column(place_col).is_valid().to_numpy(zero_copy_only=False))
        if not len(keep):
            continue
        b = b.take(pa.array(keep))
        ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        places = b.column(place_col)
        for i, j, data, offsets in text_slices(b.column(1)):
            mine = [np.unique(places[r].values.to_numpy(zero_copy_only=False)) for r in range(i, j)]
            row = np.repeat(np.arange(j - i), [len(x) for x in mine])
            place = np.concatenate(mine)
            q, most, least = place >> 16, (place >> 8) & 255, place & 255
            fits = q - least + LENGTH <= np.diff(offsets)[row]      # else found in another text of this id
            row, q, most, least = row[fits], q[fits], most[fits], least[fits]
            for k in range(0, len(row), RUN // 2):
                s = slice(k, k + RUN // 2)
                at = offsets[:-1][row[s]] + q[s]
                padded = np.concatenate([data, np.zeros(LENGTH, np.uint8)])
                right = padded[at[:, None] + np.arange(LENGTH)[None]]
                right[np.arange(LENGTH)[None] >= (LENGTH - least[s])[:, None]] = 0
                left = data[np.maximum(at[:, None] - 1 - np.arange(REACH)[None], 0)]
                left[np.arange(REACH)[None] >= most[s][:, None]] = 0
                power = span_hash(prefix_sums(right.reshape(-1)), np.arange(len(at)) * LENGTH, np.arange(len(at)) * LENGTH + GRAM)
                held.append((ids[i:j][row[s]], q[s], least[s], most[s], power, right, left))
                count += len(at)
                if count >= RUN:
                    yield _emit_runs(held, labels)
                    held, count = [], 0
    if count:
        yield _emit_runs(held, labels)


# ---- merge -------------------------------------------------------------------------------------

def _first_difference(a: bytes, b: bytes, h: int) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[h:n], "big") ^ int.from_bytes(b[h:n], "big")
    return n - (x.bit_length() + 7) // 8


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray, bytes]]) -> tuple[list[int], list[int]]:
    """Loser tree over front-coded runs (lcp, length, rests).

    Returns the order, as positions in the concatenated runs, and the common prefix of each suffix
    with the one before it. ``known[r]`` is the common prefix of run r's suffix with the last one put out: of two
    suffixes the one with the longer is the smaller, and bytes are compared only from there on when equal.
    """
    def suffixes(lcp, length, rests):
        now, at = b"", 0
        for c, n in zip(lcp.tolist(), length.tolist()):
            now = now[:c] + rests[at:at + n - c]
            at += n - c
            yield now, c

    k = len(runs)
    feeds = [suffixes(*r) for r in runs]
    head: list[bytes] = []
    for f in feeds:
        head.append(next(f)[0])
    known = [0] * k                      # -1: this run has ended
    position, base = [], 0
    for lcp, _, _ in runs:
        position.append(base)
        base += len(lcp)

    def play(x: int, y: int) -> tuple[int, int]:
        hx, hy = known[x], known[y]
        if hx != hy:
            return (x, y) if hx > hy else (y, x)
        if hx < 0:
            return x, y
        a, b = head[x], head[y]
        h = _first_difference(a, b, hx)
        if a[h:h + 1] <= b[h:h + 1]:
            known[y] = h
            return x, y
        known[x] = h
        return y, x

    size = 1
    while size < k:
        size *= 2
    known += [-1] * (size - k)
    head += [b""] * (size - k)
    loser = [0] * size
    winners = list(range(size))
    level = size
    while level > 1:                     # the first round fills the tree
        nxt = []
        for i in range(0, level, 2):
            w, l = play(winners[i], winners[i + 1])
            loser[(level + i) // 2] = l
            nxt.append(w)
        winners, level = nxt, level // 2
    top = winners[0]
    order, shared = [], []
    while known[top] >= 0:
        order.append(position[top])
        shared.append(known[top])
        position[top] += 1
        got = next(feeds[top], None)
        if got is None:
            known[top] = -1
        else:
            head[top], known[top] = got
        node = (top + size) // 2
        while node:
            other = loser[node]
            ho, ht = known[other], known[top]
            if ho > ht:
                loser[node], top = top, other
            elif ho == ht and ho >= 0:
                w, l = play(top, other)
                loser[node], top = l, w
            node //= 2
    return order, shared


def duplicate_spans(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(id, start << 8 | bytes) of the spans of a bucket's later windows."""
    parts = [decode_run(b) for b in blobs]
    order, shared = merge_runs([(p[2], p[3], p[5]) for p in parts])
    ids, q, right_len, left_len = (np.concatenate([p[i] for p in parts])[order] for i in (0, 1, 3, 4))
    left = np.concatenate([p[6] for p in parts])[order]
    shared = np.array(shared)
    n = len(ids)
    # ranks of the reversed contexts, and the common prefix of neighbours
    rows = np.empty((n, REACH + 1), np.uint8)
    rows[:, :REACH], rows[:, REACH] = left, left_len
    by_left = np.argsort(rows.view(f"S{REACH + 1}")[:, 0], kind="stable")
    common = np.zeros(n, np.int64)
    if n > 1:
        differ = left[by_left][1:] != left[by_left][:-1]
        at = np.where(differ.any(1), differ.argmax(1), REACH)
        common[1:] = np.minimum(at, np.minimum(left_len[by_left][1:], left_len[by_left][:-1]))
    by_place = np.lexsort((q, ids))
    same_place = np.zeros(n, bool)
    same_place[1:] = (np.diff(ids[by_place]) == 0) & (np.diff(q[by_place]) == 0)
    by_place = by_place[~same_place]
    least, most = LENGTH - right_len, left_len
    dup = np.zeros((n, REACH + 3), bool)
    left_group = np.empty(n, np.int64)
    for a in range(REACH + 1):
        mine = by_place[(least[by_place] <= a) & (a <= most[by_place])]
        if len(mine) < 2:
            continue
        right_group = np.cumsum(shared < LENGTH - a)
        left_group[by_left] = np.cumsum(common < a)
        key = right_group[mine] * (n + 1) + left_group[mine]
        turn = np.argsort(key, kind="stable")
        later = key[turn][1:] == key[turn][:-1]
        dup[mine[turn[1:][later]], a + 1] = True
    step = np.diff(dup.astype(np.int8), axis=1)
    who, low = np.nonzero(step == 1)
    _, high = np.nonzero(step == -1)                 # row-major, so the k-th end belongs to the k-th start
    start = q[who] - (high - 1)
    return ids[who], (start << 8) | (q[who] - low + LENGTH - start)


def _known_spans(size, blobs):
    for n, b in zip(size, blobs):
        if not n:
            x = np.frombuffer(b, np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1])], ["id", "span"])


def _window_batches(batches):
    """(h1, h2, id, start) of every window of the runs; h1 is null where a span (in start) is known already."""
    for b in batches:
        size, blobs = b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_pylist()
        for known in _known_spans(size, blobs):
            none = pa.nulls(known.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, *known.columns], ["h1", "h2", "id", "start"])
        for blob in (x for n, x in zip(size, blobs) if n):
            ids, q, lcp, right_len, left_len, rests, left = decode_run(blob)
            right = np.zeros((len(ids), LENGTH), np.uint8)
            now, at = b"", 0
            for i, (c, n) in enumerate(zip(lcp.tolist(), right_len.tolist())):
                now, at = now[:c] + rests[at:at + n - c], at + n - c
                right[i, :n] = np.frombuffer(now, np.uint8)
            whole = np.concatenate([left[:, ::-1], right], 1)          # the anchor stands at column REACH
            for k in range(0, len(ids), 2000):                         # anchors at a time: up to 69 windows each
                who, begin, digest = [], [], []
                for i in range(k, min(k + 2000, len(ids))):
                    text = whole[i].tobytes()
                    for a in range(LENGTH - int(right_len[i]), int(left_len[i]) + 1):
                        who.append(i)
                        begin.append(q[i] - a)
                        digest.append(blake2b(text[REACH - a:REACH - a + LENGTH], digest_size=16).digest())
                if who:
                    h = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1])),
                                                      pa.array(ids[who]), pa.array(np.array(begin, np.int64))], ["h1", "h2", "id", "start"])


def _large_bucket_spans(runs: DataFrame) -> DataFrame:
    """(id, span) of buckets too large for one task: their windows grouped by the hash of the whole string."""
    rows = runs.mapInArrow(_window_batches, "h1 long, h2 long, id long, start long")
    first = rows.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.min(F.struct("id", "start")).alias("first"))
    later = rows.join(first, ["h1", "h2"]).where(F.struct("id", "start") != F.col("first"))
    span = F.shiftleft("start", 8) + F.lit(LENGTH)
    return (later.select("id", span.alias("span"))
            .unionByName(rows.where("h1 IS NULL").select("id", F.col("start").alias("span"))))


def _span_batches(batches):
    for t in sorted_groups(batches, 1):
        size = t.column("n").to_numpy()
        blobs = t.column("blob").to_pylist()
        yield from _known_spans(size, blobs)
        runs = [b for n, b in zip(size, blobs) if n]
        if runs:
            ids, span = duplicate_spans(runs)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(span)], ["id", "span"])


# ---- removal -----------------------------------------------------------------------------------

def _cut_batches(batches, as_text: bool):
    for b in batches:
        spans_col = b.column(b.num_columns - 1)
        n_bytes, starts, ends, kept = [], [], [], []
        for i, j, data, offsets in text_slices(b.column(1)):
            for r in range(i, j):
                text = data[offsets[r - i]:offsets[r - i + 1]]
                n = len(text)
                n_bytes.append(n)
                packed = spans_col[r].values
                if packed is None or not n:
                    starts.append([])
                    ends.append([])
                    kept.append(text.tobytes())
                    continue
                packed = packed.to_numpy(zero_copy_only=False)
                s = np.minimum(packed >> 8, n)
                e = np.minimum((packed >> 8) + (packed & 255), n)
                cover = np.cumsum(np.bincount(s, minlength=n + 1) - np.bincount(e, minlength=n + 1))[:n] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], cover, [False]])))
                starts.append(edge[::2].tolist())
                ends.append(edge[1::2].tolist())
                kept.append(text[~cover].tobytes())
        whole = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(starts, whole), pa.array(ends, whole),
             pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()),
             *b.columns[2:-1]], ["id", "n_bytes", "span_starts", "span_ends", "kept", *b.schema.names[2:-1]])


def bucketed_runs(docs: DataFrame) -> DataFrame:
    """(bucket, n, blob, total): the sorted runs of (id, text, ...) and the anchors of their bucket."""
    places = once(repeated_anchors(docs))
    n = places.agg(F.sum(F.size("places"))).first()[0] or 0
    parts = max(shuffle_parts(docs), -(-n // ANCHORS))
    labels = partition_labels(docs.sparkSession, parts)
    runs = docs.join(places, "id", "left").mapInArrow(lambda it: _run_batches(it, labels), "bucket long, n long, blob binary")
    # the window reads a bucket's rows in order, after one shuffle that both branches share
    return runs.repartition(parts, "bucket").withColumn("total", F.sum("n").over(Window.partitionBy("bucket")))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_bytes, span_starts, span_ends, kept) of every row: the removed spans and the bytes that stay.

    ``as_text`` gives ``kept`` as a string, without characters of which a part was removed. The columns in ``carry``
    come along, as struct ``row``.
    """
    row = [F.struct(*carry).alias("row")] if carry else []
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *row)
    runs = bucketed_runs(docs)
    spans = (runs.where(F.col("total") <= BUCKET).mapInArrow(_span_batches, "id long, span long")
             .unionByName(_large_bucket_spans(runs.where(F.col("total") > BUCKET)))
             .groupBy("id").agg(F.collect_set("span").alias("spans")))
    schema = ("id long, n_bytes long, span_starts array<long>, span_ends array<long>, kept " + ("string" if as_text else "binary")
              + "".join(f", row {docs.schema['row'].dataType.simpleString()}" for _ in row))
    return (docs.join(spans, "id", "left").mapInArrow(lambda it: _cut_batches(it, as_text), schema)
            .withColumnRenamed("id", id_col))
