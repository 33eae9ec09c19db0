"""Operator 12: substring dedup by repeated-phrase automata.

A word is removed when it lies in a window of ``WINDOW`` words that also starts in a document with a smaller id.
Windows never cross documents, overlaps count, and windows are judged on the input.

1. Candidates. Every window picks the least of its ``GRAM``-word grams (a hash orders them), so equal windows pick
   it at the same place; neighbouring windows share an anchor, about one word in 5.5. Anchors whose gram occurs
   once can't lie in a recurring passage. A gram that is frequent in one task, or all over, is called hot.
2. Segments. A document's text around each remaining anchor (the windows that picked it, 13 to 22 words) goes to the
   shard of its gram; the windows of a hot gram go one by one, each to the shard of its own words, so that no shard holds the many
   contexts of one passage. Equal segments of one task are sent once, for the least id: the others are
   known to repeat it.
3. Confirm. A shard codes its words exactly and looks for the windows that start in two documents. Confirmed windows
   that always occur side by side are one phrase: a recurring passage, with the least document it starts in.
4. Automaton. The phrases of a shard are compiled into an Aho-Corasick automaton over coded words (three letters of small
   alphabets a word, so that nodes stay narrow).
5. Stream. The shard's segments of all documents run through the automaton, which tells every occurrence; an
   occurrence in a document beyond the phrase's first is a span to remove. Spans go back to the documents by id.

Hashes only choose candidates and shards; what is confirmed and found is compared word by word. A shard holds ``SHARD``
segments and the rest of its last gram's, at most ``HOT`` (of a hot gram's window: one for each run of a task). Nothing is collected
on the driver.

Defined results: a null text has no words; rows with a null id come out whole and serve no other row; rows that repeat
id and text are one document, each row is returned; rows that share an id but not the text are texts of one
document: none serves another, each is cut by its own spans (told apart by a 22-bit checksum); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import (SEPARATOR, mix, prefix_sums, shuffle_parts, span_hash, text_buffers, text_slices,
                                window_hashes, word_spans)
from tessera.llm.groups import partition_labels, sorted_groups

WINDOW = 13
GRAM = 4
REACH = WINDOW - GRAM            # furthest an anchor lies behind its window's start
FLUSH = 1_000_000                # anchors among which a task looks for frequent grams
NUMEROUS = 32                    # occurrences among them that make a gram hot
HOT = 4_000                      # occurrences in all documents that make it hot
RUN = 100_000                    # segments among which a task looks for equal ones
HELD = 100_000                   # segments that a task unpacks at a time
SHARD = 8_000                    # segments from which a shard's automaton is built
_NONE = np.zeros(0, np.int64)


# ---- candidates ----------------------------------------------------------------------------------

def anchors(words: np.ndarray, first: np.ndarray):
    """(row, anchor, least distance, greatest distance, gram hash) of a slice of hashed words, in order.

    The anchor is a word of the row; the windows that picked it start between the two distances before it.
    """
    grams, begin = _grams(words), np.arange(len(words))
    m, w = len(grams), REACH + 1
    if m < w:
        return _NONE, _NONE, _NONE, _NONE, np.zeros(0, np.uint64)
    at = np.arange(m)
    padded = np.full(-(-m // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    block = padded.reshape(-1, w)
    head = np.minimum.accumulate(block, axis=1).reshape(-1)
    tail = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    best = np.minimum(tail[:m - w + 1], head[w - 1:m])
    room = np.repeat(first[1:], np.diff(first))[:len(best)]
    p = begin[:len(best)][begin[:len(best)] + WINDOW <= room]
    if not len(p):
        return _NONE, _NONE, _NONE, _NONE, np.zeros(0, np.uint64)
    q = (best[p] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero((np.diff(q) != 0) | (np.diff(p) != 1)) + 1
    low, high = p[np.concatenate([[0], new])], p[np.concatenate([new - 1, [len(p) - 1]])]
    q = q[np.concatenate([[0], new])]
    row = np.searchsorted(first, low, "right") - 1
    return row, q - first[row], q - high, q - low, grams[q]


def _grams(words: np.ndarray) -> np.ndarray:
    """Hash of every ``GRAM`` consecutive words."""
    return window_hashes(words, np.array([0, len(words)]), GRAM)[0]


def _prints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 22-bit checksum of each row."""
    return np.array([zlib.crc32(data[a:b]) & 0x3FFFFF for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], np.int64)


def _anchor_rows(h: np.ndarray, ids: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Rows (key, id, place, n): n is 1, or 0 for an anchor known to be hot, which goes under a key of its own;
    each hot gram has one row without id, with the number of its anchors."""
    kinds, index, count = np.unique(h, return_inverse=True, return_counts=True)
    hot = count > NUMEROUS
    mine = hot[index]
    key = np.where(mine, mix(ids.view(np.uint64) * np.uint64(31) + place.view(np.uint64)), h) >> np.uint64(16)
    none = int(hot.sum())
    total = len(h) + none
    absent = np.arange(total) >= len(h)
    fill = np.zeros(none, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([key, kinds[hot] >> np.uint64(16)]).view(np.int64)), pa.array(np.concatenate([ids, fill]), mask=absent),
         pa.array(np.concatenate([place, fill]), mask=absent), pa.array(np.concatenate([(~mine).astype(np.int64), count[hot]]))],
        ["key", "id", "place", "n"])


def _anchor_batches(batches):
    held: list = []
    size = 0
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        for i, j, data, offsets in text_slices(b.column(1)):
            starts, ends, first = word_spans(data, offsets)
            row, q, least, most, h = anchors(span_hash(prefix_sums(data), starts, ends), first)
            if not len(row):
                continue
            place = (_prints(data, offsets)[row] << 41) | (q << 9) | (most << 5) | (least << 1)
            held.append((h, ids[i:j][row].astype(np.int64), place))
            size += len(row)
            if size >= FLUSH:
                yield _anchor_rows(*(np.concatenate(x) for x in zip(*held)))
                held, size = [], 0
    if size:
        yield _anchor_rows(*(np.concatenate(x) for x in zip(*held)))


def recurring_anchors(docs: DataFrame) -> DataFrame:
    """(id, places): the anchors of (id, text) whose gram occurs in two documents, with the hot ones marked in the last bit.

    48 bits of a gram's hash decide; a chance collision only adds candidates.
    """
    found = (docs.select("id", "text").where("id IS NOT NULL AND text IS NOT NULL")
             .mapInArrow(_anchor_batches, "key long, id long, place long, n long"))
    same = Window.partitionBy("key")
    found = found.select("id", "place", "n", F.sum("n").over(same).alias("total"), F.max("n").over(same).alias("top"),
                         (F.min("id").over(same) < F.max("id").over(same)).alias("several"))
    hot = (F.col("n") == 0) | (F.col("top") > NUMEROUS) | (F.col("total") > HOT)
    return (found.where("id IS NOT NULL AND (n = 0 OR top > 1 OR several)")       # top > 1: hot in another task
            .groupBy("id").agg(F.collect_set(F.col("place") + hot.cast("long")).alias("places")))


# ---- segments ------------------------------------------------------------------------------------

def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space behind each, and where each begins (words + 1)."""
    begin = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    out = np.full(begin[-1], 0x20, np.uint8)
    inside = np.ones(begin[-1], bool)
    inside[begin[1:] - 1] = False
    out[inside] = data[~SEPARATOR[data]]
    return out, begin


def _pieces(joined: np.ndarray, begin: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """The words [a, b) as strings, a space between two."""
    size = begin[b] - 1 - begin[a]
    ends = np.concatenate([[0], np.cumsum(size)])
    flat = joined[np.repeat(begin[a] - ends[:-1], size) + np.arange(ends[-1])]
    return pa.LargeStringArray.from_buffers(len(a), pa.py_buffer(ends), pa.py_buffer(flat))


def pack(key: np.ndarray, ids: np.ndarray, sizes: np.ndarray, starts: np.ndarray, texts: pa.Array) -> bytes:
    """Segments as one compressed value; ``sizes`` are the numbers of each one's ``starts``."""
    data, offsets = text_buffers(texts)
    raw = b"".join([np.int64([len(key), len(starts)]).tobytes(), key.tobytes(), ids.tobytes(), starts.tobytes(),
                    sizes.astype(np.int32).tobytes(), offsets.astype(np.int32).tobytes(), data.tobytes()])
    return np.int64([len(raw)]).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """What ``pack`` was given."""
    raw = pa.decompress(blob[8:], decompressed_size=int(np.frombuffer(blob, np.int64, 1)[0]), codec="zstd", asbytes=True)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    key, ids, starts = np.frombuffer(raw, np.uint64, n, 16), np.frombuffer(raw, np.int64, n, 16 + 8 * n), np.frombuffer(raw, np.int64, m, 16 + 16 * n)
    at = 16 + 16 * n + 8 * m
    sizes = np.frombuffer(raw, np.int32, n, at).astype(np.int64)
    at += 4 * n
    return key, ids, sizes, starts, pa.StringArray.from_buffers(n, pa.py_buffer(raw[at:at + 4 * n + 4]), pa.py_buffer(raw[at + 4 * n + 4:]))


def _segment_rows(held: list, labels: np.ndarray) -> pa.RecordBatch:
    """Rows (part, n, blob) of the segments held: n segments, one of each text, for its least id, with its places in that
    document; where n is 0, (id, span) of the documents that repeat a smaller one's segment."""
    key, ids, start, count = (np.concatenate(x) for x in list(zip(*held))[:4])
    coded = pa.chunked_array([x[4] for x in held]).combine_chunks().dictionary_encode()
    kind = coded.indices.to_numpy().astype(np.int64)
    order = np.lexsort((start, ids, kind))
    key, kind, ids, start, count = key[order], kind[order], ids[order], start[order], count[order]
    head = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    least = ids[head][kind]                              # kinds count from 0 without a gap
    fresh = np.ones(len(ids), bool)                      # not a row that occurs twice
    fresh[1:] = (kind[1:] != kind[:-1]) | (ids[1:] != ids[:-1]) | (start[1:] != start[:-1])
    out = []
    again = np.flatnonzero((ids > least) & fresh)
    if len(again):
        out.append((int(labels[len(again) % len(labels)]), 0,
                    np.concatenate([ids[again], (start[again] << 8) | count[again]]).tobytes()))
    own = np.flatnonzero((ids == least) & fresh)
    sizes = np.bincount(kind[own], minlength=len(head))
    first = np.concatenate([[0], np.cumsum(sizes)])
    key, ids, start = key[head], ids[head], start[own]
    part = (key % np.uint64(len(labels))).astype(np.int64)
    order = np.lexsort((key, part))
    for mine in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        size = sizes[mine]
        ends = np.cumsum(size)
        places = start[np.repeat(first[mine] - ends + size, size) + np.arange(ends[-1])]
        out.append((int(labels[part[mine[0]]]), len(mine),
                    pack(key[mine], ids[mine], size, places, coded.dictionary.take(pa.array(mine)))))
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))],
                                      ["part", "n", "blob"])


def _segment_batches(batches, labels: np.ndarray):
    """The segments of rows (id, text, places)."""
    held: list = []
    size = 0
    for b in batches:
        b = b.filter(b.column(2).is_valid())
        column = b.column(2)
        ids = b.column(0).to_numpy(zero_copy_only=False)
        for i, j, data, offsets in text_slices(b.column(1)):
            starts, ends, first = word_spans(data, offsets)
            words = span_hash(prefix_sums(data), starts, ends)
            mark = _prints(data, offsets)
            places = column.slice(i, j - i)
            place = places.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(j - i), pc.list_value_length(places).to_numpy(zero_copy_only=False))
            mine = (place >> 41) == mark[row]
            place, row = place[mine], row[mine]
            hot, q = (place & 1).astype(bool), (place >> 9) & 0xFFFFFFFF
            least, most = (place >> 1) & 15, (place >> 5) & 15
            fits = q - least + WINDOW <= np.diff(first)[row]         # else found in another text of this id
            row, hot, q, least, most = row[fits], hot[fits], q[fits], least[fits], most[fits]
            if not len(row):
                continue
            grams = _grams(words)
            windows = window_hashes(words, np.array([0, len(words)]), WINDOW)[0] if hot.any() else grams
            many = (most - least + 1)[hot]                            # windows of the hot anchors, one by one
            one = np.repeat(np.flatnonzero(hot), many)
            step = np.arange(len(one)) - np.repeat(np.cumsum(many) - many, many)
            owner = np.concatenate([row[~hot], row[one]])
            begin = np.concatenate([(q - most)[~hot], (q - most)[one] + step])
            count = np.concatenate([(most - least)[~hot] + WINDOW, np.full(len(one), WINDOW)])
            at = first[owner] + begin
            key = np.concatenate([grams[(first[row] + q)[~hot]], windows[at[len(at) - len(one):]]])
            joined, where = _joined(data, starts, ends)
            for k in range(0, len(at), RUN):
                s = slice(k, k + RUN)
                held.append((key[s], ids[i:j][owner[s]].astype(np.int64), (mark[owner[s]] << 32) | begin[s], count[s],
                             _pieces(joined, where, at[s], at[s] + count[s])))
                size += len(at[s])
                if size >= RUN:
                    yield _segment_rows(held, labels)
                    held, size = [], 0
    if size:
        yield _segment_rows(held, labels)


# ---- shards --------------------------------------------------------------------------------------

def _coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Exact codes of all words of the segments, and the index of each segment's first (segments + 1)."""
    split = pc.split_pattern(texts, " ")
    return split.flatten().dictionary_encode().indices.to_numpy().astype(np.int64), split.offsets.to_numpy().astype(np.int64)


def _letters(codes: np.ndarray, first: np.ndarray) -> tuple[str, np.ndarray]:
    """All segments as one string, three letters a word and three of none behind each segment; each word's place in it."""
    base = int(np.ceil((codes.max(initial=0) + 1) ** (1 / 3))) + 1
    place = np.arange(len(codes)) + np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.ones((len(codes) + len(first) - 1, 3), np.int64)
    for j, digit in enumerate((codes // (base * base), codes // base % base, codes % base)):
        out[place, j] = 2 + j * base + digit
    return out.astype("<u4").tobytes().decode("utf-32-le"), place


def confirm(codes: np.ndarray, first: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The recurring phrases of a shard: (first word, end, least document) of one occurrence each.

    Windows that start in two documents are confirmed. Where a window is always followed by one other, and that
    one always follows it, they occur together and belong to one phrase.
    """
    at = np.arange(len(codes))
    at = at[at + WINDOW <= np.repeat(first[1:], np.diff(first))]
    if not len(at):
        return _NONE, _NONE, _NONE
    flat = np.ascontiguousarray(codes.astype(np.int32)[at[:, None] + np.arange(WINDOW)])
    texts = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * WINDOW), len(at), [None, pa.py_buffer(flat)])
    kind = texts.dictionary_encode().indices.to_numpy().astype(np.int64)
    n = int(kind.max()) + 1
    owner = ids[np.searchsorted(first, at, "right") - 1]
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(low, kind, owner)
    np.maximum.at(high, kind, owner)
    beside = np.zeros(len(at), bool)                                  # the next window is one word further
    beside[:-1] = np.diff(at) == 1
    after, before = np.full(len(at), -1), np.full(len(at), -1)
    after[:-1][beside[:-1]] = kind[1:][beside[:-1]]
    before[1:][beside[:-1]] = kind[:-1][beside[:-1]]
    only_after, only_before = _only(kind, after, n), _only(kind, before, n)
    linked = np.zeros(len(at), bool)
    linked[:-1] = beside[:-1] & (only_after[kind[:-1]] == kind[1:]) & (only_before[kind[1:]] == kind[:-1])
    start = np.flatnonzero(~np.concatenate([[False], linked[:-1]]))
    end = np.flatnonzero(~linked)
    _, one = np.unique(kind[start], return_index=True)
    start, end = start[one], end[one]
    real = low[kind[start]] < high[kind[start]]
    start, end = start[real], end[real]
    return at[start], at[end] + WINDOW, low[kind[start]]


def _only(kind: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """For each kind the value that all its rows have, or -1."""
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    np.minimum.at(low, kind, value)
    np.maximum.at(high, kind, value)
    return np.where(low == high, low, -1)


def locate(text: str, phrases: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, end) of every occurrence of the phrases in the text, by one automaton."""
    import ahocorasick
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, p in enumerate(phrases):
        automaton.add_word(p, k)
    automaton.make_automaton()
    hits = np.fromiter((x for hit in automaton.iter(text) for x in hit), np.int64).reshape(-1, 2)
    return hits[:, 1], hits[:, 0] + 1


def shard_spans(ids: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first word, words) of the parts of a shard's segments that a smaller document has, too."""
    codes, first = _coded(texts)
    begin, end, low = confirm(codes, first, ids)
    if not len(begin):
        return _NONE, _NONE, _NONE
    text, place = _letters(codes, first)
    a, b = 3 * place[begin], 3 * place[end - 1] + 3
    phrase, stop = locate(text, [text[x:y] for x, y in zip(a.tolist(), b.tolist())])
    size = (end - begin)[phrase]
    word = np.searchsorted(place, stop // 3 - size)                   # a phrase begins at a word
    segment = np.searchsorted(first, word, "right") - 1
    later = ids[segment] > low[phrase]
    return segment[later], (word - first[segment])[later], size[later]


def _unpacked(blobs: list[bytes], n: int):
    """The segments of one task, about ``HELD`` of ``n`` at a time, those of a key together: (key, ids, sizes, starts, texts)."""
    rounds = max(1, -(-n // HELD))
    for k in range(rounds):
        found = []
        for key, ids, sizes, starts, texts in map(unpack, blobs):
            mine = np.flatnonzero(mix(key) % np.uint64(rounds) == k)
            found.append((key[mine], ids[mine], sizes[mine], starts[np.repeat(mix(key) % np.uint64(rounds) == k, sizes)],
                          texts.take(pa.array(mine))))
        *columns, texts = zip(*found)
        yield *map(np.concatenate, columns), pa.concat_arrays(texts)


def _shards(key: np.ndarray, ids: np.ndarray, sizes: np.ndarray, starts: np.ndarray, texts: pa.Array):
    """(ids, sizes, starts, texts) of whole groups of segments of one key: ``SHARD`` segments, and the rest of the last key's."""
    order = np.argsort(key, kind="stable")
    first = np.concatenate([[0], np.cumsum(sizes)])
    cuts = np.append(np.flatnonzero(np.diff(key[order])) + 1, len(order))
    begin = 0
    while begin < len(order):
        end = int(cuts[min(np.searchsorted(cuts, begin + SHARD), len(cuts) - 1)])
        mine = order[begin:end]
        size = sizes[mine]
        ends = np.cumsum(size)
        yield (ids[mine], size, starts[np.repeat(first[mine] - ends + size, size) + np.arange(ends[-1])], texts.take(pa.array(mine)))
        begin = end


def _span_batches(batches):
    """(id, span) of sorted rows (part, n, blob): what is known, and what the shards' automata find."""
    for t in sorted_groups(batches, 1):
        n, blobs = t.column("n").to_numpy(), t.column("blob").to_pylist()
        for b in (b for k, b in zip(n, blobs) if not k):
            known = np.frombuffer(b, np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(known[0]), pa.array(known[1])], ["id", "span"])
        blobs = [b for k, b in zip(n, blobs) if k]
        shards = (s for some in (_unpacked(blobs, int(n.sum())) if blobs else ()) for s in _shards(*some))
        for ids, many, starts, texts in shards:
            segment, word, size = shard_spans(ids, texts)
            if len(segment):
                first = np.cumsum(many) - many
                many = many[segment]
                ends = np.cumsum(many)
                place = starts[np.repeat(first[segment] - ends + many, many) + np.arange(ends[-1])] + np.repeat(word, many)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[segment], many)),
                                                  pa.array((place << 8) | np.repeat(size, many))], ["id", "span"])


# ---- removal -------------------------------------------------------------------------------------

def _cut_batches(batches):
    for b in batches:
        column = b.column(b.num_columns - 1)
        n_words, begins, ends_, kept = [], [], [], []
        for i, j, data, offsets in text_slices(b.column(1)):
            starts, ends, first = word_spans(data, offsets)
            mark = _prints(data, offsets)
            spans = column.slice(i, j - i)
            row = np.repeat(np.arange(j - i), pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))
            span = spans.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            a, size = (span >> 8) & 0xFFFFFFFF, span & 255
            mine = ((span >> 40) == mark[row]) & (a + size <= np.diff(first)[row])
            a, size = first[row[mine]] + a[mine], size[mine]
            n = len(starts)
            gone = np.cumsum(np.bincount(a, minlength=n + 1) - np.bincount(a + size, minlength=n + 1))[:n] > 0
            stays = np.concatenate([[0], np.cumsum(~gone)])[first]
            n_words.append(np.diff(first))
            # runs of removed words, cut at rows
            left, right = gone.copy(), gone.copy()
            edge = np.zeros(n + 1, bool)
            edge[first] = True
            left[1:] &= ~gone[:-1] | edge[1:n]
            right[:-1] &= ~gone[1:] | edge[1:n]
            left, right = np.flatnonzero(left), np.flatnonzero(right) + 1
            base = first[np.searchsorted(first, left, "right") - 1] if n else left
            bounds = np.searchsorted(left, first)
            begins += np.split(left - base, bounds[1:-1])
            ends_ += np.split(right - base, bounds[1:-1])
            joined, where = _joined(data, starts, ends)
            flat = joined[np.repeat(~gone, np.diff(where))]
            size = np.concatenate([[0], np.cumsum(np.diff(where)[~gone])])[stays]
            kept += [flat[x:max(x, y - 1)].tobytes().decode() for x, y in zip(size[:-1].tolist(), size[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(np.concatenate(n_words) if n_words else [], pa.int64()),
             pa.array(begins, pa.list_(pa.int64())), pa.array(ends_, pa.list_(pa.int64())), pa.array(kept, pa.string()),
             *b.columns[2:-1]], ["id", "n_words", "span_starts", "span_ends", "kept", *b.schema.names[2:-1]])


def passage_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_words, span_starts, span_ends, kept) of every row: its removed runs of words, and the words that stay,
    joined by one space. The columns in ``carry`` come along, as struct ``row``."""
    row = [F.struct(*carry).alias("row")] if carry else []
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *row)
    parts = shuffle_parts(docs)
    found = docs.join(recurring_anchors(docs), "id", "left")
    labels = partition_labels(docs.sparkSession, parts)
    # documents without places are left out in the task: a filter here would keep Spark from using one shuffle of the texts twice
    segments = found.select("id", "text", "places").mapInArrow(lambda it: _segment_batches(it, labels),
                                                               "part long, n long, blob binary")
    spans = (segments.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_span_batches, "id long, span long")
             .groupBy("id").agg(F.collect_set("span").alias("spans")))
    schema = ("id long, n_words long, span_starts array<long>, span_ends array<long>, kept string"
              + "".join(f", row {docs.schema['row'].dataType.simpleString()}" for _ in row))
    return docs.join(spans, "id", "left").mapInArrow(_cut_batches, schema).withColumnRenamed("id", id_col)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
low AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s),
gone AS (
  SELECT DISTINCT win.doc_id, i + j AS at
  FROM win JOIN low ON low.s = win.s AND low.first < win.doc_id, (SELECT unnest(generate_series(0, 12)) AS j)),
word AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS at FROM d),
rest AS (
  SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.at) AS kept, count(*) AS n
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.at = word.at WHERE gone.at IS NULL GROUP BY word.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN rest ON rest.doc_id = d.doc_id
"""
