"""Operator 13: phrase collocations from an FM-index per shard.

1. Shards. Texts are cut into words and pieces in their tasks; the words of one stratum (``lang``) in one task form
   shards of about ``SHARD`` words, cut between pieces. A shard holds its distinct words with their counts and the
   row of local word ids. Shards are written once to the shared folder.
2. Vocabulary. Summed over shards, words below ``min_count`` are dropped: no frequent phrase holds one, so they
   only end pieces. A word meets itself at most once per shard, so a frequent word is no hot key.
3. FM-index. Each shard builds the index of its word ids read forwards and backwards, sorted by ``depth`` words of
   context: the transformed text (BWT) holds the symbol before each sorted place, and its interval for a phrase
   lists the phrase's neighbours. A phrase is a pair of intervals, one in each index; extending it to the right is one step
   in the backward index (LF mapping) while the forward interval narrows along, and the other way round for the left. All
   phrases of one length are extended together in numpy. Sorting by ``depth`` symbols is enough as no phrase is longer.
4. Sum. Counts of phrases (word ids only) are added up across shards; phrases below ``min_count`` go. What is left
   gives each phrase its extensions: the longer phrases that begin or end with it.
5. Score. Each cut of a phrase into two parts compares a = f(phrase) with f of the parts, exactly
   (decimals): ``floor(1000000 * a * a / (l * r))``; the lowest cut counts, ties to the shortest first part. A phrase is dropped
   where a longer candidate that holds it has at least half its count. The best ``top`` of each stratum are ranked.

Words: ``[^\\x20\\x09]+`` inside pieces, which end at ``[.,;:!?\\x0A-\\x0D]`` and at a text's end; A-Z are lower-cased.

Defined results: a null text is empty; a null stratum is ``und``; every row counts, also rows that repeat an id or
have none; an empty table gives an empty result; other columns are ignored. A single piece of more than twice
``SHARD`` words is a shard of its own.
"""

from __future__ import annotations

from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_slices
from tessera.session import fresh_path

SHARD = 1_000_000                # words from which a shard is closed; it holds twice as many at most
POSITIONS = 1 << 27              # distinct words that a shard may hold
SCALE = 1_000_000

BREAK = np.zeros(256, bool)
BREAK[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
GAP = np.zeros(256, bool)
GAP[list(b" \t")] = True


# ---- words and shards ----------------------------------------------------------------------------

def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of a slice, and a flag at each word that begins a piece."""
    low = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    stop = BREAK[low]
    inside = ~(stop | GAP[low])
    n = len(low)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end[:-1] &= ~inside[1:] | edge[1:n]
    at, to = np.flatnonzero(start), np.flatnonzero(end) + 1
    pieces = np.cumsum(stop | edge[:n])[at] if n else at
    fresh = np.ones(len(at), bool)
    fresh[1:] = pieces[1:] != pieces[:-1]
    ends = np.concatenate([[0], np.cumsum(to - at)]).astype(np.int64)
    flat = np.ascontiguousarray(low[inside])
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(flat)), fresh


def _shard(words: pa.ChunkedArray, fresh: np.ndarray) -> tuple[pa.Array, np.ndarray, int, bytes]:
    """(distinct words, counts, bytes, packed row of local ids) of a shard; 0 stands before each piece, words count from 1."""
    coded = words.combine_chunks().dictionary_encode()
    if len(coded.dictionary) >= POSITIONS:
        raise ValueError(f"a piece without a break holds {len(coded.dictionary)} different words")
    ids = coded.indices.to_numpy().astype(np.int32) + 1
    row = np.zeros(len(ids) + int(fresh.sum()), np.int32)
    row[np.arange(len(ids)) + np.cumsum(fresh)] = ids
    counts = np.bincount(ids, minlength=len(coded.dictionary) + 1)[1:]
    return coded.dictionary, counts, row.nbytes, pa.compress(row.tobytes(), codec="zstd", asbytes=True)


class _Held:
    """Words of one stratum that wait for a full shard."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.fresh: list[np.ndarray] = []
        self.count = 0

    def add(self, words: pa.Array, fresh: np.ndarray) -> None:
        if len(words):
            self.words.append(words)
            self.fresh.append(fresh)
            self.count += len(words)

    def shards(self):
        """The shards of what is held, which is then given up."""
        words, fresh = pa.chunked_array(self.words, pa.large_string()), np.concatenate(self.fresh)
        self.__init__()
        heads = np.append(np.flatnonzero(fresh), len(fresh))
        begin = 0
        while begin < len(fresh):
            end = len(fresh)
            if end - begin > 2 * SHARD:                      # the last piece that fits, or a longer one alone
                k = int(np.searchsorted(heads, begin + 2 * SHARD, "right"))
                end = int(heads[k - 1] if heads[k - 1] > begin else heads[k])
            yield _shard(words.slice(begin, end - begin), fresh[begin:end])
            begin = end


def _shard_batches(batches):
    held: dict[str, _Held] = {}
    number = TaskContext.get().partitionId() << 16

    def out(stratum: str):
        nonlocal number
        for words, counts, size, row in held.pop(stratum).shards():
            if number & 0xFFFF == 0xFFFF:
                raise ValueError("more than 65,535 shards in one task")
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([stratum]),
                 pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())),
                 pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(counts, pa.int64())),
                 pa.array([size], pa.int64()), pa.array([row], pa.binary())],
                ["shard", "stratum", "words", "counts", "n_bytes", "ids"])
            number += 1

    for b in batches:
        strata = b.column(0)
        for s in strata.unique().to_pylist():
            mine = b.column(1).filter(pc.equal(strata, s))
            for _, _, data, offsets in text_slices(mine):
                h = held.setdefault(s, _Held())
                h.add(*words_of(data, offsets))
                if h.count >= SHARD:
                    yield from out(s)
        if sum(h.count for h in held.values()) > 2 * SHARD:        # many strata: none may wait for ever
            for s in sorted(held, key=lambda s: -held[s].count)[:max(1, len(held) // 2)]:
                if held[s].count:
                    yield from out(s)
    for s in [s for s in held if held[s].count]:
        yield from out(s)


# ---- FM-index ------------------------------------------------------------------------------------

def _context_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of a circular text in the order of their first ``depth`` symbols."""
    n, base = len(text), int(text.max(initial=0)) + 1
    key, top = text.astype(np.int64), base
    for k in range(1, depth):
        if top > (1 << 62) // base:                      # names in the same order take the place of the symbols
            names, key = np.unique(key, return_inverse=True)
            top = len(names)
        key, top = key * base + np.roll(text, -k), top * base
    return np.argsort(key, kind="stable")


class FMIndex:
    """Index of a circular text of ids, sorted by ``depth`` symbols; its BWT holds the symbol before each place."""

    def __init__(self, text: np.ndarray, depth: int):
        self.n = len(text)
        self.bwt = text[_context_order(text, depth) - 1]             # before place 0 comes the last symbol: circular
        self.rank = self.bwt.astype(np.int64) * self.n               # (symbol, place in the BWT): C and Occ in one row
        self.rank += np.arange(self.n)
        self.rank.sort()

    def symbol_start(self, symbol: np.ndarray) -> np.ndarray:
        """C: where the interval of a single symbol begins."""
        return np.searchsorted(self.rank, symbol * self.n)

    def step(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """LF mapping: C[symbol] + Occ(symbol, place)."""
        return np.searchsorted(self.rank, symbol * self.n + place)

    def neighbours(self, start: np.ndarray, size: np.ndarray):
        """(interval, symbol, count, how many of the interval's symbols are smaller) for each different symbol."""
        first = np.cumsum(size) - size
        width = int(self.rank[-1] // self.n) + 1
        place = np.repeat(start - first, size)
        place += np.arange(len(place))
        key = np.repeat(np.arange(len(size)) * width, size)
        key += self.bwt[place]
        del place
        key.sort()
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(head, len(key)))
        owner, symbol = key[head] // width, key[head] % width
        return owner, symbol, count, head - first[owner]


class BidirectionalIndex:
    """A text's forward and backward index; a phrase is a pair of intervals of one size."""

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.depth = text, depth

    @cached_property
    def forward(self) -> FMIndex:
        """Built when a phrase is first extended to the left."""
        return FMIndex(self.text, self.depth)

    @cached_property
    def backward(self) -> FMIndex:
        return FMIndex(self.text[::-1], self.depth)

    def single(self, symbols: np.ndarray):
        """Intervals of the phrases of one symbol: (forward start, backward start, size)."""
        start, end = self.backward.symbol_start(symbols), self.backward.symbol_start(symbols + 1)
        return start, start, end - start                             # both texts hold the same symbols

    def extend_right(self, forward: np.ndarray, backward: np.ndarray, size: np.ndarray):
        """(phrase, symbol behind it, forward start, backward start, size) of all right extensions but by the symbol 0."""
        return self._extend(self.backward, backward, forward, size)

    def extend_left(self, forward: np.ndarray, backward: np.ndarray, size: np.ndarray):
        """(phrase, symbol before it, forward start, backward start, size) of all left extensions but by the symbol 0."""
        owner, symbol, back, fore, count = self._extend(self.forward, forward, backward, size)
        return owner, symbol, fore, back, count

    @staticmethod
    def _extend(index: FMIndex, start, other, size):
        owner, symbol, count, smaller = index.neighbours(start, size)
        real = symbol > 0
        owner, symbol, count, smaller = owner[real], symbol[real], count[real], smaller[real]
        return owner, symbol, other[owner] + smaller, index.step(symbol, start[owner]), count

    def phrases(self, depth: int):
        """For each length from 2 to ``depth``: (ids, one column a word; count) of all phrases of the text."""
        symbols = np.unique(self.text)
        symbols = symbols[symbols > 0].astype(np.int64)
        fore, back, size = self.single(symbols)
        words = symbols[:, None]
        for _ in range(depth - 1):
            owner, symbol, fore, back, size = self.extend_right(fore, back, size)
            words = np.concatenate([words[owner], symbol[:, None]], 1)
            yield words, size


def _phrase_batches(batches, depth: int):
    """Rows (w1 .. w_depth, count) of the shards' phrases; -1 where a phrase is shorter."""
    for b in batches:
        for k in range(b.num_rows):
            size, place, known = int(b.column(0)[k].as_py()), b.column(2)[k].values, b.column(3)[k].values
            row = np.frombuffer(pa.decompress(b.column(1)[k].as_buffer(), decompressed_size=size, codec="zstd"), np.int32)
            place, known = place.to_numpy(zero_copy_only=False), known.to_numpy(zero_copy_only=False)
            local = np.zeros(int(row.max(initial=0)) + 1, np.int32)   # rare words stay 0 and end a piece
            local[place + 1] = np.arange(1, len(place) + 1)
            text = local[row]
            text = np.concatenate([np.zeros(1, np.int32), text[(text > 0) | (np.roll(text, 1) > 0)]])
            for words, count in BidirectionalIndex(text, depth).phrases(depth):
                for i in range(0, len(count), 1 << 18):
                    w = known[words[i:i + (1 << 18)] - 1]
                    short = [pa.array(np.full(len(w), -1))] * (depth - w.shape[1])
                    yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in w.T), *short,
                                                      pa.array(count[i:i + (1 << 18)])],
                                                     [*(f"w{j + 1}" for j in range(depth)), "count"])


# ---- counts over all shards ----------------------------------------------------------------------

def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def phrase_counts(docs: DataFrame, stratum_col: str = "lang", text_col: str = "text", depth: int = 3,
                  min_count: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals) of the texts.

    words: (gid, stratum, word, f) of the words with f >= min_count; phrases: (w1 .. w_depth, f), as gids, of the
    phrases of 2 to ``depth`` words with f >= min_count, -1 behind a shorter one; totals: (stratum, n) of all words.
    """
    spark = docs.sparkSession
    text = docs.select(F.coalesce(F.col(stratum_col).cast("string"), F.lit("und")).alias("stratum"), F.col(text_col).alias("text"))
    shards = _kept(text.mapInArrow(_shard_batches, "shard long, stratum string, words array<string>, counts array<long>, "
                                                   "n_bytes long, ids binary"), "shards")
    totals = shards.select("stratum", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")) \
        .groupBy("stratum").agg(F.sum("n").alias("n"))
    entry = shards.select("shard", "stratum", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "e")) \
        .select("shard", "stratum", "place", F.col("e.words").alias("word"), F.col("e.counts").alias("count"),
                (F.col("shard") * POSITIONS + F.col("place")).alias("own"))
    same = Window.partitionBy("stratum", "word")
    found = (entry.withColumn("f", F.sum("count").over(same)).withColumn("gid", F.min("own").over(same))
             .where(F.col("f") >= min_count))
    first = F.col("own") == F.col("gid")                              # one row of each word carries it
    found = _kept(found.select("shard", "place", "gid", *(F.when(first, F.col(c)).alias(c) for c in ("stratum", "word", "f"))), "words")
    words = found.where("word IS NOT NULL").select("gid", "stratum", "word", "f")
    known = (found.groupBy("shard").agg(F.collect_list(F.struct("place", "gid")).alias("e"))
             .select("shard", F.col("e.place").alias("place"), F.col("e.gid").alias("gid")))
    names = [f"w{j + 1}" for j in range(depth)]
    rows = (shards.select("shard", "n_bytes", "ids").join(known, "shard").select("n_bytes", "ids", "place", "gid")
            .mapInArrow(lambda it: _phrase_batches(it, depth), ", ".join(f"{c} long" for c in [*names, "count"])))
    phrases = rows.groupBy(*names).agg(F.sum("count").alias("f")).where(F.col("f") >= min_count)
    return words, _kept(phrases, "phrases"), totals


def extensions(phrases: DataFrame, depth: int = 3) -> DataFrame:
    """(w1 .. w_depth, left_max, right_max): the counts of each phrase's most frequent extensions by one word.

    Only phrases of two words or more that a longer one in ``phrases`` begins or ends with are returned.
    """
    names = [f"w{j + 1}" for j in range(depth)]
    none = F.lit(-1).cast("long")
    head = [F.when(F.col(names[j + 1]) >= 0, F.col(names[j])).otherwise(none) for j in range(depth - 1)] + [none]
    tail = [F.col(c) for c in names[1:]] + [none]
    parts = [F.struct(F.lit(side).alias("side"), *(c.alias(n) for c, n in zip(part, names)))
             for side, part in (("right", head), ("left", tail))]
    shorter = phrases.select("f", F.explode(F.array(*parts)).alias("e")).select("f", "e.*").where("w2 >= 0")
    return shorter.groupBy(*names).agg(*(F.max(F.when(F.col("side") == s, F.col("f"))).alias(f"{s}_max") for s in ("left", "right")))


def _frequency(words: DataFrame, phrases: DataFrame, depth: int, span: list[str], name: str) -> DataFrame:
    """The counts of single words or of phrases of len(span) words, keyed by the columns ``span``."""
    m = len(span)
    if m == 1:
        return words.select(F.col("gid").alias(span[0]), F.col("f").alias(name))
    return _of_length(phrases, depth, m).select(*(F.col(f"w{j + 1}").alias(c) for j, c in enumerate(span)), F.col("f").alias(name))


def _of_length(phrases: DataFrame, depth: int, m: int) -> DataFrame:
    whole = F.col(f"w{m}") >= 0
    return phrases.where(whole & (F.col(f"w{m + 1}") < 0) if m < depth else whole)


def _floor_score(left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exact below 10^15 occurrences."""
    a, x, y = (f"CAST({c} AS DECIMAL(15,0))" for c in ("a", left, right))
    return F.expr(f"({a} * {a} * CAST({SCALE} AS DECIMAL(7,0))) div ({x} * {y})")


def collocations(docs: DataFrame, stratum_col: str = "lang", text_col: str = "text", depth: int = 3, min_count: int = 10,
                 top: int = 2000, held_share: int = 50) -> DataFrame:
    """(stratum, rank, phrase, a, l, r, n, score) of the ``top`` phrases of each stratum.

    A phrase is dropped where a longer candidate with ``100 * f >= held_share * a`` holds it.
    """
    words, phrases, totals = phrase_counts(docs, stratum_col, text_col, depth, min_count)
    names = [f"w{j + 1}" for j in range(depth)]
    parts = []
    for m in range(2, depth + 1):
        rows = _of_length(phrases, depth, m).select(*names[:m], F.col("f").alias("a"))
        for k in range(1, m):
            for side, span in (("l", names[:k]), ("r", names[k:m])):
                rows = rows.join(_frequency(words, phrases, depth, span, f"{side}{k}"), span)
        cuts = [F.struct(_floor_score(f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
                         F.col(f"r{k}").alias("r")) for k in range(1, m)]
        rows = rows.withColumn("cut", F.array_min(F.array(*cuts)))
        rows = rows.select(*names[:m], *(F.lit(-1).cast("long").alias(c) for c in names[m:]), "a", "cut.l", "cut.r", "cut.score")
        parts.append(rows)
    scored = reduce(DataFrame.unionByName, parts)
    most = F.greatest("left_max", "right_max")               # the next longer phrases are the most frequent ones that hold it
    scored = (scored.join(extensions(phrases, depth), names, "left")
              .where(most.isNull() | (100 * most < held_share * F.col("a"))))
    for c in names:
        scored = scored.join(words.select(F.col("gid").alias(c), F.col("word").alias(f"{c}_word"),
                                          *([F.col("stratum")] if c == "w1" else [])), c, "inner" if c in ("w1", "w2") else "left")
    scored = scored.withColumn("phrase", F.concat_ws(" ", *(f"{c}_word" for c in names)))
    best = Window.partitionBy("stratum").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "stratum").select("stratum", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
s AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, w[i:i + k - 1] AS ws
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM s, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, ws, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, ws, f AS a FROM f WHERE k > 1 AND f >= 10),
cut AS (SELECT lang, k, ws, a, unnest(generate_series(1, k - 1)) AS j FROM c),
scored AS (
  SELECT cut.lang, cut.k, cut.ws, a, j, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f * y.f) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.ws = cut.ws[1:j] JOIN f y ON y.lang = cut.lang AND y.ws = cut.ws[j + 1:]),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, j) = 1),
held AS (
  SELECT lang, ws, max(f) AS f FROM (
    SELECT lang, ws[1:2] AS ws, a AS f FROM c WHERE k = 3 UNION ALL SELECT lang, ws[2:3], a FROM c WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT low.lang, array_to_string(low.ws, ' ') AS phrase, a, l, r, score
  FROM low LEFT JOIN held ON held.lang = low.lang AND held.ws = low.ws WHERE held.f IS NULL OR 100 * held.f < 50 * a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN t ON t.lang = kept.lang
QUALIFY rank <= 2000
"""
