"""Byte-level helpers shared by the operators of this subpackage.

All of them work on Arrow string columns as one byte buffer plus row offsets,
so a batch of texts is handled by a few numpy passes and no per-row Python.
Batches are walked in slices of about ``SLICE_BYTES`` (a longer text is a slice
of its own), which bounds the temporary arrays whatever the batch size is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.session import cut_lineage

SLICE_BYTES = 1 << 20

# white space that ends a word: space and \t \n \v \f \r
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1, from 0) of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, target: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``target`` bytes; a longer row is alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + target, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def text_slices(column, target: int = SLICE_BYTES):
    """(first row, end row, bytes, offsets) of each slice of a string column."""
    data, offsets = text_buffers(column)
    for i, j in row_slices(offsets, target):
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64), element-wise."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        m = max(n + 1, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            t = np.full(m, base, np.uint64)
            t[0] = 1
            _powers[k] = np.cumprod(t)
    return _powers[0], _powers[1]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` reads the hash of any span."""
    power, _ = _power_tables(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes [start, end): equal bytes, equal hash, wherever they are.

    It chooses candidates only: unlike bytes can share a hash (a polynomial modulo 2^64 has such pairs for
    every base), so equal hashes aren't taken for equal bytes. ``exact_codes`` and ``word_keys`` tell bytes apart.
    """
    _, inverse = _power_tables(len(sums) - 1)
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the index of each row's first word (rows + 1)."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    word = ~SEPARATOR[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1] | edge[1:n]
    end[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def exact_codes(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Codes of the byte strings that lie one behind the other in ``flat``, equal just where the bytes are, and the distinct strings."""
    ends = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    strings = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))])
    coded = strings.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """``exact_codes`` of the words of ``word_spans``."""
    return exact_codes(data[~SEPARATOR[data]], ends - starts)


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit key of each word that is the same in all tasks: the digest of its bytes, so that no two words are known to share one."""
    code, words = word_codes(data, starts, ends)
    digest = b"".join([hashlib.blake2b(w, digest_size=8).digest() for w in words.to_pylist()])
    return np.frombuffer(digest, np.uint64)[code]


def joined_codes(*columns: np.ndarray) -> np.ndarray:
    """One code for each row of several columns of codes, equal just where all columns are."""
    key, top = columns[0].astype(np.int64), int(columns[0].max(initial=0)) + 1
    for c in columns[1:]:
        base = int(c.max(initial=0)) + 1
        if top > (1 << 62) // base:                  # ranks take the place of the codes
            key = np.unique(key, return_inverse=True)[1]
            top = int(key.max(initial=0)) + 1
        key, top = key * base + c, top * base
    return key


def row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each row's range."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def window_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k consecutive words of a row, and the word each begins at."""
    n = len(words)
    at = np.arange(max(n - k + 1, 0))
    row_end = np.repeat(first[1:], np.diff(first))
    at = at[at + k <= row_end[:len(at)]] if len(at) else at
    h = np.zeros(len(at), np.uint64)
    for j in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[at + j]
    return mix(h), at


def shuffle_parts(df: DataFrame, at_least: int = 1) -> int:
    """The session's number of shuffle partitions (sized by its owner to the data)."""
    return max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def once(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    return cut_lineage(df)


def parquet(spark, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of one table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
