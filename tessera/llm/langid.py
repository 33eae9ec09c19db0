"""Operator 2: language identification by a byte convolutional network.

Texts are cut into windows of ``WINDOW`` bytes (the whole text; the last window is padded
with zeros). Each byte has a learned vector; filters of several widths run over the window,
are rectified and max-pooled, and a softmax layer gives the window's probabilities. A text's
probabilities are the normalised geometric mean over its windows, weighted by their bytes. The network is trained in numpy
(Adam, cross entropy) on a bounded sample of labelled texts: at most ``docs_per_lang`` texts a language,
``windows_per_doc`` windows of each, spread over the whole text. Its few thousand weights travel to
the tasks, where the convolution of a width is a sum of table rows: a table of 65,536
rows holds each byte pair's share of every filter.

The sample also tells what text of these languages looks like: ``coverage`` is the share of a text's byte triples that
occur in a training window (a table of 2^24 bits). A softmax must choose a language for anything; text in another script or
language and letters without sense have a low coverage whatever is chosen. ``cutoffs`` sets, per predicted language, the least
coverage and score from labelled texts that weren't learned from, at a stated rate of false rejections.

Defined results: a null text or one without a letter is ``und`` with score 0; with no labelled text
at all every text is; ties go to the first label in order; an empty table gives an
empty result; a null id is never held out and never learned from; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import text_buffers

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
DIM = 8


class ByteCNN:
    """Embedding -> convolutions -> ReLU -> max pool -> softmax."""

    def __init__(self, n_out: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {"E": rng.normal(0, 0.3, (256, DIM)).astype(np.float32)}
        self.p["E"][0] = 0
        for w in WIDTHS:
            self.p[f"W{w}"] = rng.normal(0, (2 / (w * DIM)) ** 0.5, (w * DIM, FILTERS)).astype(np.float32)
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.p["V"] = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), n_out)).astype(np.float32)
        self.p["c"] = np.zeros(n_out, np.float32)

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of a batch of windows."""
        p, n = self.p, len(x)
        e = p["E"][x]
        pooled, kept = [], []
        for w in WIDTHS:
            t = WINDOW - w + 1
            cols = np.concatenate([e[:, j:j + t] for j in range(w)], axis=2)
            z = cols @ p[f"W{w}"] + p[f"b{w}"]
            top = z.argmax(1)
            best = np.take_along_axis(z, top[:, None], 1)[:, 0]
            pooled.append(np.maximum(best, 0))
            kept.append((w, cols, top, best > 0))
        h = np.concatenate(pooled, 1)
        out = h @ p["V"] + p["c"]
        out = np.exp(out - out.max(1, keepdims=True))
        out /= out.sum(1, keepdims=True)
        loss = float(-np.log(out[np.arange(n), y] + 1e-9).mean())
        d = out.copy()
        d[np.arange(n), y] -= 1
        d /= n
        g = {"V": h.T @ d, "c": d.sum(0), "E": np.zeros_like(p["E"])}
        dh = d @ p["V"].T
        for i, (w, cols, top, on) in enumerate(kept):
            dz = dh[:, i * FILTERS:(i + 1) * FILTERS] * on
            picked = np.take_along_axis(cols, top[:, :, None], 1)          # n, filters, w * dim
            g[f"W{w}"] = np.einsum("nfd,nf->df", picked, dz)
            g[f"b{w}"] = dz.sum(0)
            back = dz[:, :, None] * p[f"W{w}"].T[None]                      # n, filters, w * dim
            for j in range(w):
                at = x[np.arange(n)[:, None], top + j]
                np.add.at(g["E"], at, back[:, :, j * DIM:(j + 1) * DIM])
        g["E"][0] = 0
        return loss, g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 1500, batch: int = 64, rate: float = 4e-3,
            seed: int = 11) -> ByteCNN:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(a) for k, a in self.p.items()}
        t = 0
        while t < steps:
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                t += 1
                _, g = self.step(x[order[i:i + batch]], y[order[i:i + batch]])
                lr = rate * max(0.0, 1 - t / (steps + 1))
                for k, dk in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * dk
                    v[k] = 0.99 * v[k] + 0.01 * dk * dk
                    self.p[k] -= (lr * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
        return self

    def tables(self) -> list[tuple[int, list[tuple[int, np.ndarray]], np.ndarray]]:
        """Per width: (offset, table) pairs whose rows add up to the convolution, and the bias."""
        out = []
        for w in WIDTHS:
            part = [self.p["E"] @ self.p[f"W{w}"][j * DIM:(j + 1) * DIM] for j in range(w)]
            terms = []
            for j in range(0, w - 1, 2):
                terms.append((j, np.ascontiguousarray((part[j][:, None] + part[j + 1][None]).reshape(65536, FILTERS))))
            if w % 2:
                terms.append((w - 1, part[w - 1]))
            out.append((w, terms, self.p[f"b{w}"]))
        return out


def predict_windows(windows: np.ndarray, tables, V: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Probabilities of each window; the same network as ``ByteCNN.step``."""
    pairs = windows[:, :-1].astype(np.uint16) * np.uint16(256) + windows[:, 1:]
    pooled = []
    for w, terms, bias in tables:
        t = WINDOW - w + 1
        z = None
        for j, table in terms:
            rows = np.take(table, (pairs if len(table) > 256 else windows)[:, j:j + t], axis=0)
            z = rows if z is None else np.add(z, rows, out=z)
        pooled.append(np.maximum(z.max(axis=1) + bias, 0))
    out = np.concatenate(pooled, 1) @ V + c
    out = np.exp(out - out.max(1, keepdims=True))
    return out / out.sum(1, keepdims=True)


def _windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of every row, the row of each, and its bytes."""
    lengths = np.diff(offsets)
    counts = -(-lengths // WINDOW)
    row = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[:-1][row] + nth * WINDOW
    size = np.minimum(lengths[row] - nth * WINDOW, WINDOW)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    out = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start]
    out[np.arange(WINDOW)[None] >= size[:, None]] = 0
    return out, row, size


def _learn(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str,
           docs_per_lang: int, windows_per_doc: int) -> tuple | None:
    """The model trained on the sample (labels, convolution tables, last layer, known triples); None when nothing is labelled."""
    pool = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in pool.groupBy(lang_col).count().collect()}
    if not counts:
        return None
    labels = sorted(counts)
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col(lang_col) == lang, min(1.0, 1.3 * docs_per_lang / n + 20 / n)).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1_000_003)) / 1_000_003
    picked = (pool.where(drawn < share)
              .select(F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("key"),
                      F.col(text_col).alias("text"))
              .mapInArrow(lambda batches: _sample_windows(batches, windows_per_doc),
                          "lang string, key long, windows binary")
              .limit(2 * docs_per_lang * len(labels)).collect())
    x, y, seen = [], [], dict.fromkeys(labels, 0)
    for r in sorted(picked, key=lambda r: (r.lang, r.key, bytes(r.windows))):
        if seen[r.lang] < docs_per_lang and len(r.windows):
            seen[r.lang] += 1
            w = np.frombuffer(bytes(r.windows), np.uint8).reshape(-1, WINDOW)
            x.append(w)
            y.append(np.full(len(w), labels.index(r.lang)))
    if not x:
        return None
    windows = np.concatenate(x)
    net = ByteCNN(len(labels)).fit(windows, np.concatenate(y))
    return labels, net.tables(), net.p["V"], net.p["c"], known_triples(windows)


def known_triples(windows: np.ndarray) -> np.ndarray:
    """Packed bits: which byte triples the windows hold."""
    seen = np.zeros(1 << 24, bool)
    w = windows.astype(np.int32)
    triple = (w[:, :-2] << 16) | (w[:, 1:-1] << 8) | w[:, 2:]
    seen[triple[w[:, 2:] > 0]] = True                # not the padding
    return np.packbits(seen)


def coverage(data: np.ndarray, offsets: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Share of each row's byte triples that are known; 0 for a row without one."""
    hit = np.zeros(len(data) + 1, np.int64)
    if len(data) > 2:
        w = data.astype(np.int32)
        triple = (w[:-2] << 16) | (w[1:-1] << 8) | w[2:]
        np.cumsum((seen[triple >> 3] >> (7 - (triple & 7)).astype(np.uint8)) & 1, out=hit[1:-2])
        hit[-2:] = hit[-3]
    end = np.maximum(offsets[1:] - 2, offsets[:-1])
    return (hit[end] - hit[offsets[:-1]]) / np.maximum(end - offsets[:-1], 1)


def _sample_windows(batches, windows_per_doc: int):
    for b in batches:
        data, offsets = text_buffers(b.column(2))
        out = []
        for i in range(len(offsets) - 1):
            w, _, _ = _windows(data[offsets[i]:offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
            at = np.unique(np.linspace(0, len(w) - 1, windows_per_doc).astype(int)) if len(w) else []
            out.append(w[at].tobytes() if len(w) else b"")
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())],
                                         ["lang", "key", "windows"])


def learn_languages(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    docs_per_lang: int = 600, windows_per_doc: int = 6) -> tuple | None:
    """A model for ``predict_languages``; ``learn`` says which rows may be learned from. None when nothing is labelled."""
    return _learn(docs, learn, id_col, text_col, lang_col, docs_per_lang, windows_per_doc)


def identify_language(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      docs_per_lang: int = 600, windows_per_doc: int = 6, whole_rows: bool = False) -> DataFrame:
    """(id, lang_pred, score, coverage) of every row; ``learn`` says which rows may be learned from.

    With ``whole_rows`` also the row itself, as struct ``row``.
    """
    model = _learn(docs, learn, id_col, text_col, lang_col, docs_per_lang, windows_per_doc)
    return predict_languages(docs, model, id_col, text_col, whole_rows)


FAMILIAR = 0.75                  # least coverage, as a share of a language's median


def cutoffs(found: DataFrame, false_rejection: float = 0.01) -> dict[str, tuple[float, float]]:
    """lang_pred -> (least score, least coverage) such that of the labelled rows ``found`` (lang_pred, score, coverage), which
    weren't learned from, at most the stated share lies below either.

    The least coverage is never under ``FAMILIAR`` of the language's median, so a few rows with a wrong label can't let in what
    is unlike the language. All rows count; one row a language reaches the driver.
    """
    at = F.array(F.lit(false_rejection / 2), F.lit(0.5))
    rows = found.where(F.col("lang_pred") != "und").groupBy("lang_pred").agg(
        *(F.percentile_approx(c, at, F.lit(100_000)).alias(c) for c in ("score", "coverage"))).collect()
    return {r.lang_pred: (r.score[0], max(r.coverage[0], FAMILIAR * r.coverage[1])) for r in rows}


def accepted(cuts: dict[str, tuple[float, float]]) -> Column:
    """Rows (lang_pred, score, coverage) in a language with cutoffs, and above them."""
    ok = F.lit(False)
    for lang, (score, cover) in cuts.items():
        ok = ok | ((F.col("lang_pred") == lang) & (F.col("score") >= score) & (F.col("coverage") >= cover))
    return ok


def predict_languages(docs: DataFrame, model: tuple | None, id_col: str = "doc_id", text_col: str = "text",
                      whole_rows: bool = False) -> DataFrame:
    """(id, lang_pred, score, coverage) of every row by a model of ``learn_languages``."""
    row = [F.struct(*docs.columns).alias("row")] if whole_rows else []
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                         F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False)).alias("letters"), *row)
    if model is None:
        return narrow.select(F.col("id").alias(id_col), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("coverage"),
                             *(["row"] if row else []))
    schema = T.StructType([narrow.schema["id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("coverage", T.DoubleType()),
                           *(narrow.schema["row"] for _ in row)])
    labels, tables, V, c, triples = model

    def run(batches):
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            has = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            total = np.zeros((len(offsets) - 1, len(labels)))
            known = np.zeros(len(total))
            step = 256                                   # rows at a time
            for i in range(0, len(total), step):
                j = min(i + step, len(total))
                part = offsets[i:j + 1]
                w, row, size = _windows(data[part[0]:part[-1]], part - part[0])
                known[i:j] = coverage(data[part[0]:part[-1]], part - part[0], triples)
                for k in range(0, len(w), 1024):         # windows at a time
                    prob = np.log(predict_windows(w[k:k + 1024], tables, V, c) + 1e-9)
                    np.add.at(total, row[k:k + 1024] + i, prob * size[k:k + 1024, None])
            mean = total / np.maximum(np.diff(offsets), 1)[:, None]
            share = np.exp(mean - mean.max(1, keepdims=True))
            best = share.argmax(1)
            score = np.where(has, 1 / share.sum(1), 0.0)
            pred = np.where(has, np.array(labels, object)[best], "und")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pred, pa.string()), pa.array(np.clip(score, 0, 1), pa.float64()), pa.array(known),
                 *b.columns[3:]],
                ["id", "lang_pred", "score", "coverage", *b.schema.names[3:]])

    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """The fixed third of rows that is never learned from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
