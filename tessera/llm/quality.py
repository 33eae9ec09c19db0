"""Operator 10: quality rules with risk-controlled thresholds.

Per text a fixed base test and ``RULES``: ratios that reject a text when they lie
above a cutoff. Cutoffs are not hand-set. Every rule has a fixed ladder of cutoffs,
loosest first. On labelled texts of good quality (the holdout: nothing is fitted on
it) each step of the ladder is tested per stratum: with ``k`` of ``n`` good texts
rejected, the exact (Clopper-Pearson) upper bound of the false-rejection rate must
not exceed the rule's share of ``max_false_rejection``. Multiple testing: the ladder
is walked as a fixed sequence that ends at the first failure, so its steps need no
further correction, and the error probability ``delta`` is divided by the number of
strata times rules (Bonferroni). Hence, with probability 1 - delta, no stratum loses more
than ``max_false_rejection`` of its good texts. Among the certified steps the one
with the best yield is used: most bad texts less ``COST`` times the good ones, ties to the looser.

Defined results: a null text is an empty one (no words, base test failed); a null
stratum is a stratum of its own; a stratum with too few labels gets no cutoff and its
texts pass the rules; rows with equal ids are judged on their own texts, and an
id that is labelled more than once is good only if all its labels are; a null id has no label; an
empty table gives an empty result. Other columns are ignored whatever their name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import exact_codes, joined_codes, once, row_sums, text_slices, word_codes, word_spans

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
          "n_upper", "n_lower")

# rule -> (numerator, denominator)
RULES = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"),
         "repeats": ("n_repeat_words", "n_words"), "upper": ("n_upper", "n_upper + n_lower"),
         "word_length": ("word_chars", "20 * n_words")}
# the ladder, loosest first; a ratio above the cutoff rejects
LADDER = (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02, 0.01)
COST = 20


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    flag = np.zeros(len(keys), bool)
    flag[order[1:][same]] = True
    flag[order[:-1][same]] = True
    return flag


def _later(keys: np.ndarray) -> np.ndarray:
    """True where an equal key occurs earlier."""
    order = np.argsort(keys, kind="stable")
    flag = np.zeros(len(keys), bool)
    flag[order[1:][keys[order][1:] == keys[order][:-1]]] = True
    return flag


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every row of a slice."""
    starts, ends, first = word_spans(data, offsets)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    point = (data & 0xC0) != 0x80
    inside = np.zeros(len(data) + 1, np.int64)
    np.cumsum(point, out=inside[1:])
    chars = inside[ends] - inside[starts]

    # lines start at rows and behind each \n but a row's last (the empty line there has no word)
    breaks = np.flatnonzero(data == 0x0A) + 1
    begin = np.sort(np.concatenate([offsets[:-1], breaks[~np.isin(breaks, offsets[1:])]]), kind="stable")
    line_row = np.searchsorted(offsets[:-1], begin, "right") - 1
    stop = np.concatenate([begin[1:], offsets[-1:]])
    ends_in_break = (stop > begin) & (np.append(data, 0)[np.maximum(stop - 1, 0)] == 0x0A)
    stop = stop - ends_in_break
    line = exact_codes(data[data != 0x0A], stop - begin)[0]
    filled = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
    line, line_row = line[filled], line_row[filled]
    rows = len(offsets) - 1
    n_lines = np.bincount(line_row, minlength=rows)
    n_dup = np.bincount(line_row[_later(joined_codes(line_row, line))], minlength=rows)

    word = word_codes(data, starts, ends)[0]
    at = np.arange(max(len(word) - 2, 0))
    at = at[owner[at] == owner[at + 2]]
    again = at[_repeated(joined_codes(owner[at], word[at], word[at + 1], word[at + 2]))]
    covered = np.zeros(len(starts) + 3, bool)
    for j in range(3):
        covered[again + j] = True
    return {"n_words": np.diff(first), "word_chars": row_sums(chars, first),
            "n_symbols": row_sums(SYMBOLS[data], offsets), "n_lines": n_lines, "n_dup_lines": n_dup,
            "n_repeat_words": row_sums(covered[:len(starts)], first),
            "n_upper": row_sums((data >= 65) & (data <= 90), offsets),
            "n_lower": row_sums((data >= 97) & (data <= 122), offsets)}


def text_features(docs: DataFrame, id_col: str, text_col: str, stratum_col: str, whole_rows: bool = False) -> DataFrame:
    """(id, stratum, the counts) of every text; with ``whole_rows`` also the row itself, as struct ``row``."""
    def run(batches):
        for b in batches:
            parts = [text_counts(data, offsets) for _, _, data, offsets in text_slices(b.column(2))]
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1),
                     *(pa.array(np.concatenate([p[c] for p in parts]), pa.int64()) for c in COUNTS),
                     *b.columns[3:]], ["id", "stratum", *COUNTS, *b.schema.names[3:]])

    row = [F.struct(*docs.columns).alias("row")] if whole_rows else []
    narrow = docs.select(F.col(id_col).alias("id"), F.col(stratum_col).cast("string").alias("stratum"),
                         F.col(text_col).alias("text"), *row)
    schema = T.StructType([narrow.schema["id"], narrow.schema["stratum"], *(T.StructField(c, T.LongType()) for c in COUNTS),
                           *(narrow.schema["row"] for _ in row)])
    return narrow.mapInArrow(run, schema)


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _beta(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta(1 - x, b, a)
    tiny = 1e-300
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    out = d
    for m in range(1, 100_000):
        for t in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + t * d or tiny)
            c = 1 + t / c or tiny
            out *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * out


def upper_bound(k: int, n: int, delta: float) -> float:
    """Clopper-Pearson: the rate p at which k or fewer of n have probability ``delta``."""
    if k >= n:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        # P(X <= k) = 1 - I_p(k + 1, n - k)
        low, high = (mid, high) if 1 - _beta(mid, k + 1, n - k) > delta else (low, mid)
    return high


def certified(rejected: list[tuple[int, int]], n: int, limit: float, delta: float) -> int | None:
    """Index of the chosen step: ``rejected`` has (good, bad) rejections of each step, loosest first."""
    best, best_yield = None, 0
    for step, (good, bad) in enumerate(rejected):
        # a bound above the limit needs no exact figure when the plain rate is above it
        if not n or good > limit * n or upper_bound(good, n, delta) > limit:
            break
        if bad - COST * good > best_yield:
            best, best_yield = step, bad - COST * good
    return best


def calibrate(features: DataFrame, labels: DataFrame, id_col: str, good_col: str,
              max_false_rejection: float, delta: float) -> dict[str, dict[str, float]]:
    """stratum -> rule -> cutoff. Only counts per (stratum, rule, step) reach the driver."""
    marks = (labels.select(F.col(id_col).alias("id"), F.col(good_col).alias("good"))
             .where("id IS NOT NULL AND good IS NOT NULL").groupBy("id").agg(F.min("good").alias("good")))
    steps = [F.struct(F.lit(r).alias("rule"), _step(r).alias("step")) for r in RULES]
    # one text of an id that has several labelled rows: the bound counts independent ones
    told = features.where(~base_failed()).join(marks, "id").groupBy("id").agg(F.min(F.struct("stratum", *COUNTS, "good")).alias("t"))
    table = (told.select("t.*").select(_stratum().alias("stratum"), (F.col("good") >= 1).alias("good"),
                     F.explode(F.array(*steps)).alias("r"))
             .groupBy("stratum", "good", "r.rule", "r.step").count().collect())
    strata = sorted({r.stratum for r in table})
    out: dict[str, dict[str, float]] = {}
    for s in strata:
        for rule in RULES:
            rows = [r for r in table if r.stratum == s and r["rule"] == rule]
            n = sum(r["count"] for r in rows if r.good)
            # a ratio above cutoff i (loosest first) lies above all later ones too: len - i cutoffs or more
            hit = [tuple(sum(r["count"] for r in rows if r.good == g and r["step"] >= len(LADDER) - i)
                         for g in (True, False)) for i in range(len(LADDER))]
            got = certified(hit, n, max_false_rejection / len(RULES), delta / (len(strata) * len(RULES)))
            if got is not None:
                out.setdefault(s, {})[rule] = LADDER[got]
    return out


def _stratum() -> F.Column:
    """A name for each stratum, also for the null one."""
    return F.coalesce(F.concat(F.lit("="), F.col("stratum")), F.lit(""))


def _ratio(rule: str) -> F.Column:
    a, b = RULES[rule]
    return F.expr(f"coalesce(try_divide({a}, {b}), 0D)")


def _step(rule: str) -> F.Column:
    """How many cutoffs of the ladder the ratio lies above."""
    r = _ratio(rule)
    return sum(((r > c).cast("int") for c in LADDER), F.lit(0))


def _verdict(features: DataFrame, cutoffs: dict[str, dict[str, float]]) -> DataFrame:
    failed = [F.when((_stratum() == s) & (_ratio(rule) > c), F.lit(rule))
              for s, rules in cutoffs.items() for rule, c in rules.items()]
    names = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return (features.withColumn("base_failed", base_failed()).withColumn("failed_rules", F.array_join(names, ","))
            .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == "")))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum_col: str = "lang", good_col: str = "quality",
                  max_false_rejection: float = 0.05, delta: float = 0.05) -> DataFrame:
    """(id, stratum, counts, base_failed, failed_rules, kept) of every row of ``docs``."""
    features = once(text_features(docs, id_col, text_col, stratum_col))
    cutoffs = calibrate(features, labels, id_col, good_col, max_false_rejection, delta)
    return _verdict(features, cutoffs).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              stratum_col: str = "lang", good_col: str = "quality",
              max_false_rejection: float = 0.05, delta: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that the rules keep. Counting twice is cheaper than moving the texts to a join."""
    features = once(text_features(docs, id_col, text_col, stratum_col))
    cutoffs = calibrate(features, labels, id_col, good_col, max_false_rejection, delta)
    return _verdict(text_features(docs, id_col, text_col, stratum_col, True), cutoffs).where("kept").select("row.*")
