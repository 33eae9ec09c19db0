"""Operator 11: fill-in-middle transformation by a counted-quantifier pattern.

A text is a row of units: a run of ASCII letters, or any other single character. ``regexp_count`` gives
their number n; two draws of the row's own hash choose a <= b in 0..n. A pattern made for the row, with the
possessive groups ``unit{a}`` and ``unit{b-a}``, captures prefix, middle and suffix in one match, and the
replacement puts them behind their marks (possessive groups are walked in a loop by the regex engine, without
backtracking or recursion, so a text's length is no limit):

    plain   the text
    psm     <P>prefix<S>suffix<M>middle
    spm     <S>suffix<P>prefix<M>middle

Draws: h1 to h4 are the first four 8-digit groups of the hex SHA-256 of ``seed:id``. a and b are h1 and h2 modulo
n + 1, in order; ``h3 % 100 >= 100 - plain_percent`` stays plain, else ``h4 % 100 < spm_percent`` is spm. A text that
is empty or holds a mark stays plain, so the marks in an output are those put there, and ``restore`` gives back
the text. All expressions run inside Spark's own operators, row by row, with no shuffle.

Defined results: a null text is an empty one (n 0, plain, output empty); a null id draws as the empty id; rows that
repeat an id draw alike, each on its own text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
MARKS = ("<P>", "<S>", "<M>")


def _check_marks(marks: Sequence[str]) -> None:
    """A mark must not begin inside another one: then it can't appear across the border of a part and a mark."""
    if len(set(marks)) != 3 or not all(marks):
        raise ValueError("three different marks are needed")
    for x, y in product(marks, marks):
        if any(x[-k:] == y[:k] for k in range(1, min(len(x), len(y)))) or (x != y and x in y):
            raise ValueError(f"marks {x!r} and {y!r} overlap")


def _draw(k: int) -> Column:
    """The k-th 8-digit group of the row's hash as a number."""
    return F.conv(F.substring("hash", 8 * k + 1, 8), 16, 10).cast("long")


def _pattern(a: Column, b: Column) -> Column:
    """Pattern of a text whose prefix has a units and whose prefix and middle have b."""
    unit = "(?:[A-Za-z]++|[^A-Za-z])"
    return F.concat(F.lit(rf"(?s)\A({unit}{{"), a.cast("string"), F.lit(rf"}}+)({unit}{{"), (b - a).cast("string"),
                    F.lit(r"}+)(.*+)\z"))


def _literal(mark: str) -> str:
    """The mark as it must be written in a replacement."""
    return re.sub(r"([\\$])", r"\\\1", mark)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1",
                   plain_percent: int = 10, spm_percent: int = 20, marks: Sequence[str] = MARKS,
                   carry: Sequence[str] = ()) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row; ``carry`` adds columns as struct ``row``.

    ``prefix_chars`` and ``middle_chars`` count code points and are null where the form is plain.
    """
    _check_marks(marks)
    p, s, m = marks
    row = [F.struct(*carry).alias("row")] if carry else []
    text, out = F.col("text"), F.col("output")
    marked = F.lit(False)
    for x in marks:
        marked = marked | F.contains(text, F.lit(x))
    psm = "".join(map(_literal, (p, "\0", s, "\1", m, "\2"))).replace("\0", "$1").replace("\1", "$3").replace("\2", "$2")
    spm = "".join(map(_literal, (s, "\0", p, "\1", m, "\2"))).replace("\0", "$3").replace("\1", "$1").replace("\2", "$2")
    drawn = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                         F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256).alias("hash"),
                         *row)
             .withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
             .withColumn("x", _draw(0) % (F.col("n") + 1)).withColumn("y", _draw(1) % (F.col("n") + 1))
             .withColumn("form", F.when((text == "") | marked | (_draw(2) % 100 >= 100 - plain_percent), F.lit("plain"))
                         .when(_draw(3) % 100 < spm_percent, F.lit("spm")).otherwise(F.lit("psm"))))
    pattern = _pattern(F.least("x", "y"), F.greatest("x", "y"))
    replaced = F.regexp_replace(text, pattern, F.when(F.col("form") == "spm", F.lit(spm)).otherwise(F.lit(psm)))
    made = drawn.withColumn("output", F.when(F.col("form") == "plain", text).otherwise(replaced))
    to_s, to_p, to_m = (F.locate(x, out) for x in (s, p, m))
    prefix = F.when(F.col("form") == "psm", to_s - 1 - len(p)).when(F.col("form") == "spm", to_m - to_p - len(p))
    middle = F.when(F.col("form") != "plain", F.length(out) - to_m + 1 - len(m))
    return made.select(F.col("id").alias(id_col), "n", "form", prefix.cast("long").alias("prefix_chars"),
                       middle.cast("long").alias("middle_chars"), "output", *(["row"] if carry else []))


def restore(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text of an output, from the output and its form alone."""
    p, s, m = marks
    before_m, middle = F.substring_index(output, m, 1), F.substring_index(output, m, -1)
    psm = F.concat(F.substr(F.substring_index(before_m, s, 1), F.lit(len(p) + 1)), middle, F.substring_index(before_m, s, -1))
    spm = F.concat(F.substring_index(before_m, p, -1), middle, F.substr(F.substring_index(before_m, p, 1), F.lit(len(s) + 1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
d AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS x,
         ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM t),
c AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:least(x, y)], '') AS p,
         array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1:], '') AS s
  FROM d)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""
