import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key long, kept string, n_words string"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


def doc_rows():
    """Nulls, empty, very long, copies, near copies, a shared passage, text without letters, repeated rows."""
    rng = random.Random(3)
    base, passage = words(rng, 120), words(rng, 60)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", " \n\t ", "123 456 ###", "one two", base, base, " ".join(near), base + " tail",
             words(rng, 40) + " " + passage + " " + words(rng, 40), words(rng, 10) + "\n" + passage,
             passage, words(rng, 20000), "é" * 500, "x" * 3000, "a\n" * 80, "漢字 " * 60 + passage,
             words(rng, 300), "the same line\n" * 30, "one two", None]
    rows = [(i, t, [None, "aa", "bb"][i % 3], f"s{i % 2}", None if t is None else len(t), 1, 2, "k", "w")
            for i, t in enumerate(texts)]
    rows.append(rows[6])                                     # a repeated row
    rows.append((None, base, "aa", None, None, 1, 2, "k", "w"))
    rows.append((None, None, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(doc_rows(), DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def plain():
    """(doc_id, text) of the rows with an id, once each."""
    return sorted({r[0]: r[1] for r in doc_rows() if r[0] is not None}.items())
