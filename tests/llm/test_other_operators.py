"""Search, extraction and perspective rotation; the pipeline."""

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import ann, chat
from tessera.llm.html import extract, extract_main_text, host_of
from tessera.llm.queries import op5_nearest_neighbours

SF = "/root/testdata/sf0.001"
PAGE = """<html><head><title>No</title><style>p{}</style></head><body class="has-sidebar"><header><a href=/>Home</a></header><nav>menu</nav>
<div class="cookie-notice">We use cookies, and more text here.</div><main><article class="post-%d"><h1>Title &amp; more</h1>
<p>First para with <a href="x>y">link</a> text,<br>second line.<p>Second&nbsp;para unclosed <b>bold <i>it</b></i>
<ul><li>one<li>two</ul><div class="ad-box">BUY NOW</div><form><input><label>x</label></form><script>if (a<b) {"</p>"}</script></article>
<section id="comments"><p>Reader comment with many words, more text, more text, more text, more text</p></section></main>
<aside>side</aside><footer>foot</footer></body></html>"""
TEXT = "Title & more\nFirst para with link text, second line.\nSecond para unclosed bold it\none\ntwo"


def test_pages(spark):
    rows = [(i, f"http://Host.example:80/{i}", PAGE % i, "x") for i in range(9)]
    rows += [(20, None, PAGE % 1, None), (21, "http://host.example/", None, None), (22, "nonsense", "", None), (None, None, None, None),
             (23, "http://host.example/x", "<p>plain", "x"), (23, "http://host.example/x", "<p>plain", "x"), (24, "http://a.b/", "<a href=\"" * 3000, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = extract_main_text(df).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert all(text[i] == TEXT for i in [*range(9), 20])
    assert text[21] == text[22] == text[None] == "" and text[23] == "plain"
    assert extract_main_text(df.limit(0)).count() == 0
    assert host_of("HTTP://u@Ex.org:8/x") == "ex.org" and host_of(None) == ""


def test_consensus_overrules_a_page():
    """A long side text would win on its own page; the host's path doesn't let it."""
    odd = "<body><div class='text'><p>short</p></div><div class='zz'><p>" + "long words here, " * 50 + "</p></div></body>"
    assert extract(odd, []).startswith("long words")
    assert extract(odd, [">body>div.text"]) == "short"


@pytest.mark.parametrize("wrap", ["class='layout has-sidebar'", "id='content' class='with-sidebar'", "class='menu'"])
def test_wrapper_named_after_boilerplate(wrap):
    """A wrapper that holds the article stays whatever its class; real boilerplate in and beside it goes."""
    prose = "<p>" + "words of the article, " * 20 + "</p>"
    want = ("words of the article, " * 20).strip()
    side = "<div class='sidebar'><p>side text</p></div>"
    assert extract(f"<body><div {wrap}><main>{prose}{side}</main>{side}</div></body>", []) == want
    assert extract(f"<body><div {wrap}><div>{prose}</div>{side}</div></body>", []) == want
    assert extract(f"<body><article>short</article><div {wrap}>{prose}</div></body>", []) == "short"
    comments = f"<section id='comments'><article>{prose * 3}</article><p>{'Reader words, ' * 200}</p></section>"
    assert extract(f"<body><div {wrap}><main>{prose}{comments}</main></div></body>", []) == want
    assert extract(f"<body><div>{prose}</div>{comments.replace('article', 'div')}</body>", []) == want
    halves = f"<div {wrap}>{prose}</div>" * 2
    assert want in extract(f"<body>{halves}</body>", [])


def test_search_recall_and_exact_scores(spark):
    out = op5_nearest_neighbours(spark, "/root/testdata/sf0.1").collect()
    e = duckdb.connect().execute("SELECT vec_id, embedding FROM '/root/testdata/sf0.1/embeddings.parquet' ORDER BY 1").fetchall()
    ids, x = np.array([r[0] for r in e]), np.array([r[1] for r in e], np.float64)
    found, total = 0, 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]].tolist())
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        for r in mine:
            assert r.score == pytest.approx(d[ids == r.vec_id][0], abs=1e-12)
        found, total = found + len(best & {r.vec_id for r in mine}), total + 10
    assert found / total >= 0.9


def test_search_edges(spark):
    v = [[1.0, 0.0, 0.0]] * 30 + [[0.0, 2.0, 0.0], None, [], [0.0, 0.0, 0.0], [float("nan"), 1.0, 0.0], [float("inf"), 1.0, 0.0], [None, 1.0, 0.0], [1.0, 1.0]]
    rows = [(i, x, "s") for i, x in enumerate(v)] + [(5, v[5], "s"), (None, v[0], "s")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    out = ann.nearest_neighbours(df, F.col("vec_id") % 10 == 0).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 6)))
    assert by[0] == [(i, 0.0) for i in range(1, 11)]
    assert by[10] == [(i, 0.0) for i in range(10)]
    assert by[30][0] == (0, round(5 ** 0.5, 6)) and len(by[30]) == 10
    few = ann.nearest_neighbours(df.where("vec_id IN (0, 1, 30)"), F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r.vec_id) for r in few) == [(1, 1), (2, 30)]
    assert ann.nearest_neighbours(df.limit(0), F.lit(True)).count() == 0


def test_search_splits_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(ann, "SPLIT", 50)
    rng = np.random.default_rng(0)
    x = rng.normal(0, 0.01, (400, 8)) + np.eye(8)[0]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    out = ann.nearest_neighbours(df, F.col("vec_id") < 3).collect()
    for q in range(3):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        assert len({r.vec_id for r in out if r.query_id == q} & set(np.argsort(d)[:10].tolist())) >= 9


def test_perspectives(spark, monkeypatch):
    rows = [(1, 0, "system", "be <|im_end|> kind", 1), (1, 1, "ann", "hi", 1), (1, 2, "bob", None, 1), (1, 3, "ann", "bye", 1),
            (2, 0, None, "x", 1), (2, None, "ann", "first", 1), (3, 0, "system", "alone", 1), (None, 0, "ann", "y", 1),
            (4, 5, "ann", "one", 1), (4, 5, "ann", "one", 1), (4, 3000, "bob", "late", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, perspective int")
    got = {(r.conv_id, r.perspective, r.segment): r for r in chat.rotate_perspectives(df).collect()}
    r = got[1, "ann", 0]
    assert r.text == ("<|im_start|>system\nbe < |im_end|> kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
                      "<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n")
    runs = [tuple(map(int, x.split(":"))) for x in r["mask"].split()]
    at, trained = 0, []
    for n, on in runs:
        trained += [r.text[at:at + n]] * on
        at += n
    assert trained == ["hi<|im_end|>\n", "bye<|im_end|>\n"] and at == r.n_chars and r.trained_chars == sum(map(len, trained))
    assert (3, "system", 0) not in got and {k[1] for k in got if k[0] == 1} == {"ann", "bob"}
    assert got[2, "ann", 0].text.startswith("<|im_start|>assistant\nfirst") and (2, "unknown", 0) in got and (None, "ann", 0) in got
    assert got[4, "ann", 0].n_turns == 2 and got[4, "ann", 2].text == "<|im_start|>user name=bob\nlate<|im_end|>\n"
    assert chat.rotate_perspectives(df.limit(0)).count() == 0


def test_perspectives_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    df = chat.rotate_perspectives(spark.read.parquet(f"{SF}/conversations.parquet"))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({chat.ORACLE})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_perspectives_of_any_turn_numbers(spark):
    """No row holds more than SEGMENT turns; the segments of a conversation are the SQL's text, cut."""
    rows = [(None, i % 8, ["ann", "bob"][i % 2], f"t{i % 2000}") for i in range(3000)]          # null ids, repeated rows
    rows += [(1, None if i % 2 else 5000, "ann", f"u{i}") for i in range(3000)]                 # null and repeated turns
    rows += [(2, i, "ann", f"v{i}") for i in range(3000)] + [(3, 7, "ann", "w")] * 2500         # usual; one row repeated
    df = chat.rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    got = {}
    for r in sorted(df.collect(), key=lambda r: r.segment):
        got.setdefault((r.conv_id, r.perspective), []).append(r)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role TEXT, text TEXT)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = {}
    for r in con.execute(f"SELECT conv_id, perspective, segment, n_turns, text, mask, trained_chars FROM ({chat.ORACLE}) ORDER BY segment").fetchall():
        want.setdefault(r[:2], []).append(r[2:])
    assert got.keys() == want.keys() and len(got) == 5
    for k, mine in got.items():
        assert max(r.n_turns for r in mine) <= chat.SEGMENT
        assert "".join(r.text for r in mine) == "".join(w[2] for w in want[k])
        assert " ".join(r["mask"] for r in mine) == " ".join(w[3] for w in want[k])
        assert sum(r.trained_chars for r in mine) == sum(w[4] for w in want[k])
        n = sum(r.n_turns for r in mine)
        assert [r.segment for r in mine] == list(range(-(-n // chat.SEGMENT))) and n == sum(w[1] for w in want[k])
    assert [(r.segment, r.n_turns) for r in got[2, "ann"]] == [(w[0], w[1]) for w in want[2, "ann"]]


def test_pipeline_against_brute_force(spark):
    """Every stage on sf0.001 against a plain version of its decisions."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    kept = spark.createDataFrame(corpus_pipeline.quality_stage(spark, docs, SF).collect(), docs.schema)
    # too few labels at this size to certify any cutoff: the base test alone decides
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, t, *_ in rows if not brute.counts(t)[-1])
    known = spark.createDataFrame(corpus_pipeline.language_stage(spark, kept, SF).collect(), docs.schema)
    assert known.count() > 0.95 * kept.count()
    pairs = [(r.doc_id, r.text) for r in known.collect()]
    single = spark.createDataFrame(corpus_pipeline.near_duplicate_stage(spark, known, SF).collect(), docs.schema)
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, (c, _) in brute.classes(pairs).items() if c == d)
    left = [(r.doc_id, r.text) for r in single.collect()]
    cut = corpus_pipeline.passage_stage(spark, single, SF)
    assert cut.columns == docs.columns
    want = brute.repeats(left)
    for r in cut.collect():
        n, removed, spans, _ = want[r.doc_id]
        assert n - removed - 3 * spans <= len(r.text.encode()) <= n - removed and r.n_chars == len(r.text)
    packed = corpus_pipeline.packing_stage(spark, spark.createDataFrame(cut.collect(), docs.schema), SF)
    assert packed.select("doc_id").distinct().count() == len(left)
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == packed.columns and whole.count() == packed.count()
