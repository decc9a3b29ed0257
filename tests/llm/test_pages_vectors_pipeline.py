from __future__ import annotations

import math
from pathlib import Path

import pytest

from trendloom.llm import htmltext, topk

P = htmltext.HtmlParams()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<nav><a>Menu</a></nav><article><h1>T&eacute;st</h1><p>One  <b>two</b>\n three<br>four</p><p>Of.</p></article><footer>F</footer>", "Tést\n\nOne two three four\n\nOf."),
        ("<body><div class='sidebar'>s</div><main><p>a<p>b<script>if (a<b) x('</p>')</script><form>f</form></main><div id=comments>c</div>", "a\n\nb"),
        ("<article><p>A</p><aside>no</aside><div class='ad'>buy</div><section class='comments'><p>me</p></section><p>B</article>", "A\n\nB"),
        ("<article><p><b>A<br><p>B</p></article><footer>x", "A\n\nB"),
        ("<!-- <p>no</p> --><p hidden>no</p><style>p{}</style>", ""),
        ("<ul><li>Home</ul><p>" + "long line of text " * 10 + "</p><p>" + "more of the same " * 10 + "</p><div>(c) x</div>", ("long line of text " * 10).strip() + "\n\n" + ("more of the same " * 10).strip()),
    ],
)
def test_main_text(page, text):
    assert htmltext.main_text(page, P) == text


LONG = "a line of running text that goes on for quite a while"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # stray and unquoted quotes in tags
        (f"<article><p title=it's>one</p><p>two</p><p data-x='>' a=\"b>c\">three</p></article>", "one\n\ntwo\n\nthree"),
        ("<article><p>a < b and <i>c</i></p><p>cut off <b class='x", "a < b and c\n\ncut off"),
        # whole class tokens only
        ("<article class=has-sidebar><div class=article-header><h1>T</h1></div><p class=share-price>up</p><p class='related-work'>w</p><div class='share-buttons'>s</div><div class='x comment-list'>c</div><p><math><mi>x</mi></math></p></article>", "T\n\nup\n\nw\n\nx"),
        # unmarked pages: windows part navigation from text
        ("<body>" + "".join(f"<div><a href=x>Item {i}</a></div>" for i in range(8)) + f"<h1>Head</h1><p>{LONG}</p><p>Short.</p><p>{LONG}!</p>" + "<div>x</div>" * 4 + "</body>", f"Head\n\n{LONG}\n\nShort.\n\n{LONG}!"),
        # an aside and a list of short items don't part a text in one box
        ("<div id=text>" + f"<p>{LONG}</p>" * 2 + "<aside><p>a</p><p>b</p><p>c</p></aside>" + "<ul>" + "<li>i</li>" * 5 + "</ul>" + f"<p>{LONG}</p><p>End</p></div><div><p>c</p></div>", "\n\n".join([LONG, LONG, *"iiiii", LONG, "End"])),
        # link text counts for nothing
        (f"<div><a>{LONG}</a></div>" * 6 + "<p>x</p>" * 3 + f"<section><p>{LONG}</p><p>{LONG}</p></section>", f"{LONG}\n\n{LONG}"),
    ],
)
def test_line_blocks(page, text):
    assert htmltext.main_text(page, P) == text


def test_runs_against_brute_force():
    import random

    import numpy as np

    rng = random.Random(9)
    for _ in range(500):
        size, w, least = [rng.choice([0, 0, 3, 9, 30]) for _ in range(rng.randint(1, 14))], rng.randint(1, 4), rng.choice([0, 5, 20])
        covered = set()
        for i in range(len(size)):
            if sum(size[i : i + w]) > least:
                covered.update(range(i, min(i + w, len(size))))
        assert sorted(i for a, b in htmltext.runs_between(np.array(size), w, least) for i in range(a, b)) == sorted(covered)


def test_extract(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>x</p></article>", "z"), (1, "u", "<article><p>x</p></article>", "z"), (2, None, None, "z"), (None, "v", "<p>" + "é" * 50_000, "z")], "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in htmltext.extract(df).collect())
    assert got == sorted([("1", "x", 1), ("1", "x", 1), ("2", "", 0), ("None", "é" * 50_000, 50_000)])
    assert htmltext.extract(df.limit(0)).count() == 0


def test_topk(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, rng.uniform(-1, 1)]) for _ in range(8)], "x") for i in range(250)]
    rows += [(300, None, "x"), (301, [None] * 8, "x"), (302, [math.nan] * 8, "x"), (400, [math.inf] * 8, "x"), (303, rows[5][1], "x"), (304, rows[5][1], "x"), (500, [0.5], "x"), (None, [1.0] * 8, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(3)
    ok = {r.vec_id: [math.floor(1024 * x) for x in r.embedding] for r in df.collect() if r.vec_id is not None and r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)}
    want = set()
    for q, v in ok.items():
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok.items() if i != q)[:10]
            want |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    got = topk.topk(df, F.col("vec_id") % 100 == 0, topk.TopKParams(chunk=2, block=1)).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.topk(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as c
    from trendloom.llm import langid, mixing, neardup, packing, pii

    lines = ["the house and the river in the valley " + " ".join(f"w{i}x{k}" for k in range(60)) for i in range(40)]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(lines)] + [(50, lines[0], "en", "src0", 1), (51, "12345", "en", "src1", 5), (52, None, None, "src1", None), (53, "write to a.b@c.org " + lines[1], None, "src2", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in c.STAGES] == ["language_id", "near_duplicates", "personal_data", "source_mix", "best_fit_packing"]
    seen = docs
    for name, stage in c.STAGES[:-1]:
        seen = spark.createDataFrame(stage(spark, seen, str(tmp_path)).collect(), docs.schema)
        assert seen.columns == docs.columns
        ids = {r.doc_id for r in seen.collect()}
        if name == "language_id":
            assert ids == set(range(40)) | {50, 53}
        if name == "near_duplicates":
            assert ids == set(range(40)) and 50 not in ids or ids == (set(range(40)) | {53})
        if name == "personal_data":
            assert not any("a.b@c.org" in r.text for r in seen.collect())
    total = sum(r.length for r in c.run(spark, str(tmp_path)).collect())
    assert total == sum(r.length for r in packing.pack(seen).collect()) > 0
    assert Path(c.__file__).name == "corpus_pipeline.py" and all((langid, mixing, neardup, pii))
