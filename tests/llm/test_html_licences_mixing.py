"""Main text of pages, licence rules, the mix, and the pipeline."""

import html
import math
import random
import re

import numpy as np
import public_tokenizers

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tickloom.llm import html_text, licences, mixing, toxicity
from tickloom.session import scratch_path

from .conftest import SF, odd_rows
from .test_quality_toxicity import plain_counts
from .test_simhash import plain_components, plain_fingerprint


def test_page_query(spark, queries):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries["op4_html_text"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S).group(1)
        plain = re.sub(r"</?(p|br|h1)[^>]*>", " ", article).replace("<b>", "").replace("</b>", "")
        assert r.text == " ".join(html.unescape(plain).split())
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


LONG = "Long text of the article goes here with many words and no tags at all, really long. "


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<nav>menu</nav><script>x</script>", ""),
        ("<p>a &amp;\n b&nbsp;c<p>d", "a & b c d"),
        ("<article><header><h1>Head</h1><p>by me</p></header>x<b>y</b>z<br>w<aside>q</aside></article>", "Head xyz w"),
        (f"<div class=site-header>S</div><div id=main-text><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
         "<div class=sidebar>side</div><div id=comments><p>" + LONG * 3 + "</p></div>", f"{LONG}Short. {LONG}".strip()),
        (f"<main><h1>T</h1><p>{LONG}</p><form>f<input></form><div class='cookie-notice'>{LONG}</div></main><footer>{LONG}</footer>", f"T {LONG}".strip()),
        (f"<body class='no-sidebar'><div class='content-sidebar-wrap'><p>{LONG}</p></div><ul class=menu><li>a<li>b</ul>", LONG.strip()),
        ("<article><p>unclosed <i>tags<div>more", "unclosed tags more"),
        ("<style>p{}</style><template>t</template><p hidden>h</p><p>shown</p>", "shown"),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    "inner, text",
    [
        (f"<section id='related-work'><h2>Related</h2><p>{LONG}</p></section>", f"Related {LONG}"),
        (f"<h2 id='social-impact'>Impact</h2><p>{LONG}</p>", f"Impact {LONG}"),
        (f"<h2 id='alert-handling'>Alerts</h2><h3 id=notices>Notices</h3><p>{LONG}</p>", f"Alerts Notices {LONG}"),
        (f"<div class='menu-recipe'>{LONG}</div>", LONG),
        ("<p id='notice-period'>Three months.</p>", "Three months."),
        (f"<section id=advertising><h2>Adverts</h2><p>{LONG}</p><p>{LONG}</p></section>", f"Adverts {LONG}{LONG}"),
        (f"<div class=notice>{LONG}</div>", LONG),
        ("x<span class=share-price>y</span>z", "xyz"),
        (f"<div class=ad>{LONG}</div><div class='cookie-notice'>{LONG}</div>", ""),
        ("<ul class='related-posts'><li><a href=/a>One</a><li><a href=/b>Two</a></ul>", ""),
        ("x <a class=share href=/s>Share</a>", "x"),
        ("<div class='social-share'><a href=/a>Like it now</a><div class=menu><a href=/b>More</a></div></div>", ""),
    ],
)
@pytest.mark.parametrize("around", ["<nav>n</nav><article>{}</article>", "<main>{}</main><div class='related-x'>r</div>"])
def test_names_need_the_texts_agreement(inner, text, around):
    page = around.format(f"<h1>T</h1><p>{LONG}</p>{inner}<p>{LONG}</p>")
    assert html_text.main_text(page) == " ".join(f"T {LONG}{text} {LONG}".split())


def test_names_on_pages_without_an_article():
    page = (f"<div><h1>T</h1><p>{LONG}</p><div id='related-work'><h2>R</h2><p>{LONG}</p></div>"
            f"<div class='menu-left-side'><a href=/>x</a></div><p>{LONG}</p></div>")
    assert html_text.main_text(page) == f"T {LONG}R {LONG}{LONG}".strip()


def test_pages_with_nulls_repeats_and_other_columns(spark):
    rows = [(1, None, "<p>a</p>", "x"), (1, None, "<p>a</p>", "x"), (None, "u", None, None), (2, "u", "<p>" + "w " * 200_000, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.n_chars) for r in html_text.extracted(pages).collect()), key=str)
    assert got == [(1, 1), (1, 1), (2, 399_999), (None, 0)]
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_smoothing_and_threshold():
    assert np.isclose(html_text.smoothed(np.array([0, 0, 0, 0, 1.0, 0, 0, 0, 0])).sum(), 1)
    assert 5 < html_text.threshold(np.array([1.0, 2, 1, 100, 120])) < 100
    assert html_text.threshold(np.array([3.0, 3])) == 0


MIT = """/*
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software. The above copyright notice and this permission notice shall be
 * included in all copies. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
 */"""


@pytest.mark.parametrize(
    "text, found",
    [
        (None, ("", 0, 0, 0)),
        ("", ("", 0, 0, 0)),
        ("prose only.", ("", 0, 0, 0)),
        ("a driving licence, perhaps.", ("", 0, 1, 0)),
        ("x y\nLicensed under the Apache License, Version 2.0.", ("Apache-2.0", 1, 0, 0)),
        ("Released under the MIT License. b. Released under the MIT License.", ("MIT", 2, 0, 0)),
        (MIT, ("MIT", 3, 0, 0)),
        ("This work is licensed under the GNU General Public License, version 3.", ("GPL-3.0", 1, 0, 0)),
        ("Licensed under CC BY-NC 4.0.\nA.\nThe MIT License.", ("CC-BY-NC-4.0,MIT", 2, 0, 0)),
        ("Redistributions of source code must retain the above copyright notice.", ("", 1, 0, 1)),
        ("\x01Licensed\x01under the apache license, version 2.0", ("Apache-2.0", 1, 0, 0)),
    ],
)
def test_licences(spark, text, found):
    row = licences.scanned(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert tuple(row)[1:] == found


@pytest.mark.parametrize(
    "text, found",
    [
        ("This is free and unencumbered software released into the public\ndomain.", ("Unlicense", 1, 0, 0)),
        ("Creative\n * Commons Attribution-ShareAlike 4.0 International.", ("CC-BY-SA-4.0", 1, 0, 0)),
        ("Dual-licensed under the MIT License or the Apache License, Version 2.0", ("MIT,Apache-2.0", 2, 0, 0)),
        ("The Apache License, Version 2.0 or the MIT License", ("Apache-2.0,MIT", 2, 0, 0)),
        ("You should have received a copy of the GNU General Public License, version 3", ("GPL-3.0", 1, 0, 0)),
        ("under the terms of the GNU General Public License as published by the Free Software Foundation, "
         "either version 3 of the License, or (at your option) any later version.", ("GPL-3.0-or-later", 2, 0, 0)),
    ],
)
def test_every_phrase_of_a_sentence_counts(spark, text, found):
    """Also over line breaks and comment signs; of overlapping phrases the earlier in the table."""
    row = licences.scanned(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert tuple(row)[1:] == found


def test_licence_scan_of_odd_rows(odd, nothing):
    assert licences.scanned(odd).count() == len(odd_rows())
    assert licences.scanned(nothing).count() == 0
    plan = licences.scanned(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_phrases_can_be_found():
    """Every phrase is in normal form, holds a telltale, and every rule's names exist."""
    names = {name for name, _ in licences.SENTENCES}
    for _, phrase in licences.SENTENCES:
        assert re.fullmatch(r"[a-z0-9]+( [a-z0-9]+)*", phrase) and re.search(licences.TELLTALE + "|cc by", phrase)
    for _, sequence in licences.RULES:
        assert {i.rstrip("?") for i in sequence.split()} <= names


def plain_targets(sizes):
    """Targets by resharing the excess until none is above twice its source's size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def test_mix_of_odd_rows(odd, nothing):
    got = mixing.taken(odd).collect()
    assert len(got) == len(odd_rows())
    counts = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in odd_rows():
        sizes[r[3]] = sizes.get(r[3], 0) + counts(r[1])
    want = plain_targets(sizes)
    assert np.allclose(sorted({r.target for r in got}), sorted(set(want.values())))
    assert sum(r.taken for r in got) == sum(int(t + 1e-9) for t in want.values())
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert mixing.taken(odd).collect() is not None and mixing.taken(nothing).count() == 0


def test_targets_against_resharing(spark):
    rng = np.random.default_rng(4)
    for _ in range(4):
        sizes = {f"s{i:02d}": int(n) for i, n in enumerate(rng.zipf(1.5, 12) * 10)} | {None: 7, "": 0}
        table = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mixing.targets(table).collect()}
        want = plain_targets(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def test_many_repeated_rows_are_served_one_by_one(spark):
    """Each of the equal rows has a service of its own, and rows do not multiply."""
    rows = [(7, "a", "one two three")] * 6000 + [(None, "b", "four five")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    words = F.sum(mixing.word_count(F.col("text"))).alias("n")
    got = {r.source: r.n for r in mixing.mixed(docs).groupBy("source").agg(words).collect()}
    want = {r.source: math.floor(r.target) for r in mixing.targets(
        docs.select("source", mixing.word_count(F.col("text")).alias("size"))).collect()}
    assert got == want


def test_mixed_rows_follow_the_counts(documents, odd, nothing):
    for docs in (documents, odd):
        mixed = mixing.mixed(docs)
        assert mixed.columns == docs.columns
        words = F.sum(mixing.word_count(F.col("text"))).alias("n")
        got = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(words).collect()}
        want = {}
        for r in mixing.taken(docs).collect():
            want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
        assert got == {i: n for i, n in want.items() if n}
    assert mixing.mixed(nothing).count() == 0


def test_first_words(spark):
    rows = [("a  b\tc d", 2, "a  b"), (" a b", 1, " a"), ("x", 1, "x")]
    table = spark.createDataFrame(rows, "t string, n int, want string")
    for r in table.select(mixing.first_words(F.col("t"), F.col("n")).alias("got"), "want").collect():
        assert r.got == r.want


def test_pipeline_against_plain_python(spark, queries):
    """Each stage's own input, its rows, and what plain Python makes of them."""
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "toxicity", "near_duplicates", "mixing", "packing"]

    def run(name, table):
        path = scratch_path(spark, name)
        stages[name](spark, table, SF).write.parquet(path)
        out = spark.read.parquet(path)
        assert name == "packing" or out.columns == docs.columns
        return out

    good = run("quality_rules", docs)
    sound = {r.doc_id for r in docs.collect() if not base_failed(r.text)}
    kept = {r.doc_id for r in good.collect()}
    assert kept <= sound and len(kept) > 0.9 * len(sound)

    clean = run("toxicity", good)
    model = toxicity.train(good, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in good.collect() if model.score(r.text) < 0.7}

    single = run("near_duplicates", clean)
    rows = clean.collect()
    groups = plain_components([plain_fingerprint(r.text) for r in rows], [r.doc_id for r in rows])
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(groups))

    mix = run("mixing", single)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes, served = {}, {}
    for r in single.collect():
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    for r in mix.collect():
        served[r.source] = served.get(r.source, 0) + words(r.text)
    assert served == {s: int(t + 1e-9) for s, t in plain_targets(sizes).items()}

    pieces = run("packing", mix).collect()
    want = sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in mix.collect())
    assert sum(p.length for p in pieces) == want == sum(len(p.ids) // 4 for p in pieces)
    fill = {}
    for p in pieces:
        fill[p.sequence_id] = fill.get(p.sequence_id, 0) + p.length
    assert sorted(fill) == list(range(-(-want // 4096)))
    assert sum(n < 4096 for n in fill.values()) <= 1
    assert queries["pipeline"](spark, SF).count() == len(pieces)


def base_failed(text):
    n = plain_counts(text)
    return n[0] < 50 or 100 * n[4] > 50 * n[0]


def test_pipeline_of_odd_and_empty_tables(spark, odd, nothing, tmp_path):
    spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for table in (odd, nothing):
        table.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0


def test_any_markup_is_read():
    """No text, however broken, ends the query."""
    from tickloom.llm.html_text import main_text

    assert "b" in main_text("<p>a</p><![foo[x]]>b")
    pick = random.Random(9)
    bits = ["<", ">", "<!", "<![", "]]>", "<!--", "-->", "<p>", "</p>", "<![CDATA[", "<!doctype", "<?x", "&#", "&amp", ";", "a b ", "'", '"', "=", "<a href=", "</", "<article>", "<script>", "<![if x]>", "[", "]", "\0"]
    for _ in range(3000):
        assert isinstance(main_text("".join(pick.choice(bits) for _ in range(pick.randrange(25)))), str)
