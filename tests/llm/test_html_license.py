"""Minimum-cut extraction and license scan against plain Python."""

import itertools
import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sectorpulse.llm import html_mincut, license_tfidf, queries

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style><script>var a="</p><p>no</p>";</script></head>
<body class="page"><header><a href="/">Site</a></header><nav><ul><li><a href="/a">Alpha</a><li><a href="/b">Beta</a></ul>
</nav><div class="cookie-notice">We use cookies, do you agree to that?</div><!-- c --><div id="content"><article>
<h1>Head &amp; line</h1><p><b>Bold</b> start<br>next &copy; 2024 of a paragraph that is long enough to read.
<p>Second&nbsp;paragraph with   <i>inline</i> <a href="#">link</a> text and more words in it.</p>
<div class="ad">Buy now cheap things</div><aside>Aside words</aside><blockquote>Quoted words here.</blockquote>
</article><section class="comments"><p>Nice article, I liked it a lot, thanks.</p></section></div>
<div class="sidebar"><p>Related things you may like to read as well</p></div>
<form><p>Sign up for mail</p><input><button>Go</button></form><footer>&copy; Site</footer></body></html>"""


def test_page_parts():
    assert html_mincut.main_text(PAGE).split("\n") == [
        "Head & line", "Bold start next © 2024 of a paragraph that is long enough to read.",
        "Second paragraph with inline link text and more words in it.", "Quoted words here."]


def test_without_article_element():
    body = "".join(f"<p>Paragraph {i} has quite a few words in it so that it reads as text.</p>" for i in range(4))
    page = f"<body><div class=menu><a href=x>One</a> <a href=y>Two</a></div><div>{body}</div><div class='footer'>x</div>"
    assert html_mincut.main_text(page).count("\n") == 3
    assert "One" not in html_mincut.main_text(page)


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'><article>{a}</article><div class='sidebar'><p>{r}</p></div></div>",
    "<div class='layout with-comments'><article>{a}</article><section class='comments'><p>{r}</p></section></div>",
    "<div class='sidebar-layout'><main>{a}</main></div><div class='related'><article><p>{r}</p></article></div>",
    "<form id='f'><article>{a}</article></form><nav><p>{r}</p></nav>",
    "<article><header class='entry-header'>{h}<p class='byline'>By someone</p></header>{p}</article><footer>{r}</footer>",
    "<div class='related-story'>{a}</div><div class='footer'><p>{r}</p></div>",
    "<div>{a}</div><section class='comments'><article class='comment'><p>{r}</p></article></section>",
    "<article>{a}</article><div class='comments'><article><p>{r}</p></article><article><p>{r}</p></article></div>"])
def test_marked_wrappers_keep_the_article(page):
    h, other = "<h1>The head line</h1>", "Another text of some words that is not the story."
    p = "".join(f"<p>Paragraph {i} has quite a few words in it so that it reads as text.</p>" for i in range(4))
    got = html_mincut.main_text("<body>" + page.format(a=h + p, h=h, p=p, r=other))
    assert got.split("\n") == ["The head line", *re.findall("<p>(.*?)</p>", p)]


PROSE = "This is the main paragraph of the story, and it goes on for quite a while with many words in it."


@pytest.mark.parametrize("page, want", [
    ("<article><h1>T</h1><div class='text-widget'><p>{p}</p></div></article><div class=sidebar><p>{p}</p></div>", "T\n{p}"),
    ("<article><p>{p}</p><p class='share-price'>{p} 2</p><p class=dialog>{p} 3</p></article>", "{p}\n{p} 2\n{p} 3"),
    ("<article><p>{p}</p><ul><li><a href=x>One link</a></li><li><a href=y>Two links</a></li></ul></article>",
     "{p}\nOne link\nTwo links"),
    ("just text", "just text"),
    ("<article><p>{p}</p><div class=kommentare><p>{p} 2</p></div><div class=werbung><p>{p} 3</p></div></article>", "{p}"),
    ("<article><p>{p}</p><div class=share><a href=a>One</a> <a href=b>Two</a></div></article>", "{p}"),
    ("<p title='a>b'>{p}</p><p class=\"x>{p} 2</p>", "{p}\n{p} 2"),
    ("<p>it's</p><a don't>{p}</a><p>{p} 2</p>", "it's\n{p} 2")])
def test_names_do_not_decide_alone(page, want):
    assert html_mincut.main_text(page.format(p=PROSE)) == want.format(p=PROSE)


@pytest.mark.parametrize("page", ["<a '" * 250_000, "<a x='" * 160_000 + "<p>end</p>", "<a x='y\"" * 125_000, "<!" * 500_000,
                                  "<div>" * 100_000 + "x</p>" * 100_000])
def test_broken_pages_of_a_megabyte_are_read_in_linear_time(page):
    began = time.process_time()
    html_mincut.main_text(page)
    assert time.process_time() - began < 20


def test_many_alternating_blocks():
    page = "".join(f"<p>{PROSE} {i}</p><p><a href=x>link number {i} here</a></p>" for i in range(10_000))
    began = time.process_time()
    assert html_mincut.main_text(page).count("\n") >= 9_999
    assert time.process_time() - began < 10


def test_html_defined_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>cut <b>off & on <a hr"), (None, "u", "plain text only, no tags"),
            (4, "u", "<div" * 5), (5, "u", "</p></div></body>"), (6, "u", "<p>" + "word " * 50_000),
            (7, "u", "<script>never closed <p>x</p>"), (8, "u", "<" * 3000), (9, "u", "<div>" * 3000 + "deep text in here")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in html_mincut.extract(df, ["page_id", "url"]).collect()}
    assert got[1] == got[2] == got[7] == got[5] == got[4] == ""
    assert got[3] == "cut off & on" and got[None] == "plain text only, no tags"
    assert got[6] == ("word " * 50_000).strip() and got[9] == "deep text in here"
    assert html_mincut.extract(df.limit(0), ["page_id"]).count() == 0


def test_min_cut_against_all_labellings():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 8)
        scores = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(labels):
            return (sum(max(s, 0) if not x else max(-s, 0) for s, x in zip(scores, labels))
                    + sum(w for a, b, w in edges if labels[a] != labels[b]))

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(html_mincut.min_cut(scores, edges)) == pytest.approx(best, abs=1e-6)


def test_html_query(spark):
    """The generated pages hold one article each; its blocks, read another way, are the expected text."""
    import html
    import re

    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op4_html(spark, sf).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h\d|div|ul|li|blockquote)\b[^>]*>", article)
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
        assert r.text == "\n".join(x for x in want if x)
        assert r.n_chars == len(r.text)


def test_license_scan(spark):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/x.py", "code only"),
            (3, "a/b/c/y.py", "nothing here"), (4, "a/b/LICENSE.txt", "x\nLicensed under the Apache License, Version 2.0.\n"),
            (5, "z.py", "All rights reserved.\ncode"), (6, "q/r.py", None), (7, None, "Licensed under CC BY-NC 4.0."),
            (8, None, None), (9, "a/b/own.py", "# Licensed under CC BY 4.0."), (2, "a/x.py", "code only"),
            (10, "a/long.py", "word " * 40_000 + "\nThis work is licensed under the GNU General Public License, version 3.")]
    df = spark.createDataFrame(rows, "id long, path string, text string").withColumn("license", F.lit("clash"))
    got = {r.id: (r.license, r.origin, r.from_directory) for r in license_tfidf.scan(df, "id", "path", "text").collect()}
    assert got == {1: ("MIT", "stated", None), 2: ("MIT", "inherited", "a"), 3: ("Apache-2.0", "inherited", "a/b"),
                   4: ("Apache-2.0", "stated", None), 5: ("Proprietary", "stated", None), 6: (None, "none", None),
                   7: ("CC-BY-NC-4.0", "stated", None), 8: (None, "none", None), 9: ("CC-BY-4.0", "stated", None),
                   10: ("GPL-3.0", "stated", None)}
    assert license_tfidf.scan(df.limit(0), "id", "path", "text").count() == 0


def brute_stated(text):
    """TF-IDF cosine of every line to every template in plain Python."""
    import math
    import re

    idf, vectors = license_tfidf.template_vectors(license_tfidf.TEMPLATES)
    outside = math.log(1 + len(vectors)) + 1
    best = None
    for line in set(re.split(r"\r\n|\n|\r", text or "")):
        bag = license_tfidf.tokens_of(line)
        length = math.sqrt(sum((bag.count(w) * idf.get(w, outside)) ** 2 for w in set(bag)))
        for (name, _), v in zip(license_tfidf.TEMPLATES, vectors):
            score = sum(bag.count(w) * idf[w] * v[w] for w in set(bag) & v.keys()) / length if length else 0
            if round(score, 9) >= license_tfidf.THRESHOLD:
                best = min(best or (0, ""), (-round(score, 9), name)) if best else (-round(score, 9), name)
    return best[1] if best else None


def test_license_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op7_license(spark, sf).collect()}
    assert got.keys() == texts.keys()
    for d, text in texts.items():
        assert (got[d].license if got[d].origin == "stated" else None) == brute_stated(text)
    assert any(r.origin == "stated" for r in got.values())


@pytest.mark.parametrize("line, license", [
    ("Licensed under the MIT License.", "MIT"), ("This project is released under the MIT License.", "MIT"),
    ("This text is licensed under CC BY 4.0.", "CC-BY-4.0"), ("GNU GENERAL PUBLIC LICENSE", "GPL"),
    ("                 Apache License", "Apache-2.0"), ("// SPDX-License-Identifier: MIT", "MIT"),
    ("# SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"), ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("This program is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("GNU AFFERO GENERAL PUBLIC LICENSE", "AGPL-3.0"), ("GNU LESSER GENERAL PUBLIC LICENSE", "LGPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("The public may use a version of this work.", None), ("Licensed plumbers work in the public domain.", None),
    ("General remarks on the version of the text", None)])
def test_wordings_of_notices(spark, line, license):
    """Against a plain cosine, written apart from the operator's vectors, and the license meant."""
    got = license_tfidf.stated(spark.createDataFrame([(1, f"some code\n{line}\nmore")], "id int, t string"), "id", "t").collect()
    bags = [Counter(re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", t.lower())) for _, t in license_tfidf.TEMPLATES]
    idf = lambda w: math.log((1 + len(bags)) / (1 + sum(w in b for b in bags))) + 1
    own = Counter(re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", line.lower()))
    norm = lambda b: math.sqrt(sum((n * idf(w)) ** 2 for w, n in b.items()))
    scores = [sum(n * idf(w) * b[w] * idf(w) for w, n in own.items()) / norm(own) / norm(b) for b in bags]
    best = max(range(len(bags)), key=lambda i: round(scores[i], 9))
    assert (got[0].license if got else None) == license
    assert (license is None) == (scores[best] < license_tfidf.THRESHOLD)
    if got:
        assert got[0].score == pytest.approx(scores[best], abs=1e-8)


def test_only_a_document_of_notices_licenses_its_directory(spark, tmp_dir):
    whole = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software\n\n----\n"
             "Released under the MIT License.\r\n  Released under the MIT License\nAll rights reserved.\n") * 2
    assert len(whole) > 200
    rows = [(1, "Some prose.\nReleased under the MIT License.", "a"), (2, "code", "a"), (3, whole, "b"), (4, "code", "b"),
            (5, "All rights reserved.", "c"), (6, None, "c"), (7, "\u041f\u0440\u043e\u0437\u0430.\nAll rights reserved.", "d"),
            (8, "code", "d")]
    spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: (r.license, r.origin) for r in queries.op7_license(spark, tmp_dir).collect()}
    assert {d: got[d] for d in (1, 2, 5, 6, 7, 8)} == {
        1: ("MIT", "stated"), 2: (None, "none"), 5: ("Proprietary", "stated"), 6: ("Proprietary", "inherited"),
        7: ("Proprietary", "stated"), 8: (None, "none")}
    assert got[3] == ("MIT", "stated") and got[4] == ("MIT", "inherited")
