"""Operators on pages and vectors, and the registered queries."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tidegauge.llm import html_text, url_filter, vectors, warc
from tidegauge.llm.components import connected_components
from tidegauge.llm.queries import ORACLE_SQL, QUERIES, URL_RULES

PAGES = "page_id long, url string, html string, host string, text string, rule string, payload int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "t", "r", 1) for r in rows], PAGES)


MESSY = [
    (1, "https://Blog.Example.ORG/es/x?q=1", "<p>one</p>" * 30),
    (2, "http://example.org/en/12#a", "<p>one</p>" * 30),
    (3, None, None),
    (4, "no scheme", ""),
    (5, "x://a.com", "<p>\u00e9 &amp; \U0001f600</p>"),
    (5, "x://a.com", "<p>\u00e9 &amp; \U0001f600</p>"),
    (None, "https://com/fr/?x", "<p>one</p>" * 30),
    (6, "https://b.com/de/\r\nX-Evil: 1", "z" * 400_000),
    (7, "https://notexample.org/es/", "z" * 400_000),
    (2, "http://example.org/en/12#a", "<p>one</p>" * 30),
]


# Archives


def test_warc_round_trip(spark):
    frame = pages(spark, MESSY)
    index, folder = warc.write_archives(frame, max_bytes=2_000)
    rows = warc.read_records(index, folder, gap=10, run_bytes=500).collect()
    smallest = {}
    for page_id, _, html in MESSY:
        if page_id is not None:
            smallest[html] = min(page_id, smallest.get(html, page_id))
    want = []
    for page_id, url, html in MESSY:
        raw = (html or "").encode()
        other = smallest.get(html) if len(raw) >= 100 and page_id is not None else None
        refers = other if other is not None and other != page_id else None
        want.append((page_id, url, "response" if refers is None else "revisit", refers, hashlib.sha256(raw).hexdigest(), len(raw), None if refers is not None else raw))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((*r[:6], None if r.payload is None else bytes(r.payload)) for r in rows), key=key) == sorted(want, key=key)
    some = warc.read_records(index.filter("page_id = 6"), folder).collect()
    assert [r.page_id for r in some] == [6] and bytes(some[0].payload) == b"z" * 400_000
    empty, folder = warc.write_archives(pages(spark, []))
    assert warc.read_records(empty, folder).collect() == []


# URLs


def test_url_parts_and_rules(spark):
    got = [(r.host, r.path, r.rule) for r in url_filter.judge_urls(pages(spark, MESSY), URL_RULES).collect()]
    assert got == [
        ("blog.example.org", "/es/x", "example.org/es/"),
        ("example.org", "/en/12", "example.org/en/1"),
        ("", "", None),
        ("", "", None),
        ("a.com", "", None),
        ("a.com", "", None),
        ("com", "/fr/", "com/fr/"),
        ("b.com", "/de/\r\nX-Evil: 1", "com/de/"),
        ("notexample.org", "/es/", "org/"),
        ("example.org", "/en/12", "example.org/en/1"),
    ]


def test_regression_learns_from_labelled_urls(spark):
    def url(i):
        return (f"{'casino' if i % 2 else 'news'}{i % 50}.net", f"/{'win' if i % 2 else 'story'}/{i}")

    labelled = spark.createDataFrame([(*url(i), i % 2) for i in range(600)], "host string, path string, label int")
    frame = pages(spark, [(i, "https://" + "".join(url(i)), None) for i in range(600, 900)])
    rows = url_filter.judge_urls(frame, (), labelled=labelled).collect()
    right = sum((r.verdict == "block") == (r.page_id % 2 == 1) for r in rows)
    assert right >= 0.99 * len(rows) and all(0 <= r.block_score <= 1 for r in rows)


def test_no_labels(spark):
    rows = url_filter.judge_urls(pages(spark, MESSY), ()).collect()
    assert {r.verdict for r in rows} == {"allow"}
    assert url_filter.judge_urls(pages(spark, []), URL_RULES).collect() == []
    one = url_filter.judge_urls(pages(spark, [(1, "http://x.org/a", None), (2, "http://y.net/a", None)]), URL_RULES).collect()
    assert {r.verdict for r in one} == {"allow"}


# Main text


@pytest.mark.parametrize(
    "html,text",
    [
        ("<html><head><title>T</title></head><body><nav>menu</nav><article><h1>A &amp; B</h1><p>one\n two<br>three<p><b>four</article><footer>f", "A & B\n\none two three\n\nfour"),
        ("<body><div class='ad'>x</div><main><p>a</p><aside>s</aside></main><p>out</p></body>", "a"),
        ("<p>plain", "plain"),
        ("bare &lt;text&gt;", "bare <text>"),
        ("<article><p>a</p><form><input>f</form><script>var t='</p>';</script><div class='comments'><article class='comment'><p>c</p></article></div></article>", "a"),
        ("<article><header><h1>H</h1></header><p>a<!-- x --></p><div id=cookie-notice><p>n</p></div></article>", "H\n\na"),
        ("<article><p>cut &amp; run</p><p class=\"x", "cut & run"),
        ("<ul><li>a<li>b</ul>", "a\n\nb"),
        ("<p>a</b></i></p></div>b", "a\n\nb"),
        ("", ""),
    ],
)
def test_main_text(html, text):
    assert html_text.Page(html).text() == text


def test_site_templates(spark):
    menu = "<div><ul><li>Home</li><li>About</li></ul></div>"
    rows = [(i, "http://a.com/x", f"<body>{menu}<div><p>page {i}</p><p>same everywhere</p></div></body>") for i in range(20)]
    rows += [(100 + i, "http://b.com/x", f"<body>{menu}<div><p>other {i}</p></div></body>") for i in range(3)]
    rows += [(200 + i, "http://c.com/x", "<article><p>copied text</p></article>") for i in range(20)]
    rows += [(300, None, f"<body>{menu}</body>"), (301, "http://a.com", None)]
    got = {r.page_id: r for r in html_text.extract_text(pages(spark, rows)).collect()}
    assert got[3].text == "page 3" and got[3].n_chars == 6
    assert got[101].text == "Home\n\nAbout\n\nother 1"
    assert got[205].text == "copied text"
    assert got[300].text == "Home\n\nAbout" and got[301].text == ""
    assert html_text.extract_text(pages(spark, [])).collect() == []


def test_copies_of_a_page_are_no_template(spark):
    def distinct(host, n, at):
        return [(at + i, f"http://{host}/x", f"<body><ul><li>Home</li><li>Top</li></ul><div><p>story {i} of {host}</p></div></body>") for i in range(n)]

    rows = [(i, f"http://a.com/{i}", f"<head><title>{i}</title></head><body><div class=c{i}><div><p>text of the copy</p></div></div></body>") for i in range(20)]
    rows += [(100 + i, "http://b.com/x", "<article><section><p>first</p></section><section><p>again</p></section></article><p>outside</p>") for i in range(20)]
    rows += distinct("c.com", 10, 200) + [(300 + i, "http://c.com/y", "<body><ul><li>Home</li><li>Top</li></ul><div><h2>copied</h2><p>in a third of all rows</p></div></body>") for i in range(5)]
    # A story that five other pages quote is still the text of its own page.
    rows += [(400 + i, "http://d.com/x", f"<body><div><p>quoted one</p><p>quoted two</p></div><div><p>a far longer text of the page number {i}</p></div></body>") for i in range(9)]
    rows += [(500, "http://d.com/q", "<body><div><p>quoted one</p><p>quoted two</p></div><p>by me</p></body>")]
    got = {r.page_id: r.text for r in html_text.extract_text(pages(spark, rows)).collect()}
    assert {got[i] for i in range(20)} == {"text of the copy"}
    assert {got[100 + i] for i in range(20)} == {"first\n\nagain"}
    assert [got[200 + i] for i in range(10)] == [f"story {i} of c.com" for i in range(10)]
    assert {got[300 + i] for i in range(5)} == {"copied\n\nin a third of all rows"}
    assert got[403] == "a far longer text of the page number 3"
    assert got[500] == "quoted one\n\nquoted two\n\nby me"


def test_an_emptied_article_gives_no_text_from_outside(spark):
    rows = [(i, "http://a.com/x", f"<article><div><p>sign in</p></div><div><p>to go on</p></div></article><p>page {i}</p>") for i in range(20)]
    rows += [(100 + i, "http://a.com/y", f"<article><div><p>sign in</p></div><div><p>to go on</p></div><p>a long text of its own, page {i}</p></article>") for i in range(20)]
    got = {r.page_id: r.text for r in html_text.extract_text(pages(spark, rows)).collect()}
    assert got[3] == "to go on" and got[103] == "a long text of its own, page 3"


def test_long_and_broken_markup():
    assert html_text.Page("<div>" * 3000 + "x").text() == "x"
    assert html_text.Page("<" * 20_000).text() != ""
    assert html_text.Page('<a href="' * 5_000).text() == ""


# Vectors


def brute_links(rows, cosine=0.93):
    ok = [v is not None and len(v) and None not in v and all(map(math.isfinite, v)) and any(v) and label is not None for _, v, label in rows]
    scaled = [np.array(v, float) / np.abs(np.array(v, float)).max() if good else None for (_, v, _), good in zip(rows, ok)]
    unit = [None if v is None else v / np.linalg.norm(v) for v in scaled]
    n = len(rows)
    linked = [[j for j in range(n) if i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((len(linked[i]), min(ids) if ids else None))
    return out


@pytest.mark.parametrize("cell_rows,block_rows", [(2048, 2048), (40, 15)])
def test_vectors(spark, cell_rows, block_rows):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(60, 8))
    rows = [(i, [float(x) for x in base[i % 60] + draw.normal(size=8) * 0.35 * (i // 60) / 4], i % 3) for i in range(300)]
    v = rows[0][1]
    rows += [(1000 + i, v, 0) for i in range(30)] + [(5, v, 0), (2000, [2 * x for x in v], 0), (2001, v, None), (2002, v, 1)]
    rows += [(2003, None, 0), (2004, [0.0] * 8, 0), (2005, [1.0, None] + [0.0] * 6, 0), (2006, [float("nan")] * 8, 0), (2007, [float("inf")] + [1.0] * 7, 0)]
    rows += [(2008, [], 0), (2009, v[:4], 0), (2010, v[:4], 0), (None, v, 0), (None, [0.0] * 8, 0), (2011, [1e-300] * 8, 2), (2012, [1e300] * 8, 2)]
    frame = spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id long, embedding array<double>, label int, class string, size int")
    got = vectors.link_vectors(frame, cell_rows=cell_rows, block_rows=block_rows).collect()
    want = brute_links([(r.vec_id, r.embedding, r.label) for r in got])
    assert [(r.n_links, r.component_id) for r in got] == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert vectors.link_vectors(frame.limit(0)).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (7, 7), (300, 100)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# Registered queries


def test_registered_queries(spark, sf_dir):
    numbers = sorted(int(name.split("_")[0][2:]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    for name in ("op2_url_filter", "op5_warc", "op9_html_text", "op3_near_vectors"):
        table = "embeddings" if name.startswith("op3") else "pages"
        assert QUERIES[name](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    from compare import compare

    assert compare(spark, sf_dir, QUERIES[name], ORACLE_SQL[name]) is None


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:2]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns
        assert 0 < after.count() <= docs.count()
        docs = after
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
