"""Host verdicts at two sizes of the corpus, and main texts on pages unlike the given ones."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tidegauge.llm.html_text import Page, extract_text
from tidegauge.llm.quality import RULES, host_verdicts, judge


@pytest.mark.parametrize("others", [1_000, 1_000_000])
def test_one_bad_host_in_a_corpus_of_any_size(spark, others):
    """Fifty documents of one host fail all the same rule; one in twenty of the others does."""
    rows = spark.range(others).select(F.concat(F.lit("h"), F.col("id") % 40).alias("host"), F.expr("cast(id div 40 % 20 = 0 as int)").alias("symbols"))
    rows = rows.unionByName(spark.range(50).select(F.lit("bad").alias("host"), F.lit(1).alias("symbols")))
    # A host with three failures is not enough to tell.
    rows = rows.unionByName(spark.range(3).select(F.lit("tiny").alias("host"), F.lit(1).alias("symbols")))
    rows = rows.select("host", *[F.col("symbols") if r == "symbols" else F.lit(0).alias(r) for r in RULES])
    verdicts = {r.host: r.host_kept for r in host_verdicts(rows, dict.fromkeys(RULES, 0.8)).collect()}
    assert [h for h, kept in verdicts.items() if not kept] == ["bad"] and len(verdicts) == 42


def test_a_rejected_host_takes_its_good_documents(spark):
    good, junk = " ".join(f"w{i}" for i in range(60)), " ".join(f"##x{i}%%" for i in range(60))
    rows = [(i, good, f"s{i % 5}") for i in range(300)] + [(1000 + i, junk, "bad") for i in range(80)] + [(2000, good, "bad")]
    judged = judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    dropped = {r.doc_id for r in judged if not r.kept}
    assert dropped == {r[0] for r in rows if r[2] == "bad"} and not any(r.base_failed for r in judged)


@pytest.mark.parametrize(
    "html,text",
    [
        ("<article class=teaser><p>t</p></article><main><h1>H</h1><p>long main text</p></main>", "H\n\nlong main text"),
        ("<main><article><h1>H</h1><p>the article</p></article><p>more</p></main>", "H\n\nthe article"),
        ("<main><p>all of it is here</p><article><p>x</p></article></main>", "all of it is here\n\nx"),
        ("<article><div class='related-work'><p>w</p></div><p id='comment-on-law'>l</p><p class='share'>s</p></article>", "w\n\nl\n\ns"),
        ("<article><p>a</p><div class='comment-list'><p>c</p></div><div id=cookie-notice>n</div><section class='ad box'>d</section></article>", "a"),
        ("<article><p>a <noscript>b</noscript> <button>c</button></p></article>", "a b c"),
        ("<article><p>a</p><nav>m</nav><form>f</form></article>", "a"),
    ],
)
def test_main_text_of_other_pages(html, text):
    assert Page(html).text() == text


@pytest.mark.parametrize("piece", ["<b></i>", "</p>", "<b>", "<p></div>", "<li></b><i>"])
def test_unmatched_tags_take_linear_time(piece):
    took = []
    for n in (20_000, 80_000):
        page = "<article><p>start</p>" + piece * n + "end"
        began = time.process_time()
        assert Page(page).text().endswith("end")
        took.append(time.process_time() - began)
    assert took[1] < 12 * took[0] + 0.5


def test_words_of_articles_against_their_markup(spark):
    """Every word put into an article's paragraphs comes out, in order, whatever classes stand around it; no word from outside does."""
    import random

    draw = random.Random(5)
    classes = ["lead", "related-work", "share", "note", "x ad-hoc", "commentary", "widgetry", "sidebarred"]
    rows, want = [], {}
    for i in range(200):
        paragraphs = [" ".join(f"w{i}x{draw.randrange(1000)}" for _ in range(draw.randint(1, 30))) for _ in range(draw.randint(1, 6))]
        body = "".join(f"<p class='{draw.choice(classes)}'>{p}</p>" if draw.random() < 0.5 else f"<div class='{draw.choice(classes[:2] + classes[3:])}'><p>{p}</p></div>" for p in paragraphs)
        rows.append((i, f"http://h{i % 3}.org/{i}", f"<html><nav>menu</nav><div class=sidebar>out</div><article>{body}</article><footer>out</footer>"))
        want[i] = "\n\n".join(paragraphs)
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want
