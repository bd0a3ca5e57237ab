from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F

from docloom.llm import site_style
from docloom.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


def text(page: str) -> str:
    return site_style.Page(page).text(set())


@pytest.mark.parametrize(
    "page, expected",
    [
        ("", ""),
        ("<p>a<p>b", "a\n\nb"),
        ("<article><h1>T &amp; &#233;&eacute;&nbsp;x</h1><p>a\n  b<br>c</p></article><p>out", "T & éé x\n\na b c"),
        ("<nav>n</nav><header>h</header><div>t</div><aside>s</aside><footer>f</footer>", "t"),
        ("<article><header><h1>T</h1></header><p>x</p><div class='ad-box'>a</div><section id=comments>c</section></article>", "T\n\nx"),
        ("<main><p>x<script>var t='</p>';</script><style>p{}</style><form>f<input></form> y</p></main>", "x\n\ny"),
        ("<article>x</article><article class='comment'>c</article><article>y</article>", "x\n\ny"),
        ("<div class=cookieNotice>n</div><div class='sideBar menu'>m</div><p>shadow", "shadow"),
        ("<ul><li>a<li>b <ul><li>c</ul></ul><table><tr><td>1<td>2</table>", "a\n\nb\n\nc\n\n1\n\n2"),
        ("<article><p>a <b>b</p><p>c</b> d</article>e", "a b\n\nc d"),
        ("<p title='a > b'>x</p><!-- <p>no</p> -->&lt;p&gt;", "x\n\n<p>"),
        ("<body class='sidebar-right'><p>x", "x"),
        ("<div role=banner>b</div><div hidden>h</div><p>x</p></div></section>y", "x\n\ny"),
        ("<article><p>" + "a " * 50_000 + "</article>", " ".join(["a"] * 50_000)),
        ("<div>" * 5000 + "deep", "deep"),
    ],
)
def test_blocks(page, expected):
    assert text(page) == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<div class='layout has-sidebar'><article>a</article></div>", "a"),
        ("<div class='widget'><div class=menu>m</div><article>a</article></div>", "a"),
        ("<div class='content no-ads'>Text of the page</div>", "Text of the page"),
        ("<article><h2 id='related-work'>R</h2><h2 id='social-policy'>S</h2><h2 id=notice>N</h2><p class='notice'>p</article>", "R\n\nS\n\nN\n\np"),
        ("<div class=post><p>A long text of its own</div><article>Teaser</article>", "A long text of its own\n\nTeaser"),
        ("<article>Long text</article><div class=related><article>Card</article></div>", "Long text"),
        ("<article>Teaser</article><div class=social><article>A long text</article></div>", "Teaser\n\nA long text"),
        ("<article>x<div id=comments><article>A long remark</article></div></article>", "x"),
        ("<div class=ad-box>a</div><div class=share_buttons>s</div><div class=navBar>n</div><p>x", "x"),
        ("<article>A long teaser</article><div class=social><main>x</main></div>", "A long teaser\n\nx"),
        ("<main> </main><div class=post>x</div>", "x"),
        ("<main>x</main><div class=post>More text beside</div>", "x"),
    ],
)
def test_names_take_no_text(page, expected):
    assert text(page) == expected


def page(i: int, body: str) -> str:
    return f"<html><body><div class=top>Same words at every page</div>{body}<div class=end>Share this page</div></body></html>"


def rows(n: int):
    return [(i, f"http://Site.example/{i}", page(i, f"<div class=post><p>Own text {i}</p><p>Common paragraph</p></div>")) for i in range(n)]


def test_branches_alike_on_many_pages_go(spark):
    made = rows(12) + [(100, "http://other.example/", page(0, "<p>alone</p>"))]
    found = {r["page_id"]: r["text"] for r in site_style.main_text(spark.createDataFrame(made, SCHEMA)).collect()}
    assert all(found[i] == f"Own text {i}\n\nCommon paragraph" for i in range(12))
    assert found[100] == "Same words at every page\n\nalone\n\nShare this page"  # one page tells nothing about its site


def test_importance_is_an_entropy(spark):
    made = spark.createDataFrame([("h", 1, 7, i) for i in range(8)] + [("h", 2, 7, 7)] * 8 + [("h", 3, 1, 1)], "host string, node long, presentation long, content long")
    found = {r["node"]: (r["pages"], round(r["importance"], 6)) for r in site_style.importance(made).collect()}
    assert found == {1: (8, 0.9), 2: (8, 0.0), 3: (1, 1.0)}


def test_copied_articles_stay(spark):
    same = "<html><body><article><h1>Title</h1><p>One text on all pages</p></article></body></html>"
    found = site_style.main_text(spark.createDataFrame([(i, "http://a.example/", same) for i in range(20)], SCHEMA))
    assert {r["text"] for r in found.collect()} == {"Title\n\nOne text on all pages"}


PARTS = "<div class=body><p>In a div</p></div><ul><li>In a list</ul><table><tr><td>In a table</table>"


@pytest.mark.parametrize("body", [f"<article>{PARTS}</article>", f"<div class=wrap><main>{PARTS}</main></div>", PARTS])
def test_copies_lose_no_text(spark, body):
    found = site_style.main_text(spark.createDataFrame([(i, "http://a.example/", body) for i in range(20)], SCHEMA))
    assert {r["text"] for r in found.collect()} == {"In a div\n\nIn a list\n\nIn a table"}


def test_copies_do_not_outvote_other_pages(spark):
    made = [(i, "http://a.example/", page(0, f"<div class=post><p>Text {max(i, 80)}</p></div>")) for i in range(100)]
    found = {r["page_id"]: r["text"] for r in site_style.main_text(spark.createDataFrame(made, SCHEMA)).collect()}
    assert all(found[i] == f"Text {max(i, 80)}" for i in range(100))


def test_parts_alike_in_articles_stay(spark):
    made = [(i, "http://a.example/", f"<article><p>Own {i}</p><ul><li>Same list</ul></article>") for i in range(8)]
    found = {r["page_id"]: r["text"] for r in site_style.main_text(spark.createDataFrame(made, SCHEMA)).collect()}
    assert all(found[i] == f"Own {i}\n\nSame list" for i in range(8))


def test_awkward_rows(spark):
    made = [*rows(6), (6, None, "<p>x</p>"), (7, "http://[bad", "<p>y</p>"), (8, "http://a/", None), (9, "http://a/", ""), (None, "http://a/", "<p>z</p>"), rows(1)[0]]
    pages = spark.createDataFrame(made, SCHEMA).withColumn("text", F.lit("clash")).withColumn("host", F.lit("clash")).withColumn("_low", F.lit(1))
    found = site_style.main_text(pages).collect()
    assert len(found) == len(made)
    by = {r["page_id"]: r["text"] for r in found}
    assert (by[6], by[7], by[8], by[9], by[None]) == ("x", "y", "", "", "z")
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert site_style.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op8_site_style"](spark, sf_dir).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)
