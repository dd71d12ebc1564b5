import html
import re

import pytest

from lakeops.llm import pages

SCHEMA = "page_id long, url string, html string, host string, path string"


def run(spark, rows):
    df = spark.createDataFrame([(i, u, h, "h", "p") for i, u, h in rows], SCHEMA)
    return sorted(((r.page_id, r.text) for r in pages.extract(df).collect()), key=str)


def site(n, article, side="<aside>Side</aside>", tail="</body></html>"):
    return (f"<!DOCTYPE html><html><head><title>T{n}</title><style>p{{}}</style><script>var t='</p>';</script></head><body><header><h2>Site</h2></header>"
            f"<nav><ul><li><a href='/a'>Menu</a></li></ul></nav><!-- x --><div class=\"cookie-notice\">We use cookies</div>{article}{side}<footer>&copy; x</footer>{tail}")


def test_extraction(spark):
    rows = [(i, f"http://a.org/{i}", site(i, f"<article><h1>Title {i}</h1><p>One &amp; <b>two</b>\n  three<br>four<p>Five &lt;{i}&gt;"
                                             "<div class='ad'>Buy</div><form>F</form><div id=comments><p>Nice</p></div><table><tr><td>a<td>b</table></article>")) for i in range(6)]
    want = "Title {0}\nOne & two three four\nFive <{0}>\na\nb"
    assert run(spark, rows) == [(i, want.format(i)) for i in range(6)]


def test_host_without_article_element(spark):
    """The content slot is found by its share of the text, on all pages of the host."""
    story = lambda i: f"<div class='story'><p>{'Long text of the story. ' * 5}{i}</p></div>"
    rows = [(i, f"http://b.net/{i}", site(i, f"<div class='wrap'><div class='teaser'><p>Read more</p></div>{story(i)}</div>")) for i in range(5)]
    rows.append((9, "http://b.net/short", site(9, "<div class='wrap'><div class='teaser'><p>A teaser that is longer than the story itself</p></div><div class='story'><p>Short.</p></div></div>")))
    got = dict(run(spark, rows))
    assert got[0] == "Long text of the story. " * 5 + "0" and got[9] == "Short."


def test_names_of_containers(spark):
    """Layout remarks drop no article; what stands in the slot is dropped though a wrapper outside has such a name too."""
    body = lambda i: f"<p>{'Long text of the story. ' * 5}{i}</p>"
    want = "Long text of the story. " * 5
    for k, (name, whole) in enumerate([("page no-sidebar", ""), ("content with-sidebar", ""), ("side-by-side", ""), ("search-results", ""),
                                       ("social-story", ""), ("story", " class='has-menu nav'")]):
        rows = [(i, f"http://n{k}.net/{i}", f"<html{whole}><body{whole}><div class='{name}'>{body(i)}<div class='cookie-notice'>We use cookies</div>"
                                            "<div class='sidebar-left'>Side</div><div id=comments>Nice</div></div></body></html>") for i in range(4)]
        assert run(spark, rows) == [(i, want + str(i)) for i in range(4)], (name, whole)
    rows = [(i, f"http://w.net/{i}", f"<html><body><div class='widget'><article>{body(i)}<nav>Menu</nav><div id=comments>Nice</div></article></div></body></html>") for i in range(4)]
    assert run(spark, rows) == [(i, want + str(i)) for i in range(4)]


def test_defined_cases(spark):
    rows = [(1, None, None), (2, "http://c.org/", ""), (3, "http://c.org/x", "plain <b>text</b> & more"), (4, "x", "<article><p>cut off <a href='"),
            (5, "http://d.org/", "<article><p>" + "word " * 50_000 + "</article>"), (5, "http://d.org/", "<article><p>" + "word " * 50_000 + "</article>"),
            (6, "http://e.org/", "<main>a < b &nbsp;&eacute;&#233;</main>"), (None, "http://e.org/2", "<body><p>x<script>never closed")]
    long = ("word " * 50_000).strip()
    assert run(spark, rows) == sorted([(1, ""), (2, ""), (3, "plain text & more"), (4, "cut off"), (5, long), (5, long), (6, "a < b éé"), (None, "x")], key=str)
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        pages.extract(spark.createDataFrame([(1, "u", "h", "t")], "page_id long, url string, html string, text string"))


def test_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = dict(run(spark, [(r.page_id, r.url, r.html) for r in rows]))
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        inner = re.sub(r"</?(?:p|h1)>", "\0", inner)
        inner = re.sub(r"<br>", " ", inner)
        lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in inner.split("\0"))
        assert got[r.page_id] == "\n".join(x for x in lines if x)
