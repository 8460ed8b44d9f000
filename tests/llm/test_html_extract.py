import html
import re

from quillpair.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a < b) { x("<p>no</p>") }</script></head><body>
<header><h1>Site</h1></header><nav><ul><li>One<li>Two</ul></nav><div class="cookie-notice">We use cookies</div>
<article class=post id="p-%d"><h1>Title &amp; more &#233;</h1><p>First <b>bold <i>text</b>.<br>next
 line &lt;p&gt;<p>Second <span class="ad">Buy</span>part.<aside>Side</aside><form>Mail</form>
<ul><li>item one<li>item two</ul><table><tr><td>a<td>b<tr><td>c</table><!-- <p>gone</p> -->
<section id="comments"><article><p>Reader</p></article></section><noscript>Js</noscript></article>
<aside>More</aside><footer>&copy; x</footer></body></html>"""
WANT = "Title & more é\nFirst bold text. next line <p>\nSecond part.\nitem one\nitem two\na b\nc"
NOT_MARKED = """<html><body><div class="menu">M</div><div class="top">Always here</div><div class="body"><p>Own %d</p>
<p>Text %d</p></div><div class="low">Also always</div></body></html>"""


def test_one_page():
    assert H.main_text(PAGE % 1, set()) == WANT
    assert H.main_text("", set()) == "" and H.main_text("just text &amp; no tags", set()) == "just text & no tags"
    assert H.main_text("<p>open <b>never closed <div", set()) == "open never closed <div"
    assert H.main_text("<article></article><p>x</p>", set()) == ""


def test_names_do_not_drop_what_a_page_is_about():
    for page in ('<div class="content has-sidebar"><p>A</p></div>', '<main class="no-sidebar"><p>A</p></main>',
                 '<article class="post comments-open"><p>A</p></article>',
                 '<form><div><article><p>A</p></article><nav>n</nav></div></form>',
                 '<form><p>A</p><div class="menu"></div></form>', '<div class="sidebar"><article>A</article></div>',
                 '<div class="page-sidebar-left"><main><p>A</p></main><div class="sidebar">S</div></div>',
                 '<article><div class="ad-supported"><p>A</p></div><div class="ad"></div></article>',
                 '<article><p>A</p></article><div id="comments"><article>Says more than the article</article></div>'):
        assert H.main_text(page, set()) == "A", page


def _run(spark, rows):
    df = spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h) in enumerate(rows)],
                               "page_id long, url string, html string, host string, row int")
    return {r.page_id: (r.url, r.text, r.n_chars) for r in H.extract_main_text(df).collect()}


def test_templates(spark):
    rows = [(f"http://a.example/{i}", NOT_MARKED % (i, i)) for i in range(8)]
    rows += [("http://b.example/1", PAGE % 1), ("http://b.example/2", PAGE % 2), (None, None), ("no host", "<p>x  y</p>"),
             ("http://c.example/", NOT_MARKED % (1, 1)), ("http://d/", "<p>" + "long " * 60_000)]
    out = _run(spark, rows)
    assert len(out) == len(rows)
    for i in range(8):
        assert out[i][1] == f"Own {i}\nText {i}"  # what stands on every page of the host is template
    assert out[8][1] == out[9][1] == WANT
    assert out[10] == (None, "", 0) and out[11][1] == "x y"
    assert out[12][1] == "Always here\nOwn 1\nText 1\nAlso always"
    assert out[13][2] == 5 * 60_000 - 1


def test_shared_passages_of_articles_stay(spark):
    rows = [(f"http://a/{i}", f"<nav>n</nav><article><p>Shared by all.</p><p>Own {i}</p></article>") for i in range(12)]
    assert [t for _, t, _ in _run(spark, rows).values()].count("Shared by all.\nOwn 3") == 1
    assert all("Shared by all." in t for _, t, _ in _run(spark, rows).values())


def test_template_decides_in_articles(spark):
    page = ("<nav>n</nav><article><h1>%s</h1><div class=x1>Tell your friends</div><p>Own %d</p>%s"
            "<div class=x2>Rate this</div></article>")
    rows = [(f"http://a/{i}", page % (f"Title {i}", i, "<p>More</p>" * (i % 3))) for i in range(12)]
    rows += [(f"http://copies/{i}", page % ("Same", 1, "")) for i in range(6)]  # nothing varies: kept whole
    rows += [(f"http://b/{i}", page % ("Same" if i < 9 else f"T {i}", i, "")) for i in range(12)]
    out = _run(spark, rows)
    for i in range(12):
        assert out[i][1] == "\n".join([f"Title {i}", f"Own {i}"] + ["More"] * (i % 3))
        assert out[18 + i][1] == ("Same" if i < 9 else f"T {i}") + f"\nOwn {i}"
    assert all(out[i][1] == "Same\nTell your friends\nOwn 1\nRate this" for i in range(12, 18))


def test_layouts_below_half_of_a_host(spark):
    page = "<html lang=%s><body><div class=top>%s</div><div class=%s><p>Own %d</p>%s</div><div class=low>%s</div></body></html>"
    rows = [("http://big/%s%d" % (lang, i), page % (lang, f"Always {lang}", lang, i, "<p>x</p>" * (i % 2), f"Low {lang}"))
            for lang in ("de", "en", "fr", "es") for i in range(8)]
    out = _run(spark, rows)
    assert all(t == "\n".join([f"Own {k % 8}"] + ["x"] * (k % 2)) for k, (_, t, _) in out.items())


def test_equal_vectors_make_a_class(spark):
    from quillpair.llm.html_extract import templates
    page = "<div class=a><p class=x%d>t</p></div><div class=c></div>" + "<div class=b></div>"
    rows = [(i, "h", page % i if i % 2 else (page % i).replace("<div class=b></div>", "")) for i in range(6)]
    (t,) = templates(spark.createDataFrame(rows, "row long, host string, html string")).collect()
    a, p, c, b = (e.token for e in H.parse(page % 1)[0])
    assert set(t.tokens) == {a, c}  # b is alone in its class, p on one page


def test_empty_table(spark):
    assert _run(spark, []) == {}


def test_given_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {r.page_id: r.text for r in H.extract_main_text(df).collect()}
    for r in df.collect():
        a = r.html[r.html.index("<article>") + 9:r.html.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", a))
        assert out[r.page_id] == "\n".join(b for b in blocks if b)
