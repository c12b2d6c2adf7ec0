"""Main text against a plain reading of the test pages; wrappers; made-up page kinds; edge rows."""

import html
import json
import re

from changelake.llm import html_extract as hx
from changelake.llm.queries import QUERIES


def alone(page):
    return hx.Extractor(hx.tokens(page)).text(page)


def test_query(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op6_html_extraction"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        parts = (html.unescape(re.sub("<[^>]*>", "", x)) for x in re.split(r"</?p>|</?h1>", inner))
        want = "\n".join(x for x in (" ".join(p.split()) for p in parts) if x)
        assert r["text"] == want and r["n_chars"] == len(want)


PAGE = """<html><head><title>T</title><script>var x = "<p>no</p>";</script></head><body class="home">
<header><a href="/">Site</a></header><div id="cookie-notice">We use cookies</div><nav><ul><li>A<li>B</ul></nav>
<main><article class="post"><header><h1>Head &amp; line</h1></header><div class="ad">Buy</div>
<p>One <b>bold</b><script>s()</script> word<br>next &nbsp; <button>Share</button>line<p>Two &lt;tag&gt; &#233;
<ul><li>item 1<li>item 2</ul><table><tr><td>c1<td>c2</table><form><p>Name <input></p></form>
<blockquote>quote</blockquote><!-- <p>hidden</p> --></article><aside>Related</aside>
<section class="comments"><article class="comment"><p>First!</p></article></section></main>
<div role="complementary">side</div><p style="display: none">unseen</p><span aria-hidden="true">x</span><footer>c</footer></body></html>"""


def test_kinds_of_boilerplate():
    assert alone(PAGE) == "Head & line\nOne bold word next line\nTwo <tag> é\nitem 1\nitem 2\nc1\nc2\nquote"


def test_page_without_container_and_broken_pages():
    assert alone("<body><nav>m</nav><div><p>a</p>b</div><footer>f</footer>") == "a\nb"
    assert alone("plain text &amp; more") == "plain text & more"
    assert alone("<article><p>open") == "open"
    assert alone("<p>a < b and c</p>") == "a < b and c"
    assert alone("") == "" and alone("<script>never closed") == "" and alone("<!-- never closed") == ""
    assert alone("</p></div>x<p>y</b></p>z") == "x\ny\nz"


def test_alignment_makes_repeated_and_optional_groups():
    a = hx.tokens("<article><h1>t</h1><p>1</p><p>2</p></article><footer>same</footer>")
    b = hx.tokens("<article><h1>u</h1><div class='note'>n</div><p>1</p></article><footer>same</footer>")
    w = hx.align(a, b)
    kinds = [(n[0], hx.bare(n)[1] if hx.bare(n)[0] == "t" else hx.bare(hx.bare(n))[1]) for n in w]
    assert ("?", "article/div.note") in kinds and ("+", "article/p") in kinds
    texts = {s[1]: s[3] for s in hx.slots(w)}
    assert texts["footer"] == "same" and texts["article/h1"] is None
    # whatever the order, the same slots
    assert {s[1] for s in hx.slots(hx.align(b, a))} == {s[1] for s in hx.slots(w)}


def test_long_streams_align_without_a_table():
    page = "<article>" + "".join(f"<div class='c{i}'>x</div>" for i in range(1500)) + "</article>"
    w = hx.align(hx.tokens(page), hx.tokens(page.replace("c7'", "d7'")))
    assert sum(n[0] == "?" for n in w) == 2


def test_rows(spark):
    art = "<html><body><div class='menu'>m</div><article><p>text {}</p></article></body></html>"
    rows = [(i, f"http://h.example/{i}", art.format(i), "clash") for i in range(40)]
    rows += [(100, "http://h.example/x", "<body><p>no article</p><nav>n</nav>", "c"), (101, None, art.format("null url"), "c"),
             (102, "http://h.example/y", None, "c"), (None, "HTTP://H.example/z", "", "c"), (5, "http://h.example/5", art.format(5), "c"),
             (103, "http://big.example/", "<article>" + "<p>long</p>" * 30_000 + "</article>", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {}
    for r in hx.extract(df).collect():
        got.setdefault(r["page_id"], []).append((r["text"], r["n_chars"]))
    assert sum(map(len, got.values())) == len(rows) and len(got[5]) == 2
    assert all(got[i][0] == (f"text {i}", len(f"text {i}")) for i in range(40))
    assert got[100] == [("no article", 10)] and got[101] == [("text null url", 13)]
    assert got[102] == got[None] == [("", 0)]
    assert got[103][0][1] == 30_000 * 5 - 1
    assert hx.extract(df.limit(0)).count() == 0
    wrappers = {r["host"]: json.loads(r["wrapper"]) for r in hx.infer_wrappers(df.select("html", hx.F.lit("h").alias("host"))).collect()}
    assert "+" in {n[0] for n in wrappers["h"]} | {n[1][0][0] for n in wrappers["h"] if n[0] == "?"}


def test_host_pages_decide_without_names(spark):
    page = ("<body><div class='zq1'><ul><li>Home<li>Shop<li>Us</ul></div><div class='zq2'>Try our plan</div>"
            "<div class='share-story'><h2>Title {0}</h2><p>story {0} goes on</p><p>and ends {0}</p></div><div class='zq3'>All rights</div></body>")
    copy = "<body><div class='zq1'>Top</div><p>the same text</p><div class='zq2'>read {}</div></body>"
    rows = [(i, f"http://many.example/{i}", page.format(i)) for i in range(12)]
    rows += [(100 + i, "http://copies.example/", copy.format(7)) for i in range(12)] + [(200 + i, "http://dated.example/", copy.format(i)) for i in range(12)]
    rows += [(300 + i, "http://few.example/", page.format(i).replace("zq1", "menu").replace("share-", "")) for i in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in hx.extract(df).collect()}
    assert all(got[i] == f"Title {i}\nstory {i} goes on\nand ends {i}" for i in range(12))
    # copies of a page are no template
    assert all(got[100 + i] == "Top\nthe same text\nread 7" and "the same text" in got[200 + i] for i in range(12))
    # names decide where there are few pages
    assert got[300] == "Try our plan\nTitle 0\nstory 0 goes on\nand ends 0\nAll rights"


def extracted(spark, pages):
    rows = [(i, f"http://{host}/{i}", page) for i, (host, page) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(40)
    got = {r["page_id"]: r["text"] for r in hx.extract(df).collect()}
    return [got[i] for i in range(len(rows))]


def test_adverts_notices_and_comments_that_vary_stay_out(spark):
    """They change from page to page by nature, in an article or main element and without one, named by class or by id."""
    kinds = {
        "plain": "<body><div class='ad'>Buy {0} now</div><div id='cookie'>We use cookies {0}</div><div class='post'><p>story {0} goes on</p><p>ends {0}</p></div></body>",
        "article": "<body><div class='ad-box'>Buy {0}</div><article class='post comments-open'><p>story {0} goes on</p><div id='sponsor-{0}' class='sponsored'>by {0}</div>"
                   "<p>ends {0}</p></article><section class='comments'><article class='comment'><p>reader {0} says much, much more than the story {0} itself</p></article></section></body>",
        "bare": "<body><main><h1>story {0} goes on</h1><p>ends {0}</p><article class='comment depth-1'><p>First {0}!</p></article></main><p class='notice'>Notice {0}</p></body>",
        "list": "<body><ul class='menu'><li>m{0}</ul><p>story {0} goes on</p><p>ends {0}</p><ol id='comments'><li>one {0}<li>two {0}</ol><div class='sidebar'>{0}</div></body>",
    }
    pages = [(f"{host}.example", page.format(i)) for host, page in kinds.items() for i in range(9)]
    got = extracted(spark, pages)
    assert got == [f"story {i} goes on\nends {i}" for _ in kinds for i in range(9)]


def test_a_doubtful_name_is_overruled_by_most_of_the_text_only(spark):
    page = ("<body><div class='share-story'><h2>Title {0}</h2><p>story {0} goes on and on</p></div><div class='related'><p>more {0}</p></div>"
            "<div class='zq'><p>by line {0}</p></div></body>")
    got = extracted(spark, [("h.example", page.format(i)) for i in range(9)])
    assert got == [f"Title {i}\nstory {i} goes on and on\nby line {i}" for i in range(9)]


def test_wrappers_merge_as_a_tree(spark, monkeypatch):
    page = "<body><div class='zq1'>Top</div><p>a long story {0}</p>{1}<div class='zq2'>End</div></body>"
    pages = [("h.example", page.format(i, "<pre>opt</pre>" if i % 3 == 0 else "")) for i in range(60)]
    want = extracted(spark, pages)
    assert want == [f"a long story {i}" for i in range(60)]
    monkeypatch.setattr(hx, "FAN", 2)
    assert extracted(spark, pages) == want


def test_the_wrapper_changes_the_answer_where_names_are_silent(spark):
    """Share of pages on which the host's wrapper decides otherwise than the page alone: all of a template without names."""
    page = "<body><div class='x1'>Home Shop</div><p>a rather long story {0}</p><div class='x2'>All rights</div></body>"
    pages = [("a.example", page.format(i)) for i in range(20)] + [("b.example", f"<body><article><p>s {i}</p></article></body>") for i in range(20)]
    got = extracted(spark, pages)
    changed = sum(g != alone(p) for g, (_, p) in zip(got, pages))
    assert changed == 20 and got[0] == "a rather long story 0" and got[20] == "s 0"
