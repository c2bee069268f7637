import html
import re

import duckdb
from pyspark.sql import functions as F

from wicklake.llm import html as pages_of
from wicklake.llm.queries import LLM_QUERIES


def plain_article(page):
    """The article of the test tables' pages, whose only elements are headings and paragraphs."""
    body = re.search("<article>(.*?)(</article>|$)", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:h1|p)>", body))
    return "\n\n".join(b for b in blocks if b)


def test_whole_table_equals_plain_reading(spark, small):
    rows = duckdb.sql(f"SELECT page_id, url, html FROM read_parquet('{small}/pages.parquet')").fetchall()
    got = {r.page_id: r for r in LLM_QUERIES["op7_html"](spark, small).collect()}
    assert len(got) == len(rows)
    for page_id, url, page in rows:
        assert (got[page_id].url, got[page_id].text) == (url, plain_article(page))
        assert got[page_id].n_chars == len(got[page_id].text)


def soup(i):
    """A page without any telling element or name."""
    return (f"<html><body><div><div>Daily Paper</div><div><a href=/>Home</a> <a href=/n>News</a></div><div><h2>Story {i}</h2>"
            f"<p>First part of story {i}, with &lt;{i}&gt; &amp; more.<p>Second {'word ' * (i + 3)}</div>"
            f"<div>Subscribe today and save</div><div>All rights reserved</div></div></body></html>")


def test_wrapper_of_pages_without_names():
    template, content = pages_of.induce([soup(i) for i in range(6)])
    assert content == "/#root/html/body/div/div"
    text = pages_of.extract(soup(77), set(template), content)
    assert text == f"Story 77\n\nFirst part of story 77, with <77> & more.\n\nSecond {'word ' * 80}".rstrip()


def test_copies_make_no_template():
    copies = [soup(3).replace("</html>", " " * k + "</html>") for k in range(5)]
    template, _ = pages_of.induce(copies)
    assert template == []


def test_matching_aligns_in_order():
    a, b = (pages_of._items(pages_of.parse(f"<div><p>1</p>{extra}<p>2</p></div><ul><li>x</ul>")) for extra in ("<h2>t</h2>", ""))
    size, pairs = pages_of.match(a, b)
    assert size == 1 + 1 + 2 + 2
    assert [(x.text, y.text) for x, y in pairs if x.node.tag == "p"] in ([("2", "2"), ("1", "1")], [("1", "1"), ("2", "2")])
    assert pages_of.match(a.kids[0], b.kids[1])[0] == 0


def test_what_is_left_out():
    page = """<!doctype html><title>T</title><header><h1>Site</h1></header><nav>menu</nav><div class="cookie-notice">ok?</div>
    <aside>aside</aside><div id=sideBar>side</div><main><div role="search">find</div><article class="post"><header><h1>Head &amp; line</h1></header>
    <p hidden>secret</p><p style="display: none">none</p><p>One<br>two <b>three</b>&nbsp;four<script>var a = "<p>";</script></p>
    <style>p{}</style><!-- note --><div class="ad-slot">buy</div><form><p>Your mail</p><input value=x></form>
    <ul><li>a<li>b <i>c</i></ul><table><tr><td>1<td>2<tr><td>3</table><blockquote>quoted</blockquote><svg><text>s</text></svg>
    <section class="comments"><article><p>first!</p></article></section></article></main><div class=comment>no</div><footer>foot</footer>"""
    assert pages_of.extract(page) == "Head & line\n\nOne two three four\n\na\n\nb c\n\n1 2\n\n3\n\nquoted"


def test_names_give_way_to_the_content():
    story = "<h1>Head</h1><p>A long story about many things.</p>"
    rest = "<div class=comments><article>me too</article></div><div id=related>more</div>"
    want = "Head\n\nA long story about many things."
    for name in ("class=has-sidebar", 'class="layout with-banner"', "id=search-results", "class=page-header"):
        for holder in ("article", "main"):
            assert pages_of.extract(f"<body><div {name}><{holder}>{story}</{holder}></div>{rest}") == want
        assert pages_of.extract(f"<body><main><div {name}>{story}</div></main>{rest}") == want
        assert pages_of.extract(f"<body><div {name}>{story}</div><div class=menu>{'<a href=/>A link</a> ' * 90}</div><div id=related>more</div>") == want
    # A short article of a page that has more text in a named element.
    assert pages_of.extract(f"<body><div class=with-sidebar><article>short</article></div><div class=x>{story}</div>") == "short"
    # The wrapper finds the content in a named element.
    pages = [soup(i).replace("<body><div>", "<body><div class=has-sidebar>") for i in range(6)]
    template, content = pages_of.induce(pages)
    assert content == "/#root/html/body/div.has.sidebar/div"
    assert pages_of.extract(pages[4], set(template), content).startswith("Story 4\n\nFirst part") and "Subscribe" not in pages_of.extract(pages[4], set(template), content)


def test_odd_markup():
    assert pages_of.extract(None) == pages_of.extract("") == pages_of.extract("<p></p> \n") == ""
    assert pages_of.extract("no markup &am &eacute; &#128512; x &lt b") == "no markup &am é 😀 x < b"
    assert pages_of.extract("<article><p>open <b>bold<p>next</i> end") == "open bold\n\nnext end"
    assert pages_of.extract("<p>a</div>b</p>c") == "a b\n\nc" or pages_of.extract("<p>a</div>b</p>c") == "ab\n\nc"
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert pages_of.extract(deep) == "deep"
    pages_of.induce([deep.replace("deep", f"deep {i}") for i in range(3)])


def test_odd_rows(spark):
    long = "<article>" + "".join(f"<p>Paragraph {i} of many.</p>" for i in range(20000)) + "</article>"
    rows = [(1, "http://a.example/1", "<article><p>x</article>"), (2, None, "<p>y"), (3, "not a url", None), (4, "http://a.example/2", ""), (5, "https://A.example", long),
            (5, "https://A.example", long), (None, "http://a.example/3?q", "<article>z</article>"), (6, "http://a.example/4", "<article><p>x</article>")]
    frame = spark.createDataFrame([(*r, "h", "t", "c", 1) for r in rows],
                                  "page_id long, url string, html string, host string, template string, content string, nth int")
    got = pages_of.main_text(frame).collect()
    assert sorted((r.page_id or 0, r.text[:11]) for r in got) == [(0, "z"), (1, "x"), (2, "y"), (3, ""), (4, ""), (5, "Paragraph 0"), (5, "Paragraph 0"), (6, "x")]
    assert {len(r.text.split("\n\n")) for r in got if r.page_id == 5} == {20000}
    assert {r.page_id: r.url for r in got}[2] is None
    assert pages_of.main_text(frame.limit(0)).collect() == []


def test_hosts_use_their_own_wrapper(spark):
    rows = [(i, f"http://soup.example/{i}", soup(i)) for i in range(30)] + [(100 + i, f"http://other.example/{i}", f"<p>Daily Paper</p><p>{i}</p>") for i in range(2)]
    got = {r.page_id: r.text for r in pages_of.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].startswith(f"Story {i}\n\n") and "Subscribe" not in got[i] and "Home" not in got[i] for i in range(30))
    assert got[101] == "Daily Paper\n\n1"


def test_exact_copies_take_no_place_of_the_sample(spark):
    pages = [soup(i) for i in range(10)]
    # Many copies of every page: whichever hash is the smallest, its copies would fill the sample.
    rows = [(100 * k + i, f"http://soup.example/{i}/{k}", page) for i, page in enumerate(pages) for k in range(8)]
    got = {r.page_id: r.text for r in pages_of.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == 80
    assert all(got[100 * k + i].startswith(f"Story {i}\n\n") and "Subscribe" not in got[100 * k + i] for i in range(10) for k in range(8))


def by_hash(spark, pages):
    signs = spark.createDataFrame([(p,) for p in pages], "html string").select("html", F.xxhash64("html").alias("sign")).collect()
    return [(r.sign, r.html) for r in sorted(signs, key=lambda r: r.sign)]


def test_wrapper_counts_all_pages_of_a_host(spark):
    # Eight pages that share nothing with others come first by hash; the template is on all of the rest.
    odd = by_hash(spark, [f"<html><body><p>Odd one {i}</p><p>{'thing ' * i} alone</p></body></html>" for i in range(300)])[:8]
    usual = [p for sign, p in by_hash(spark, [soup(i) for i in range(60)]) if sign > odd[-1][0]]
    assert len(usual) > 40
    pages = [p for _, p in odd] + usual
    rows = [(i, f"http://soup.example/{i}", p) for i, p in enumerate(pages)]
    got = {r.page_id: r.text for r in pages_of.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].startswith("Odd one") for i in range(8))
    assert all(got[i].startswith("Story") and "Subscribe" not in got[i] and "Home" not in got[i] and "reserved" not in got[i] for i in range(8, len(pages)))


def test_a_text_on_few_pages_is_no_template(spark):
    # Of the pages, the eight first by hash have a paragraph in common that the others do not have.
    note = by_hash(spark, [soup(i).replace("<div>Subscribe", "<div>Told by our own reporter</div><div>Subscribe") for i in range(300)])[:8]
    pages = [p for _, p in note] + [p for sign, p in by_hash(spark, [soup(300 + i) for i in range(60)]) if sign > note[-1][0]]
    rows = [(i, f"http://soup.example/{i}", p.replace("<body>", "<body><article>")) for i, p in enumerate(pages)]
    rows += [(1000 + i, url.replace("soup", "bare"), p) for (i, url, _), p in zip(rows, pages)]
    got = {r.page_id: r.text for r in pages_of.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    template, content = pages_of.induce(pages)
    for i, page in enumerate(pages):
        assert got[1000 + i] == pages_of.extract(page, set(template), content)
        assert "Subscribe" not in got[i] and ("Told by our own reporter" in got[i]) == (i < 8)


def test_wrapper_equals_alignment_of_every_two_pages(spark):
    menu, legal = "<div><a href=/>Home</a> <a href=/n>News</a></div>", "<div>All rights reserved by us</div>"
    pages = [f"<html><body>{menu}<div><h2>Title {i}</h2><p>{f'word{i} ' * (10 + i)}</p>{'<p>Read more</p>' * (i % 3)}</div>"
             f"{'<div>Sign up here</div>' if i % 5 else ''}{'<ul><li>One<li>Two</ul>' if i % 2 else ''}{legal}</body></html>" for i in range(20)]
    # Pages that are template alone, and near copies.
    pages += [f"<html><body>{menu}{'<br>' * i}{legal}</body></html>" for i in range(3)]
    pages += [pages[7].replace("</h2>", f", copy {i}</h2>") for i in range(8)]
    rows = [(k, f"http://{k % 2}.example/{k}", p) for k, p in enumerate([p for p in pages for _ in range(4)])]
    template, content = pages_of.induce(pages)
    assert len(template) >= 3 and content
    got = {r.page_id: r.text for r in pages_of.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == pages_of.extract(p, set(template), content) for k, _, p in rows)
