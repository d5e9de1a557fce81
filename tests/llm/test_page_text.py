import os
import random
import time

import pytest

from brindle.llm import page_text as op

PAGES = "page_id long, url string, html string"


def extract(spark, rows):
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS host", "2 AS path", "3 AS lines", "4 AS text")
    return sorted(map(tuple, op.extract(df).collect()), key=str)


@pytest.mark.parametrize("html,want", [
    ("", ""), ("plain  text", "plain text"), ("<p>a<p>b</p>c", "a\nb\nc"), ("<p>x<br>y</p>", "x\ny"),
    ("<article><h1>T &amp; t</h1><p>a\n b<b>c</b>&nbsp;d</article><footer>f</footer>", "T & t\na bc d"),
    ("<nav>n</nav><header>h</header><p>x</p><aside>s</aside><form>q<input></form>", "x"),
    ("<body class='menu x'><p>x</p><div class=ad>ad</div><div id='cookie-notice'><p>c</p></div></body>", "x"),
    ("<article><header><h1>T</h1></header><p>x</p><section class=comments><p>c</p></section></article><p>outside</p>", "T\nx"),
    ("<p>a<script>if (a<b) '</p>'</script>b<style>p{}</style></p><!-- <p>no</p> -->", "ab"),
    ("<p>1 < 2 &lt;b&gt; &copy; &#233;&#x41;</p>", "1 < 2 <b> © éA"), ("<main><p>a</p></main><div>b", "a"),
    ("<div hidden>h</div><p style='display: none'>n</p><p aria-hidden=true>t</p><p>v", "v"),
    ("<p>cut off <b", "cut off"), ("<ARTICLE><P>Up</P></ARTICLE><NAV>n", "Up"), ("<p title='a > b'>x</p>", "x"),
    ("<article>one</article><div>ad</div><article>two</article>", "one\ntwo"), ("<textarea><p>x</textarea><p>y", "y"),
    ("<div id=top>t</div><div class='main-content'><p>a</p><div class=share-bar>s</div></div><div>b</div>", "t\na\nb"),
    ("<p>one</p><a title=it's>two</a><p>three's</p>", "one\ntwo\nthree's"), ("<article>Real text<noscript><p>x</p></noscript></article>", "Real text"),
    ('<article>Body text <span class="ad">Buy<br>more</article>', "Body text"), ("<p>Body <button>Share</button></p>", "Body"),
    ('<p>a <span class="advert">b</span> c</p>', "a c"), ("<p>t<svg><text>x</text></svg></p>", "t"),
    ('<div class="post"><p>hi there</p></div><p>out</p>', "hi there\nout"), ('<article><p class="lead-menu">body</p><p class=menu>x</article>', "body"),
    ('<div class="has-sidebar"><p>k</p></div><div class="sidebar">s</div>', "k"), ("<p>a<p class=ad>b<p>c", "a\nc"), ('<a x="b>c</a><p>d', "c\nd"),
    ("<article><div>x</article><p>y", "x"), ("<table><tr><td>a<td class=ad>b<td>c</table>", "a\nc"), ("<ul><li class=ad>a<li>b</ul>", "b"),
    ("<form><p>menu</p><main><p>x</p><form>q</form></main></form><form>z</form>", "x"), ("<article><form><main>q</main></form>x</article>", "x"),
    ("<form class=search><article>q</article></form><p>x</p>", "q"), ("<p>a</i>b</span>c</p>", "abc"), ("a<!-->b<!--->c<!-- > --!>d", "abcd"), ("<div>" * 600 + "x" + "</div>" * 600 + "<p class=ad>y</p>z", "x\nz"),
    ("<div class=main-nav>n</div><p>x</p>", "x"),
])
def test_markup(html, want):
    assert "\n".join(op.page_lines(html)[0]) == want


@pytest.mark.parametrize("open_tag", [
    '<article class="post type-post category-social hentry">', '<article class="post tag-advertising">', '<article class="post comments-open">',
    '<main class="search-results">', '<main class="layout-sidebar-left">', '<div id="content" class="related-content">', '<main role="alert" id="menu">',
    '<div class="has-menu"><article>', '<div class="nav-layout"><main>', '<section class="comments"><article>', '<article id="comment-1" class="comment">',
    '<form class="search"><main>', '<article class="ad">', '<div class="post-social">', '<div class="sidebar-right"><section>',
])
def test_names_never_empty_an_article(open_tag):
    html = f"<nav>n</nav><div class='ad'>buy</div>{open_tag}<h1>Title</h1><p>All of the text.</p></article></main></div></form></section><footer>f</footer>"
    assert "\n".join(op.page_lines(html)[0]).endswith("Title\nAll of the text.")


@pytest.mark.parametrize("block", [
    '<div class="search-engine-history">{}</div>', '<p class="notice">{}</p>', '<p id="social">{}</p>', '<h2 id="comment">{}</h2>', '<section class="share-of-market">{}</section>',
    '<h2 class="alert">{}</h2>', '<blockquote class="promo">{}</blockquote>',
])
def test_blocks_of_doubtful_names_are_text_unless_they_recur(spark, block):
    page = "<article><p>{}</p>" + block + "<p>last words</p></article>"
    rows = [(1, "http://h/a", page.format("one", "the same")), (2, "http://h/b", page.format("two", "the same"))]
    rows += [(3, "http://i/a", page.format("one", "this")), (4, "http://i/b", page.format("two", "that")), (5, "http://j/", page.format("one", "lone"))]
    named = "id=" not in block  # ids of paragraphs and headings are anchors
    got = {r[0]: (r[2], r[3]) for r in extract(spark, rows)}
    same = {i: (f"{x}\nlast words", 1) if named else (f"{x}\nthe same\nlast words", 0) for i, x in ((1, "one"), (2, "two"))}
    assert got == same | {3: ("one\nthis\nlast words", 0), 4: ("two\nthat\nlast words", 0), 5: ("one\nlone\nlast words", 0)}


@pytest.mark.parametrize("inside", [
    "<div class='ad'>Buy now</div>", "<section class='comments'><article class='comment'><p>Nice post, says Ann</p></article></section>", "<div class='comment-list'><p>c</p></div>",
    "<div id='cookie-notice'>c</div>", "<ul class='share-buttons'><li>s</ul>", "<div class='post-comments'>c</div>", "<aside>a</aside>", "<div class='newsletter'>n</div>",
    "<div role='navigation'>n</div>", "<form>f</form>", "<div class='sidebar widget'>s</div>", "<div class='related-posts'>r</div>", "<p class='copyright'>c</p>",
])
def test_parts_of_plain_names_go_also_where_they_are_unique(inside):
    assert op.page_lines(f"<article><h1>T</h1><p>x</p>{inside}</article><div>d</div>")[0] == ["T", "x"]
    assert op.page_lines(f"<article><h1>T</h1><p>x</p></article>{inside}<div>d</div>")[0] == ["T", "x"]


def test_a_small_article_is_not_the_text_alone(spark):
    page = "<div>Site name</div><p>{}</p><article>teaser {}</article>"
    rows = [(1, "http://h/1", page.format("long text " * 20, "a")), (2, "http://h/2", page.format("other words " * 20, "b"))]
    assert [r[2] for r in extract(spark, rows)] == [("long text " * 20).strip() + "\nteaser a", ("other words " * 20).strip() + "\nteaser b"]


def test_pages_among_many_copies_have_a_neighbour(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_PAGES", 5)
    page, long = "<div>Site name</div><p>{}</p><div>Imprint</div>", [f"line {k} of a long text" for k in range(40)]
    copy = lambda k: page.format("</p><p>".join([*long, str(k)]))
    rows = [(k, f"http://h/m?copy={k}", copy(k)) for k in range(40)] + [(100, "http://h/a", page.format("a")), (101, "http://h/z", page.format("z"))]
    rows += [(200 + k, f"http://one/?copy={k}", copy(k)) for k in range(12)]  # no other path
    got = {r[0]: r[2] for r in extract(spark, rows)}
    want = {k: "\n".join([*long, str(k)]) for k in range(40)} | {100: "a", 101: "z"}
    want |= {200 + k: "\n".join(["Site name", *long, str(k), "Imprint"]) for k in range(12)}
    assert got == want


def test_shared_undecided_lines_go_and_decided_ones_stay(spark):
    page = "<div>Site name</div><div>{}</div><div>Imprint</div>"
    rows = [
        (1, "http://h/a/1", page.format("first")), (2, "http://h/a/2?x=1", page.format("second")),
        (3, "http://other/a/1", page.format("alone")),
        (4, "http://h/b", "<article><p>same</p></article>"), (5, "http://h/b#top", "<article><p>same</p></article>"),
        (6, None, None), (6, None, None), (7, "odd", "<p>x</p>"), (None, "http://z/", "<p>y"),
    ]
    got = {(r[0], r[2]) for r in extract(spark, rows)}
    assert got == {
        (1, "first"), (2, "second"), (3, "Site name\nalone\nImprint"), (4, "same"), (5, "same"), (6, ""), (7, "x"), (None, "y"),
    }
    assert len(extract(spark, rows)) == len(rows)


def test_pages_with_containers_are_differenced_too(spark):
    site = "<div>Site name</div>{}<div>Imprint</div>"
    rows = [
        (1, "http://h/a/1", site.format("<p>long text</p><div class=story>teaser one</div>")),
        (2, "http://h/a/2", site.format("<p>other text</p><div class=story>teaser two</div>")),
        (3, "http://w/1", "<div id=main><p>Site name</p><p>first</p></div>"), (4, "http://w/2", "<div id=main><p>Site name</p><p>second</p></div>"),
        (5, "http://c/1", site.format("<div class=post>same</div><p>x</p>")), (6, "http://c/2", site.format("<div class=post>same</div><p>y</p>")),
        (7, "http://p/1", "<article><p>same</p><p>u</p></article><p>by A</p>"), (8, "http://p/2", "<article><p>same</p><p>v</p></article><p>by A</p>"),
        (9, "http://alone/", site.format("<div class=post>post</div>")),
    ]
    assert {r[0]: r[2] for r in extract(spark, rows)} == {
        1: "long text\nteaser one", 2: "other text\nteaser two", 3: "first", 4: "second", 5: "same\nx", 6: "same\ny",
        7: "same\nu", 8: "same\nv", 9: "Site name\npost\nImprint",
    }


def test_copies_keep_their_text(spark):
    page = "<div>Site name</div><p>{}</p><div>Imprint</div>"
    long = "a text of many words " * 20
    rows = [
        (1, "http://h/a?id=1", page.format("one")), (2, "http://h/a?id=1&print=1", page.format("one")), (2, "http://h/a?id=1&print=1", page.format("one")),
        (3, "http://h/b", page.format("two")), (4, "http://h/b2", page.format("two")),
        (5, "http://p/a", page.format(long)), (6, "http://p/a?print=1", page.format(long) + "<p>Print"), (7, "http://p/z", page.format("z")),
        (8, "http://only/", "<p>x</p>"), (9, "http://only/?2", "<p>x</p>"),
    ]
    got = extract(spark, rows)
    assert len(got) == len(rows)
    assert {r[0]: r[2] for r in got} == {
        1: "one", 2: "one", 3: "two", 4: "two", 5: long.strip(), 6: long.strip() + "\nPrint", 7: "z", 8: "x", 9: "x",
    }


def test_nearest_url_is_the_one_that_shares_more_of_the_path(spark):
    rows = [(1, "http://h/a/x", "<p>A</p><p>t</p>"), (2, "http://h/a/y", "<p>A</p><p>B</p><p>u</p>"), (3, "http://h/b", "<p>B</p><p>v</p>")]
    assert [(r[0], r[2]) for r in extract(spark, rows)][1] == (2, "B\nu")


def test_long_page(spark):
    html = "<article>" + "".join(f"<p>line {i}</p>" for i in range(30000)) + "</article>"
    (row,) = extract(spark, [(1, "http://h/", html)])
    assert row[2].count("\n") == 29999


@pytest.mark.parametrize("html", [
    "<p>a</p><a " + '"x" ' * 20000, "<p>a</p><a " + 'x="y" ' * 100000, "<a x='>" * 40000, '<a x=">' * 40001, "</script " * 40000, "<title></title " * 40000,
    "<!--" * 40000, "<![CDATA[" * 40000, "<b>" * 40000 + "</i>" * 40000, "<p>" * 40000, "<a x" + "=" * 40000, "<a " + "/" * 40000, "<" * 40000, "&#" * 40000,
])
def test_odd_pages_are_read_in_linear_time(html):
    began = time.process_time()
    op.page_lines(html)
    assert time.process_time() - began < 2


def test_lines_that_repeat_very_often(spark):
    same = "<p>same</p>" * 20000
    rows = [(1, "http://h/1", same + "<p>one</p>"), (2, "http://h/2", "<p>two</p>" + same)]
    assert [(r[0], r[2]) for r in extract(spark, rows)] == [(1, "one"), (2, "two")]


def site(seed, n, lines=6):
    """Pages without article tags: (page, its own lines), each host's own template around them."""
    r, out = random.Random(seed), []
    for i in range(n):
        host = r.choice("aaab")
        own = [f"line {k} of page {i}" for k in range(r.randrange(1, lines))]
        wrap = [f"{host} head", *(f"{host} link {k}" for k in range(3))], [f"{host} imprint"]
        html = "".join(f"<div class={r.choice('xyz')}>{x}</div>" for x in (*wrap[0], *own, *wrap[1]))
        out.append(((i, f"http://{host}/{r.randrange(20)}/{i}", html), own))
    return out


@pytest.mark.parametrize("partitions", ["1", "3", "50"])
def test_pages_without_markup_for_any_partitioning(spark, partitions, monkeypatch):
    """All lines of templates go, and all others stay: what a plain comparison with any other page of the host says."""
    monkeypatch.setattr(op, "BLOCK_PAGES", 5)
    pages = site(3, 120)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r[0]: r[2] for r in extract(spark, [p for p, _ in pages])}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {p[0]: "\n".join(own) for p, own in pages}
    removed = sum(len(op.page_lines(p[2])[0]) for p, _ in pages) - sum(x.count("\n") + 1 for x in got.values())
    assert removed == 5 * len(pages)


def test_neighbours_against_brute_force(spark, monkeypatch):
    """Random pages of few kinds of lines: what goes is as long as the longest common subsequence with the neighbour that the definition names."""
    monkeypatch.setattr(op, "BLOCK_PAGES", 5)
    r = random.Random(5)
    pages = [(i, f"http://h/{r.choice('ab')}/{r.choice('abcd')}/{i}", "".join(f"<p>{r.choice('stuvw')}</p>" for _ in range(r.randrange(1, 9)))) for i in range(60)]
    first = {}
    for i, url, html in sorted(pages, key=lambda p: p[1]):
        first.setdefault(html, url)
    order = sorted(first.items(), key=lambda x: x[1])
    got = {x[0]: x[2] for x in extract(spark, pages)}
    for i, _, html in pages:
        at = next(k for k, x in enumerate(order) if x[0] == html)
        sides = [order[at - 1]] * (at > 0) + order[at + 1 : at + 2]
        other = max(sides, key=lambda x: len(os.path.commonprefix([x[1], order[at][1]])))
        own, lines = op.page_lines(html)[0], op.page_lines(other[0])[0]
        best = [[0] * (len(lines) + 1) for _ in range(len(own) + 1)]
        for a, x in enumerate(own):
            for b, y in enumerate(lines):
                best[a + 1][b + 1] = best[a][b] + 1 if x == y else max(best[a][b + 1], best[a + 1][b])
        assert len(got[i].split()) == len(own) - best[-1][-1]


def test_many_verdicts_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_LINES", 0)
    pages = site(4, 40)
    assert {r[0]: r[2] for r in extract(spark, [p for p, _ in pages])} == {p[0]: "\n".join(own) for p, own in pages}


def test_empty(spark):
    assert op.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_whole_table_against_a_plain_parser(spark):
    import html
    import re

    from brindle.llm import queries

    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op7_page_differencing(spark, sf).collect():
        body = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", body))
        text = "\n".join(filter(None, blocks))
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, text, len(text))
