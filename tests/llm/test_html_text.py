from conftest import SF_SMALL
from strata.llm import html_text as H

PAGES = {
    "<p>a</p>": "a",
    "<html><body><nav><a>x</a></nav><article><h1>T &amp; U</h1><p>one <b>t</b>wo<br>three&nbsp;\n four</article><footer>f</footer>": "T & U one two three four",
    "<article><p>a<div class='side-bar ad'>no</div><p>b<section id=comments><p>c</p></section></article><p>out</p>": "a b",
    "<main><form><p>x</p></form><ul><li>1<li>2</ul><table><tr><td>3<td>4</table></main>": "1 2 3 4",
    "<article><script>if (a < b) '<p>x</p>'</script><style>p{}</style><!-- <p>c</p> -->k</article>": "k",
    "<article>5 < 6 and a<b>c</b></i>d</article>": "5 < 6 and acd",
    "<div role=navigation>n</div><div role='main'><header>h</header>text<aside>s</aside></div>": "text",
    "plain": "plain",
    "<article><p>unclosed <b>bold<p>next": "unclosed bold next",
    "<body class='header'><p>x</p></body>": "x",
    "<div><!-- open": "",
    "": "",
}


def test_main_text_of_single_pages():
    for page, text in PAGES.items():
        assert H.main_text(page) == text


def site(n):
    """Pages without an article: a line that never changes and one that does."""
    return [(i, f"http://s.net/{i}", f"<body><div><p>Always the same line.</p></div><section><p>Words of page {i}.</p></section></body>") for i in range(n)]


def test_low_importance_branches_go(spark):
    rows = site(12) + [(99, None, None), (98, None, ""), (97, "http://t.net/", "<div><p>Always the same line.</p></div>"), (0, *site(1)[0][1:])]
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, host string")
    want = sorted((i, f"Words of page {i}." if i < 90 else "Always the same line." if i == 97 else "") for i, _, _ in rows)
    for limit in (H.MOST_NODES, 0):  # broadcast and joined
        assert sorted((r["page_id"], r["text"]) for r in H.extract(pages, most_nodes=limit).collect()) == want
    assert H.extract(pages.limit(0)).count() == 0


def test_articles_of_the_test_pages(spark):
    import html
    import re
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    got = {r["page_id"]: r for r in H.op5_main_text(spark, SF_SMALL).collect()}
    for r in rows:
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", r["html"], re.S)[1]
        body = re.sub(r"</?(?:p|br|h1)>", "\n", re.sub(r"</?b>", "", body))
        assert got[r["page_id"]]["text"] == " ".join(html.unescape(body).split())
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def texts(spark, rows, **options):
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    return [r["text"] for r in sorted(H.extract(pages, **options).collect(), key=lambda r: r["page_id"])]


def test_hosts_of_copies_keep_their_text(spark):
    page = lambda words: f"<body><div><p>Always the same line.</p></div><section><p>{words}</p></section></body>"
    rows = [("http://copies.net/", page("One text."))] * 20  # a host of copies only
    rows += [("http://half.net/", page("One text."))] * 20 + [("http://half.net/", page(f"Words of page {i}.")) for i in range(20)]
    # contents of one path, of which some repeat and some are unique
    rows += [("http://mixed.net/", page("Closed today." if i % 10 else f"Words of page {i}.") + f"<h2>{i}</h2>") for i in range(60)]
    want = ["Always the same line. One text."] * 20 + ["One text."] * 20 + [f"Words of page {i}." for i in range(20)]
    want += [f"{i}" if i % 10 else f"Words of page {i}. {i}" for i in range(60)]
    for limit in (H.MOST_NODES, 0):
        assert texts(spark, rows, most_nodes=limit) == want


def test_cells_of_a_single_page_stay(spark):
    cells = ["a"] * 50 + ["b"] * 30 + ["c"] * 20
    page = "<table><tr>" + "".join(f"<td>{c}" for c in cells) + "</table>"
    assert texts(spark, [("http://s.net/", page)]) == [" ".join(cells)]


def test_names_that_only_hint_at_noise():
    article = "<article><p>text</p></article>"
    for wrapper in ("div class='page has-sidebar'", "div class='layout nav-open'", "div id='search-results'", "div id=search", "div class='site-header'",
                    "div data-id=share", "a href='/x?id=share'", "div title='class=ad'", "div data-class='ad'"):
        assert H.main_text(f"<body><{wrapper}>{article}</body>") == "text", wrapper
        assert H.main_text(f"<article><div><{wrapper}>in</article>") == ("" if "search" in wrapper.split("=") or "site" in wrapper else "in"), wrapper
    for inside in ("div class='share-price'", "section id='related-work'", "div class=unrelated", "p class='x' data-id='ad'"):
        assert H.main_text(f"<article><{inside}>in</article>") == "in", inside
    for noise in ("div class='site-header'", "div id=cookie-banner", "ul class='x social_share'", "section CLASS = 'Comments'", "div class='ad1'"):
        assert H.main_text(f"<article>k<{noise}>n") == "k", noise
    # an article inside named noise of an article is part of it, as is one whose own name says so
    assert H.main_text("<main><p>k</p><div id=comments><article>c</article></div></main>") == "k"
    assert H.main_text("<article>k</article><article class=comment>c</article><aside><article>n</article></aside>") == "k"


def test_the_tree_is_applied_inside_articles(spark):
    page = lambda words, more="": f"<article><p>{words}</p><div class=x><b>Always</b> here.</div>{more}</article>"
    rows = [("http://a.net/", page(f"Words of page {i}.")) for i in range(20)]
    rows += [("http://copies.net/", page("One text."))] * 20  # one distinct page
    # near copies on half of the pages keep what they share, hinted names go sooner
    hint = "<div class='share-row'>Tell a friend.</div>"
    rows += [("http://near.net/", page("One text." if i % 2 else f"Words of page {i}.", f"<h2>{i}</h2>" + hint * (i % 3 > 0))) for i in range(20)]
    rows += [("http://same.net/", f"<main>Same.</main><p>{i}</p>") for i in range(20)]  # nothing else in main
    want = [f"Words of page {i}." for i in range(20)] + ["One text. Always here."] * 20
    want += [f"{'One text.' if i % 2 else f'Words of page {i}.'} {i}" for i in range(20)] + ["Same."] * 20
    assert texts(spark, rows) == want
