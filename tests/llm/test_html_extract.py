import html
import random
import re

from tabml.llm.html_extract import blocks_of, decide, extract_pages, main_text
from tabml.llm.queries import op7_html_extract

LONG = "It was the best of times and it was the worst of times, as they say of all the ages that have been, for in that age the people were with and without it, and so they are to this day."
PAGE = f"""<!DOCTYPE html><html><head><title>Site</title><style>p{{}}</style><script>var t="</p><article>";</script></head><body>
<header class="site"><a href="/">Home</a> The name of the site</header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, as all of the others do, and you can turn them off in the settings of it.</div>
<div id="sidebar"><p>{LONG}</p></div>
<main><article><header><h1>A  title &amp; more</h1></header><p>Short.<p>{LONG}<br>After the   break&nbsp;&eacute;
<aside>{LONG}</aside><form><label>Name</label><input></form>
<ul><li>a point of the list</li></ul><ul><li><a href="/r">Read the other one</a></li></ul>
<table><tr><td>cell one</td><td>cell two</td></tr></table><!-- hidden <p>words</p> -->
<section id="comments"><p>{LONG}</p></section></article></main>
<div class="ad">{LONG}</div><footer>&copy; all of it</footer></body></html>"""


def test_article_without_boilerplate():
    assert main_text(PAGE).split("\n") == ["A title & more", "Short.", LONG, "After the break é", "a point of the list", "cell one", "cell two"]


def test_names_that_mark_boilerplate_or_content():
    for attrs in ('class="sideBar"', "id=side-bar", 'class="x user-comments"', 'class="cookieNotice"', "hidden", 'style="display: none"', 'role="navigation"', 'class="post__related"', 'aria-hidden="true"'):
        assert main_text(f"<main><p>kept</p><div {attrs}><p>{LONG}</p></div></main>") == "kept", attrs
    assert main_text("<article><header><h1>Title</h1><p>By a writer</p></header><p>Text</p></article>") == "Title\nText"
    assert main_text('<div id="content"><p>a | b</p></div><div id="footer">all rights</div>') == "a | b"


def test_names_around_the_article_do_not_lose_it():
    story = f"<h1>Title</h1><p>{LONG}</p>"
    for attrs in ('class="content-sidebar-wrap"', 'class="has-sidebar"', 'id="page" class="no-sidebar"', 'class="site-header-fixed social-on"', 'class="widget"', 'class="notice"', 'id="comments-page"', 'class="related"'):
        for part in ("main", "article"):
            assert main_text(f"<body><div {attrs}><{part}>{story}</{part}></div><footer>x</footer></body>") == f"Title\n{LONG}", (attrs, part)
    assert main_text(f"<main><div class='content-sidebar-wrap'><article>{story}</article></div></main>") == f"Title\n{LONG}"
    assert main_text(f"<div class='content-sidebar-wrap'><article>{story}</article></div><article><p>More</p></article>") == f"Title\n{LONG}\nMore"
    assert main_text(f"<div class='has-sidebar'><p>{LONG}</p></div>") == LONG
    for header in ('<header class="entry-header">', '<header class="page-header masthead" id="top-banner">', '<div class="entry-header">'):
        assert main_text(f"<article>{header}<h1>Title</h1></{header[1:].split()[0]}><p>{LONG}</p></article>") == f"Title\n{LONG}", header
    for attrs in ('data-title="The hidden cost"', 'class="x hidden md:block"', "title='is hidden ='"):
        assert main_text(f"<article {attrs}>{story}</article>") == f"Title\n{LONG}", attrs
    for attrs in ("hidden", "class=x hidden=''", 'data-a="b"hidden', "HIDDEN/"):
        assert main_text(f"<article {attrs}>{story}</article><p>{LONG}</p>") == LONG, attrs


def test_articles_of_other_texts_stay_out():
    teaser = f"<article class='post'><h3>Other</h3><p>{LONG}</p></article>"
    for attrs in ('class="sidebar"', 'id="sidebar-1"', 'class="related-posts"', 'id="comments"', 'class="recommended"', 'class="widget"'):
        assert main_text(f"<article><p>kept</p></article><div {attrs}>{teaser}</div>") == "kept", attrs
        assert main_text(f"<main><article><p>kept</p></article><div {attrs}>{teaser}</div></main>") == "kept", attrs
    assert main_text(f"<div class='content-sidebar-wrap'><main><p>kept</p></main><div class='sidebar'>{teaser}</div></div>") == "kept"
    assert main_text(f"<p>{LONG}</p><nav>{teaser}</nav><div class='related'>{teaser}</div>") == LONG


def test_pages_without_a_container_use_the_two_passes():
    page = f"<body><div><a href=x>One</a> | <a href=y>Two</a> | <a href=z>Three</a></div><h2>Heading</h2><p>{LONG}</p><p>Yes.</p><p>{LONG}</p><p>End note</p><div><a href=q>Links of the foot</a></div></body>"
    blocks = blocks_of(page)
    decide(blocks)
    assert [(b.text, b.good) for b in blocks][1:] == [("Heading", True), (LONG, True), ("Yes.", True), (LONG, True), ("End note", False), ("Links of the foot", False)]
    assert blocks[0].good is False
    assert main_text("bare text &lt;3") == "bare text <3"


def test_links_inside_the_article_are_judged():
    more = "<div><a href=a>One story of ours</a> | <a href=b>Another story of ours</a></div>"
    assert main_text(f"<article><h1><a href=t>Title</a></h1><p>{LONG}</p>{more}</article>") == f"Title\n{LONG}"
    only = "<p><a href=s>Read the source</a></p>"
    assert main_text(f"<article><p>{LONG}</p>{only}<p>Text.</p>{only}</article><footer>x</footer>") == f"{LONG}\nRead the source\nText.\nRead the source"
    assert main_text(f"<article><p>{LONG}</p>{only}{more}</article>") == LONG
    linked = f"<p>{LONG} <a href=x>here</a> and <a href=y>there</a></p>"
    assert main_text(f"<article>{linked}</article>") == f"{LONG} here and there"


def test_broken_markup_and_edges():
    assert main_text(None) == main_text("") == main_text("<p>  </p>") == main_text("<script>x") == ""
    assert main_text("<article><p>a < b and <b>c</article>") == "a < b and c"
    assert main_text("<article><p>cut <b>of") == "cut of"
    assert main_text("<article><p title='x > y'>in</p><![CDATA[raw]]></article></x></article>") == "in\nraw"
    assert main_text("<ARTICLE><P>Up</P></ARTICLE>") == "Up"
    for odd in ("<a " * 20_000, '<a "' * 20_000, "<!--" * 20_000, "<div>" * 20_000 + "</x>" * 20_000, "<svg>" * 20_000):
        main_text(odd)


def test_random_markup_never_fails():
    rng = random.Random(9)
    bits = ["<p>", "</p>", "<article>", "</article>", "<nav>", "</nav>", "text ", "&amp;", "<", ">", '"', "<a href='", "</", "<br/>", "<li>", "<script>", "</script>", "&#x0;", "&#99999999;"]
    for _ in range(500):
        main_text("".join(rng.choices(bits, k=rng.randint(1, 40))))


def test_query_matches_the_articles_of_the_pages(spark):
    rows = op7_html_extract(spark, "/root/testdata/sf0.001").collect()
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        want = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)>", inside)]
        assert r.text == "\n".join(x for x in want if x) and r.n_chars == len(r.text)


def test_null_repeated_and_clashing_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>a", "y"), (None, "u", "<p>a", "y")], "page_id bigint, url string, html string, text string").repartition(2)
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in extract_pages(df).collect()) == [("1", "", 0), ("None", "a", 1), ("None", "a", 1)]
    assert extract_pages(df.limit(0)).count() == 0


PROSE = [
    "The people of the town have been in the habit of going to the river with all of their boats, and this is what they did on the first day of the year, as it was the custom of the land and of the people who were there before them.",
    "It was not until the end of the week that the news came to the house on the hill, and by then there was no one in it who had the time to read what was in the letter or to ask from whom it had been sent to them in the first place.",
]
BODY = "".join(f"<p>{p}</p>" for p in PROSE)


def test_a_form_header_aside_or_dialog_around_the_only_article_is_no_boilerplate():
    for name in ("form", "header", "aside", "dialog"):
        page = f'<body><{name} id="aspnetForm"><nav>Menu</nav><article>{BODY}</article><button>Send now</button></{name}></body>'
        assert main_text(page) == "\n".join(PROSE), name
    assert main_text(f"<body><article>{BODY}</article><form>{BODY}</form><aside>{BODY}</aside></body>") == "\n".join(PROSE)


def test_a_boilerplate_word_within_a_longer_name_leaves_the_passes_to_decide():
    assert main_text(f'<body><div class="ad-hoc-report"><h1>Title</h1>{BODY}<p>Short end.</p></div></body>') == "\n".join(["Title", *PROSE, "Short end."])
    assert main_text(f'<body><p>{PROSE[0]}</p><div class="notice-period-guide"><p>{PROSE[1]}</p></div></body>') == "\n".join(PROSE)
    for kind in ('section id="related-work"', 'div class="share-price-history"'):
        tag = kind.split()[0]
        page = f"<article><p>{PROSE[0]}</p><{kind}><h2>More</h2><p>{PROSE[1]}</p></{tag}><p>{PROSE[0]}</p></article>"
        assert main_text(page) == "\n".join([PROSE[0], "More", PROSE[1], PROSE[0]])
    for name in ("comment-body", "reader-comments", "ad-container", "cookie-banner-2", "comments"):  # such words alone
        assert main_text(f'<body><article>{BODY}</article><div class="{name}"><p>{PROSE[1]}</p></div></body>') == "\n".join(PROSE), name
    assert main_text(f'<body><article>{BODY}</article><div class="promo-tile-x"><p>Buy now.</p></div></body>') == "\n".join(PROSE)


def test_foreign_elements_that_end_themselves_and_nested_templates():
    assert main_text('<p>A<svg class="i"/><p>B is here.</p><svg></svg><math/>') == "A\nB is here."
    assert main_text(f"<article><p>{PROSE[0]}</p><template><p>x</p><template>y</template><p>z</p></template><p>{PROSE[1]}</p></article>") == "\n".join(PROSE)
    assert main_text(f"<article><p>{PROSE[0]}<svg><g><svg/></g><svg><text>t</text></svg>u</svg></p><object><object>a</object>b</object></article>") == PROSE[0]
    assert main_text(f"<article><template><p>{PROSE[0]}</p></article>") == PROSE[0]


def test_pages_without_an_article_are_decided_by_the_passes():
    """Token precision and recall over pages whose containers say nothing (or mislead)."""
    import random

    rng = random.Random(4)
    hit = got = want = 0
    for i in range(200):
        body = [" ".join(rng.sample(PROSE[0].split() + PROSE[1].split(), 60)) for _ in range(rng.randint(2, 5))]
        menu = "".join(f'<li><a href="/{k}">Entry {k}</a></li>' for k in range(8))
        junk = [f"<ul>{menu}</ul>", '<div><a href="/x">Home</a> | <a href="/y">Contact us</a></div>', f"<p>© {1990 + i} Company</p>", '<p><a href="/z">Read the next story of the series here</a></p>']
        box = rng.choice(["div", 'div class="wrap"', 'div class="ad-hoc-report"', "td", 'div class="page-banner-history"'])
        page = f"<body>{junk[0]}{junk[1]}<{box}><h1>A title of some words</h1>{''.join(f'<p>{b}</p>' for b in body)}</{box.split()[0]}>{junk[3]}{junk[2]}</body>"
        found, truth = main_text(page).split(), ["A", "title", "of", "some", "words", *" ".join(body).split()]
        left = list(truth)
        for w in found:
            if w in left:
                left.remove(w)
                hit += 1
        got, want = got + len(found), want + len(truth)
    assert hit / got > 0.97 and hit / want > 0.97, (hit / got, hit / want)
