from plazaflow.llm.html_text import extract, main_text

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>x</p>";</script></head>
<body class="no-sidebar"><header><h1>Site</h1><nav><a href=/>home</a></nav></header><div id="wrap"><aside>side</aside>
<div class="post-content"><h2>Title &eacute; &amp; more</h2><p>One
 two<p>Three<div class="advert">Buy now, a long text that is not content at all, but longer than all else</div><p>four</p>
<ul><li>x<li>y</ul></div><div id="comments"><p>first!</p></div><form><p>in</p></form></div><footer>f</footer></body>"""


def test_whole_page():
    assert main_text(FULL) == "Title é & more\nOne two\nThree\nfour\nx\ny"


def test_cases():
    cases = {
        None: "", "": "", "   ": "", "<": "<", "<div": "", "a < b": "a < b", "plain text": "plain text", "<p>&lt;p&gt;</p>": "<p>",
        "<article><p>a<br>b</p><!-- c --><p>d</article><p>not": "a\nb\nd", "<article><p>cut &am": "cut &am",
        "<article><p>cut <b": "cut", "<p>short</p><div class=menu><p>a much longer text that is a menu</p></div><p>tail": "short\ntail",
        "<main><h1>h</h1><article>x<aside>y</aside>z</article></main>": "x\nz", "<article>a <span class='ad'>buy</span>b</article>": "a b",
        "<article><header><h1>t</h1></header><p>b</article>": "t\nb", "<nav>a<article>b</article></nav>": "",
        "<article>b<article class='comment'>c</article></article>": "b", "<ARTICLE><P>Up</ARTICLE>": "Up", "\x00<p>\x01</p>": "\x00\n\x01",
        "<article><p>a  \n\t b</p></article>": "a b",
    }
    for html, want in cases.items():
        assert main_text(html) == want, html


def test_very_long_page():
    html = "<article>" + "<p>word</p>" * 100_000 + "<div>" * 5000
    assert main_text(html) == "\n".join(["word"] * 100_000)


def test_table(spark):
    pages = spark.createDataFrame([(1, "u", "<p>é</p>", "x"), (1, "u", "<p>é</p>", "x"), (None, None, None, None)],
                                  "page_id long, url string, html string, text string")
    got = sorted(tuple(r) for r in extract(pages).collect() if r.page_id)
    assert got == [(1, "u", "é", 1)] * 2
    assert [tuple(r) for r in extract(pages.where("page_id is null")).collect()] == [(None, None, "", 0)]
    assert extract(pages.where("false")).collect() == []


def test_supplied_pages_give_their_articles(spark):
    import re
    from html import unescape

    for r in extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).join(
            spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(unescape(re.sub("</?b>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", article)]
        assert r.text == "\n".join(b for b in blocks if b)


def test_container_bounds_only_when_it_holds_most():
    long = "whole article " * 20
    cases = {
        f'<body><div class="entry-title"><h1>T</h1></div><p>{long}</p></body>': f"T\n{long.strip()}",
        f'<div class="post-meta">by me</div><div class="main-image">a view</div><div class="story-lead">{long}</div><p>end</p>':
            f"by me\na view\n{long.strip()}\nend",
        f"<article>teaser</article><main><p>{long}</p></main>": long.strip(),
        f"<article>teaser</article><div class='content'><p>{long}</p></div>": long.strip(),
        f"<div class='title'><h1>T</h1></div><div class='entry-content'><p>{long}</p></div><p>out": f"T\n{long.strip()}",
        f"<article>teaser</article><div><p>{long}</p><p>{long}</p></div>": f"teaser\n{long.strip()}\n{long.strip()}",
    }
    for html, want in cases.items():
        assert main_text(html) == want, html


def test_names_count_as_whole_and_never_take_the_article():
    long = "whole article " * 20
    kept = ["<article class='post has-comments'>", "<article class='post comments-open'>", "<div class='content with-comments'>",
            "<div id='search-results-page'>", "<article class='share'>", "<main class='widget'>", "<div class='widget'>", "<section class='comments'><h1>"]
    for tag in kept:
        assert main_text(f"<body>{tag}<p>{long}</p></body>") == long.strip(), tag
    for tag in ("section id='related-work'", "p class='legal'", "p class='navy'", "figcaption", "dialog", "button"):
        assert main_text(f"<article><p>{long}</p><{tag}>more</{tag.split()[0]}></article>") == f"{long.strip()}\nmore", tag
    for tag in ("div class='comments-area'", "div id='site-footer'", "div class='x cookie_notice'", "p class=ad", "section class='main-menu'",
                "div class=related-posts", "div role=navigation"):
        assert main_text(f"<p>{long}</p><{tag}>gone</{tag.split()[0]}><p>end") == f"{long.strip()}\nend", tag
    assert main_text(f"<article>short</article><div id=comments><article class=comment>{long}</article></div>") == "short"
    assert main_text("<article><div class='entry-header'><h2>t</h2></div><p>b</article>") == "t\nb"
    assert main_text(f"<div class='widget'><h1>T</h1><p>{long}</p><div class=ad>{long}</div></div><p>end") == f"T\n{long.strip()}\nend"


def test_text_around_a_removed_element_stays():
    long, short = "x" * 1000, "y" * 100
    for gone in ("<div class=ad>a</div>", "<div class='notice'>a<p>b<p>c<p>d</div>", "<form><p>a</form>", "<div hidden>a</div>", "<aside>a</aside>"):
        assert main_text(f"<p>{long}</p>{gone}<p>{short}</p>") == f"{long}\n{short}", gone
        assert main_text(f"<p>t</p>{gone}<p>{long}</p>{gone}<p>.</p>") == f"t\n{long}\n.", gone


def test_window_sums_tell_link_lists_from_text():
    a = "<a href='/x'>a link of a menu</a>"
    text, links = "<p>a paragraph of some words, and more words</p>", f"<div><ul>{f'<li>{a}' * 6}</ul></div>"
    p, at = "a paragraph of some words, and more words", "a link of a menu"
    cases = {
        links + text * 2 + links: [p, p], f"{text}{links}<p>end": [p, "end"], f"{links}<p>x</p>{links}": ["x"], f"{text}<p>{a}</p>{text}": [p, at, p],
        f"<h1>{a}</h1>{text}<p>see {a} and {a} for more of this and that": [at, p, f"see {at} and {at} for more of this and that"],
        f"{text}<p>{a}": [p, at], f"{links}": [at] * 6, f"<article>{text}{links}{text}</article>": [p, p],
        f"<div><a name=x>{text}<p>b<p>c<p>d</div>": [p, "b", "c", "d"], f"{text}<a href=x><p>b<p>c<p>d<p>e": [p, "b", "c", "d", "e"],
        f"<div><a href=x>{'<div>card</div>' * 4}</a></div>{text}": [p], f"<nav>{links}</nav>{text}<footer>{a}</footer>": [p],
    }
    for html, want in cases.items():
        assert main_text(html) == "\n".join(want), html
    assert main_text(f"{text}<p>{a}<p>{a}<p>{a}</p>{text}", 3) != main_text(f"{text}<p>{a}<p>{a}<p>{a}</p>{text}", 5)
