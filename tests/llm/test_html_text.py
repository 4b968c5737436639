import pytest

from grouprank.llm.html_text import extract_text, main_text

P = "<p>One two, three four, and five six seven eight nine ten.</p>"
T = "One two, three four, and five six seven eight nine ten."


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<html><body></body></html>", ""),
    (f"<article><h1>Head &amp; more</h1>{P}</article>", f"Head & more\n{T}"),
    (f"<body><nav><a href=x>Menu</a></nav><header><h1>Site</h1></header><div id=main>{P}{P}</div><footer>foot, foot</footer></body>", f"{T}\n{T}"),
    (f"<body><div class='sidebar'><p>a, b, c, d, e, f</p></div><section>{P}<ul><li>item, one<li>item two</ul>{P}</section></body>",
     f"{T}\nitem, one\nitem two\n{T}"),
    (f"<article>{P}<section id='comments'><p>Reader, words, here, and, there</p></section></article>", T),
    (f"<article><p><b>Open<br>line{P}<script>var a='<p>x</p>';</script><style>p{{}}</style><!-- c <p>no</p> --></article>", f"Open line\n{T}"),
    (f"<article>{P}<div class='cookie-notice'>We use, cookies</div><form><p>Name, please, now</p></form><aside><p>ad, ad</p></aside></article>", T),
    ("<article><p>a&nbsp;b\n\t c &#233;&eacute;&amp;lt; &am</p></article>", "a b c éé&lt; &am"),
    (f"<article><div><div>{P}</div></div><p>short</p></article>", f"{T}\nshort"),
    (f"<article>{P}<p class=\"x", T),
    (f"<body><div class='post'>{P}{P}</div><div class='links'><a href=a>one, two, three</a> <a href=b>four, five, six</a></div></body>", f"{T}\n{T}"),
    (f"<article><header><h1>Title</h1></header>{P}</article>", f"Title\n{T}"),
    (f"<article>{P}<p hidden>not shown</p><div style='display: none'>nor this</div></article>", T),
    (f"<html><head><title>T</title><meta name=x><body>{P}</body></html>", T),
    (f"<html><head><title>T</title>{P}", T),
    (f"<article class='post related-to-health'>{P}</article>", T),
    (f"<main><div class='menu-of-the-day'>{P}{P}</div><div class='menu-top'><p>Starters, mains</p></div></main>", f"{T}\n{T}"),
    (f"<div class='layout has-sidebar'><h1>Head</h1>{P}{P}</div><div class='left-sidebar'><p>a, b, c</p></div>", f"Head\n{T}\n{T}"),
    (f"<article>{P}{P}<h2>Sources</h2><ul><li><a href=a>One, the first</a><li><a href=b>Two</a></ul></article>", f"{T}\n{T}\nSources\nOne, the first\nTwo"),
    (f"<body><ul><li><a href=a>Home</a><li><a href=b>About, us</a></ul>{P}{P}</body>", f"{T}\n{T}"),
    (f"<article><p>Let <math><mi>x</mi></math> be <label>named</label>, one, two.{P}</article>", f"Let x be named, one, two.\n{T}"),
    (f"<article>{P}</article><div class='reader-comments'><article class='comment'>{P}{P}{P}</article></div>", T),
    (f"<article>{P}<article class='comment'>{P}</article></article>", T),
])
def test_main_text(html, text):
    assert main_text(html) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + P + "</div>" * 5000) == T
    assert main_text("<article>" + P * 20_000 + "</article>").count("\n") == 19_999


@pytest.mark.parametrize("html", ["<a " * 350_000, "<a \"" * 250_000, "<span>" * 80_000 + "</p>" * 80_000, "<b>" * 80_000 + "<hr>" * 80_000,
                                  "<i>" * 60_000 + "word " * 60_000, "<header>" * 80_000, "<!--" * 250_000, "<a href='" * 100_000 + ">", "</div>" * 160_000])
def test_malformed_pages_take_linear_time(html):
    from time import process_time
    start = process_time()
    main_text(html)
    assert process_time() - start < 12


def test_rows(spark):
    rows = [(1, "u", f"<article>{P}</article>"), (1, "u", f"<article>{P}</article>"), (2, None, None), (None, "v", "")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = sorted((str(r["page_id"]), str(r["url"]), r["text"], r["n_chars"]) for r in extract_text(pages).collect())
    assert found == sorted([("1", "u", T, len(T)), ("1", "u", T, len(T)), ("2", "None", "", 0), ("None", "v", "", 0)])
    assert extract_text(pages.limit(0)).collect() == []
