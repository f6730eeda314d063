import pytest

from tagwerk.llm.html_text import extract_pages, main_text

LONG = "Some sentence, with commas, that goes on for a while so that it counts. "


def page(body, head=""):
    return f'<!DOCTYPE html><html><head><title>Title</title>{head}</head><body>{body}</body></html>'


CASES = {
    "article": (page(f"<nav><a href='/'>Home</a></nav><div class='ad'>Buy now, buy, buy.</div><article><h1>Head</h1><p>{LONG}</p><p>Short.</p>"
                     "</article><footer>&copy; site</footer>"), f"Head {LONG.strip()} Short."),
    "unclosed": (page(f"<article><h1>Head</h1><p><b>Bold<br><p>{LONG}</p><p>End.</article><footer>x"), f"Head Bold {LONG.strip()} End."),
    "container": (page(f"<div id='sidebar'><p>{LONG}</p></div><div id='content'><p>{LONG}</p><p>{LONG}</p></div>"
                       f"<div class='comments'><p>{LONG * 9}</p></div>"), f"{LONG.strip()} {LONG.strip()}"),
    "names of the layout": (page(f"<div class='page has-sidebar no_comments'><div id='with-menu'><p>{LONG}</p><p>{LONG}</p></div>"
                                 f"<div class='no-print left-sidebar'><p>{LONG}</p></div></div>"), f"{LONG.strip()} {LONG.strip()}"),
    "menu without a name": (page(f"<div><ul><li><a href='a'>One</a></li><li><a href='b'>Two</a></li></ul></div><div><p>{LONG}</p><p>{LONG}"
                                 "See <a href='c'>this</a>.</p></div>"), f"{LONG.strip()} {LONG}See this."),
    "sections": (page(f"<article><section><p>{LONG * 3}</p></section><section><h2>Two</h2><p>Tiny.</p></section></article>"),
                 f"{(LONG * 3).strip()} Two Tiny."),
    "references": (page(f"<article><p>A &amp; B &lt;c&gt; &#233;&#x41; &nbsp; d &amp;amp; {LONG}</p></article>"), f"A & B <c> éA d &amp; {LONG.strip()}"),
    "inline": (page(f"<article><p>un<b>bro</b>ken wo<i>rd</i> {LONG}</p><div>x</div>y</article>"), f"unbroken word {LONG.strip()} x y"),
    "scripts": (page(f"<script>var a='</p><p>{LONG}';</script><article><style>p{{}}</style><p>{LONG}</p><script>1<2</script><!-- <p>no</p> --></article>"),
                LONG.strip()),
    "forms": (page(f"<article><p>{LONG}</p><form><p>{LONG}</p><input value='x'><button>Go</button></form></article>"), LONG.strip()),
    "hidden": (page(f"<article><p>{LONG}</p><div hidden><p>{LONG}</p></div><div style='display: none'>x</div><div role='navigation'>n</div></article>"),
               LONG.strip()),
    "lists and tables": (page(f"<article><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>"),
                         f"{LONG.strip()} one two a b c"),
    "no markup": ("just text, no tags", "just text, no tags"),
    "empty body": (page(""), ""),
    "only menus": (page("<nav>Home</nav><footer>End</footer>"), ""),
    "cut in a tag": (f"<article><p>{LONG}</p><p>End</p><di", f"{LONG.strip()} End"),
    "cut in a reference": (f"<article><p>{LONG}</p></article><footer>a &am", LONG.strip()),
    "cut in a script": (f"<article><p>{LONG}</p></article><script>var", LONG.strip()),
    "upper case": (f"<BODY><ARTICLE><P>{LONG}</P></ARTICLE></BODY>", LONG.strip()),
    "greater sign in an attribute": (f"<article><p title='a > b'>{LONG}</p></article>", LONG.strip()),
    "self-closed drawings": (page(f"<article><svg class='i' /><p>{LONG}</p><p>Two<math/> three<svg><path/>no</svg>.</p><svg/></article>"),
                             f"{LONG.strip()} Two three."),
    "self-closed drawing with a bare value": (page(f"<article><svg href=#i /><p>{LONG}</p></article>"), LONG.strip()),
    "stray ends": (f"</div></p><article></b><p>{LONG}</p></article></article>", LONG.strip()),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    source, want = CASES[name]
    assert main_text(source) == want


def test_long_and_deep_pages():
    assert main_text("<div>" * 5000 + f"<p>{LONG}</p>") == LONG.strip()
    many = "".join(f"<p>{LONG}{i}.</p>" for i in range(3000))
    text = main_text(page(f"<article>{many}</article>"))
    assert text.count("Some sentence") == 3000 and text.endswith("2999.")


def test_page_rows(spark):
    rows = [(i, f"u{i}", source) for i, (source, _) in enumerate(CASES.values())] + [(90, None, None), (91, "u", ""), (None, "u", "x"), (0, "u0", "y")]
    clash = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {(r.page_id, r.url): r for r in extract_pages(clash).collect()}
    for i, (_, want) in list(enumerate(CASES.values()))[1:]:
        assert got[i, f"u{i}"].text == want and got[i, f"u{i}"].n_chars == len(want)
    assert got[90, None].text == "" and got[91, "u"].n_chars == 0 and got[None, "u"].text == "x"
    assert extract_pages(clash).count() == len(rows)
    assert extract_pages(clash.limit(0)).collect() == []
