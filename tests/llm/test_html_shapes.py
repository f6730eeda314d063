"""Page shapes whose article is known, and a second reader over ``html.parser`` events."""

from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest

from tagwerk.llm.html_text import BLOCK, main_text
from tagwerk.llm.queries import op2_html_extraction

LONG = "Some sentence, with commas, that goes on for a while so that it counts. "
P = f"<p>{LONG * 2}</p>"
TEXT = (LONG * 2).strip()
NOISE = "Reader words, that do not belong, however long they are, and they are long. " * 3

SHAPES = {
    "comment inside the article": (f"<article>{P}<article class='comment'><p>{NOISE}</p></article></article>", TEXT),
    "comments beside the article": (f"<article>{P}</article><article class='comment' id='c1'><p>{NOISE}</p></article>"
                                    f"<article id='comment-22'><p>{NOISE}</p></article>", TEXT),
    "comment body of a theme": (f"<main><article class='post comments-open'>{P}</article><ol class='commentlist'><li>{NOISE}</ol></main>", TEXT),
    "thread": (f"<article>{P}</article><div id='disqus_thread'><p>{NOISE}</p></div><section id=comments><p>{NOISE}</p></section>", TEXT),
    "second section of main": (f"<main><section>{P * 3}</section><section><p>One paragraph, short.</p></section></main>",
                               f"{' '.join([TEXT] * 3)} One paragraph, short."),
    "heading and list beside": (f"<div id=page><h1>Title</h1><div class=text>{P * 3}</div><ul><li>one<li>two</ul><div class=footer>x</div></div>",
                                f"Title {' '.join([TEXT] * 3)} one two"),
    "heading before the article": (f"<main><h1>Title</h1><article>{P}</article></main>", f"Title {TEXT}"),
    "table between two parts": (f"<body><div>{P * 2}</div><table><tr><td>cell</table><div>{P * 2}</div></body>",
                                f"{TEXT} {TEXT} cell {TEXT} {TEXT}"),
    "names that only sound like it": (f"<article>{P}<div class='related-work'>{P}</div><div id='share-price'><p>12, up.</p></div>"
                                      "<section class='form-factor'><p>Small.</p></section></article>", f"{TEXT} {TEXT} 12, up. Small."),
    "names that are it": (f"<article>{P}<div class='related-posts'>{P}</div><ul class='share-buttons'><li>x</ul><div class=newsletterSignup>y</div>"
                          "<div class='sidebar-1 col-4'>z</div><a class='skip-link' href=x>skip</a></article>", f"{TEXT} skip"),
    "doubtful name with links": (f"<article>{P}<div class='related-reading-tips'><a href=a>Other page</a></div></article>", TEXT),
    "doubtful name outside": (f"<div class='top-cookie-info'><p>{NOISE}</p></div><div>{P * 9}</div>", " ".join([TEXT] * 9)),
    "sources in an article": (f"<article>{P}<ul><li><a href=a>First source</a><li><a href=b>Second</a></ul></article>", f"{TEXT} First source Second"),
    "unquoted value with a quote": (f"<article><p>See <a href=foo'bar>this</a> and <a href=x\"y>that</a>, it is fine. {LONG}</p></article>",
                                    f"See this and that, it is fine. {LONG.strip()}"),
    "attributes without space or value": (f"<article><p class=\"a\"id=b hidden2 =c data-x='>'/>{LONG}</p></article>", LONG.strip()),
    "less-than signs": (f"<article><p>1 < 2 <3 a<b>c</b> <>{LONG}</p></article>", f"1 < 2 <3 ac <>{LONG.strip()}"),
    "comments of the standard": (f"<!--><!---><!-- a -- b --!><article><?php x ?></ y><!x>{P}<!-- > --></article>", TEXT),
    "drawing in a drawing": (f"<article><svg><svg></svg><text>no</text></svg>{P}</article>", TEXT),
    "script end in a longer name": (f"<script>a</scripts>{NOISE}</script ><article>{P}</article>", TEXT),
    "header with the title": (f"<article><header><h1>T</h1></header>{P}</article>", TEXT),
    "first of a repeated attribute": (f"<article><div class=text class=sidebar>{P}</div></article>", TEXT),
}


@pytest.mark.parametrize("name", SHAPES)
def test_shapes(name):
    source, want = SHAPES[name]
    assert main_text(source) == want


class Reader(HTMLParser):
    """Text of the article by events: what no cut element holds, blocks apart."""

    CUT = {"nav", "header", "footer", "aside", "form", "button", "script", "style", "template", "noscript"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool]] = []
        self.out: list[str] = []

    def handle_starttag(self, tag, attrs):
        names = (dict(attrs).get("class") or "").split()
        if tag in BLOCK:
            self.out.append(" ")
        if tag not in ("br", "img", "hr"):
            self.open.append((tag, tag in self.CUT or bool({"ad", "sidebar", "comment", "share"} & set(names))))

    def handle_endtag(self, tag):
        self.open.pop()
        if tag in BLOCK:
            self.out.append(" ")

    def handle_data(self, data):
        if any(tag == "article" for tag, _ in self.open) and not any(cut for _, cut in self.open):
            self.out.append(data)


def random_page(rng):
    def some(n):
        return " ".join(rng.choice(["word", "Umläut", "1 &lt; 2", "&amp;amp;", "a, b,", "&#8211;", "x&nbsp;y", "end."]) for _ in range(rng.randrange(n) + 1))

    def inline():
        return "".join(rng.choice([some(9) + " ", f"<b>{some(2)}</b>", f"<a href=u'v>{some(1)}</a>, ", f"<i>{some(3)}</i> ", "<br>", "<img src=x>"])
                       for _ in range(rng.randrange(1, 6)))

    def block(depth):
        kind = rng.randrange(10)
        if kind < 4 or depth > 3:
            return f"<p>{inline()}</p>"
        if kind == 4:
            return f"<ul>{''.join(f'<li>{inline()}</li>' for _ in range(3))}</ul>"
        if kind == 5:
            return f"<table><tr><td>{inline()}</td><th>{some(2)}</th></tr></table>"
        if kind == 6:
            return f"<h2>{some(4)}</h2><blockquote>{block(depth + 1)}</blockquote>"
        if kind == 7:
            tag, name = rng.choice([("nav", ""), ("aside", ""), ("div", " class='x ad'"), ("section", ' class="sidebar"'), ("article", " class=comment"),
                                    ("footer", ""), ("form", ""), ("div", " class=share"), ("script", ""), ("style", "")])
            return f"<{tag}{name}>{some(9) if tag in ('script', 'style') else block(depth + 1)}</{tag}>"
        return f"<div class='{rng.choice(['text', 'row col-2', 'no-sidebar'])}'>{block(depth + 1)}{block(depth + 1)}</div>"

    body = "".join(block(0) for _ in range(rng.randrange(1, 9))) + f"<p>{LONG * 30}</p>"
    return (f"<html><head><title>t</title></head><body><nav>{inline()}</nav><article>{body}</article>"
            f"<footer><p>{some(30)}</p></footer></body></html>")


def test_random_pages_equal_the_second_reader():
    rng = random.Random(2)
    for _ in range(400):
        source = random_page(rng)
        reader = Reader()
        reader.feed(source)
        reader.close()
        assert main_text(source) == " ".join("".join(reader.out).split()), source


def test_query_equals_the_second_reader(spark, scratch):
    rng = random.Random(3)
    rows = [(i, f"u{i}", random_page(rng)) for i in range(40)] + [(None, None, None), (50, "u", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{scratch}/pages.parquet")
    got = {r.page_id: r for r in op2_html_extraction(spark, scratch).collect()}
    for page_id, url, source in rows:
        reader = Reader()
        reader.feed(source or "")
        want = " ".join("".join(reader.out).split())
        assert (got[page_id].url, got[page_id].text, got[page_id].n_chars) == (url, want, len(want))


def test_odd_markup_takes_linear_time():
    for piece in ("<a ", "<a b=", "<a b='", "<!--", "<", "</", "<a b=c'd ", "<svg>", "<div class=\"", "&"):
        main_text("<article><p>x</p>" + piece * 30_000)
