"""Main text of web pages by tree scoring.

The page is read into a tree, tags by the states of the HTML standard.  Parts
that never belong to an article (menus, headers, footers, sidebars, notices,
adverts, forms, reader comments) are cut off by tag, role or name.  A name that
only sounds like such a part ("related-work") counts where the part has many
links or lies outside of an article.  Each paragraph passes points for its
length and commas to its ancestors: all to the parent, half to the grandparent,
then a third, a quarter and so on.  A container's points are discounted by its
link density; the best one is kept, or the article or main part that it lies
in, with those siblings that score a fifth of it and the headings, lists and
other blocks of few links that adjoin what is kept.

A ``header`` goes wherever it stands, as page headers do, also with a title in it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_path

#: Element names of the HTML standard by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
FOREIGN = frozenset(("svg", "math"))
OUTSIDE = frozenset("nav header footer aside form button select option dialog menu fieldset object canvas audio video".split())
BLOCK = frozenset("""address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2
 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul br""".split())
PARAGRAPH = frozenset("p pre blockquote td dd li h1 h2 h3 h4 h5 h6 figcaption".split())
ADJOINING = frozenset("p pre blockquote ul ol dl table figure h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCK - {"br", "html", "body"}
#: Elements that a new one of the same set ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = frozenset("table ul ol dl article section div main body html blockquote".split())

OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: Words in class names and ids: of parts beside the article, of reader comments, and of mere position or form.
OUTSIDE_WORDS = re.compile(
    r"ads?|adverts?|advertis\w*|adsense|adsbygoogle|banners?|sponsor\w*|promos?|promotions?|cookies?|consent|gdpr|notices?|alerts?|popups?|modal|overlay|newsletter|"
    r"subscri\w+|signup|login|(?:main|top|side|sub|left|right|bottom)?(?:menus?|nav)|(?:top|side|left|right|bottom)(?:bars?|ads?)|navbar|navigation|breadcrumbs?|pagination|pager|aside|footers?|headers?|"
    r"masthead|toolbar|share|sharing|social|related|recommend\w*|widgets?|skip|hidden|form")
COMMENT_WORDS = re.compile(r"comment(?:s|list|box|area|form|section|body|text|author|meta|thread)*|disqus|replies|reply|respond|guestbook")
NEUTRAL_WORDS = frozenset("""left right top bottom main site page global primary secondary sub inner outer wrap wrapper container box block
 section area list item items row col column content body links link buttons button bar panel module group holder unit slot text title
 post posts article articles story stories icons icon media fixed sticky float mobile desktop side user reader readers form thread div
 entry blog""".split())
#: Names that say what a wrapper has beside its content ("has-sidebar"), not what it is.
LAYOUT_NAMES = re.compile(r"(?<![\w-])(?:with|without|has|no|not)[_-][\w-]+|[\w-]+[_-](?:open|closed|enabled|disabled|on|off)(?![\w-])", re.IGNORECASE)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[_\-\d]+")
MARKUP = re.compile(r"<(?=[a-zA-Z/!?])")
#: Rest of a start tag: attributes with quoted, unquoted or no values.  Nothing is given back, so a tag takes linear time.
ATTRIBUTES = re.compile(r"""(?>[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?>"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+|[\s/]++)*+>""")
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+)))?+""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
COMMENT = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))", re.DOTALL)


class Page:
    """Nodes by number (0 is the root) and the pieces of text in page order."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.cut = ["#root"], [-1], [False]
        self.doubt, self.within = [False], [False]
        self.pieces: list[tuple[int, str | None]] = []  # None: a block boundary
        self._read(source)

    def _read(self, source: str) -> None:
        stack, at, n = [0], 0, len(source)
        while at < n:
            m = MARKUP.search(source, at)
            if m is None:
                self._text(stack[-1], source[at:])
                break
            if m.start() > at:
                self._text(stack[-1], source[at:m.start()])
            at, sign = m.start(), source[m.end():m.end() + 1]
            name = NAME.match(source, at + (2 if sign == "/" else 1))
            if name is None:  # a comment, or what the standard reads as one
                at = COMMENT.match(source, at).end() if source.startswith("<!--", at) else self._after(source, ">", at)
                if source.startswith("<![CDATA[", m.start()):
                    at = self._after(source, "]]>", m.start())
                continue
            rest = ATTRIBUTES.match(source, name.end())
            if rest is None:
                break  # the page ends inside a tag
            at, tag, attributes = rest.end(), name[0].lower(), rest[0][:-1]
            if sign == "/":
                self._end(stack, tag)
            elif tag in FOREIGN:
                if not attributes.rstrip().endswith("/"):  # else it has no end tag
                    at = self._drawing_end(source, tag, at)
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                at = end.end() if end else n
            else:
                self._start(stack, tag, attributes)

    @staticmethod
    def _after(source: str, mark: str, at: int) -> int:
        found = source.find(mark, at)
        return found + len(mark) if found >= 0 else len(source)

    @staticmethod
    def _drawing_end(source: str, tag: str, at: int) -> int:
        """End of a drawing that may hold others of its kind."""
        depth = 1
        for m in re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.IGNORECASE).finditer(source, at):
            depth += -1 if m[1] else not m[0].endswith("/>")
            if not depth:
                return m.end()
        return len(source)

    def _text(self, node: int, raw: str) -> None:
        self.pieces.append((node, html.unescape(raw) if "&" in raw else raw))

    def _start(self, stack: list[int], tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self._close(stack, {"p"})
        if tag in ENDS:
            self._close(stack, ENDS[tag])
        if tag in BLOCK:
            self.pieces.append((stack[-1], None))
        if tag in VOID:
            return
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(stack[-1])
        within = self.within[stack[-1]]
        kind = self._outside(tag, attributes, within)
        self.within.append(within or tag == "article")
        self.cut.append(self.cut[stack[-1]] or kind == "cut")
        self.doubt.append(kind == "doubt")
        if not attributes.rstrip().endswith("/") or tag in BLOCK or tag == "a":
            stack.append(node)

    @staticmethod
    def _outside(tag: str, attributes: str, within: bool) -> str | None:
        """``cut``: never of the article; ``doubt``: only a part of a name speaks against it."""
        if tag in OUTSIDE:
            return "cut"
        if not attributes.strip() or tag in ("html", "body", "a"):
            return None
        a = {k.lower(): v1 or v2 or v3 or "" for k, v1, v2, v3 in reversed(ATTRIBUTE.findall(attributes))}  # the first of a name counts
        if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in OUTSIDE_ROLES:
            return "cut"
        if re.search(r"display\s*:\s*none", a.get("style", ""), re.IGNORECASE):
            return "cut"
        doubt = False
        for name in LAYOUT_NAMES.sub(" ", html.unescape(f"{a.get('class', '')} {a.get('id', '')}")).split():
            words = [w.lower() for w in CAMEL.split(name) if w]
            comment = [COMMENT_WORDS.fullmatch(w) is not None for w in words]
            if tag == "main" or tag == "article" and not within:  # its name tells no more than whether it is a comment
                if any(comment) and all(c or w in NEUTRAL_WORDS for w, c in zip(words, comment, strict=True)):
                    return "cut"
                continue
            known = [c or OUTSIDE_WORDS.fullmatch(w) is not None for w, c in zip(words, comment, strict=True)]
            if any(known):
                if all(k or w in NEUTRAL_WORDS for w, k in zip(words, known, strict=True)):
                    return "cut"
                doubt = True
        return "doubt" if doubt else None

    def _close(self, stack: list[int], tags: set[str]) -> None:
        """End the nearest open element of ``tags``, if no container lies between."""
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] in tags:
                del stack[k:]
                self.pieces.append((stack[-1], None))
                return
            if self.tag[stack[k]] in SCOPE:
                return

    def _end(self, stack: list[int], tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] == tag:
                del stack[k:]
                break
        if tag in BLOCK:
            self.pieces.append((stack[-1], None))

    def _totals(self) -> tuple[list[int], list[int], list[int], list[int], list[int], list[int]]:
        """Characters, commas of each node itself, and characters, those in links, commas, links of its subtree."""
        n = len(self.tag)
        own, link, commas = [0] * n, [0] * n, [0] * n
        inside_a = [False] * n
        for v in range(1, n):
            inside_a[v] = self.tag[v] == "a" or inside_a[self.parent[v]]
        for v, piece in self.pieces:
            if piece is not None and not self.cut[v]:
                size = len("".join(piece.split()))
                own[v] += size
                link[v] += size if inside_a[v] else 0
                commas[v] += sum(map(piece.count, (",", "、", "，", "،")))
        length, links, comma, anchors = own[:], link[:], commas[:], [int(tag == "a") for tag in self.tag]
        for v in range(n - 1, 0, -1):  # children come after their parents
            for total in (length, links, comma, anchors):
                total[self.parent[v]] += total[v]
        return own, commas, length, links, comma, anchors

    def _settle_doubts(self) -> None:
        """Cut the parts of a doubtful name that have many links or lie outside of an article."""
        if not any(self.doubt):
            return
        _, _, length, links, _, _ = self._totals()
        for v in range(1, len(self.tag)):
            if self.doubt[v] and not (self.within[v] and links[v] <= 0.3 * length[v]):
                self.cut[v] = True
            self.cut[v] = self.cut[v] or self.cut[self.parent[v]]

    def _best(self, own, commas, length, links, comma) -> tuple[int | None, list[float]]:
        """The container of the highest score, and all scores."""
        n = len(self.tag)
        points = [0.0] * n
        direct = [False] * n  # holds text itself, as a container without paragraphs does
        for v in range(1, n):
            direct[v] = self.tag[v] in ("div", "section", "article", "main", "body") and own[v] > 0
        for v in range(1, n):
            if self.cut[v] or not (self.tag[v] in PARAGRAPH or direct[v]):
                continue
            size, c = (length[v], comma[v]) if self.tag[v] in PARAGRAPH else (own[v], commas[v])
            if not size:
                continue
            gain = min(size / 25, 1) + c + min(size / 100, 3)
            up, level = (v if direct[v] else self.parent[v]), 1
            while up > 0:
                if self.tag[up] not in ("html", "body") or level == 1:
                    points[up] += gain / level
                    level += 1
                up = self.parent[up]
        score = [points[v] * (1 - links[v] / length[v]) if length[v] else 0.0 for v in range(n)]
        best = max(range(n), key=lambda v: (score[v], -v))
        return (best if score[best] > 0 else None), score

    def _kept(self, best: int, score: list[float], length: list[int], links: list[int]) -> set[int]:
        """``best`` with the siblings that belong to it."""
        beside = [v for v in range(1, len(self.tag)) if self.parent[v] == self.parent[best] and not self.cut[v] and length[v]]
        sparse = {v: links[v] <= 0.25 * length[v] for v in beside}
        kept = [v == best or score[v] >= score[best] / 5 or self.tag[v] == "p" and sparse[v] and length[v] > 80 for v in beside]
        first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
        for k, v in enumerate(beside):
            kept[k] = kept[k] or first < k < last and sparse[v]
        for way, k in ((-1, first - 1), (1, last + 1)):  # blocks in a row before and after
            while 0 <= k < len(beside) and self.tag[beside[k]] in ADJOINING and sparse[beside[k]]:
                kept[k] = True
                k += way
        return {v for v, stays in zip(beside, kept, strict=True) if stays}

    def main_text(self) -> str:
        self._settle_doubts()
        own, commas, length, links, comma, anchors = self._totals()
        n = len(self.tag)
        if not length[0]:
            return ""
        best, score = self._best(own, commas, length, links, comma)
        if best is None:
            kept = {0}
        else:
            up, part = best, None
            while up > 0:  # a part of an article stands for the article, or else for the main part
                if self.tag[up] == "article" or self.tag[up] == "main" and (part is None or self.tag[part] != "article"):
                    part = up
                up = self.parent[up]
            best = part or best
            kept = self._kept(best, score, length, links)
        shown = [False] * n
        shown[0] = 0 in kept
        for v in range(1, n):
            menu = (self.tag[v] in ("ul", "ol", "div", "section", "table") and v not in kept and links[v] > 0.6 * length[v]
                    and not self.within[v] and links[v] < 25 * anchors[v])
            shown[v] = not self.cut[v] and not menu and (v in kept or shown[self.parent[v]])
        out = "".join(" " if piece is None else piece for v, piece in self.pieces if piece is None or shown[v])
        return " ".join(out.split())


def main_text(source: str | None) -> str:
    """The article of a whole page; empty for null, empty pages and pages without text."""
    return Page(source).main_text() if source else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null and empty html give an empty text; repeated rows each give a row; null
    ids and urls are kept; broken mark-up is read as browsers do, as far as
    needed; an empty table gives no rows; other columns are not read.
    """
    python_path(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
