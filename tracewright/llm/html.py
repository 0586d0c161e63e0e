"""Main text of HTML pages by text-to-tag ratios over parser events.

The standard library's parser is fed in pieces; its events make *lines*: the
text between two block-level boundaries, white space collapsed. Each line has
the number of tags in it, its link text, its container path and whether an
enclosing element is boilerplate by tag, role, class or id. Of classes and ids
only whole tokens count (``has-sidebar`` is no sidebar), and an element that is
boilerplate by its class or id, or a form, stays if it has a content class, an
article or main in it, or more than half of the page's votes. Related items
stay for an article in them only if there is none elsewhere, comments and
cookie notices for nothing else. Headers, footers, navigation and asides by tag
or role stay for a main in them. The text-to-tag
ratios of the lines are smoothed with a Gaussian and clustered in two by their
threshold (the mean of the two clusters' means, iterated); the lines above it
vote, by their length. The page's content region is all of its ``article`` and
``main`` elements if there are any, else the deepest container (no paragraph,
list or quotation) round all voting lines. All lines of the region are kept,
short ones and links too, but for boilerplate; so the ratios select regions,
not single lines. If the region is the whole page, link lines before the first
and after the last voting line go, unless in a paragraph or heading.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup html iframe legend li main menu nav noscript ol option optgroup p pre search section select "
    "summary table tbody td template textarea tfoot th thead title tr ul".split()
)
DROPPED = frozenset(
    "script style noscript template head title iframe svg canvas object audio video math select textarea "
    "button menu dialog search input label datalist map".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Elements by tag that are dropped unless a main (a form: an article, or most votes) is in them.
FRAMES = frozenset("header footer nav aside form".split())
_BOX = r"(?:[-_]+(?:top|bottom|left|right|inner|outer|wrap|wrapper|container|box|block|area|section|bar|list|links?|items?|buttons?|btns?|icons?|form|panel|group|row|primary|secondary|desktop|mobile|sticky|fixed|\d+))*"
_SITE = r"(?:(?:site|page|main|global|top|bottom|left|right|primary|secondary|mobile|desktop|sticky|fixed|footer|header|sidebar|nav|social|cookies?)[-_]+)*"
_COMMENT = r"comments?|comment-?list|disqus\w*|respond|cookies?|consent|gdpr"
_RELATED = r"related|recommend\w*"
_FURNITURE = r"ads?|advert\w*|sponsor\w*|promo|promos|promotions?|banner|side-?bar|newsletter|subscri\w+|social|share|sharing|breadcrumbs?|menu|nav|navbar|navigation|footer|pagination|pager"
_OTHER = r"notices?|alert|masthead|topbar|header|popup|pop-up|modal|overlay|widget|login|signup|skip-?link"
_POST = r"(?:(?:post|article|entry|story|blog)[-_]+)?"


def _tokens(words: str) -> re.Pattern:
    return re.compile(words, re.I)


#: kind → pattern of a whole class token or id; the first that matches wins.
NAMES = {
    "comment": _tokens(rf"{_SITE}{_POST}(?:{_COMMENT})(?:[-_]+(?:{_COMMENT}|{_FURNITURE}|{_OTHER}))*{_BOX}"),
    "related": _tokens(rf"{_SITE}{_POST}(?:{_RELATED})(?:[-_]+(?:posts?|articles?|stories|content|{_FURNITURE}))*{_BOX}"),
    "name": _tokens(rf"{_SITE}(?:{_POST}(?:{_FURNITURE})|{_OTHER})(?:[-_]+(?:{_FURNITURE}|{_OTHER}))*{_BOX}"),
}
CONTENT = _tokens(r"(?:(?:main|page|site|article|post|entry|story|blog)[-_]+)*(?:article|content|main|post|entry|story|body)(?:[-_]+(?:body|content|text|main|wrap|wrapper|inner|container|area))*")
#: What may be a region: a long paragraph, list or quotation is none.
CONTAINERS = frozenset("html body div section table tbody tr td center form fieldset details".split())
HEADINGS = frozenset("p h1 h2 h3 h4 h5 h6".split())
CLOSES = {"p": frozenset({"p"}), "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}), "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}), "option": frozenset({"option"})}
SCOPES = frozenset("article aside body div section main nav header footer form table ul ol dl blockquote td th figure details fieldset li".split())
SPACE = re.compile(r"\s+")
PIECE = 1 << 16
SIGMA = 1.0
#: Characters a tag from which a line votes wherever the clusters part, so that no long paragraph hides the others.
PROSE = 80.0


@lru_cache(4096)
def named(words: str) -> str:
    """The kind of boilerplate that the tokens of a class and an id tell, or ""."""
    tokens = words.split()
    kinds = [k for k, pattern in NAMES.items() if any(pattern.fullmatch(t) for t in tokens)]
    if not kinds or kinds[0] != "comment" and any(CONTENT.fullmatch(t) for t in tokens):
        return ""
    return kinds[0]


class Line:
    __slots__ = ("text", "tags", "link", "path", "dropped", "ratio")

    def __init__(self, text, tags, link, path, dropped):
        self.text, self.tags, self.link, self.path, self.dropped = text, tags, link, path, dropped
        self.ratio = len(text) / max(1, tags)


class Lines(HTMLParser):
    """Parser events to lines; the open elements are kept as a stack."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[tuple[str, int, bool]] = []  # tag, number, dropped
        self.made = self.tags = self.link = self.links = 0
        self.parts: list[str] = []
        self.is_article: dict[int, tuple[int, ...]] = {}  # number → numbers of the elements round it
        self.is_main: set[int] = set()
        self.doubtful: dict[int, str] = {}  # number → kind of boilerplate, unless it proves to be content
        self.tag_of: dict[int, str] = {}

    def _end_line(self):
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            top = self.stack[-1] if self.stack else ("", 0, False)
            self.lines.append(Line(text, self.tags, self.link, tuple(n for _, n, _ in self.stack), top[2]))
            self.tags = 0
        self.parts, self.link = [], 0

    def _pop(self, k: int):
        for tag, _, _ in self.stack[k:]:
            self.links -= tag == "a"
        del self.stack[k:]

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in BLOCK or tag == "hr":
            self._end_line()
            shut = CLOSES.get(tag) or (CLOSES["p"] if tag not in ("option", "td") else None)
            for k in range(len(self.stack) - 1, -1, -1):
                name = self.stack[k][0]
                if name in shut:
                    self._pop(k)
                    if tag in ("p",) or name != "p":
                        break
                elif name in SCOPES:
                    break
        if tag in VOID:
            return
        a = {k: v or "" for k, v in attrs}
        words = f"{a.get('class', '')} {a.get('id', '')}"
        role = a.get("role", "").lower()
        dropped = bool(self.stack and self.stack[-1][2]) or tag in DROPPED or "hidden" in a or a.get("aria-hidden") == "true"
        self.made += 1
        self.tag_of[self.made] = tag
        if tag in ("article", "main") or role in ("main", "article") or a.get("itemprop") == "articleBody":
            if not dropped:
                self.is_article[self.made] = tuple(n for _, n, _ in self.stack)
                if "main" in (tag, role):
                    self.is_main.add(self.made)
        elif tag in FRAMES or role in ROLES:
            self.doubtful[self.made] = "form" if tag == "form" else "frame"
        elif words != " " and tag not in ("html", "body"):
            kind = named(words)
            if kind and not (tag in ("h1", "h2", "h3", "p") and "header" in words.lower()):
                self.doubtful[self.made] = kind
        self.stack.append((tag, self.made, dropped))
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("script", "style", "iframe", "template"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self._end_line()
        if tag in VOID:
            return
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k][0]
            if name == tag:
                self._pop(k)
                return
            if name in SCOPES and tag not in BLOCK:
                return  # an inline end tag does not close blocks

    def handle_data(self, data):
        if self.stack and self.stack[-1][0] in ("script", "style", "template"):
            return
        self.parts.append(data)
        if self.links:
            self.link += len(data)

    def finish(self):
        self.close()
        self._end_line()
        return self.lines


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing with weights renormalised at the ends."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out, n = [], len(values)
    for i in range(n):
        lo, hi = max(0, i - reach), min(n, i + reach + 1)
        w = kernel[lo - i + reach : hi - i + reach]
        out.append(sum(a * b for a, b in zip(w, values[lo:hi])) / sum(w))
    return out


def threshold(values: list[float]) -> float:
    """The value that parts two clusters: midway between their means."""
    if not values:
        return 0.0
    cut = sum(values) / len(values)
    for _ in range(32):
        low, high = [v for v in values if v <= cut], [v for v in values if v > cut]
        if not low or not high:
            return min(values)
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def voters(lines: list[Line]) -> list[Line]:
    """Lines above the threshold of the smoothed ratios that are not mostly links."""
    ratios = smoothed([x.ratio for x in lines])
    cut = min(threshold(ratios), PROSE)
    text = [x for x in lines if 2 * x.link < len(x.text)]
    return [x for x, r in zip(lines, ratios) if r >= cut and 2 * x.link < len(x.text)] or text


def without_boilerplate(parser: Lines) -> list[Line]:
    """Lines in no element that is boilerplate and proves to be no content."""
    doubtful = dict(parser.doubtful)

    def outside(kinds):
        return [x for x in lines if not any(doubtful.get(n) in kinds for n in x.path)]

    def spare(kinds, numbers):
        for n in numbers:
            if doubtful.get(n) in kinds:
                del doubtful[n]

    lines = [x for x in parser.lines if not x.dropped]
    for n in parser.is_main:
        spare(("frame", "form", "name", "related", "comment"), parser.is_article[n])
    for around in parser.is_article.values():
        if not any(doubtful.get(n) in ("frame", "related", "comment") for n in around):
            spare(("form", "name"), around)
    filled = {n for x in lines for n in x.path if n in parser.is_article}
    if not any(not any(n in doubtful for n in parser.is_article[k]) for k in filled):
        for k in filled:
            if not any(doubtful.get(n) == "frame" for n in parser.is_article[k]):
                spare(("form", "name", "related", "comment"), parser.is_article[k])
    lines = outside(("frame", "comment"))
    votes: dict[int, int] = {}
    voting = voters(lines)
    total = sum(len(x.text) for x in voting)
    for x in voting:
        for n in x.path:
            votes[n] = votes.get(n, 0) + len(x.text)
    spare(("form", "name", "related"), [n for n, v in votes.items() if 2 * v > total])
    return outside(("form", "name", "related"))


def main_lines(parser: Lines) -> list[str]:
    lines = without_boilerplate(parser)
    articles = {n for x in lines for n in x.path if n in parser.is_article}
    if articles:
        return [x.text for x in lines if articles.intersection(x.path)]
    voting = voters(lines)
    if not voting:
        return []
    # the deepest container round all voting lines; it may be the page, but no
    # container of a single line, which is a paragraph by another name
    sizes = Counter(n for x in lines for n in x.path)
    region, whole = None, True
    for column in zip(*(x.path for x in voting)):
        if len(set(column)) > 1:
            break
        if parser.tag_of[column[0]] in CONTAINERS and sizes[column[0]] > 1:
            region, whole = column[0], parser.tag_of[column[0]] in ("html", "body")
    inside = [x for x in lines if region is None or region in x.path]
    if not whole:
        return [x.text for x in inside]
    # round the run of voting lines a page has menus; between them all is kept
    first, last = inside.index(voting[0]), inside.index(voting[-1])
    return [x.text for k, x in enumerate(inside) if first <= k <= last or 2 * x.link <= len(x.text) or any(parser.tag_of[n] in HEADINGS for n in x.path)]


def extract_text(html: str | None) -> str:
    """Main text of one page; null, empty or contentless pages give ``""``."""
    if not html:
        return ""
    parser = Lines()
    for start in range(0, len(html), PIECE):
        parser.feed(html[start : start + PIECE])
    parser.finish()
    return "\n".join(main_lines(parser))


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars. One narrow pass.

    Null or empty html has an empty text; repeated rows and null ids are treated
    like others; columns besides page_id, url and html are ignored.
    """

    def run(batches):
        for b in batches:
            texts = [extract_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    src = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return src.mapInArrow(run, f"page_id {src.dtypes[0][1]}, url string, text string, n_chars long")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op2_html": op2_html}
ORACLES: dict[str, str] = {}
