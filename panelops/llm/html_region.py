"""Main text of HTML pages as the maximum-scoring contiguous region of tokens: words score by where they
stand, tags cost, and one linear scan finds the best region. Scores are learned from labelled pages."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.llm.common import fresh, texts_of, with_columns

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|title|textarea|noscript|template|iframe|svg)\b[^>]*+>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-z][a-z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[a-z/!?][^>]*(?:>|\Z)|[^<]+|<""",
    re.IGNORECASE | re.DOTALL,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
PART = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that end an open paragraph, and their like, where they begin.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

#: Labelled pages: pieces of a page in order, with 1 for main text and 0 for the rest.
LABELLED = (
    (("<body><header class='site-header'><h1>The Daily Site</h1><a href='/'>Daily Site Name</a><p>Tagline of the site</p></header><nav class='menu'><ul><li><a>Home</a></li><li><a>World</a></li><li><a>Sport</a></li></ul></nav>", 0),
     ("<article><h1>Storm reaches the coast</h1><p>The storm reached the coast on Monday and <a>thousands of people</a> left their homes for shelters in the <b>hills</b>.</p><p>Officials said that roads would be closed.<br></p><h2>What comes next</h2><p>More rain is expected.</p></article>", 1),
     ("<aside class='sidebar'><h3>Most read</h3><ul><li><a>Ten things to know today</a></li><li><a>Best recipes</a></li></ul></aside><footer id='footer'>Copyright Daily Site. All rights reserved. <a>Terms</a> <a>Privacy</a></footer></body>", 0)),
    (("<body><div class='cookie-notice banner' role='alert'>We use cookies to improve your visit. <button>Accept</button></div><div id='nav'><a>Start</a><a>Blog</a><a>About</a></div>", 0),
     ("<main id='content'><h1>How to grow tomatoes</h1><p>Tomatoes need sun and water. Plant them after the last frost, in rich soil.</p><ul><li>Water them every morning</li><li>Tie the stems to a pole</li></ul><blockquote><p>A garden is never finished.</p></blockquote><table><tr><td>Seeds</td><td>March</td></tr></table><pre>dig plant water</pre>", 1),
     ("<div class='ad advert sponsored'><p>Buy our fertilizer today and save half of the price.</p></div><div class='share social'><a>Share this</a><a>Tweet</a></div>", 0),
     ("<p>Pick the fruits when they are red.</p></main>", 1),
     ("<section class='comments' id='comments'><h3>Comments</h3><div class='comment'><p>Great article, thank you so much for it!</p></div><form class='comment-form'><label>Your name</label><textarea>text</textarea><button>Send</button></form></section><div class='related'><h4>Related posts</h4><a>How to grow beans</a></div><footer>Made with love in the garden. Contact us</footer></body>", 0)),
    (("<body><div class='top header'><span class='logo'>Shop</span><form class='search'><input><button>Search the shop</button></form></div><div class='breadcrumb breadcrumbs'><a>Home</a> <a>Books</a></div>", 0),
     ("<div class='post entry'><h1>A short history of paper</h1><div><p>Paper was made in China long before it came to Europe.</p><p>Mills used water to beat rags into pulp, and sheets were dried in the air.</p><ol><li>First, rags were sorted.</li></ol><figure><figcaption>A mill on the river</figcaption></figure></div></div>", 1),
     ("<div class='widget newsletter subscribe signup'><p>Subscribe to our newsletter and never miss a story.</p></div><div class='tags meta'><a>history</a> <a>paper</a></div><div id='sidebar' class='side'><div class='ads promo'>Cheap flights from nine euros only this week</div></div><div class='footer bottom'><p>Impressum and legal notice of the publisher</p></div></body>", 0)),
    (("<body><nav><ul><li><a>One</a></li><li><a>Two</a></li><li><a>Three</a></li></ul></nav><div class='ad'>Lorem offers of the week for you and all your friends.</div>", 0),
     ("<article><h1>Title of it</h1><p><b>Title of it<br><p>One.</p><p>Body text of some length goes on here.</p><p>Two words.</p></article>", 1),
     ("<footer>&copy; host &middot; Words of a footer that may be long, too.</footer></body>", 0)),
    (("<body><div class='notice warning alert message'>This page is out of date. Please read the notice.</div><div role='navigation'><a>Menu</a></div><div role='banner'>Banner words</div>", 0),
     ("<div role='main' class='content text body story'><section><h2>Second level heads</h2><p>The council met on Tuesday to discuss the new bridge across the river, and no decision was taken.</p><dl><dt>Bridge</dt><dd>A way across.</dd></dl><p>It will meet again in May.</p></section></div>", 1),
     ("<div role='complementary'>Weather: sunny, twenty degrees</div><div class='popup modal overlay consent gdpr'>Do you agree to our terms of use?</div><div class='disclaimer copyright credits'>No warranty of any kind is given.</div><div class='pagination pager'><a>Next</a></div><div id='disqus_thread' class='replies reviews discussion'><p>I do not agree with the author on this.</p><p>Nor do I.</p></div><menu><li>Print</li></menu></body>", 0)),
    (("<body><div id='page'><div class='masthead site-header'><a>Paper of the town</a></div><div class='skip'><a>Skip to content</a></div>", 0),
     ("<div class='article-body post-content entry-content'><div class='article-header'><h1>Bells ring again</h1><p>After ten years the bells of the old tower ring again.</p></div><p>Many came to hear them, and some had walked for hours.</p><table><tr><th>Bell</th><th>Weight</th></tr><tr><td>Great bell</td><td>Two tons</td></tr></table><ul><li>The first rings at noon.</li><li>The second rings at <a>six</a>.</li></ul>", 1),
     ("<aside><h3>In short</h3><p>Read more of our stories about towers and bells</p></aside><form><p>Sign up now for more</p><fieldset><legend>Your mail</legend><select><option>Daily</option></select></fieldset><button>Send it now</button></form><nav><p>Contents of this series</p></nav>", 0),
     ("<p>The tower may be visited on Sundays.</p></div>", 1),
     ("<dialog>Do you want to get our letters? Say yes or no</dialog><section id='comments' class='comment-list'><article class='comment'><p>I was there and it was very loud, but we all liked it</p></article></section></div></body>", 0)),
    (("<body>", 0),
     ("<p>A page without any names has its text in plain paragraphs, and all of it is main text for the reader.</p><div><p>There is nothing else on it, neither a menu nor a footer, and so the words speak for themselves.</p><ol><li>It has a list.</li><li>The list has items.</li></ol></div><h2>It has a second part</h2><p>The second part ends the page.</p>", 1),
     ("</body>", 0)),
    (("<body><header><h1>The Weekly</h1><p>News since the year of the great flood</p></header>", 0),
     ("<main><article><header><h1>How the flood came</h1></header><p>It rained for nine days before the river left its bed, and on the tenth day the lower town stood under water.</p><section><h3>The bridge</h3><p>The bridge held until noon, when a barge broke loose and struck it.</p><h4>Who was there</h4><p>Two guards saw it happen and ran for the bells.</p></section></article></main>", 1),
     ("<footer><p>The Weekly is printed in the lower town</p></footer></body>", 0)),
)

#: Elements that format a text of any kind; like inline ones they do not tell what it is.
FORMAT = frozenset("blockquote caption dd dl dt figcaption figure h2 h3 h4 h5 h6 hr li ol p pre table tbody td tfoot th thead tr ul".split())
#: Names that say where a part stands, not what it is; they do not thin out the rest of a compound class name.
STRUCTURE = frozenset("area block box container inner item items left list panel right section slot unit wrap wrapper".split())
#: Log-odds from which a name tells main text from the rest; the most that the names of one element say for and against.
TELLING, MOST_FOR, MOST_AGAINST = 1.0, 2.5, -3.5
#: The most an element passes on to those within it, so that an advert within an article stays an advert.
PASSED_ON = 1.0
#: Score from which an element is main text as a whole; what interrupts it costs next to nothing, so that
#: the region goes on behind a long form or table.
MAIN, INTERRUPTION = 1.0, -0.001


class Frame:
    """An open element: its names, and the element around it."""

    __slots__ = ("around", "main", "name", "names", "score")

    def __init__(self, name: str, names: tuple[str, ...], around: Frame | None):
        self.name, self.names, self.around = name, names, around
        self.score, self.main = 0.0, False


@dataclass(frozen=True)
class Weights:
    """What names say for or against main text, and the cost of a tag by its name."""

    start: float
    name: dict[str, float]
    tag: dict[str, float]
    other_tag: float

    def says(self, name: str) -> float:
        """A whole name as learned. A compound one says what its last part says against main text, else the mean
        of its parts, and half of it if the last part, which tells what it is, is not known: alert-systems."""
        if name in self.name or name[0] != ".":
            return self.name.get(name, 0.0)
        parts = [f".{x}" for x in PART.findall(name) if x not in STRUCTURE]
        if not parts:
            return 0.0
        mean = sum(self.name.get(x, 0.0) for x in parts) / len(parts)
        return min(mean, self.name[parts[-1]]) if parts[-1] in self.name else mean / 2

    def of_names(self, names: tuple[str, ...]) -> float:
        found = [w for w in map(self.says, names) if abs(w) >= TELLING]
        best = min(MOST_FOR, max([0.0, *found]))
        return best + max(MOST_AGAINST, sum(w for w in found if w < 0))

    def place(self, frame: Frame, known: dict[tuple[str, ...], float]) -> None:
        """Score of the words of an element: what it gets from around it, and what its own names say."""
        if frame.names not in known:
            known[frame.names] = self.of_names(frame.names)
        above = frame.around.score if frame.around else self.start
        frame.score = max(-3.0, min(2.0, min(PASSED_ON, above) + known[frame.names]))
        frame.main = frame.around is not None and frame.around.main or frame.score >= MAIN


def events(html: str) -> Iterator[tuple[str, str, Frame, int]]:
    """Texts and tags in order: (kind "text" / "open" / "close" / "single", characters or name, element, place).
    The element of a start tag is the new one. Linear in the length of the page: an element holds its own
    names only, and an end tag that nothing open has is found by a count."""
    top = Frame("", (), None)
    stack, opened = [top], Counter()

    def leave() -> None:
        opened[stack.pop().name] -= 1

    for m in TOKEN.finditer(html):
        if m[3] is None:
            if m[0][0] != "<" or m[0] == "<":
                yield "text", m[0], stack[-1], m.start()
            continue
        name = m[3].lower()
        if m[2]:
            yield "close", name, stack[-1], m.start()
            if opened[name]:
                while stack[-1].name != name:
                    leave()
                leave()
        elif name in VOID or m[4].endswith("/"):
            yield "single", name, stack[-1], m.start()
        else:
            if name not in INLINE:
                ends = CLOSES.get(name, ())
                while stack[-1].name in ends or stack[-1].name == "p":
                    leave()
            own = [] if name in INLINE or name in FORMAT else [name]
            if m[4]:
                own += sorted({f".{x}" for a in NAMES.findall(m[4]) for x in "".join(a).lower().split()})
            stack.append(Frame(name, tuple(own), stack[-1]))
            opened[name] += 1
            yield "open", name, stack[-1], m.start()


def learn(pages: tuple = LABELLED) -> Weights:
    """Log-odds of main text against the rest: of words by the names around them, of tags by their name. A word of
    the rest counts against the elements that began in the rest, not against the article around them."""
    words, tags, totals = (Counter(), Counter()), (Counter(), Counter()), [0, 0]
    for page in pages:
        ends, at = [], 0
        for piece, label in page:
            at += len(piece)
            ends.append((at, label))
        began: dict[Frame, int] = {}
        for kind, value, frame, place in events("".join(p for p, _ in page)):
            label = next(x for end, x in ends if place < end)
            if kind == "open":
                began[frame] = label
            if kind != "text":
                tags[label][value] += 1
            elif n := len(value.split()):
                totals[label] += n
                around = set()
                while frame.around:
                    if label or not began[frame]:
                        around.update(frame.names)
                        around.update(f".{x}" for w in frame.names if w[0] == "." for x in PART.findall(w))
                    frame = frame.around
                words[label].update({f: n for f in around})
    names = set(words[0]) | set(words[1])
    name = {f: log((words[1][f] + 0.5) / (totals[1] + 1)) - log((words[0][f] + 0.5) / (totals[0] + 1)) for f in names}
    n = [sum(t.values()) for t in tags]
    tag = {t: min(-0.05, 0.25 * (log((tags[1][t] + 1) / (n[1] + 1)) - log((tags[0][t] + 1) / (n[0] + 1)))) for t in set(tags[0]) | set(tags[1])}
    return Weights(log(totals[1] / totals[0]), name, tag, -0.25)


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and past-last place of the contiguous stretch with the largest sum, by one scan; (0, 0) if no sum
    is positive. Of equal sums the one that ends first, begun as late as it can be."""
    best = total = 0.0
    region, begin = (0, 0), 0
    for i, score in enumerate(scores):
        total += score
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, region = total, (begin, i + 1)
    return region


def scored(html: str, weights: Weights) -> list[tuple[str, str, float, float]]:
    """(kind, characters or name, score in the scan, score of a word there) of all tokens of a page. Words score by
    their element, also below zero, so that a menu ends a region; tags cost. Inside main text both costs are small."""
    known: dict[tuple[str, ...], float] = {}
    top, out = None, []
    for kind, value, frame, _ in events(html):
        if top is None:
            top = frame if frame.around is None else frame.around
            top.score = weights.start
        if kind == "open":
            weights.place(frame, known)
        if kind == "text":
            n = len(value.split())
            score = frame.score * n if frame.score > 0 or not frame.main else min(n, 1) * INTERRUPTION
        else:
            score = INTERRUPTION if frame.main else weights.tag.get(value, weights.other_tag)
        out.append((kind, value, score, frame.score))
    return out


def main_text(html: str, weights: Weights) -> str:
    """The blocks of the best region without the interruptions in it, joined by line ends."""
    found = scored(html, weights)
    first, last = best_region([score for _, _, score, _ in found])
    blocks, held = [], []

    def close() -> None:
        if held and (text := " ".join("".join(held).split())):
            blocks.append(text)
        held.clear()

    for kind, value, _, word in found[first:last]:
        if kind == "text":
            if word > 0:
                held.append(unescape(value))
        elif value == "br":
            held.append(" ")
        elif value not in INLINE:
            close()
    close()
    return "\n".join(blocks)


def extract(pages: DataFrame, html_col: str = "html", text: str = "text", n_chars: str = "n_chars", weights: Weights | None = None) -> DataFrame:
    """`pages` with the main text of the whole html and its length in code points. NULL, empty and broken pages
    without main text give the empty text; an empty table gives no rows, equal rows stay apart. Columns that are
    called like the new ones stay, and the new ones get underscores before their names."""
    text = fresh(pages, text)
    n_chars = fresh(pages, n_chars)
    fitted, place = weights or learn(), pages.columns.index(html_col)

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        texts = [main_text(h, fitted) for h in texts_of(batch.column(place))]
        return {text: texts, n_chars: [len(t) for t in texts]}

    return with_columns(pages, run, f"`{text}` string, `{n_chars}` long")


def pages_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page; equal rows stay apart."""
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return extract(slim).drop("html")
