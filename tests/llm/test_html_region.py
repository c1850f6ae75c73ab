from __future__ import annotations

import random
import re
import time

import pytest

from panelops.llm import html_region as hr

W = hr.learn()
ARTICLE = "<h1>On &amp; on</h1><p><b>First  line<br>\n goes</b> here.<p>One.</p><ul><li>An item</li></ul><p>caf&eacute; &#x41;</p>"
TEXT = "On & on\nFirst line goes here.\nOne.\nAn item\ncafé A"
BEFORE = "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t='</p><p>no';</script></head><body><nav><ul><li><a href='/x'>Menu words</a></li></ul></nav><!-- ad <p>no</p> --><div class=\"ad\">Buy this thing today, it is on sale for you.</div>"
AFTER = "<div class='comments'><p>I liked reading this very much, thanks to all of you.</p></div><footer>&copy; site &middot; Footer words that are not few at all.</footer></body></html>"


@pytest.mark.parametrize("tag", ["<article>{}</article>", "<main>{}</main>", "<div id='content'>{}</div>"])
def test_article_without_the_rest(tag):
    assert hr.main_text(BEFORE + tag.format(ARTICLE) + AFTER, W) == TEXT


def test_advert_and_form_within_the_article():
    inner = ARTICLE + "<div class='ad'><p>Cheap things for sale now.</p></div><form><label>Your mail</label></form><p>The end.</p>"
    assert hr.main_text(f"<body><article>{inner}</article></body>", W) == TEXT + "\nThe end."


BODY = "<h1>On it</h1><p>Some words of the text that go on.</p>{}<p>The end.</p>"
WITHIN = ["<article>{}</article>", "<body><div class='page'><main class='article'><article>{}</article></main></div>", "<div class='post-content'>{}</div>", "<body><header><h1>Site</h1></header><main>{}</main>"]
CUT = [
    "<form><p>Sign up now for more</p></form>", "<nav><p>Contents</p></nav>", "<aside><p>Side words</p></aside>", "<button>Go</button>",
    "<section id='comments'><p>I like it a lot</p></section>", "<section id=comments><article class=comment><p>nice words</p></article></section>",
    "<form><table><tr><td>one<td>two</table></form>", "<div class='ad-banner'><h2>Buy it</h2></div>", "<footer><p>x y</p></footer>",
    "<select><option>a<option>b</select>", "<div role=navigation><ul><li>a</ul></div>", "<aside>" + "<p>many words are here</p>" * 300 + "</aside>",
]
KEPT = [
    "<div class='article-header'><p>{}</p></div>", '<section class="alert-systems"><p>{}</p></section>', "<header><h1>{}</h1></header>",
    "<h4><a href=x>{}</a></h4>", "<ul><li><a>{}</a></li></ul>", "<table><tr><td>{}</td></tr></table>", "<details><summary>{}</summary></details>",
]


@pytest.mark.parametrize("around", WITHIN)
def test_parts_within_the_article(around):
    for part in CUT:
        assert hr.main_text(around.format(BODY.format(part)), W) == "On it\nSome words of the text that go on.\nThe end.", part
    for part in KEPT:
        got = hr.main_text(around.format(BODY.format(part.format("Lead of the story"))), W)
        assert got == "On it\nSome words of the text that go on.\nLead of the story\nThe end.", part


def test_best_region_by_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        scores = [rng.randint(-4, 4) for _ in range(rng.randint(0, 14))]
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        first, last = hr.best_region(scores)
        assert sum(scores[first:last]) == max([0, *sums])


def test_the_region_decides():
    """Words that score for main text, but stand behind a menu that costs more, are not in the region."""
    page = f"<body><div><p>Plain words of a page head.</p></div><nav><a>Home</a><a>World</a><a>Sport</a></nav><article>{ARTICLE}</article></body>"
    assert hr.main_text(page, W) == TEXT
    assert any(kind == "text" and word > 0 and "page head" in value for kind, value, _, word in hr.scored(page, W))


def test_held_out_pages():
    for k, page in enumerate(hr.LABELLED):
        fitted = hr.learn(hr.LABELLED[:k] + hr.LABELLED[k + 1:])
        want = {x for piece, label in page if label for x in re.sub("<[^>]*>", " ", piece).split()}
        got = set(hr.main_text("".join(piece for piece, _ in page), fitted).split())
        assert len(want & got) / len(want | got) > 0.5


def test_nested_markup_is_linear():
    page = "".join(f"<div class='c{i}'>" for i in range(20000)) + "x" + "</span>" * 20000
    begin = time.perf_counter()
    hr.main_text(page, W)
    assert time.perf_counter() - begin < 5


@pytest.mark.parametrize("html", ["", "<p", "<", "<<<", "</p></div>", "<a href='x", "<!-- open", "<script>x", "&", "<p>" * 3000])
def test_broken_markup(html):
    assert "<p" not in hr.main_text(html, W)


def test_rows(spark):
    rows = [(1, "u", BEFORE + f"<article>{ARTICLE}</article>"), (2, None, None), (2, None, None), (None, "v", ""), (3, "w", f"<article><p>{'word ' * 50000}</p></article>")]
    pages = spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, html string, text long")
    got = hr.pages_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.n_chars) for r in got.collect()) == [(0, 0), (1, len(TEXT)), (2, 0), (2, 0), (3, 249999)]
    assert hr.pages_text(pages.limit(0)).collect() == []
    beside = hr.extract(pages)
    assert beside.columns == [*pages.columns, "_text", "n_chars"] and {r.text for r in beside.collect()} == {7}
