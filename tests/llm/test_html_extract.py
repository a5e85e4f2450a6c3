from __future__ import annotations

import difflib
import random

import pytest
from pyspark.sql import SparkSession

from corpusloom.llm import html_extract

PAGES = "page_id long, url string, html string, lines string, host string, text string"


def _text(spark: SparkSession, html: str | None, url: str = "http://a/b") -> str:
    df = spark.createDataFrame([(1, url, html, "x", "y", "z")], PAGES)
    ((row),) = html_extract.extract(df).collect()
    return row["text"]


WHOLE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li>Menu</li></ul></nav><div class="cookie-notice">We use cookies</div><aside>Side</aside><!-- <p>no</p> -->
<article><header><h1>A &amp; B&nbsp;caf&eacute; &#x263A;</h1></header><p>One <b>two</b>
 three.<br>Four</p><div class="ad">Buy</div><form><input value="q">Search</form><p>Fi<i>ve</i> 1 &lt; 2 <p>Six<script>x</script></p><section class="comments"><p>First!</p></section></article>
<footer>&copy; Site</footer><div id="comments"><p>Reader</p></div></body></html>"""


def test_article_without_the_rest(spark: SparkSession) -> None:
    assert _text(spark, WHOLE) == "A & B café ☺ One two three. Four Five 1 < 2 Six"


@pytest.mark.parametrize("html", [None, "", "<html><body></body></html>", "<nav>menu</nav><footer>foot</footer>", "<script>never closed <p>text</p>", "<!-- open"])
def test_pages_without_text(spark: SparkSession, html: str | None) -> None:
    assert _text(spark, html) == ""


def test_differencing_deletes_what_neighbours_share(spark: SparkSession) -> None:
    page = lambda i: f"<body><p>Welcome to our site</p><p>Story {i} begins here</p><p>It goes on {i * 7}</p><p>All rights reserved</p></body>"
    rows = [(i, f"https://Host.example/{p}?x={i}", page(i), "x", "y", "z") for i, p in enumerate(("a/1", "a/2", "b/1", "b/2"))]
    rows += [(9, "https://other.example/a/1", page(9), "x", "y", "z"), (10, None, page(10), None, None, None)]
    found = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for i in range(4):
        assert found[i] == f"Story {i} begins here It goes on {i * 7}"
    assert found[9] == "Welcome to our site Story 9 begins here It goes on 63 All rights reserved"  # alone on its host
    assert len(found) == 6


def test_mirrors_keep_their_lines(spark: SparkSession) -> None:
    rows = [(i, f"http://h/{i}", "<body><p>Same story</p><p>on two urls</p></body>", "", "", "") for i in range(2)] * 2
    found = html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert [r["text"] for r in found] == ["Same story on two urls"] * 4


def test_shared_lines_are_a_longest_common_subsequence() -> None:
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randrange(12))] for _ in range(2))
        mask = html_extract.shared(a, b)
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        kept = [x for x, m in zip(a, mask, strict=True) if m]
        assert len(kept) == table[-1][-1]
        rest = iter(b)
        assert all(x in rest for x in kept)
    assert difflib.SequenceMatcher(None, "a", "a").ratio() == 1.0


def test_whole_table_and_empty_table(spark: SparkSession, sf_dir: str) -> None:
    rows = html_extract.op7_html_difference(spark, sf_dir).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages) and {r["page_id"] for r in rows} == set(pages)
    for r in rows:
        assert r["n_chars"] == len(r["text"]) > 0
        assert "<" not in r["text"] and "track(" not in r["text"] and "&copy;" not in r["text"]
    assert html_extract.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_story_outside_the_article_elements_is_kept(spark: SparkSession) -> None:
    """Article elements are only teasers here: the story stands in a div, and what the pages share outside is deleted."""
    page = lambda i: f"<body><p>Welcome</p><div><p>Story {i}</p></div><article>Teaser {i}</article><article>Same teaser</article><p>Rights</p></body>"
    rows = [(i, f"http://h/{i}", page(i), "", "", "") for i in range(4)]
    found = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {i: f"Story {i} Teaser {i} Same teaser" for i in range(4)}


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_pages_of_a_large_host_meet_their_nearest_url(spark: SparkSession, parts: int) -> None:
    """A host with over a thousand pages in sections of three: each section's own menu is shared only by neighbouring paths, and goes."""
    page = lambda i: f"<body><p>Menu of section {i // 3}</p><p>Story {i}</p></body>"
    rows = [(i, f"http://h/{i // 3:04d}/{i % 3}", page(i), "", "", "") for i in range(1200)]
    found = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, PAGES), parts).collect()}
    assert found == {i: f"Story {i}" for i in range(1200)}


def test_large_hosts_by_the_default_ranges(spark: SparkSession) -> None:
    page = lambda i: f"<body><p>Menu of section {i // 3}</p><p>Story {i}</p></body>"
    rows = [(i, f"http://h/{i // 3:04d}/{i % 3}", page(i), "", "", "") for i in range(1200)]
    found = html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert {r["text"] for r in found} == {f"Story {i}" for i in range(1200)}


BROKEN = [
    ('<div class="content share-enabled"><article><p>Main text</p></article></div>', "Main text"),
    ('<div id="page" class="site right-sidebar comments-open"><main><p>Main text</p></main></div>', "Main text"),
    ('<div class="sidebar-layout"><p>Lead</p><article><p>A long main text here</p></article><p>End</p></div>', "Lead A long main text here End"),
    ('<article><p id="ad-hoc">Ad hoc.</p><h2 id="related-work">Related work</h2><p>Text</p></article>', "Ad hoc. Related work Text"),
    ('<article><p>One.<p class="promo">Buy now<p>Two body text.<p>Three.</article>', "One. Two body text. Three."),
    ('<article><ul><li class="related">X<li>Real point</ul><p>After list.</article>', "Real point After list."),
    ('<article><div class="ad">Buy</span></section></div><p>Text</p></article>', "Text"),
    ('<form id="whole"><article><p>Inside a page form</p><form>Search</form></article></form>', "Inside a page form"),
    ('<article><p>Story of some length</p></article><div class="related"><article>Teaser</article></div><section class="comments"><article>First!</article></section>', "Story of some length"),
    ('<table><tr><td class="ad">Buy<td>Cell<tr><td>Next</table><p>End', "Cell Next End"),
    ("<head><meta charset=utf-8><p>No body tag</p>", "No body tag"),
    ('<nav><ul><li>Menu</nav><p>Text', "Text"),
    ('<article><p class="share-price">Shares rose 5%.</p><div class="related-work"><p>Earlier studies.</p></div><table class="navigation-data"><tr><td>12 knots</table></article>', "Shares rose 5%. Earlier studies. 12 knots"),
    ('<article><p>Story.</p></article><div class="comments"><article>A comment that is much longer than the story itself, by far.</article></div>', "Story."),
    ('<article><p>Story.</p></article><article class="comment">A comment that is much longer than the story itself, by far.</article>', "Story."),
    ('<article class="comment">Only this one is here.</article>', "Only this one is here."),
    ('<div class="comments"><article>First comment, long enough.</article></div><div class="sidebar-layout"><article>Story.</article></div>', "Story."),
    ('<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> be.</p></article>', "Let x=2 be."),
    ('<article><p>Text</p><div class="more-related-here"><a href=1>One link</a> <a href=2>Two</a></div><div class="more-related-here">One fact <a href=1>x</a></div></article>', "Text One fact x"),
    ('<article><p>Text</p><div class="related-posts"><p>Other story</p></div><ul class="social-links"><li>Like</ul><div class="ad-slot">Buy</div></article>', "Text"),
    ('<main class="nav-main"><p>Text</p><div class="newsletter-box">Join</div></main>', "Text"),
    ('<article><h2 class="title share">Kept? no</h2><h2 class="share-title">Kept</h2></article>', "Kept"),
    ('<article><blockquote class="social-history">Old times</blockquote><section id="notice-and-takedown"><p>Law</p></section></article>', "Old times Law"),
    ('<article><p>One</p><article class="related">Teaser</article><p>Two</p></article>', "One Two"),
    ('<div class="content"><p>Lead</p><div id="comment-list"><p>Reader</p></div></div>', "Lead"),
    ('<article><div class="commentary"><p>The commentary</p></div><div class="advice">Do this</div></article>', "The commentary Do this"),
]


@pytest.mark.parametrize(("html", "want"), BROKEN)
def test_broken_and_odd_markup(html: str, want: str) -> None:
    assert " ".join(html_extract.lines(html)[0]) == want


def _plain(rows: list[tuple]) -> dict:
    """Each page's nearest URL by comparing it with all pages of its host, and the lines that a plain table of both pages leaves."""
    out = {}
    parts = {}
    for i, url, html in rows:
        rest = (url or "").split("://", 1)[-1]
        host, _, path = rest.partition("/")
        parts[i] = (host.split("?")[0].split("#")[0].lower(), ("/" + path if _ else "").split("?")[0].split("#")[0], html_extract.lines(html or ""))
    for i, (host, path, (own, open_)) in parts.items():
        before = [(p, j) for j, (h, p, _) in parts.items() if h == host and (p, j) < (path, i)]
        after = [(p, j) for j, (h, p, _) in parts.items() if h == host and (p, j) > (path, i)]
        alike = lambda x: len([1 for k in range(min(len(x[0]), len(path))) if x[0][: k + 1] == path[: k + 1]])  # noqa: B023, E731
        near = ([max(before)] if before else []) + ([min(after)] if after else [])
        if not near:
            out[i] = " ".join(own)
            continue
        other = parts[max(near, key=alike)[1]][2][0]
        gone = html_extract.shared(own, other)
        kept = [x for x, g, o in zip(own, gone, open_, strict=True) if not g or not o]
        out[i] = " ".join(kept or own)
    return out


def test_against_a_plain_version(spark: SparkSession, sf_dir: str) -> None:
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    found = {r["page_id"]: r["text"] for r in html_extract.op7_html_difference(spark, sf_dir).collect()}
    assert found == _plain(rows)
    rng = random.Random(4)
    rows = [(i, f"http://h{rng.randrange(3)}/{rng.choice('ab')}/{rng.choice('cd')}{rng.randrange(40)}", "".join(f"<p>{rng.choice(['Menu', 'Rights', 'Next', f'Story {i}', f'More {i}', 'Old'])}</p>" for _ in range(rng.randrange(8)))) for i in range(300)]
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], PAGES)
    assert {r["page_id"]: r["text"] for r in html_extract.extract(df, 9).collect()} == _plain(rows)
