"""Main text of HTML pages by nearest-URL page differencing, checked by the page's own structure.

A page is read into text lines, one for each block, in page order, without those of menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts and styles (by element, or by class, id and role words): they are never
main text, also where they differ from page to page. Outside an article such a word may stand anywhere in a name. Inside one a name must be that word
(`ad`) or that word and others for mere boxes (`related-posts`); other names with it (`related-work`, `share-price`) count only on a
wrapper whose text is mostly links. Running text (paragraphs, headings, items, cells) goes only if its class is the word itself.

The main article is the longest of the articles that nothing of the kind is around; only if there is none, the longest of
the others, those of readers' comments last. What is around the main article is never taken for boilerplate. Each page is paired with its nearest page by URL path within its host (of the
pages before and after it in path order the one with the longer common start, else the one before), the two pages' lines are aligned by longest common subsequence, and shared lines are
deleted as the host's boilerplate. Structure then restores shared lines inside article and main elements, so an
article under two URLs stays. Pages without such elements whose lines are all shared are mirrors of each other, which says
nothing about boilerplate, so they keep their lines. Lines outside the article stay if the neighbour lacks them: they may
be the story of a page whose article elements are only teasers.

Pages are sorted by host, path and page_id in ranges, and the first and last page of each range meet those of the
ranges beside it by a join, so every page meets its nearest URL however many pages its host has, and no host is gathered in one task. The bounds of the
ranges never decide the result.

Cases: a null html is an empty page, and a page without main text gives an empty text. A null url is of the empty host
and path. Repeated rows are neighbours of each other; as mirrors they keep their lines. Paragraphs, list items and table cells end
where the next one begins, other unclosed elements with the element around them or the page, end tags of nothing count for nothing; an unclosed script or style hides the rest. Character references are decoded once, also
those without a semicolon where HTML allows it. An empty table gives an empty result. Only page_id, url and
html are read.
"""

from __future__ import annotations

import html as _html
import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|noscript|template|textarea|select|svg|iframe|object|title|annotation|annotation-xml)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)(/?)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OWN = frozenset(("article", "main"))
#: Elements that never hold main text, and those that don't outside an article.
NEVER = frozenset("nav footer aside form menu button dialog head".split())
OUTSIDE = frozenset(("header",))
#: Words of class, id and role that mark such parts, anywhere and outside an article; and words that make a name a mere state.
NEVER_WORDS = frozenset("ad ads advert advertisement adverts advertising sponsor sponsored promo cookie cookies consent gdpr newsletter subscribe sidebar nav navbar navigation menu breadcrumb breadcrumbs pagination comment comments disqus related share sharing social popup modal notice footer".split())
OUTSIDE_WORDS = frozenset("header masthead banner toolbar topbar widget search login contentinfo complementary".split())
STATES = frozenset("is has no not with without enabled disabled open opened closed on off active inactive free ready allowed".split())
#: Words that only name a box: a name of these and a marking word is that word's box.
BOX_WORDS = frozenset("area bar block body bottom box btn button buttons col column container content contents entries form group head heading icons inner item items js label left link links list media module outer panel post posts right row section set slot stories story thread title tools top unit widget wrap wrapper wrapping".split())
COMMENT_WORDS = frozenset("comment comments disqus".split())
#: A wrapper inside an article with a doubtful name goes if so much of its text is links.
LINKS = 0.5
#: Elements of running text: only their classes count, as their ids name what they say.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption blockquote pre summary".split())
#: Rows of one answer's batch.
ROWS = 1000
#: What a start tag closes if it is open, and the elements past which it doesn't look.
_ROW, _TABLE = frozenset(("td", "th")), frozenset(("table",))
IMPLIED = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))), "dt": (frozenset(("dt", "dd")), frozenset(("dl",))), "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "td": (_ROW, _TABLE), "th": (_ROW, _TABLE), "tr": (_ROW | {"tr"}, _TABLE), "body": (frozenset(("head",)), frozenset()),
} | {x: (_ROW | {"tr", "tbody", "thead", "tfoot"}, _TABLE) for x in ("tbody", "thead", "tfoot")}
_P, _CELLS = frozenset(("p", "head")), frozenset(("table", "td", "th", "caption", "button"))


#: How sure a name is: no mark, one that links must confirm, a sure one, and one of readers' comments.
NONE, DOUBT, SURE, READERS = range(4)


def _marks(name: str, attributes: str, inside: bool) -> int:
    """Whether class, id or role words tell that an element is no main text."""
    found = NONE
    for a in _ATTRIBUTE.finditer(attributes):
        if (name in RUNNING or name in OWN) and a[1].lower() != "class":
            continue
        for one in (a[2] or a[3] or a[4] or "").split():
            words = {w.lower() for w in _WORDS.findall(one)}
            marking = words & NEVER_WORDS if inside or name in OWN else words & (NEVER_WORDS | OUTSIDE_WORDS)
            if not marking or words & STATES:
                continue
            if name in RUNNING or name in OWN:
                sure = len(words) == 1
            else:
                sure = not inside or words <= NEVER_WORDS | OUTSIDE_WORDS | BOX_WORDS
            if sure:
                found = max(found, READERS if marking & COMMENT_WORDS else SURE)
            elif name not in RUNNING and name not in OWN:
                found = max(found, DOUBT)
    return found


def lines(page: str) -> tuple[list[str], list[bool]]:
    """Text lines in page order and whether each is open (outside any article element). Lines of known boilerplate are left out."""
    page = _HIDDEN.sub(" ", page)
    found: list[tuple[str, int, int, int]] = []  # a line, its outermost article, its innermost boilerplate element (-1: none) and how many of its characters are links
    part: list[str] = []
    stack: list[tuple[str, int, int]] = []  # open blocks: name, and both of these inside it
    count: dict[str, int] = {}
    around: list[int] = []  # of each article: the boilerplate element that it is in
    above: list[int] = []  # of each boilerplate element: the next one outside it
    sure: list[int] = []  # and how sure it is
    own = bad = -1
    at = links = 0
    linked = False

    def flush() -> None:
        nonlocal links
        if part:
            text = " ".join(_html.unescape("".join(part)).split())
            part.clear()
            if text:
                found.append((text, own, bad, min(links, len(text))))
        links = 0

    def drop(depth: int) -> None:
        nonlocal own, bad
        for name, *_ in stack[depth:]:
            count[name] -= 1
        del stack[depth:]
        own, bad = stack[-1][1:] if stack else (-1, -1)

    def close(names: frozenset, stop: frozenset) -> None:
        """Drops the outermost open element of these names that no element of `stop` is around."""
        if any(count.get(n) for n in names):
            depth = None
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in names:
                    depth = i
                elif stack[i][0] in stop:
                    break
            if depth is not None:
                drop(depth)

    for m in _TAG.finditer(page):
        if m.start() > at:
            part.append(page[at : m.start()])
            links += (m.start() - at) * linked
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name == "a":
            linked = not m[1]
        if name not in BLOCKS and name != "button":
            continue
        flush()
        if name in VOID:
            continue
        if m[1]:
            if count.get(name):
                drop(max(i for i, x in enumerate(stack) if x[0] == name))
            continue
        if name in IMPLIED:
            close(*IMPLIED[name])
        if name not in ("html", "head", "body", "button"):
            close(_P, _CELLS)
        inside = own >= 0
        mark = SURE if name in NEVER or (not inside and name in OUTSIDE) else _marks(name, m[3], inside) if m[3] and name not in ("body", "html", "main") else NONE
        if mark:
            above.append(bad)
            sure.append(mark)
            bad = len(above) - 1
        if name in OWN and own < 0:
            around.append(bad)
            own = len(around) - 1
        stack.append((name, own, bad))
        count[name] = count.get(name, 0) + 1
    part.append(page[at:])
    flush()
    rest = _kept(found, around, above, sure)
    return [text for text, _ in rest], [o for _, o in rest]


def _kept(found: list[tuple[str, int, int, int]], around: list[int], above: list[int], sure: list[int]) -> list[tuple[str, bool]]:
    """The lines that no boilerplate element holds, and whether each is outside any article."""
    # doubtful elements without many links hold main text
    text_of, links_of = [0] * len(above), [0] * len(above)
    for text, _, b, links in found:
        while b >= 0:
            text_of[b] += len(text)
            links_of[b] += links
            b = above[b]
    real = [mark > DOUBT or links >= LINKS * max(1, size) for mark, size, links in zip(sure, text_of, links_of, strict=True)]

    def holder(b: int) -> int:
        while b >= 0 and not real[b]:
            b = above[b]
        return b

    def kind(b: int) -> int:
        """The surest mark around an article."""
        most = NONE
        while (b := holder(b)) >= 0:
            most, b = max(most, sure[b]), above[b]
        return most

    size = [0] * len(around)
    for text, o, b, _ in found:
        if o >= 0 and holder(b) == holder(around[o]):
            size[o] += len(text)
    kept = {-1}
    if size:
        main = min(range(len(size)), key=lambda o: (kind(around[o]) == READERS, kind(around[o]) != NONE, -size[o], o))
        b = holder(around[main])
        while b >= 0:
            kept.add(b)
            b = holder(above[b])
    return [(text, o < 0) for text, o, b, _ in found if holder(b) in kept]


def shared(a: list[str], b: list[str]) -> list[bool]:
    """Which lines of a are in a longest common subsequence with b, by a bit-parallel table of rows."""
    where: dict[str, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        rows.append(row)
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    rows.append(row)
    # a zero bit j of rows[i] is a step of the table's row i at column j: walk back from the end
    out, j = [False] * len(a), len(b)
    count = lambda r, n: n - (r & ((1 << n) - 1)).bit_count()
    for i in range(len(a), 0, -1):
        while j and count(rows[i], j - 1) == count(rows[i], j):
            j -= 1
        if j and count(rows[i - 1], j) < count(rows[i], j):
            out[i - 1] = True
            j -= 1
    return out


def _packed(text: list[str], open_: list[bool]) -> bytes:
    """Lines (which hold no line feed), each after a mark of whether it is open."""
    return zlib.compress("\n".join("ao"[o] + x for x, o in zip(text, open_, strict=True)).encode("utf-8", "replace"), 6)


def _unpacked(page: bytes) -> list[str]:
    return [x for x in zlib.decompress(page).decode().split("\n") if x]


def _parsed(pages: DataFrame) -> DataFrame:
    """Every page with its packed lines."""
    kind = dict(pages.dtypes)["page_id"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_packed(*lines(page or "")) for page in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(found, pa.binary())], ["page_id", "url", "page"])

    return pages.select("page_id", "url", "html").mapInArrow(make, f"page_id {kind}, url string, page binary")


def main_lines(page: bytes, other: bytes | None) -> list[str]:
    """A page's main text: its lines without those shared with the other page, but with all article lines; a mirror without any keeps its lines."""
    own = _unpacked(page)
    mask = shared([x[1:] for x in own], [x[1:] for x in _unpacked(other)]) if other is not None else [False] * len(own)
    kept = [x[1:] for x, m in zip(own, mask, strict=True) if not m or x[0] == "a"]
    return kept or [x[1:] for x in own]


def _alike(a: str, b: str) -> int:
    """The length of the common start of two paths."""
    return len(os.path.commonprefix([a, b]))


PLACE = ("host", "path", "page")
_PLACE = "struct<host:string,path:string,page:binary>"


def _nearest(own: tuple, others: list[tuple | None]) -> tuple | None:
    """Of the pages before and after one that of its host with the longer common start; the one before, if both are as near."""
    return max((x for x in others if x is not None and x[0] == own[0]), key=lambda x: _alike(own[1], x[1]), default=None)


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, tuple | None, tuple, tuple | None]]:
    """(batch, place in it, the page before, the page, the page after) of a range's rows; None where the range ends."""
    before: tuple | None = None
    now: tuple | None = None
    for b in batches:
        for i, place in enumerate(zip(*(b.column(c).to_pylist() for c in PLACE), strict=True)):
            if now is not None:
                yield now[0], now[1], before, now[2], place
                before = now[2]
            now = (b, i, place)
    if now is not None:
        yield now[0], now[1], before, now[2], None


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Main texts of the rows that have both neighbours in their range."""
    out: list[tuple] = []

    def taken() -> pa.RecordBatch:
        ids, urls, texts = zip(*out, strict=True)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(urls), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    for b, i, before, own, after in _triples(batches):
        if before is not None and after is not None:
            other = _nearest(own, [before, after])
            out.append((b.column("page_id").slice(i, 1), b.column("url").slice(i, 1), " ".join(main_lines(own[2], other and other[2]))))
        if len(out) >= ROWS:
            yield taken()
    if out:
        yield taken()


def _outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's first and last row with the neighbours that they have inside it."""
    struct = pa.struct([("host", pa.string()), ("path", pa.string()), ("page", pa.binary())])
    as_struct = lambda x: pa.array([None if x is None else dict(zip(PLACE, x, strict=True))], struct)
    for b, i, before, own, after in _triples(batches):
        if before is None or after is None:
            yield pa.RecordBatch.from_arrays([*b.slice(i, 1).columns, as_struct(own), as_struct(before), as_struct(after)], [*b.schema.names, "own", "before", "after"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = []
        for own, *others in zip(*(b.column(c).to_pylist() for c in ("own", "before", "after", "left", "right")), strict=True):
            own, *others = (None if x is None else tuple(x[c] for c in PLACE) for x in (own, *others))
            other = _nearest(own, [others[0] or others[2], others[1] or others[3]])
            texts.append(" ".join(main_lines(own[2], other and other[2])))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame, parts: int | None = None) -> DataFrame:
    """page_id, url and text of every row of pages (page_id, url, html)."""
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    kind = dict(pages.dtypes)["page_id"]
    order = [host, path, F.col("page_id"), F.col("page")]
    parts = parts or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # host and path are made from the url again where they are needed, so that they are neither shuffled nor written
    rows = cut(_parsed(pages).repartitionByRange(parts, *order[:3]).sortWithinPartitions(*order))
    rows = rows.select("page_id", "url", "page", host.alias("host"), path.alias("path"), F.spark_partition_id().alias("range"))
    schema = f"page_id {kind}, url string, text string"
    inner = rows.mapInArrow(_inner, schema)
    # at most two rows for each range, joined to those of the nearest ranges that hold any
    outer = cut(rows.mapInArrow(_outer, ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), f"own {_PLACE}, before {_PLACE}, after {_PLACE}"])))
    beside = Window.orderBy("range")
    ranges = outer.select("range").distinct().select("range", F.lag("range").over(beside).alias("previous"), F.lead("range").over(beside).alias("next"))  # a number for each range
    lasts = outer.where("after is null").select(F.col("range").alias("previous"), F.col("own").alias("left"))
    firsts = outer.where("before is null").select(F.col("range").alias("next"), F.col("own").alias("right"))
    ends = outer.join(ranges, "range").join(lasts, "previous", "left").join(firsts, "next", "left").select("page_id", "url", "own", "before", "after", "left", "right")
    return inner.unionByName(ends.mapInArrow(_ends, schema))


def op7_html_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
