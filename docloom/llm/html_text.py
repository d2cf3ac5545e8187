"""Operator 9, HTML extraction by line-block distribution.

A page is stripped of markup into lines, one for each block element. What site elements hold (nav, header, footer, aside, menu) and
dialogs, buttons, scripts, hidden elements and reader comments is left out; where site elements stood, and at
the border of article and main elements, BLOCK empty lines mark the break. A line's size is its text outside of articles
less the text of its links, as menus are links. The sizes of BLOCK lines from each line on are summed. Where a sum surges to
SURGE characters a region is found; it reaches back to the line after the last sum of 0, and on to where the sum dives to
0. The lines from the first region's surge to the last one's dive are kept, all that have text.

Forms, noscript, object and canvas, and elements whose class, id or role says advert, menu, notice and the like are marked: each
outermost one is a run of lines of its own, whose sizes count one in MARKED, kept if its sums surge. A mark is told by whole words
of a name ("cookie-banner", not "no-sidebar", "post-header" or "related-work"), and it is void where the element holds an article or
main, or, on a page with no article outside of marks, more than half of the text and SURGE characters.

Defined results: null or empty html, or html without text: '' and 0; no sum that surges: the region with most
text, the first of equals; unclosed elements end with their parent; a tag whose quotes do not close ends at its first '>', and
quotes are not heeded from there on; the text of math is text; svg, iframe, template and textarea have none;
repeated rows give the same; an empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import small_batches, table

BLOCK, SURGE = 3, 100  # lines in a sum; characters at which it opens a region
MARKED = 16  # so many characters of a marked element count as one

# Element names and the words of class, id and role by which an element is told.
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea svg iframe".split())
#: Parts of the site, at which the text breaks off; the other dropped elements may stand within it.
SITE = frozenset("nav header footer aside menu".split())
DROPPED = frozenset("head title nav header footer aside menu button select dialog".split())
MARKED_NAMES = frozenset("form noscript object canvas".split())
WORDS = frozenset("ad ads adbox adsense banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent notice notification popup modal newsletter subscribe share sharing social related recommended login search widget pagination pager toolbar skip complementary contentinfo".split())
STEMS = ("advert", "sponsor", "promo")
DISCUSSION = frozenset("comment comments commentlist replies respond disqus".split())
#: What may stand beside these words in a name; with another word beside it a name says something else.
BESIDE = frozenset("site page global main top bottom left right primary secondary box bar list item items block area wrap wrapper container inner outer section row slot unit links link buttons button posts articles news content text message body form panel group sticky fixed overlay thread".split())
NOT = frozenset("no not has with without hide is".split())
OF_AN_ARTICLE = frozenset("header banner masthead".split())  # within one these are its own
ALWAYS = frozenset("html body article main".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = BLOCKS - {"br", "option", "body", "html", "head"}

QUOTE_OR_END = re.compile("[>\"']")
NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"\bhidden\b(?!\s*=)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^\W\d_]+")


@lru_cache(4096)
def said(name: str, in_article: bool) -> int:
    """What a name of class, id or role says: 2 reader comments, 1 another part that is not text, 0 nothing."""
    parts = [x.lower() for x in PARTS.findall(name)]
    if not parts or parts[0] in NOT:
        return 0
    known = [x in WORDS and not (in_article and x in OF_AN_ARTICLE) or x.startswith(STEMS) for x in parts]
    talk = [x in DISCUSSION for x in parts]
    whole = all(k or t or x in BESIDE or x in WORDS for k, t, x in zip(known, talk, parts, strict=True))
    if talk[-1] or any(talk) and whole:
        return 2
    return int(whole and any(known))


def dropped(name: str, tag: str, in_article: bool = False) -> int:
    """2: an element is left out; 1: it is marked."""
    if name in DROPPED:
        return 2
    marked = int(name in MARKED_NAMES)
    if name in ALWAYS or "=" not in tag and "hidden" not in tag.lower():
        return marked
    for m in MARKS.finditer(tag):
        for word in (m[1] or m[2] or m[3] or "").split():
            if len(word) <= 100:
                marked = max(marked, said(word, in_article))
    if marked == 2 or HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", lambda m: m.group() if "none" in m.group() or "true" in m.group() else '""', tag)):
        return 2
    return marked


def tags(page: str) -> Iterator[tuple[int, int]]:
    """Start and end of every tag, comment and declaration, in one pass: what does not close is not searched for twice."""
    at, quotes, size = page.find("<"), True, len(page)
    while 0 <= at < size - 1:
        end = None
        nxt = page[at + 1]
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4) + 3
        elif page.startswith("<![CDATA[", at):
            end = page.find("]]>", at) + 3
        elif nxt in "!?":
            end = page.find(">", at) + 1
        elif (nxt.isascii() and nxt.isalpha()) or (nxt == "/" and page[at + 2 : at + 3].isascii() and page[at + 2 : at + 3].isalpha()):
            here = at + 1
            while quotes and (m := QUOTE_OR_END.search(page, here)):
                if m.group() == ">":
                    end = m.end()
                    break
                here = page.find(m.group(), m.end()) + 1
                if not here:
                    break
            if end is None:
                quotes, end = False, page.find(">", at) + 1
        if end is not None:
            end = end if end > at else size  # to the end of the page
            yield at, end
            at = page.find("<", end)
        else:
            at = page.find("<", at + 1)


Line = tuple[str, bool, int, bool, int]  # text, in an article, characters outside of links, after a break, innermost mark (0: none)


def lines(page: str, marks: list[tuple[int, bool]] | None = None) -> Iterator[Line]:
    """The lines of a page. marks gets, for each mark in page order, the mark around it (0: none) and whether it holds an article."""
    marks = [] if marks is None else marks
    open_: list[tuple[str, bool, int]] = []  # name, dropped, the mark around a marked element (-1: not marked)
    mark = 0
    many: dict[str, int] = {}  # how many elements of a name are open
    buffer: list[str] = []
    bad = articles = at = links = free = 0  # free: characters of the line outside of links
    broken = False

    def flush() -> list[Line]:
        nonlocal broken, free
        text = " ".join(references.unescape("".join(buffer)).split())
        outside, before = free, broken
        buffer.clear()
        free = 0
        if not text:
            return []
        broken = False
        return [(text, articles > 0, min(outside, len(text)), before, mark)]

    def close(upto: int) -> None:
        nonlocal bad, articles, links, broken, mark
        while len(open_) > upto:
            name, was_bad, around = open_.pop()
            mark = around if around >= 0 else mark
            many[name] -= 1
            bad -= was_bad
            links -= name == "a"
            if name in ("article", "main"):
                articles -= 1
            if was_bad and not bad and not articles and name in SITE:
                broken = True

    for start, end in [*tags(page), (len(page), len(page))]:
        if start < at:  # within a script or the like
            continue
        raw = page[at:start]
        if raw and not bad:
            buffer.append(raw)
            free += 0 if links else len(raw.strip())
        at, tag = end, page[start:end]
        if not (n := NAME.match(tag)):
            if tag.startswith("<![CDATA[") and not bad:
                buffer.append(references.escape(tag[9:-3]))
                free += len(tag) - 12
            continue
        name = n.group(1).lower()
        if tag.startswith("</"):
            if name in BLOCKS:
                yield from flush()
            if many.get(name):
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k][0] == name:
                        if name not in BLOCKS and (open_[k][1] or open_[k][2] >= 0):
                            yield from flush()
                        close(k)
                        break
                    if open_[k][0] in ("article", "main", "td", "table") and name not in ("article", "main", "table", "body", "html", "div", "section"):
                        break
            continue
        if name in BLOCKS:
            yield from flush()
            if name in ENDS_P and name != "p":
                for k in range(len(open_) - 1, max(-1, len(open_) - 5), -1):
                    if open_[k][0] in ("article", "main", "td", "div"):
                        break
                    if open_[k][0] == "p":
                        close(k)
                        break
            if name in CLOSES:
                for k in range(len(open_) - 1, max(-1, len(open_) - 4), -1):
                    if open_[k][0] in CLOSES[name]:
                        close(k)
                        break
                    if open_[k][0] in ("ul", "ol", "dl", "table", "article", "main", "div", "section", "td"):
                        break
        if name in VOID or tag.endswith("/>"):
            continue
        if name in RAW:
            found = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            at = (page.find(">", found.end()) + 1 or len(page)) if found else len(page)
            continue
        how = 0 if name == "header" and articles else dropped(name, tag, articles > 0)
        is_bad = how == 2
        if how:
            yield from flush()
        if is_bad and not bad and not articles and name in SITE:
            broken = True
        if name in ("article", "main") and mark and not bad:
            up = mark
            while up and not marks[up - 1][1]:
                marks[up - 1] = (marks[up - 1][0], True)
                up = marks[up - 1][0]
        open_.append((name, is_bad, mark if how == 1 else -1))
        if how == 1:
            marks.append((mark, False))
            mark = len(marks)
        many[name] = many.get(name, 0) + 1
        bad += is_bad
        links += name == "a"
        articles += name in ("article", "main")
    yield from flush()


def regions(page: list[Line], surge: int = SURGE) -> tuple[int, int]:
    """The first line that is kept, and the one after the last."""
    sizes, where = [], []
    for k, (text, article, free, after, _) in enumerate(page):
        if k and (after or article != page[k - 1][1]):
            sizes += [0] * BLOCK
            where += [k] * BLOCK
        sizes.append(len(text) if article else free)
        where.append(k)
    sums = [sum(sizes[i : i + BLOCK]) for i in range(len(sizes))]
    found: list[tuple[int, int, int, int]] = []  # start, dive, highest sum, text
    i = 0
    while i < len(sums):
        if not sums[i]:
            i += 1
            continue
        start, top = i, 0
        while i < len(sums) and sums[i]:
            top = max(top, sums[i])
            i += 1
        first = next(k for k in range(start, i) if sizes[k])
        found.append((first, i, top, sum(sizes[first:i])))
    kept = [x for x in found if x[2] >= surge] or [max(found, key=lambda x: x[3])] if found else []
    return (where[kept[0][0]], where[kept[-1][1] - 1] + 1) if kept else (0, 0)


def outermost(page: list[Line], marks: list[tuple[int, bool]]) -> list[int]:
    """Each line's outermost mark that holds, or 0."""
    size = [0] * (len(marks) + 1)
    for text, _, _, _, mark in page:
        size[mark] += len(text)
    for m in range(len(marks), 0, -1):
        size[marks[m - 1][0]] += size[m]
    articles = any(article and not mark for _, article, _, _, mark in page) or any(holds for _, holds in marks)
    top = [0] * (len(marks) + 1)
    for m, (around, holds) in enumerate(marks, 1):
        void = holds or not articles and 2 * size[m] > size[0] and size[m] >= SURGE
        top[m] = top[around] or (0 if void else m)
    return [top[line[4]] for line in page]


def kept(page: str, surge: int = SURGE) -> list[str]:
    """The lines of a page's text."""
    marks: list[tuple[int, bool]] = []
    found = list(lines(page, marks))
    runs: dict[int, list[int]] = {}
    plain, broken = [], False
    for k, top in enumerate(outermost(found, marks)):
        broken |= found[k][3]
        runs.setdefault(top, []).append(k)
        if not top:
            plain.append((*found[k][:3], broken, 0))
            broken = False
    own = runs.pop(0, [])
    first, after = regions(plain, surge)
    out = own[first:after]
    for run in runs.values():
        sizes = [found[k][2] for k in run]
        if any(sum(sizes[i : i + BLOCK]) >= surge * MARKED for i in range(len(sizes))):
            out += run
    return [found[k][0] for k in sorted(out)]


def main_text(page: str | None, surge: int = SURGE) -> str:
    return " ".join(kept(page, surge)) if page else ""


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    small_batches(pages.sparkSession)

    def run(it):
        for b in it:
            texts = [main_text(x) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return given.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


QUERIES = {"op9_html_text": op9_html_text}
