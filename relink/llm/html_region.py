"""HTML extraction: the maximum-scoring contiguous region of a page.

A page is read as a line of events: words and tags. Words score positive and tags negative; the contiguous stretch of
greatest sum, found in one linear scan, is the content region. Its blocks, without what is no prose, are the text.

Weights. Pages that mark their content themselves (exactly one `article` or `main` element) are labelled pages: an event inside
that element is content, any other is not. Spark counts, over all labelled pages, how often each tag stands inside and
outside, and how many words do (events in skipped elements, below, are neither). A tag costs 1 plus the smoothed log-odds (base 2) of standing outside, times the words that a
page has outside for each tag there, so that a stretch of boilerplate costs more than its words bring however long it usually
is; at least 1/4 and no more than 64. A tag's name holds its class or id if that marks boilerplate (`div.ad`). The content
element's own tags are left out of the counts and cost 1/4, else the labels would be learned instead of what is in them; a tag
that no labelled page has costs what PRIOR says. A page that is labelled itself has its label: a tag inside its content
element costs WITHIN only, a word outside scores -1.

Boilerplate that can stand inside an article is told by its element: words in the elements of SKIPPED, in an element whose
class, id or role has a mark of MARKS, or in a hidden element, score nothing and are no part of the text (a `header` inside the
content element keeps its headings). Comments, doctypes, scripts, styles and other raw elements are no events.

Text. The region's words are put together by blocks: every block tag ends a block, as does `br`; character references are
decoded once, white space becomes one blank, empty blocks vanish, blocks are joined by one line end, in page order. Nothing
else is dropped: a heading or paragraph that repeats stays.

Broken markup: an unknown or unclosed tag is an event like any other; an element that is never closed ends with its parent; a
`<` that starts no tag is text; an unclosed comment, script or style goes on to the page's end.

Defined results: null and empty pages, and pages without a word outside skipped elements, give an empty text and n_chars 0;
repeated rows give repeated rows; no pages give no rows; without labelled pages the PRIOR weights are used. Only page_id, url
and html are read, so other columns can't clash.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, written

#: Elements whose content is markup or code, not text: the tag goes on to its own end tag.
RAW = frozenset("script style noscript template textarea iframe svg math object xmp noembed noframes title".split())
#: Elements that hold no article text.
SKIPPED = frozenset("head nav header footer aside form menu dialog select button label fieldset input option canvas audio video".split()) | RAW
#: Words of a class, id or role that mark boilerplate.
HEADERS = frozenset("header site-header page-header top-header".split())
MARKS = frozenset((
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside footer masthead comment comments disqus respond reply replies cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended pagination pager toolbar widget "
    "complementary contentinfo search form hidden").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
CONTENT = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that an opening tag of the key ends, if they are open.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Tags that end an open paragraph.
BLOCK = frozenset(("address article aside blockquote center details dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
                   "pre section table ul").split())
#: Cost of tags that no labelled page has: those of prose, and all others.
PRIOR = {"li": 1.0, "ul": 1.0} | {t: 0.25 for t in "p h1 h2 h3 h4 h5 h6 br blockquote pre figure figcaption table tbody thead tr td th dl dt dd ol hr".split()} | {t: 0.25 for t in INLINE if t != "a"}
OTHER, LEAST, MOST = 4.0, 0.25, 64.0
#: Cost of a tag inside the content element of a labelled page, less than any word's score.
WITHIN = 1 / (1 << 20)

#: A quoted attribute may hold `>`; where quotes don't pair up before the next `<` the tag ends at the first `>`.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+|[^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_MARK = re.compile(r"[a-z]+")


def _mark(attributes: str) -> str:
    """The mark of boilerplate that an element's attributes give it, or an empty text."""
    if not attributes:
        return ""
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return "hidden"
        if name in ("class", "id", "role"):
            if not HEADERS.isdisjoint(value.split()):
                return "header"
            for word in _MARK.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", m[2] or m[3] or m[4] or "").lower()):
                if word in MARKS:
                    return word
    return ""


def events(page: str) -> Iterator[tuple[str, str, bool, int]]:
    """(kind, value, skipped, depth) in page order: kind `tag` with a tag's name (`/` before an end tag, a mark after a dot) or `text` with
    the raw text between tags; skipped says whether boilerplate elements are open, depth how many content elements are."""
    open_: list[tuple[str, bool]] = []  # elements and whether they are skipped
    skipped = depth = seen = 0
    at = 0

    def close(name: str) -> None:
        nonlocal skipped, depth
        for k in range(len(open_) - 1, max(-1, len(open_) - 257), -1):
            if open_[k][0] == name:
                for n, s in open_[k:]:
                    skipped -= s
                    depth -= n in CONTENT
                del open_[k:]
                return

    last = page.rfind(">") + 1  # no tag ends later: beyond it nothing is searched, so that a page costs one pass
    while at < len(page):
        m = _TAG.search(page, at, last)
        if m is None:
            yield "text", page[at:], skipped > 0, depth
            return
        if m.start() > at:
            yield "text", page[at : m.start()], skipped > 0, depth
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                return
            continue
        name = m[2].lower()
        if m[1]:
            yield "tag", "/" + name, skipped > 0, depth
            close(name)
            continue
        for gone in ENDS.get(name, ()):
            if open_ and open_[-1][0] == gone:
                close(gone)
        if name in BLOCK:
            k = len(open_) - 1
            while k > 0 and open_[k][0] in INLINE:
                k -= 1
            if k >= 0 and open_[k][0] == "p":
                close("p")
        # frames of the page and its first content element may be named after what stands beside the text ("has-sidebar")
        mark = "" if name in ("html", "body") or (name in CONTENT and not seen) else _mark(m[3])
        if depth and (name == "header" or mark == "header"):
            skip = mark not in ("", "header")
        else:
            skip = bool(mark) or name in SKIPPED
        if name in CONTENT:
            if not seen:  # what the first content element stands in is a frame, however it is named
                open_[:] = [(n, was and n in SKIPPED and n != "form") for n, was in open_]
                skipped = sum(was for _, was in open_)
            seen += 1
        yield "tag", f"{name}.{mark}" if mark else name, skipped > 0 or (depth > 0 and skip), depth
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s>/])[^>]*>", re.I).search(page, at) if not m[3].rstrip().endswith("/") or name not in ("svg", "math") else None
            if end:
                yield "tag", "/" + name, True, depth
                at = end.end()
            elif not m[3].rstrip().endswith("/"):
                return
        elif name not in VOID and not m[3].rstrip().endswith("/"):
            open_.append((name, skip))
            skipped += skip
            depth += name in CONTENT


def label_counts(page: str | None) -> tuple[Counter, Counter, int, int] | None:
    """Tags inside and outside the content element and words outside of a labelled page; None of any other."""
    page = page or ""
    if sum(m[2] is not None and not m[1] and m[2].lower() in CONTENT for m in _TAG.finditer(page)) != 1:
        return None
    inside, outside, words, tags = Counter(), Counter(), 0, 0
    for kind, value, skipped, depth in events(page):
        if skipped:
            continue
        if kind == "text":
            words += 0 if depth else len(value.split())
        elif value.lstrip("/") not in CONTENT:
            (inside if depth else outside)[value] += 1
            tags += not depth
    return inside, outside, words, tags


def tag_counts(pages: DataFrame) -> DataFrame:
    """(tag, inside, outside) over all labelled pages; the row of tag null has words and tags outside."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside, words, tags = Counter(), Counter(), 0, 0
        for batch in batches:
            for page in batch.column("html"):
                found = label_counts(page.as_py())
                if found:
                    inside.update(found[0])
                    outside.update(found[1])
                    words, tags = words + found[2], tags + found[3]
            if len(inside) + len(outside) > 100_000:
                yield rows(inside, outside)
                inside, outside = Counter(), Counter()
        yield rows(inside, outside)
        yield pa.record_batch([pa.nulls(1, pa.string()), pa.array([words], pa.int64()), pa.array([tags], pa.int64())], names=["tag", "inside", "outside"])

    def rows(inside: Counter, outside: Counter) -> pa.RecordBatch:
        names = sorted(inside.keys() | outside.keys())
        return pa.record_batch([pa.array(names, pa.string()), pa.array([inside[t] for t in names], pa.int64()),
                                pa.array([outside[t] for t in names], pa.int64())], names=["tag", "inside", "outside"])

    part = map_batches(pages.select("html"), count, "tag string, inside bigint, outside bigint")
    return part.groupBy("tag").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))


#: Tags whose weights are collected: the most frequent ones, far more than HTML has. Rarer ones cost what PRIOR says.
TAGS = 5_000


def learned(pages: DataFrame) -> dict[str, float]:
    """Cost of each tag from all labelled pages."""
    counts = written(tag_counts(pages), "tags")
    words, tags = next(((r.inside, r.outside) for r in counts.where("tag is null").collect()), (0, 0))
    rows = counts.where("tag is not null").orderBy(F.desc(F.col("inside") + F.col("outside")), "tag").limit(TAGS).collect()
    if not rows:
        return {}
    a, b = (sum(r[k] for r in rows) + 1 for k in ("inside", "outside"))
    per_tag = max(1.0, words / max(1, tags))
    return {r.tag: min(MOST, max(LEAST, (1 + math.log2((r.outside + 1) / (r.inside + 1) * a / b)) * per_tag)) for r in rows}


def cost(tag: str, weights: dict[str, float]) -> float:
    name = tag.lstrip("/")
    if name in CONTENT:
        return LEAST
    return weights.get(tag, PRIOR.get(name, OTHER))


def region(line: list[tuple[str, str, bool, int]], weights: dict[str, float]) -> tuple[int, int]:
    """[first, last) of the events whose scores have the greatest sum; (0, 0) if none is positive. One scan; of equal sums the first."""
    best, where, sum_, start = 0.0, (0, 0), 0.0, 0
    costs: dict[str, float] = {}
    own = sum(kind == "tag" and value in CONTENT and not skipped for kind, value, skipped, _ in line) == 1
    for k, (kind, value, skipped, depth) in enumerate(line):
        if skipped:
            score = 0.0
        elif kind == "text":
            score = float(len(value.split()))
            if own and not depth:
                score = -score
        elif own and depth:
            score = -WITHIN
        else:
            score = costs.get(value)
            if score is None:
                score = costs[value] = -cost(value, weights)
        if sum_ <= 0:
            sum_, start = 0.0, k
        sum_ += score
        if sum_ > best:
            best, where = sum_, (start, k + 1)
    return where


def blocks(line: list[tuple[str, str, bool, int]]) -> list[str]:
    """Texts of the blocks of a stretch of events."""
    out, held = [], []
    for kind, value, skipped, _ in line:
        if kind == "text":
            if not skipped:
                held.append(value)
        elif value.lstrip("/").split(".")[0] not in INLINE:
            out.append(held)
            held = []
    out.append(held)
    texts = (" ".join(html.unescape("".join(h)).split()) for h in out if h)
    return [t for t in texts if t]


def main_text(page: str | None, weights: dict[str, float]) -> str:
    line = list(events(page or ""))
    a, b = region(line, weights)
    return "\n".join(blocks(line[a:b]))


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; without ``weights`` they are learned from all labelled pages of the table."""
    pages = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    weights = learned(pages) if weights is None else weights
    shared = pages.sparkSession.sparkContext.broadcast(weights)  # TAGS numbers at most

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), shared.value) for page in batch.column("html")]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return map_batches(pages, read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
