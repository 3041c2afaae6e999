"""Main text of web pages by the distribution of line blocks.

Markup is stripped into lines, one per block element; an element that never
holds article text (navigation, forms, scripts, adverts, reader comments ...)
leaves blank lines instead, unless it stands in the middle of its parent's text.  The text length of every window of a few lines
is summed; where the sum leaves zero the text surges, where it falls back it
dives, and the lines between form a region.  Lines of links and callouts
outside an <article> weigh nothing.  Regions inside <article> or <main> are
the article; where there are none, or one that holds more text lies outside,
so is every region whose peak is as high as a paragraph's, or the longest one
if none is.  What stands in one container stays together: a region that shares
its container with the article belongs to it, and so does a weightless line
behind the first line of that container.  A button or a marked inline element
is text where it stands in a line of text, and goes where it stands alone.
An element that would be dropped is read after all if it wraps the page's
largest <article> or <main> and none stands elsewhere, or if it holds most of
the page's text and its <h1>, or if nothing else is left.

Edge cases: null, empty and text-less pages give an empty text; unclosed or
stray tags close with their parents; a page cut off inside a tag, comment or
script ends there; of regions with equal text the first is the longest;
repeated rows give one row each.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.common import fresh

# Lines in a window; the gap that a dropped element leaves is as wide.
WINDOW = 3
# Characters in a window from which on the text surges as high as a paragraph's.
SURGE = 100
# A line is a menu line if this share of its text lies in links.
LINK_SHARE = 0.8
# An element holds the bulk of a page if it has more than this share of its text.
BULK_SHARE = 0.5

# Fixed values of HTML: elements without an end tag, elements whose content is not markup, elements that begin a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul").split())
# Elements that never hold article text, and words of class, id and role that mark others.
DROPPED = frozenset("head script style textarea title noscript iframe xmp noembed noframes template nav aside footer form button select menu dialog svg canvas "
                    "object embed audio video map datalist search".split())
MARKS = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "masthead footer related recommended share sharing social cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login comment comments disqus respond replies reply pagination pager toolbar widget widgets skip complementary contentinfo search dialog").split())
# Marks that also name a callout in an article's text.
CALLOUTS = frozenset("alert notice notices dialog response".split())
# Elements of one paragraph or heading: the first word of their names says what they are.
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre caption figcaption dt dd address".split())
# First words of compound names that say what an element lacks or has beside it, not what it is.
UNMARKING = frozenset("has have no not non with without hide hidden show".split())
ARTICLE = frozenset(("article", "main"))
# Elements that text consists of; every other one that begins a line is a container of text.
TEXT = frozenset("address blockquote caption dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr legend li ol option p pre summary table tbody td tfoot th thead tr ul".split())
# Containers of the whole page: text beside a dropped element goes on behind it only if both lie in the container itself.
PAGE = frozenset(("html", "body"))
# An open element that one of these ends: a paragraph ends where a block begins.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTES = re.compile(r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>""")
MARKING = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")


class _Lines:
    """Collects lines of text while the markup is read."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.weights: list[int] = []
        self.holders: list[int] = []  # container of each line; 0: none but the page
        self.articles: list[bool] = []  # whether the line lies in an article
        self.text: list[str] = []
        self.in_links = self.plain = 0  # characters in links, and of text that is no button or marked inline element
        self.n = 0
        self.holder = 0  # container of the last line
        self.pages: set[int] = {0}  # numbers of the elements that hold the whole page
        self.cuts: list[tuple[int, int, bool]] = []

    def add(self, raw: str, link: bool, soft: bool = False) -> None:
        self.text.append(raw)
        size = len(raw.strip())
        if link:
            self.in_links += size
        if not soft:
            self.plain += size

    def end_line(self, in_article: bool, places: list[tuple[int, int, int]], callout: bool = False) -> None:
        """End a line of text in the innermost of ``places``: (number, lines before, number of its container) of the open elements."""
        line = " ".join(html.unescape("".join(self.text)).split()) if self.plain else ""
        if line:
            holder = places[-1][2] if places else 0
            if any((depth and (len(places) < depth or places[depth - 1][0] != number)) or (direct and holder != number) for depth, number, direct in self.cuts):
                self.gap()
            self.cuts, self.holder, self.n = [], holder, self.n + 1
            self.lines.append(line)
            self.weights.append(0 if not in_article and (callout or self.in_links >= LINK_SHARE * len(line)) else len(line))
            self.holders.append(0 if holder in self.pages else holder)
            self.articles.append(in_article)
        self.text, self.in_links, self.plain = [], 0, 0

    def cut(self, places: list[tuple[int, int, int]], page: bool) -> None:
        """An element of the innermost of ``places`` was dropped: blank lines, unless that one has text before and has the next text as well."""
        number, before, _ = places[-1] if places else (0, 0, 0)
        if self.n == before or (page and self.holder != number):
            self.gap()
        else:
            self.cuts.append((len(places), number, page))

    def gap(self) -> None:
        self.lines += [""] * WINDOW
        self.weights += [0] * WINDOW
        self.holders += [0] * WINDOW
        self.articles += [False] * WINDOW


def marks(attributes: str, first: bool = False) -> set[str]:
    """The words of class, id and role that mark an element as no article text; ``first``: first words of names alone."""
    found = set()
    for m in MARKING.finditer(attributes):
        value = m[1] or m[2] or m[3] or ""
        for name in value.lower().split():
            words = WORD.findall(name)
            if words and words[0] not in UNMARKING:
                found.update(w for w in words[:1 if first else None] if w in MARKS)
    return found


def ends_unquoted(attributes: str) -> bool:
    """Whether the last attribute's value has no quotes: a slash at its end belongs to it."""
    value = attributes.rsplit(None, 1)[-1].partition("=")[2]
    return bool(value) and value[0] not in "\"'"


class _Element:
    """An element that is dropped, or an article: its place and what it holds."""

    def __init__(self, at: int, depth: int, outer: bool, text: int, titles: int) -> None:
        self.at, self.end, self.depth, self.outer = at, 0, depth, outer  # outer: dropped, and inside no other dropped one
        self.text, self.titles, self.inner = -text, -titles, 0  # inner: text of the dropped elements right inside


class _Census:
    """Counts the text of all dropped elements, nested ones included, and of all articles while the markup is read."""

    def __init__(self) -> None:
        self.text = self.titles = 0
        self.open: dict[bool, list[_Element]] = {True: [], False: []}  # articles, dropped elements
        self.articles: list[_Element] = []
        self.dropped: list[_Element] = []
        self.free = 0  # articles that are not dropped

    def enter(self, article: bool, at: int, depth: int, outer: bool) -> None:
        element = _Element(at, depth, outer, self.text, self.titles)
        self.open[article].append(element)
        (self.articles if article else self.dropped).append(element)

    def leave(self, depth: int, at: int) -> None:
        """The elements deeper than ``depth`` end."""
        for opened in self.open.values():
            while opened and opened[-1].depth > depth:
                element = opened.pop()
                element.end, element.text, element.titles = at, element.text + self.text, element.titles + self.titles
                if opened:
                    opened[-1].inner += element.text

    def spared(self) -> frozenset[int]:
        """Places of the dropped elements that wrap the article."""
        outside = self.text - sum(x.text for x in self.dropped if x.outer)
        out = set()
        if self.articles and not self.free:
            article = max(self.articles, key=lambda x: x.text)
            if article.text > 0:
                return frozenset(x.at for x in self.dropped if x.at < article.at and x.end >= article.end)
        for x in self.dropped:  # those with the bulk of the text lie inside one another
            if x.text > BULK_SHARE * self.text and (x.titles or not outside) and (x.outer or out):
                out.add(x.at)
                outside += x.text - x.inner
        return frozenset(out)


def lines_of(page: str) -> _Lines:
    """The page's lines with their weights, containers and articles, and blank lines for what is dropped.  Time is linear in the page."""
    found, census = _read(page, frozenset())
    spared = census.spared()
    return _read(page, spared)[0] if spared else found


def _read(page: str, spared: frozenset[int]) -> tuple[_Lines, _Census]:
    """As ``lines_of``, without dropping the elements that begin at the places ``spared``; plus what the dropped ones hold."""
    out, census = _Lines(), _Census()
    stack: list[str] = []  # open elements
    places: list[tuple[int, int, int]] = []  # as end_line() takes them
    number = 0
    dropped = 0  # depth of the stack at which an element is dropped; 0: none
    article = links = posts = 0  # posts: articles so far that nothing marks
    soft = callout = 0  # depth of the stack at which a marked inline element, a callout begins; 0: none
    at, end, quotes = 0, len(page), True
    while at < end:
        open_at = page.find("<", at)
        if open_at < 0:
            open_at = end
        if open_at > at:
            census.text += len(page[at:open_at].strip())
            if not dropped:
                out.add(page[at:open_at], links > 0, soft > 0)
        if open_at == end:
            break
        at = open_at
        if page.startswith("<!--", at):
            close = page.find("-->", at + 4)
            at = end if close < 0 else close + 3
            continue
        if page.startswith(("<!", "<?"), at):
            close = page.find(">", at)
            at = end if close < 0 else close + 1
            continue
        m = TAG.match(page, at)
        if not m:
            if not dropped:
                out.add("<", links > 0, soft > 0)
            at += 1
            continue
        begin, closing, name = at, m[1], m[2].lower()
        rest = ATTRIBUTES.match(page, m.end()) if quotes else None
        if rest is None:
            quotes = False  # an open quote runs to the end of the page: from here on, tags end at the next bracket
            close = page.find(">", m.end())
            if close < 0:
                break
            attributes, at = page[m.end():close], close + 1
        else:
            attributes, at = rest[0][:-1], rest.end()
        if closing:
            if name in stack:
                if name in BLOCK and not dropped:
                    out.end_line(article > 0, places, callout > 0)
                while True:
                    top = stack.pop()
                    places.pop()
                    article -= top in ARTICLE
                    links -= top == "a"
                    soft, callout = soft if len(stack) >= soft else 0, callout if len(stack) >= callout else 0
                    if dropped and len(stack) < dropped:
                        dropped = 0
                        if not article:
                            out.cut(places, not stack or stack[-1] in PAGE)
                    if top in ARTICLE and not article and not dropped:
                        out.gap()
                    if top == name:
                        break
                census.leave(len(stack), begin)
            continue
        if name == "body" and "head" in stack:  # the end tag of the head may be left out
            del places[stack.index("head"):]
            del stack[stack.index("head"):]
            census.leave(len(stack), begin)
            dropped = soft = callout = 0
        if name == "br":
            if not dropped:
                out.add(" ", False, True)
            continue
        if name in BLOCK:
            if not dropped:
                out.end_line(article > 0, places, callout > 0)
            while stack and (stack[-1] == "p" or stack[-1] in CLOSES.get(name, ())) and not (dropped and len(stack) <= dropped):
                stack.pop()
                places.pop()
                soft, callout = soft if len(stack) >= soft else 0, callout if len(stack) >= callout else 0
            census.leave(len(stack), begin)
        if name in VOID:
            continue
        if name in RAW:
            close = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            if close is None:
                at = end
                break
            after = page.find(">", close.end())
            at = end if after < 0 else after + 1
            continue
        if attributes.endswith("/") and name not in BLOCK and not ends_unquoted(attributes):
            continue
        number += 1
        places.append((number, out.n, number if name in BLOCK and name not in TEXT else places[-1][2] if places else 0))
        inline = name == "button" or name not in BLOCK
        words = marks(attributes, name in PARAGRAPH or inline) if attributes and name not in ("html", "body") else set()
        in_text = inline and (out.plain > 0 or (name == "button" and bool(stack) and stack[-1] in TEXT))
        stack.append(name)
        if name in PAGE:
            out.pages.add(number)
        if name in ARTICLE and (not words or not posts):
            article += 1
            posts += not words and not dropped
            soft = callout = 0
            census.enter(True, begin, len(stack), False)
            census.free += not dropped
            if article == 1 and not dropped:
                out.gap()
            words = set()
        elif name in ARTICLE:
            stack[-1] = "section"  # a reader's comment or a teaser behind the article
        links += name == "a"
        census.titles += name == "h1"
        if in_text and (name == "button" or (words and name not in DROPPED)):
            soft = soft or len(stack)
        elif name in PARAGRAPH and words and words <= CALLOUTS:
            callout = callout or len(stack)
        elif name in DROPPED or (name == "header" and not article) or words:
            if begin not in spared:
                census.enter(False, begin, len(stack), not dropped)
                if not dropped:
                    out.end_line(article > 0, places, callout > 0)
                    dropped = len(stack)
    census.leave(0, end + 1)
    if not dropped:
        out.end_line(article > 0, places, callout > 0)
    return out, census


def regions(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, peak): the runs of lines between a window sum's rise from zero and its fall to zero, with its highest value."""
    found, total, surge, peak = [], sum(lengths[:window]), None, 0
    for i in range(len(lengths)):
        if total and surge is None:
            surge, peak = i, 0
        if total:
            peak = max(peak, total)
        elif surge is not None:
            found.append((surge, i, peak))
            surge = None
        total += (lengths[i + window] if i + window < len(lengths) else 0) - lengths[i]
    if surge is not None:
        found.append((surge, len(lengths), peak))
    return found


def main_text(page: str | None) -> str:
    """The main text of a page, one line per block."""
    found = lines_of(page or "")
    held = [(sum(found.weights[s:e]), s, e, peak, any(found.articles[s:e])) for s, e, peak in regions(found.weights)]
    if not held:
        return ""
    marked_up = sum(n for n, *_, article in held if article)
    most = max(n for n, *_ in held)
    chosen = [i for i, (n, _, _, peak, article) in enumerate(held) if article or (n > marked_up and (peak >= SURGE or (n == most and not marked_up)))]
    if max(held[i][3] for i in chosen) < SURGE and not marked_up:
        chosen = chosen[:1]
    # what shares a container with the article
    inside: dict[int, list[int]] = {}
    for i, (_, s, e, _, _) in enumerate(held):
        for holder in {found.holders[k] for k in range(s, e) if found.weights[k]} - {0}:
            inside.setdefault(holder, []).append(i)
    first: dict[int, int] = {}  # the first line of each container of the article
    kept, ahead = set(chosen), list(chosen)
    while ahead:
        _, s, e, _, _ = held[ahead.pop()]
        for k in range(s, e):
            holder = found.holders[k]
            if holder and found.weights[k]:
                more = [i for i in inside.pop(holder, ()) if i not in kept]
                kept.update(more)
                ahead += more
                first[holder] = min(first.get(holder, k), k)
    lines = {k for i in kept for k in range(held[i][1], held[i][2]) if found.weights[k]}
    lines.update(k for k, holder in enumerate(found.holders) if holder in first and k > first[holder] and found.lines[k])
    return "\n".join(found.lines[k] for k in sorted(lines))


def extract_text(df: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``df`` without its markup column, plus the main text and its length in code points."""
    keep = [c for c in df.columns if c != html_col]
    text, n_chars = fresh(keep, name, "n_chars")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*keep, text, n_chars])

    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(text, T.StringType()), T.StructField(n_chars, T.LongType())])
    return df.select(*keep, html_col).mapInArrow(extract, schema)
