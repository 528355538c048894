"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score by the block they stand in,
mostly positive; tags score negative. One linear scan finds the contiguous
region with the highest sum, which is the content. Scripts, forms, menus,
adverts and reader comments within the region are left out, known by their
element or by whole words of class, id and role out of a closed list; ids of
headings do not count. A header within an ``article`` or ``main`` stays, as it
holds the title, and so does any element that holds the page's content
(``Page._content``). What no list names is left to the scores.

Weights come from labelled pages: those whose author marked one ``article`` or
``main`` element. Each kind of token weighs the logarithm of how much more often
it occurs inside than outside. At most ``MAX_LABELLED`` different labelled pages
are used (all, if there are fewer), chosen by their hash; kinds that no labelled
page shows have the default weights below.

Edge cases: NULL and empty pages, and pages without words, give an empty text.
Unclosed and crossed tags are tolerated; a script, style, title or textarea
without end reaches to the end of the page. Pictures, players, lists to select
from and the like (``PARTS``) are left out from tag to end tag; without one, or
closed in itself, such a tag is a tag like others. A page of any length is read whole, in time linear in
its length. Repeated pages are rows like others, an empty table gives an empty
result, and new columns whose name is taken get underscores in front.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.arrow import mapped, slices
from cairn.llm.samples import sample
from cairn.llm.text import fresh, quoted

MAX_LABELLED = 5_000
WORD_LIMIT, TAG_RANGE = 3.0, (-3.0, -0.1)
PLAIN_WORD, LINK_WORD, BLOCK_TAG, INLINE_TAG = 1.0, -1.0, -1.0, -0.1

# Element names with a meaning of their own.
RAW = "script|style|title|textarea"
PARTS = frozenset("noscript template select svg iframe object audio video canvas".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
APART = frozenset("aside button dialog footer form header menu nav".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# These never wrap the content; other elements are kept if they hold it.
NEVER_CONTENT = frozenset("button footer menu nav".split())
# Whole words of class, id and role, with "-" for "_".
NAMED_HEADER = frozenset("header masthead page-header entry-header post-header article-header site-header".split())
NAMED_APART = NAMED_HEADER | frozenset(
    "ad ads ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper adsbygoogle advert adverts advertisement "
    "advertisements advertising alertdialog banner banner-ad banners breadcrumb breadcrumbs comment comments comment-area "
    "comment-form comment-list comment-respond comment-section comments-area comments-list comments-section commentlist "
    "complementary consent consent-banner contentinfo cookie cookies cookie-banner cookie-bar cookie-consent cookie-law "
    "cookie-notice cookie-policy cookie-popup disqus disqus-thread footer article-footer entry-footer footer-links "
    "footer-nav footer-widgets page-footer post-footer site-footer gdpr gdpr-banner menu main-menu menu-main menubar "
    "mobile-menu nav-menu sidebar-menu site-menu modal nav main-nav main-navigation nav-bar nav-links navbar navigation "
    "page-navigation post-navigation primary-nav primary-navigation secondary-nav site-nav site-navigation sub-nav "
    "top-nav newsletter newsletter-box newsletter-form newsletter-signup overlay pagination pop-up popup promo promos "
    "promo-box recommendations recommended related related-articles related-content related-links related-news "
    "related-posts related-stories replies respond search search-box search-form searchform share share-bar share-buttons "
    "share-links sharing sharing-buttons sidebar left-sidebar right-sidebar sidebar-left sidebar-right site-sidebar signup "
    "signup-form social social-buttons social-icons social-links social-media social-share sponsor sponsored sponsors "
    "subscribe subscribe-box subscribe-form subscription toolbar widget widget-area widgets".split()
)

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>]).*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-z][\w:-]*)(?P<more>(?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-z][^>]*>",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"(?<![\w:-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(rf"</(?:{'|'.join(sorted(PARTS))})[\s>]", re.I)
SELF_CLOSED = re.compile(r"(?:\A|[\s\"'])/\Z")
SPACE = re.compile(r"\s+")


def parts(source: str) -> dict[int, int]:
    """First and last character of each element of ``PARTS`` that has its end tag."""
    if not PART.search(source):
        return {}
    opened: dict[str, list[int]] = {name: [] for name in PARTS}
    found = {}
    for m in TOKEN.finditer(source):
        name = (m["name"] or "").lower()
        if name not in PARTS:
            continue
        if not m["end"]:
            if not SELF_CLOSED.search(m["more"]):
                opened[name].append(m.start())
        elif opened[name]:
            found[opened[name].pop()] = m.end()
    return found


class Page:
    """A page as parallel lists: kind of each token, text, words, and what is left out."""

    def __init__(self, source: str):
        self.kinds: list[str] = []
        self.texts: list[str | None] = []
        self.words: list[int] = []
        self.names: list[str] = []  # of tags, "/name" for ends
        self.apart: list[bool] = []
        marks = self._read(source)
        self._leave_out(marks)

    def _add(self, kind: str, name: str = "", text: str | None = None, words: int = 0) -> None:
        self.kinds.append(kind)
        self.names.append(name)
        self.texts.append(text)
        self.words.append(words)

    def _text(self, raw: str, blocks: list[str], links: int) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            kind = f"word {blocks[-1] if blocks else '-'}{' link' if links else ''}"
            self._add(kind, "", text, len(text.split()))

    def _read(self, source: str) -> list[int]:
        """Fill the lists; the places of tags that open something to leave out."""
        marks, blocks, links, last, closed = [], [], 0, 0, parts(source)
        for m in TOKEN.finditer(source):
            if m.start() < last:
                continue
            self._text(source[last : m.start()], blocks, links)
            if m.start() in closed:
                last = closed[m.start()]
                continue
            last = m.end()
            name = (m["name"] or "").lower()
            if not name:
                continue
            if name == "a":
                links = 0 if m["end"] else 1
            if m["end"]:
                if name in BLOCKS and name in blocks:
                    while blocks.pop() != name:
                        pass
                    links = 0
                self._add(f"tag {name}", f"/{name}")
                continue
            if name in BLOCKS:
                if blocks and blocks[-1] == "p":
                    blocks.pop()  # a paragraph ends where the next block begins
                blocks.append(name)
                links = 0
            inside = "article" in blocks[:-1] or "main" in blocks[:-1]
            if self._set_apart(name, m["more"], inside):
                marks.append(len(self.kinds))
            self._add(f"tag {name}", name)
        self._text(source[last:], blocks, links)
        return marks

    @staticmethod
    def _set_apart(name: str, more: str, inside: bool) -> bool:
        """Whether an element is left out; a header within the content is its title."""
        if name in APART:
            return not (inside and name == "header")
        if "=" not in more:
            return False
        said = ((attribute.lower(), next(filter(None, v), "")) for attribute, *v in ATTRIBUTE.findall(more))
        values = [v for attribute, v in said if not (attribute == "id" and name in HEADINGS)]
        found = NAMED_APART.intersection(word for v in values for word in v.lower().replace("_", "-").split())
        return bool(found - NAMED_HEADER if inside else found)

    def closing(self) -> dict[int, int]:
        """The end tag of each start tag that has one."""
        opened: dict[str, list[int]] = {}
        found = {}
        for i, name in enumerate(self.names):
            if name.startswith("/"):
                if waiting := opened.get(name[1:]):
                    found[waiting.pop()] = i
            elif name and name not in VOID:
                opened.setdefault(name, []).append(i)
        return found

    def _leave_out(self, marks: list[int]) -> None:
        """Flag what stands in the marked elements; an unclosed one ends at the next block."""
        self.apart = [False] * len(self.kinds)
        if not marks:
            return
        ends, extents = self.closing(), []
        for i in marks:
            if self.names[i] in ("body", "html", "main", "article"):
                continue
            end = ends.get(i)
            if end is None:
                rest = range(i + 1, len(self.names))
                end = next((k - 1 for k in rest if self.names[k].lstrip("/") in BLOCKS), len(self.names) - 1)
            extents.append((i, end))
        until, holds = 0, self._content(extents)
        for i, end in extents:
            if self.names[i] not in NEVER_CONTENT and holds(i, end):
                continue
            for k in range(max(i, until), end + 1):
                self.apart[k] = True
            until = max(until, end + 1)

    def _content(self, extents: list[tuple[int, int]]) -> Callable[[int, int], bool]:
        """Tells whether the tokens from one to another hold the content.

        They do with the ``main`` element; with the first ``article``, unless it
        is a teaser or comment beside a title of the page; without both, with
        all titles; and with most words out of links, unless ``main`` or the
        first ``article`` stands outside.
        """
        places: dict[str, list[int]] = {"main": [], "article": [], "h1": []}
        for i, name in enumerate(self.names):
            if name in places:
                places[name].append(i)
        marked = (places["main"] or places["article"])[:1]
        beside = [0] * (len(self.names) + 1)  # how many extents without the marked element begin or end
        for first, last in extents:
            if marked and not first <= marked[0] <= last:
                beside[first] += 1
                beside[last + 1] -= 1
        beside = list(accumulate(beside))
        titles = [i for i in places["h1"] if not beside[i]]
        prose = list(accumulate((0 if k.endswith(" link") else n for k, n in zip(self.kinds, self.words, strict=True)), initial=0))

        def holds(first: int, last: int) -> bool:
            if marked and not first <= marked[0] <= last:
                return False
            all_titles = not titles or first <= titles[0] and titles[-1] <= last
            if (marked or titles) and (places["main"] or all_titles):
                return True
            return 2 * (prose[last + 1] - prose[first]) > prose[-1]

        return holds

    def marked_region(self) -> tuple[int, int] | None:
        """The one element that the page's author marked as content."""
        for name in ("article", "main"):
            places = [i for i, n in enumerate(self.names) if n == name]
            if len(places) == 1 and (end := self.closing().get(places[0])) is not None:
                return places[0], end
        return None

    def region(self, weights: dict[str, float]) -> tuple[int, int]:
        """First and one past the last token of the best-scoring stretch."""
        best, first, last, total, start = 0.0, 0, 0, 0.0, 0
        for i, kind in enumerate(self.kinds):
            words = self.words[i]
            if kind.startswith("word"):
                fallback = LINK_WORD if kind.endswith("link") else PLAIN_WORD
                score = 0.0 if self.apart[i] or not words else words * weights.get(kind, fallback)
            else:
                fallback = BLOCK_TAG if self.names[i].lstrip("/") in BLOCKS else INLINE_TAG
                score = 0.0 if self.apart[i] else weights.get(kind, fallback)
            if total <= 0:
                total, start = 0.0, i
            total += score
            if total > best:
                best, first, last = total, start, i + 1
        return first, last

    def text(self, first: int, last: int) -> str:
        """The blocks of a stretch, one per line."""
        lines, line = [], []

        def end() -> None:
            if said := SPACE.sub(" ", "".join(line)).strip():
                lines.append(said)
            line.clear()

        for i in range(first, last):
            name = self.names[i].lstrip("/")
            if name in BLOCKS:
                end()
            elif name == "br":
                line.append(" ")
            elif not self.apart[i] and self.texts[i]:
                line.append(self.texts[i])
        end()
        return "\n".join(lines)


def counted(sources: list[str]) -> Counter:
    """Tokens of labelled pages by kind, inside (True) and outside."""
    counts: Counter = Counter()
    for source in sources:
        page = Page(source)
        if (region := page.marked_region()) is None:
            continue
        for i, kind in enumerate(page.kinds):
            inside = region[0] < i < region[1] and not page.apart[i]
            counts[kind, inside] += page.words[i] if kind.startswith("word") else 1
    return counts


def weighed(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log ratio of the share inside to the share outside, within bounds."""
    inside = sum(n for (_, i), n in counts.items() if i)
    outside = sum(n for (_, i), n in counts.items() if not i)
    weights = {}
    for kind in {kind for kind, _ in counts}:
        ratio = math.log((counts.get((kind, True), 0) + 1) / (inside + 1))
        ratio -= math.log((counts.get((kind, False), 0) + 1) / (outside + 1))
        low, high = (-WORD_LIMIT, WORD_LIMIT) if kind.startswith("word") else TAG_RANGE
        weights[kind] = min(max(ratio, low), high)
    return weights


def learn_weights(pages: DataFrame, column: str = "html", limit: int = MAX_LABELLED) -> dict[str, float]:
    """Token weights from the labelled pages."""
    source = F.col(quoted(column))
    one = (F.regexp_count(source, F.lit(r"(?i)<article\b")) == 1) | (F.regexp_count(source, F.lit(r"(?i)<main\b")) == 1)
    # Copies of a page teach nothing new: each different page counts once.
    chosen = sample(pages.where(one), source, [], limit, copies=False).select("value")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = counted(batch.column(0).to_pylist())
            rows = [(kind, inside, n) for (kind, inside), n in found.items() if _known(kind)]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.bool_(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "inside", "n"])

    counts = chosen.mapInArrow(count, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n"))
    return weighed({(kind, inside): n for kind, inside, n in counts.collect()})


def _known(kind: str) -> bool:
    """Made-up element names have no weight of their own."""
    name = kind.split()[1]
    return name in BLOCKS or name in VOID or kind.startswith("word -") or len(name) <= 6


def main_text(source: str, weights: dict[str, float]) -> str:
    """The main text of one page."""
    page = Page(source)
    return page.text(*page.region(weights))


def extract(
    pages: DataFrame, column: str = "html", weights: dict[str, float] | None = None, keep: list[str] | None = None
) -> tuple[DataFrame, str]:
    """The input's columns (or those of ``keep``) with the main text, and its name."""
    weights = learn_weights(pages, column) if weights is None else weights
    kept = pages.columns if keep is None else keep
    name = fresh("text", kept)
    schema = T.StructType([*[pages.schema[c] for c in kept], T.StructField(name, T.StringType())])
    html_place = pages.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                texts = [main_text(s or "", weights) for s in part.column(html_place).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(texts, pa.string())], names=[*kept, name]
                )

    return mapped(pages, run, schema), name
