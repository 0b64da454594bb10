"""Main text of web pages: site templates are found by counting, and removed.

Every page becomes a tree of elements, and every subtree a hash of its tags, attributes and words. Spark counts, for
each host and hash, the pages and their distinct main texts; a subtree that occurs with ``enough`` distinct
texts is a template, however large the host. Hosts of fewer than ``enough`` / ``least_share`` pages do with
that share of their pages, but ``least_pages`` at least.

A page's text is then what is left of its main part: its ``article`` elements, else ``main``, else
the body, without templates and without elements that say themselves that they are none of the article (``nav``, ``form``,
``class="ad"`` and the like), which also covers hosts with few pages. A name is a whole class, id or role made of
such words only. It never takes an element that holds the main part, nor one that holds most of the text and a page's own
parts; and if nothing else would be left, only tags decide. Templates
of an ``article`` or ``main`` are counted by themselves, as whole paragraphs, lists and tables, never a cell,
an item or a word within a line; an ``h1`` stays. Copies of an article have one main text and so count once. A line of fewer than
``line_words`` words may recur by chance and must be on ``line_share`` of the host's pages. A page most of whose
paragraphs recur, ``copied`` at least, is a changed copy and keeps them, and so does one of which nothing would be left.
A block of ``long_words`` words or more is also that of changed copies, and stays, where the texts around it have less than half as many
titles (their ``h1``, else their longest other block) as there are of them.

Defined results: null or empty html gives an empty text. A page without a host counts for none and only
loses what says so itself. Broken markup is read as far as it can be; unclosed elements end with
their parent. Repeated rows are pages of their own. Rows keep their other columns out of it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Set
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from twinloom.session import materialize
from twinloom.sizing import fits

# Fixed lists of element names, and of the words that class, id and role attributes of asides are made of.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
PROSE = set("blockquote dd dl dt figcaption h1 h2 h3 h4 h5 h6 li ol p pre table tbody td th thead tr ul".split())
INLINE = set("a abbr b bdi bdo cite code data del dfn em i ins kbd mark q s samp small span strong sub sup time u var".split())
#: Nothing below these is text of the page.
SILENT = set("audio canvas head iframe math noscript object script select style svg template textarea title video".split())
#: Of these only a form may hold the whole page.
ASIDE = set("aside button dialog footer form input label menu nav".split())
#: What may stand in a head; anything else ends it.
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
ASIDE_WORDS = set(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies dialog discussion disqus footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notices overlay popup promo promotion related reply replies search share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: An element that starts closes an open one of these, up to the given holders.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CLOSED_BY_BLOCK = "p"
HOLD_BLOCKS = {"td", "th", "article", "section", "div", "main", "li", "blockquote"}
PAGE_PARTS = {"aside", "footer", "h1", "header", "nav"}
COPY_SALTS = 8


@dataclass(frozen=True)
class TemplateConfig:
    least_pages: int = 3
    least_share: float = 0.1  # of a small host's pages
    enough: int = 10
    line_words: int = 4
    line_share: float = 0.5
    copied: int = 4
    long_words: int = 20
    #: A block of prose has a place if it is one of so many at the start or end of the main part, and is a template
    #: only if this share of the texts that hold it have it at one place.
    edge: int = 3
    placed_share: float = 0.8


class Element:
    __slots__ = ("tag", "attrs", "parts", "hash", "words", "holds_part")

    def __init__(self, tag: str, attrs: tuple):
        self.tag, self.attrs = tag, attrs
        self.parts: list = []  # texts and elements, in order
        self.hash = 0
        self.words = 0  # of the texts below, but for silent ones
        self.holds_part = False  # whether something below is a part that only a page has


class TreeBuilder(HTMLParser):
    """The elements of a page, each with a hash of all below it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html", ())
        self.open = [self.root]
        self.tags: Counter = Counter()  # open elements of each tag
        self.paragraphs = [0]  # open ones above each holder of paragraphs

    def _push(self, element: Element) -> None:
        self.open.append(element)
        self.tags[element.tag] += 1
        if element.tag in HOLD_BLOCKS:
            self.paragraphs.append(0)
        elif element.tag == CLOSED_BY_BLOCK:
            self.paragraphs[-1] += 1

    def _cut(self, at: int) -> None:
        """Closes the open elements from this one on."""
        for element in reversed(self.open[at:]):
            self.tags[element.tag] -= 1
            if element.tag in HOLD_BLOCKS:
                self.paragraphs.pop()
            elif element.tag == CLOSED_BY_BLOCK:
                self.paragraphs[-1] -= 1
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._end_head(tag)
        if tag in ("html", "body") and len(self.open) == 1:
            return
        if tag in CLOSES:
            self._end(*CLOSES[tag])
        elif tag in BLOCKS and tag != "br" and self.paragraphs[-1]:
            self._end({CLOSED_BY_BLOCK}, HOLD_BLOCKS)
        element = Element(tag, tuple(attrs))
        self.open[-1].parts.append(element)
        if tag not in VOID:
            self._push(element)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and len(self.open) > 1 and self.open[-1].tag == tag:
            self._cut(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1) if self.tags[tag] else ():
            if self.open[k].tag == tag:
                self._cut(k)
                return

    def _end(self, tags: set, holders: set) -> None:
        for k in range(len(self.open) - 1, 0, -1) if any(self.tags[t] for t in tags) else ():
            if self.open[k].tag in tags:
                self._cut(k)
                return
            if self.open[k].tag in holders:
                return

    def _end_head(self, tag: str) -> None:
        """A body ends an open head and all left open in it; other elements that belong in no head end it if they are its own."""
        if len(self.open) > 1 and self.open[1].tag == "head" and (tag == "body" or len(self.open) == 2 and tag not in IN_HEAD):
            self._cut(1)

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._end_head("")
        self.open[-1].parts.append(data)


def parse(html: str | None) -> Element:
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    _hash(builder.root)
    return builder.root


def _hash(root: Element) -> None:
    """Hashes from the leaves up, without recursion: pages may be nested deeply."""
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        todo += [p for p in element.parts if isinstance(p, Element)]
    for element in reversed(order):
        said = [element.tag, *(f"{k}={v}" for k, v in element.attrs)]
        for part in element.parts:
            words = [f"<{part.hash}>"] if isinstance(part, Element) else part.split()
            said.append(" ".join(words))
            element.words += part.words if isinstance(part, Element) else len(words)
            if isinstance(part, Element):
                element.holds_part |= part.holds_part or part.tag in PAGE_PARTS
        if element.tag in SILENT:
            element.words = 0
        element.hash = (xxhash.xxh3_64_intdigest("\0".join(said)) >> 1) or 1


def _named_aside(element: Element, in_article: bool) -> bool:
    """Whether it is hidden, or a whole class, id or role is made of words for asides only (``cookie-banner``, not ``no-sidebar``)."""
    for key, value in element.attrs:
        if key in ("class", "id", "role") and value:
            for token in value.lower().split():
                words = [w for w in re.split(r"[^a-z0-9]+", token) if w]
                if words and ASIDE_WORDS.issuperset(words) or words == ["header"] and not in_article:
                    return True
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            return True
    return False


def _tagged_aside(element: Element, in_article: bool) -> bool:
    return element.tag in SILENT or element.tag in ASIDE or element.tag == "header" and not in_article


def _below(element: Element) -> list[Element]:
    return [p for p in reversed(element.parts) if isinstance(p, Element)]


def _outermost(base: list[Element], wanted: str, names: bool) -> list[Element]:
    """Outermost elements of a tag below ``base``, but for asides; those that are asides by name only count unless ``names``."""
    found, todo = [], [p for element in reversed(base) for p in _below(element)]
    while todo:
        element = todo.pop()
        if element.tag == wanted and not (names and _named_aside(element, True)):
            found.append(element)
        elif element.tag == "form" or not _tagged_aside(element, False):
            if not (names and _named_aside(element, False)):
                todo += _below(element)
    return found


def _wraps(element: Element, words: int) -> bool:
    """Whether it holds most of ``words`` and also a part that only a page has: then no name makes it an aside."""
    return element.tag not in SILENT and 2 * element.words > words and element.holds_part


def _kept_words(parts: list[Element], in_article: bool) -> int:
    """Words of ``parts`` outside asides, wherever these are."""
    words, todo = 0, list(parts)
    while todo:
        element = todo.pop()
        words += sum(len(p.split()) for p in element.parts if isinstance(p, str))
        todo += [p for p in _below(element) if not _tagged_aside(p, in_article) and not _named_aside(p, in_article)]
    return words


def _dropped(element: Element, in_article: bool, words: int, names: bool) -> bool:
    """Whether an element of a main part of so many words is an aside; without ``names`` only its tag decides, and no form is one."""
    by_tag = _tagged_aside(element, in_article)
    if by_tag and element.tag != "form":
        return True
    return names and (by_tag or _named_aside(element, in_article)) and not _wraps(element, words)


def _main_parts(root: Element) -> tuple[list[Element], bool]:
    """Outermost ``article`` elements, else ``main``, else the page; whether it is one of the first two.

    Names bar the way to an article only while there is another one, or more text outside of what they name.
    """
    found = _outermost([root], "article", True)
    if found:
        return found, True
    mains = _outermost([root], "main", True) or _outermost([root], "main", False)
    base = mains or [root]
    named = _outermost(base, "article", False)
    if named and sum(p.words for p in named) > _kept_words(base, bool(mains)):
        return named, True
    return base, bool(mains)


#: Prose of a main part is counted apart from the same subtree elsewhere.
IN_MAIN = 1 << 61


def _key(element: Element, alone: bool, in_prose: bool, marked: bool) -> int:
    """What the subtree counts as, or 0 if it can be no template where it stands.

    ``alone``: no text beside it. ``in_prose``: within a paragraph, list or table. ``marked``: within an article or main.
    """
    if element.tag in VOID or element.tag in ("html", "body", "head") or element.tag in INLINE and not alone:
        return 0
    if not marked or element.tag not in PROSE and element.tag not in INLINE:
        return 0 if marked and in_prose else element.hash
    return 0 if in_prose or element.tag == "h1" else element.hash ^ IN_MAIN


def _blocks(element: Element, in_prose: bool) -> tuple[bool, bool]:
    """Whether what is below stands alone, and whether in prose."""
    alone = not any(isinstance(p, str) and p.strip() for p in element.parts)
    return alone, in_prose or element.tag in PROSE or element.tag in INLINE


def _said(element: Element) -> str:
    """All text of an element, in order, with single blanks."""
    said, todo = [], [element]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            said.append(part)
        elif part.tag not in SILENT:
            todo += reversed(part.parts)
    return " ".join("".join(said).split())


def _headings(parts: list[Element]) -> set[str]:
    """Texts of the first-level headings of a main part."""
    found, todo = set(), list(parts)
    while todo:
        element = todo.pop()
        if element.tag == "h1":
            found.add(_said(element))
        todo += _below(element)
    return found


#: The place of what is not prose of a main part, and so needs none.
ANYWHERE = 99
#: Stands in for a place: a page has this text as its heading, so that it is no notice of any site.
TITLE = 98


def title_keys(root: Element, config: TemplateConfig) -> Iterator[tuple[int, bool]]:
    """What a paragraph would count as that says no more than a heading of the page, and whether it is a short line."""
    for said in _headings(_main_parts(root)[0]):
        key = (xxhash.xxh3_64_intdigest(f"p\0{said}") >> 1) or 1
        yield key ^ IN_MAIN, len(said.split()) < config.line_words


def candidates(root: Element, config: TemplateConfig = TemplateConfig()) -> tuple[int, dict[int, tuple[bool, int, int]]]:
    """Hash of the main text, and the subtrees that may be templates.

    Of each: whether it is a short line of the main part, the title of what is around a long block of it (else the main text),
    and the place of a block: 1, 2 ... from the start, -1, -2 ... from the end, 0 further in. A block that says
    what a heading of its page says is none.
    """
    parts, marked = _main_parts(root)
    whole = {id(p) for p in parts} if marked else set()
    own, words = set(whole), sum(p.words for p in parts)
    elsewhere: set[int] = set()
    prose: dict[int, int] = {}  # words of the blocks of the main part
    heads: list[int] = []
    order: list[int] = []
    blocks: dict[int, Element] = {}
    alone, _ = _blocks(root, False)
    todo = [(p, alone, False, False) for p in _below(root)]
    todo += [(p, True, False, False) for p in reversed(parts) if marked]  # also those that an aside holds
    while todo:
        element, alone, in_prose, within = todo.pop()
        if id(element) in whole:
            if id(element) in own:
                own.remove(id(element))
                alone, _ = _blocks(element, False)
                todo += [(p, alone, False, True) for p in _below(element)]
            continue
        if _dropped(element, within, words, True):
            continue
        key = _key(element, alone, in_prose, within)
        if within and element.tag == "h1":
            heads.append(element.hash)
        if key and within and (element.tag in PROSE or element.tag in INLINE):
            prose[key] = element.words
            order.append(key)
            blocks[key] = element
        elif key:
            elsewhere.add(key)
        below = _blocks(element, in_prose)
        todo += [(p, *below, within) for p in _below(element)]
    text = xxhash.xxh3_64_intdigest(main_text(root, frozenset())) >> 1
    longest = sorted(prose, key=lambda k: (-prose[k], k))[:2]
    found = dict.fromkeys(elsewhere, (False, text, ANYWHERE))
    places: dict[int, int] = {}
    for at, key in enumerate(order):
        back = len(order) - at
        place = at + 1 if at < back else -back
        places.setdefault(key, place if abs(place) <= config.edge else 0)
    headings = _headings(parts) if heads else set()
    for key, size in prose.items():
        if headings and _said(blocks[key]) in headings:
            continue
        title = heads[0] if heads else next((k for k in longest if k != key), 0)
        found[key] = size < config.line_words, title if size >= config.long_words else text, places[key]
    return text, found


def _passes(root: Element, templates: Set[int], copied: int) -> Iterator[str]:
    """Texts of the main part, ever more sparing: without templates; with those that are prose; with named asides, too."""
    parts, marked = _main_parts(root)
    own, words = {id(p) for p in parts}, sum(p.words for p in parts)
    headings: list[set[str]] = []

    def is_heading(element: Element) -> bool:
        if not headings:
            headings.append(_headings(parts))
        return _said(element) in headings[0]

    def text(spare_prose: bool, names: bool) -> str:
        said: list[str] = []
        recur = stay = 0
        todo: list = [(p, True, False) for p in reversed(parts)]
        while todo:
            part, alone, in_prose = todo.pop()
            if isinstance(part, str):
                said.append(part)
                continue
            whole = id(part) in own
            prose = part.tag in PROSE or part.tag in INLINE
            if not whole:
                if _dropped(part, marked, words, names):
                    continue
                key = _key(part, alone, in_prose, marked)
                known = bool(key) and key in templates and not (marked and prose and is_heading(part))
                if marked and prose and key and part.words:
                    recur, stay = recur + known, stay + (not known)
                if known and not (prose and spare_prose):
                    continue
            edge = [(" ", alone, in_prose)] if part.tag in BLOCKS else []
            said += [x[0] for x in edge]
            below = (_blocks(part, False)[0], False) if whole else _blocks(part, in_prose)
            todo += [*edge, *((p, *below) for p in reversed(part.parts))]
        if recur >= copied and recur > stay and not spare_prose:
            return ""
        return " ".join("".join(said).split())

    yield text(False, True)
    yield text(True, True)
    yield text(True, False)


def main_text(root: Element, templates: Set[int], copied: int = TemplateConfig.copied) -> str:
    """Text of the main part without templates and asides; blocks are joined by one blank."""
    return next(filter(None, _passes(root, templates, copied)), "")


class Asked(set):
    """Holds nothing, and remembers what it was asked for."""

    def __contains__(self, key: object) -> bool:
        self.add(key)
        return False


def asked_keys(root: Element, copied: int) -> list[int]:
    """Every template that could change the text of a page, wherever a pass may come to."""
    asked = Asked()
    for _ in _passes(root, asked, copied):
        pass
    return list(asked)


def host_of(url: Column) -> Column:
    """Host of an address, in lower case, without port and user; null if it has none."""
    host = F.regexp_extract(F.lower(url.cast("string")), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def site_templates(pages: DataFrame, config: TemplateConfig = TemplateConfig()) -> DataFrame:
    """``host, hash``: the subtrees that recur on a host's pages, a row each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_of: Counter = Counter()
            for host, html in zip(batch.column(0), batch.column(1)):
                host = host.as_py()
                root = parse(html.as_py())
                text, found = candidates(root, config)
                pages_of.update((host, key, line, 0, 0, TITLE) for key, line in title_keys(root, config))
                pages_of[host, 0, False, 0, 0, ANYWHERE] += 1  # pages of the host
                pages_of.update((host, key, line, text, title, place) for key, (line, title, place) in found.items())
            columns = [[k[j] for k in pages_of] for j in range(6)] + [list(pages_of.values())]
            kinds = (pa.string(), pa.int64(), pa.bool_(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "hash", "line", "text", "title", "place", "n"]
            )

    narrow = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string")).filter("host is not null")
    counts = narrow.mapInArrow(
        count, "host string, hash long, line boolean, text long, title long, place long, n long"
    )
    # Step by step, so that a text counts once and no key gathers its texts.
    by_text = counts.groupBy("host", "hash", "line", "title", "text", "place").agg(F.sum("n").alias("n"))
    by_title = by_text.groupBy("host", "hash", "line", "title", "place").agg(F.sum("n").alias("n"), F.count("*").alias("texts"))
    by_place = by_title.groupBy("host", "hash", "line", "place").agg(
        F.sum("n").alias("n"), F.sum("texts").alias("texts"), F.count("*").alias("titles")
    )
    counts = by_place.groupBy("host", "hash", "line").agg(
        F.sum("n").alias("n"), F.sum("texts").alias("texts"), F.sum("titles").alias("titles"),
        F.max(F.when(F.col("place") != 0, F.col("texts"))).alias("placed"), F.max(F.col("place") == TITLE).alias("title"),
    )
    several = (F.col("texts") >= config.least_pages) | (F.col("hash") == 0) | F.col("title")
    counts = materialize(counts.filter(several), "html-counts")
    counts = counts.join(counts.filter("title").select("hash").distinct(), "hash", "left_anti")
    totals = counts.filter("hash = 0").select("host", F.col("n").alias("pages"))
    share = F.least(F.lit(float(config.enough)), F.greatest(F.lit(float(config.least_pages)), F.col("pages") * config.least_share))
    often = (
        (F.col("texts") >= share) & (2 * F.col("titles") >= F.col("texts"))
        & (F.coalesce("placed", F.lit(0)) >= F.col("texts") * config.placed_share)
        & (~F.col("line") | (F.col("n") >= F.col("pages") * config.line_share))
    )
    return counts.filter("hash <> 0").join(totals, "host").filter(often).select("host", "hash")


def with_main_text(pages: DataFrame, config: TemplateConfig = TemplateConfig(), small: bool | None = None) -> DataFrame:
    """``page_id, url, text`` of every page; templates are those of the same pages.

    Few templates (measured, unless ``small`` says) go to every task. Many are joined to the subtrees of pages by host and
    hash, and each page meets only its own.
    """
    found = materialize(site_templates(pages, config), "html-templates")
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("_host"))
    if fits(found) if small is None else small:
        known: dict[str, set[int]] = {}
        for row in found.collect():
            known.setdefault(row["host"], set()).add(row["hash"])

        @F.pandas_udf("string")
        def extract(html: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for texts, hosts in html:
                yield pd.Series([
                    main_text(parse(h), known.get(host, frozenset()), config.copied) for h, host in zip(texts, hosts)
                ], dtype=object)

        return rows.select("page_id", "url", extract("html", "_host").alias("text"))

    @F.pandas_udf("array<long>")
    def hashes(html: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in html:
            yield pd.Series([asked_keys(parse(h), config.copied) for h in texts], dtype=object)

    @F.pandas_udf("string")
    def extract_own(html: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lists in html:
            yield pd.Series([
                main_text(parse(h), frozenset() if t is None else frozenset(t), config.copied) for h, t in zip(texts, lists)
            ], dtype=object)

    rows = rows.withColumn("_page", F.sha2(F.coalesce("html", F.lit("")), 256))
    each = rows.filter("_host is not null").select("_host", "_page", F.explode(hashes("html")).alias("hash")).distinct()
    met = each.join(found.withColumnRenamed("host", "_host"), ["_host", "hash"])
    met = met.groupBy("_host", "_page").agg(F.collect_list("hash").alias("_templates"))
    # Copies of one page are dealt to several groups.
    met = met.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(COPY_SALTS - 1))))
    rows = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(COPY_SALTS)).cast("int"))
    joined = rows.join(met, ["_host", "_page", "_salt"], "left")
    return joined.select("page_id", "url", extract_own("html", "_templates").alias("text"))
