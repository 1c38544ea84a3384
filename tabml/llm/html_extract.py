"""Main text of web pages by two-pass block rules.

Pass 1 decides each block by itself: boilerplate containers (navigation, headers, footers, sidebars, forms, notices,
adverts, comments, by element, role or a name of such words alone) are bad; a boilerplate word within a longer name is only
a suspicion, against which long prose without links wins; blocks of the article container are good unless they are links for the most part: several
links are bad, a single one stays open; elsewhere length, link density and stop-word density decide, and short or
half-dense blocks stay open.  Pass 2 gives open blocks the label of the nearest decided blocks (of the article, for the
article's): good only if both sides, or the only side, are good; headings look forward.

Pages are parsed by a linear tokenizer inside Arrow batches; nothing of a page is shuffled.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tabml.llm._common import col

#: Frequent function words of the supported languages.
STOP_WORDS = frozenset(
    """
    a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which will with you
    al como con de del el en es esta este la las lo los más no para pero por que se si sin sobre son su sus un una y
    au aux avec ce ces cette dans des du elle est et il ils je la le les leur mais ne nous ou par pas plus pour qui sa se ses son sur une vous
    aber als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch nur oder sich sie sind so um und von war wie wird zu zum zur über
    """.split()
)
#: Elements without text of their own.
RAW = frozenset("script style noscript template textarea svg math iframe object select canvas audio video title button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE = frozenset("nav footer menu head".split())
#: Boilerplate too, unless the page's article is inside.
ENCLOSING = frozenset("header aside form dialog".split())
#: Raw elements that can hold others of their name, and those that may end in their own tag.
NESTED, FOREIGN = frozenset("template svg math object".split()), frozenset("svg math".split())
BOILERPLATE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar".split())
ARTICLE = frozenset("article main".split())
#: Words of a class or id that name boilerplate.
BOILERPLATE_NAME = frozenset(
    """
    ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe
    subscription signup login nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside header masthead topbar footer colophon copyright comment comments commentlist disqus
    respond reply replies related recommended recommendations share sharing social pagination pager widget widgets toolbar skip
    """.split()
)
#: Of these, what names other texts than the page's own, also where they are articles.
OTHER_NAME = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment comments commentlist disqus respond reply replies related recommended recommendations".split())
#: Words that leave a name's meaning as it is: with boilerplate words and these alone a name names boilerplate outright.
GENERIC = frozenset(
    """
    area bar block bottom box col column container footer form group header heading holder inner item items left line link links list menu meta module outer
    panel reader region right row section slot thread title top unit user wrap wrapper zone
    """.split()
)
#: Words that do so only beside those for other texts ("comment-content"): alone they may name the page's own.
GENERIC_OTHER = frozenset("body content main post posts text".split())
#: A class with one of these tells the state of a container ("no-sidebar", "has-comments"), not what it is.
STATE = frozenset("no not has have with without free".split())
MAIN_ID = frozenset("main content main-content maincontent main_content".split())
NONE, ARTICLE_PART, MAIN_PART = range(3)  # what of the page's content an element is
LOOSE, NAMED, OTHER = range(3)  # a boilerplate word within a longer name (a suspicion), as the whole name, a name of other texts

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
WORD = re.compile(r"[^\W\d_]+")
SPACE = re.compile(r"\s+")

LOW_LINKS, HIGH_LINKS = 0.2, 0.5
SHORT, LONG = 70, 200
LOW_STOPS, HIGH_STOPS = 0.15, 0.30


class Block:
    __slots__ = ("text", "link_chars", "links", "heading", "bad", "mark", "article", "listed", "good", "suspect")

    def __init__(self, text: str, link_chars: int, links: int, heading: bool, bad: bool, mark: Mark | None, article: bool, listed: bool) -> None:
        self.text, self.link_chars, self.links, self.heading = text, link_chars, links, heading
        self.bad, self.mark, self.article, self.listed, self.good, self.suspect = bad, mark, article, listed, None, False


class Mark:
    """A container that its class or id calls boilerplate; an article or main inside may clear it."""

    __slots__ = ("level", "parent", "named", "mains", "holds", "clear", "bad", "suspect")

    def __init__(self, level: int, parent: Mark | None, mains: int) -> None:
        self.level, self.parent, self.mains = level, parent, mains
        self.named = level != LOOSE or parent is not None and parent.named
        self.holds, self.clear, self.bad, self.suspect = NONE, False, True, False


def _names(named: str) -> tuple[set[str], int | None]:
    """(words of a class and id, how its boilerplate words name the element; None without)."""
    words, level = set(), None
    for name in named.split():
        own = {w.lower() for w in NAME_WORD.findall(name)}
        if own & STATE:
            continue
        whole = name.lower().replace("-", "").replace("_", "")
        found = (own | {whole}) & BOILERPLATE_NAME
        if found:
            generic = GENERIC | GENERIC_OTHER if found & OTHER_NAME else GENERIC
            exact = whole in found or all(w in BOILERPLATE_NAME or w in generic or w.isdigit() for w in own)
            level = max(level or LOOSE, LOOSE if not exact else OTHER if found & OTHER_NAME else NAMED)
        words |= own | {whole}
    return words, level


def _kind(name: str, attrs: str, in_article: bool) -> tuple[bool, int | None, int]:
    """(boilerplate, level of a name that says so, part of the content) of an element from its name, role, class and id."""
    own_header = name == "header" and in_article
    if name in BOILERPLATE and not own_header:
        return True, None, NONE
    found = {}
    for k, a, b, c in ATTRIBUTE.findall(attrs):
        found.setdefault(k.lower(), a or b or c)
    if "hidden" in found or NOT_SHOWN.search(found.get("style", "")) or found.get("aria-hidden") == "true" or found.get("role", "").lower() in BOILERPLATE_ROLE:
        return True, None, NONE
    if name in ENCLOSING and not own_header:
        return False, NAMED, NONE
    if name not in ("html", "body") and not own_header:
        words, level = _names(f"{found.get('class', '')} {found.get('id', '')}")
        if name == "main" or found.get("role") == "main":
            return False, None, MAIN_PART
        if name == "article" or found.get("role") == "article":
            return bool(words & {"comment", "comments", "ad", "ads", "advert", "related"}), None, ARTICLE_PART
        if level is not None and not (in_article and words & BOILERPLATE_NAME <= {"header"}):
            return False, level, NONE
        if name in ("div", "section", "td"):
            named = words & {"article", "story"} or {"post", "content"} <= words or {"entry", "content"} <= words or found.get("id", "").lower() in MAIN_ID
            return False, None, ARTICLE_PART if named else NONE
    return False, None, NONE


NO_ELEMENT = ("", False, None, False, 0)


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order with what pass 1 needs."""
    blocks: list[Block] = []
    stack: list[tuple[str, bool, Mark | None, bool, int]] = []  # open elements: name, boilerplate, mark, article, mains, each with what encloses it
    marks: list[Mark] = []
    outside = 0  # article containers outside of any container with a boilerplate name
    parts: list[str] = []
    link_from, link_chars, links, heading = None, 0, 0, False
    open_names: Counter[str] = Counter()
    unclosed: set[str] = set()  # raw elements without an end in the rest of the page

    def text(piece: str) -> None:
        nonlocal link_chars
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if link_from is not None:
                link_chars += len(piece.strip())

    def flush() -> None:
        nonlocal link_chars, links
        if parts:
            whole = SPACE.sub(" ", "".join(parts)).strip()
            if whole:
                _, bad, mark, article, _ = stack[-1] if stack else NO_ELEMENT
                listed = any(s[0] in ("ul", "ol", "menu") for s in stack[-4:])
                if open_names["header"] and not heading:  # of an article's own header, the headings
                    bad |= any(s[0] == "header" and k and stack[k - 1][3] for k, s in enumerate(stack))
                blocks.append(Block(whole, link_chars, links, heading, bad, mark, article, listed))
            parts.clear()
        link_chars, links = 0, 1 if link_from is not None else 0

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            text(m["cdata"] or "")
            continue
        name = name.lower()
        if m["close"]:
            if name == "a":
                link_from = None
            if name in BLOCK:
                flush()
            if name in HEADING:
                heading = False
            while open_names[name]:
                gone = stack.pop()[0]
                open_names[gone] -= 1
                if gone == name:
                    break
            continue
        if name in BLOCK:
            flush()
        if name in FOREIGN and m["attrs"].endswith("/"):
            continue
        if name in NESTED and name not in unclosed:
            at = _past(page, at, name)
            if at < 0:
                unclosed.add(name)
                at = m.end()
            continue
        if name in RAW:
            closing = None if name in unclosed else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if closing is None:
                if name in ("script", "style"):
                    break
                unclosed.add(name)
            at = closing.end() if closing else at
            continue
        if name == "a":
            link_from, links = m.start(), links + 1
        if name in HEADING:
            heading = True
        if name in VOID or m["attrs"].endswith("/") and name not in BLOCK:
            continue
        if name in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == name:
            open_names[stack.pop()[0]] -= 1
        if name in ARTICLE or name == "body":  # an unclosed element before the content does not swallow it
            while stack and stack[-1][0] in ("p", "head", "a", "b", "i", "span", "li"):
                open_names[stack.pop()[0]] -= 1
        _, bad, mark, article, mains = stack[-1] if stack else NO_ELEMENT
        own_bad, level, part = _kind(name, m["attrs"], article)
        if level is not None:
            mark = Mark(level, mark, mains)
            marks.append(mark)
        if part and not own_bad and not bad:
            if mark is not None:
                mark.holds = max(mark.holds, part)
            if mark is None or not mark.named:
                outside += 1
                mains += part == MAIN_PART
        stack.append((name, bad or own_bad, mark, article or part != NONE, mains))
        open_names[name] += 1
    flush()
    _clear(blocks, marks, outside)
    return blocks


def _past(page: str, at: int, name: str) -> int:
    """The place behind the end of an element that is open at ``at``, others of its name inside counted; -1 without end."""
    depth = 1
    for m in re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>", re.I).finditer(page, at):
        depth += -1 if m[1] else 0 if name in FOREIGN and m[0].endswith("/>") else 1
        if not depth:
            return m.end()
    return -1


def _clear(blocks: list[Block], marks: list[Mark], outside: int) -> None:
    """Names do not count against a container around the page's article.

    A ``main`` clears every container around it, an article those with a boilerplate word within a longer name.  An
    article clears one named by such words alone if no other article is outside, and one that names other texts if the
    page has nothing else.
    """
    for mark in reversed(marks):  # the inner ones first
        if mark.parent is not None:
            mark.parent.holds = max(mark.parent.holds, mark.holds)
        mark.clear = mark.holds == MAIN_PART or mark.holds != NONE and (mark.level == LOOSE or mark.level == NAMED and outside == mark.mains)
    for last in (False, True):
        for mark in marks:
            mark.clear |= last and mark.holds != NONE
            mark.bad = not mark.clear and mark.level != LOOSE or mark.parent is not None and mark.parent.bad
            mark.suspect = not mark.clear and mark.level == LOOSE or mark.parent is not None and mark.parent.suspect
        if any(not b.bad and (b.mark is None or not b.mark.bad) for b in blocks):
            break
    for b in blocks:
        b.bad |= b.mark is not None and b.mark.bad
        b.suspect = b.mark is not None and b.mark.suspect and not b.bad


def _density(text: str) -> float:
    words = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def decide(blocks: list[Block]) -> None:
    """Pass 1, then pass 2, on the blocks of one page."""
    for b in blocks:
        share = b.link_chars / len(b.text)
        if b.bad or (b.article and b.listed and b.links and share > HIGH_LINKS):
            b.good = False
        elif b.suspect:  # a name alone decides nothing: long prose without links wins, the rest goes by it
            prose = len(b.text) > LONG and share <= LOW_LINKS and _density(b.text) >= HIGH_STOPS
            b.good = True if prose else False if share > HIGH_LINKS else None
        elif b.article:  # the container is the prior: only what is links for the most part is judged
            b.good = True if b.heading or share <= HIGH_LINKS else False if b.links > 1 else None
        elif share > HIGH_LINKS or b.text.startswith("©"):
            b.good = False
        elif b.heading or len(b.text) < SHORT:
            b.good = False if share > LOW_LINKS else None
        else:
            stops = _density(b.text)
            if stops >= HIGH_STOPS and share <= LOW_LINKS:
                b.good = True if len(b.text) > LONG or stops >= HIGH_STOPS else None
            elif stops >= LOW_STOPS:
                b.good = True if len(b.text) > LONG and share <= LOW_LINKS else None
            else:
                b.good = None if len(b.text) > LONG and not share else False
    groups: dict[int, list[Block]] = {}
    for b in blocks:
        if b.suspect:
            groups.setdefault(id(b.mark), []).append(b)
    for group in groups.values():
        if any(b.good for b in group):
            _settle(group)
        elif not group[0].article:  # nothing speaks against the name
            for b in group:
                b.good = False
    _settle([b for b in blocks if b.article and not b.bad])
    _settle(blocks)


def _settle(blocks: list[Block]) -> None:
    """Pass 2: open blocks get the label of the nearest decided ones."""
    n = len(blocks)
    before, after = [None] * n, [None] * n
    for order, out in ((range(n), before), (range(n - 1, -1, -1), after)):
        last = None
        for k in order:
            out[k] = last
            last = last if blocks[k].good is None else blocks[k].good
    for k, b in enumerate(blocks):
        if b.good is None:
            sides = [s for s in ((after[k],) if b.heading and after[k] is not None else (before[k], after[k])) if s is not None]
            b.good = all(sides) if sides else True


def main_text(page: str | None) -> str:
    """The main text: good blocks in page order, one to a line; empty for null or where there is none."""
    blocks = blocks_of(page or "")
    decide(blocks)
    return "\n".join(b.text for b in blocks if b.good)


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page, repeated rows included: page_id, url, ``text``, ``n_chars`` (its code points).

    A null or empty page has the empty text; pages of any length are read whole, in time that follows their length.  Other
    columns are not looked at; null ids and URLs pass through; an empty
    table gives no row.  A page where nothing is decided (bare text) is its own text.
    """
    rows = pages.select(col(id_col).cast("bigint").alias("page_id"), col(url_col).cast("string").alias("url"), col(html_col).alias("html"))
    return rows.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
