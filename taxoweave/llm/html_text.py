"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass classifies each
block by what surrounds it (menus, footers, notices and the like), and where
that says nothing by its length, link density and share of stop words, inside
articles and mains as well. Short blocks stay undecided, and linked ones within
an article. The second pass gives them the label of their nearest decided
neighbours; articles and mains are a prior there.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import or_empty, ship_package

# HTML's elements by what they mean for the text of a page, and words that mark page furniture.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select
    summary table tbody td tfoot th thead title tr ul noscript search""".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIPPED = frozenset("""script style textarea title head template noscript iframe object embed svg math canvas audio video select option
    button datalist map noembed noframes xmp""".split())
FURNITURE = frozenset("nav header footer aside form menu dialog search".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What an open element of the first kind is closed by.
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option", "optgroup"]),
    "p": BLOCKS - frozenset(["body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"]),
    "thead": frozenset(["tbody", "tfoot"]), "tbody": frozenset(["tbody", "tfoot"]), "head": frozenset(["body"]),
}
FURNITURE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner
    nav navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs topbar toolbar masthead sidebar aside rail widget widgets
    footer foot colophon copyright legal cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay
    comment comments commentlist respond reply replies disqus discussion related recommended recommendations share sharing social
    newsletter subscribe subscription signup login search pagination pager paging tags skip outbrain taboola""".split())
HEADER_OF_PAGE = frozenset("site page main global top".split())
COMMENT_WORDS = frozenset("ad ads advert comment comments reply replies related recommended sponsored promo".split())
STATE_WORDS = frozenset("no has with without is".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
STOP_WORDS = frozenset("""the of and to a in is that it for was on are as with his they be at this have from or by not but what all were we when
    your can said there use an each which she do how their if will up about out many then them these so some her would make like him into
    der die das und in zu den von mit ist des sich nicht auf für im dem ein eine auch als an es werden aus er hat dass sie nach wird bei
    le la les de des et en un une du que qui dans pour pas sur au avec ce il est par plus se son ne el los las y que del por con para una su
    al lo como más o pero sus""".split())

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

LONG, SHORT = 70, 25
LINKED, FEW_STOP, MANY_STOP = 0.33, 0.05, 0.15
MENU_ROW = 3

TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACES = re.compile(r"\s+")
PARTS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"([a-z])([A-Z])")
# The heading that reader comments stand under, and the line of rights at a page's end.
OF_COMMENTS = re.compile(r"(?:\d[\d.,]*|no) (?:reader )?(?:comments?|replies|responses?)(?: (?:on|to)\b.*)?|(?:reader )?comments? ?[(\[]\d[\d.,]*[)\]]"
                         r"|(?:leave|post|add|write) an? (?:comment|reply|response)", re.I)
OF_RIGHTS = re.compile(r"(?:copyright|©|\(c\))[ ©(c)]*\d{4}\b.*|.*\ball rights reserved\.?", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass
class Block:
    """One block of a page: its text, how much of it is linked, and where it stands."""

    parts: list[str] = field(default_factory=list)
    linked: int = 0
    furniture: bool = False
    inside: int = -1
    holder: int = -1
    main: bool = False
    article: bool = False
    suspect: bool = False
    heading: bool = False
    text: str = ""
    label: str = ""


def _attributes(source: str) -> dict[str, str]:
    if not source.strip():
        return {}
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)}


SURE, LISTED, HINT = 3, 2, 1


def _furniture(tag: str, attrs: dict[str, str]) -> int:
    """How surely an element holds something else than the page's own text, by its name, role and class; 0 says nothing.

    A class of listed words alone is ``LISTED``; a form and a class that merely
    contains a listed word are a ``HINT``.
    """
    role = attrs.get("role", "").lower()
    if role in FURNITURE_ROLES and role != "form" or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return SURE
    if HIDDEN.search(attrs.get("style", "")):
        return SURE
    if tag in ("html", "body"):
        return 0
    if tag in FURNITURE and tag != "form":
        return SURE
    level = HINT if tag == "form" or role == "form" else 0
    marks = COMMENT_WORDS if tag in ("article", "main") else FURNITURE_WORDS
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = PARTS.findall(CAMEL.sub(r"\1 \2", name).lower())
        if not words or words[0] in STATE_WORDS:
            continue
        if words == ["header"] or words[-1] == "header" and words[0] in HEADER_OF_PAGE or marks.issuperset(words):
            level = LISTED
        elif marks.intersection(words):
            # "site-footer" and "main-nav" are a footer and a menu.
            level = max(level, LISTED if words[-1] in marks and words[0] in HEADER_OF_PAGE else HINT)
    return level


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, each with its text; the hidden and the empty ones are left out."""
    out: list[Block] = []
    # Open elements: name, whether skipped, furniture, in a main (1) or an article (2), the numbers of the innermost suspect one and of that around the first article or main.
    stack: list[tuple[str, bool, bool, int, int, int]] = []
    nothing = ("", False, False, 0, -1, -1)
    suspects: list[tuple[int, int]] = []  # level, and the suspect element around
    opened: dict[str, int] = {}
    current, links, at, begun = Block(), 0, 0, False

    def end_block() -> None:
        nonlocal current, begun
        if current.parts:
            current.text = SPACES.sub(" ", "".join(current.parts)).strip()
            if current.text:
                out.append(current)
                begun = begun or len(current.text) > LONG and not current.furniture
        current = Block()

    def end_of_text() -> None:
        """Behind its text, a heading of comments makes furniture of itself and of what follows in its element."""
        nonlocal nothing
        if begun and out[-1].heading and OF_COMMENTS.fullmatch(out[-1].text):
            out[-1].furniture = True
            if stack:
                stack[-1] = (*stack[-1][:2], True, *stack[-1][3:])
            else:
                nothing = (*nothing[:2], True, *nothing[3:])

    def add(raw: str, decode: bool = True) -> None:
        if raw and not (stack and stack[-1][1]):
            text = html.unescape(raw) if decode and "&" in raw else raw
            if not current.parts:
                _, _, current.furniture, main, current.inside, current.holder = stack[-1] if stack else nothing
                current.main, current.article = main > 0, main == 2
                current.heading = any(e[0] in HEADINGS for e in stack[-3:])
            current.parts.append(text)
            if links:
                current.linked += len(text)

    def pop() -> str:
        nonlocal links
        name = stack.pop()[0]
        links -= name == "a"
        opened[name] = opened.get(name, 0) - 1
        return name

    def close(tag: str) -> None:
        while stack and pop() != tag:
            pass

    n = len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        found = TOKEN.match(page, start)
        if not found:
            add(page[at:start + 1])
            at = start + 1
            continue
        add(page[at:start])
        at = found.end()
        if found["cdata"] is not None:
            add(found["cdata"], decode=False)
        if not (found["tag"] or found["tag2"]):
            continue
        tag, source = (found["tag"] or found["tag2"]).lower(), found["attrs"] or found["attrs2"] or ""
        if tag == "br" and current.parts:
            current.parts.append(" ")
        if tag in BLOCKS:
            end_block()
        if found["close"] or found["close2"]:
            if opened.get(tag):
                # An inline end tag doesn't close the blocks around it.
                inside = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)
                if tag in BLOCKS or tag in SKIPPED or not any(e[0] in BLOCKS for e in stack[inside + 1:]):
                    close(tag)
                    if tag in HEADINGS:
                        end_of_text()
                elif tag == "a":
                    stack[inside], links = ("", *stack[inside][1:]), links - 1
                    opened[tag] -= 1
            continue
        if tag in VOID:
            continue
        while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
            pop()
        if tag in BLOCKS:  # formatting that was left open ends with its paragraph
            k = len(stack) - 1
            while k >= 0 and stack[k][0] not in BLOCKS:
                k -= 1
            if k >= 0 and stack[k][0] == "p" and tag in CLOSED_BY["p"]:
                close("p")
        attrs = _attributes(source)
        _, skipped, furniture, main, inside, holder = stack[-1] if stack else nothing
        in_article = main and tag == "header" and any(e[0] in ("article", "main") for e in stack)
        level = 0 if in_article else _furniture(tag, attrs)
        if level in (LISTED, HINT):
            suspects.append((level, inside))
            inside = len(suspects) - 1
        if not main and (tag in ("article", "main") or attrs.get("role") == "main"):
            main, holder = 1, inside
        if tag == "article":
            main = 2
        stack.append((tag, skipped or tag in SKIPPED, furniture or level == SURE, main, inside, holder))
        links += tag == "a"
        opened[tag] = opened.get(tag, 0) + 1
        if tag in RAW and not source.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            close(tag)
    end_block()
    _weigh_suspects(out, suspects)
    return out


def _weigh_suspects(found: list[Block], suspects: list[tuple[int, int]]) -> None:
    """Decide which suspect elements are furniture, by what they hold.

    One of listed words is, unless all text of articles and mains is in it, or
    most of the page's text while no block outside such elements reads like
    text. A form or a mere hint is nothing if it holds half of the text of
    articles and mains or of the page's; else its blocks stay suspect.
    """
    held, mains, total, all_mains = [0] * len(suspects), [0] * len(suspects), 0, 0
    for block in found:
        if block.furniture:
            continue
        size = len(block.text)
        total += size
        all_mains += size * block.main
        if block.inside >= 0:
            held[block.inside] += size
        if block.holder >= 0:
            mains[block.holder] += size
    for i in range(len(suspects) - 1, -1, -1):
        around = suspects[i][1]
        if around >= 0:
            held[around] += held[i]
            mains[around] += mains[i]
    # For each element the innermost listed one that it is or lies in, and the texts that no other listed one stands around.
    listed: list[int] = []
    for i, (level, around) in enumerate(suspects):
        listed.append(i if level == LISTED else listed[around] if around >= 0 else -1)
    texts = [0] * len(suspects)
    outside = 0
    for block in found:
        if _reads_like_text(block):
            at = listed[block.inside] if block.inside >= 0 else -1
            if at >= 0:
                texts[at] += 1
            else:
                outside += 1
    verdicts: list[int] = []  # the surest level of an element and those around it
    for i, (level, around) in enumerate(suspects):
        if level == LISTED:
            wraps = 0 < all_mains == mains[i] or outside == 0 and total < 2 * held[i]
            if wraps and (around < 0 or verdicts[around] < LISTED):
                outside += texts[i]
        else:
            wraps = 0 < all_mains <= 2 * mains[i] or total < 2 * held[i]
        verdicts.append(max(0 if wraps else level, verdicts[around] if around >= 0 else 0))
    for block in found:
        verdict = verdicts[block.inside] if block.inside >= 0 else 0
        block.furniture = block.furniture or verdict == LISTED
        block.suspect = verdict == HINT


def _stops(text: str) -> float:
    """Share of stop words."""
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)


def _reads_like_text(block: Block) -> bool:
    """Whether length, link density and stop words alone speak for a block."""
    return not block.furniture and len(block.text) > LONG and block.linked / len(block.text) <= LINKED and _stops(block.text) >= MANY_STOP


def _first_pass(block: Block) -> str:
    """``good``, ``bad``, ``linked`` (bad by its links alone), ``near`` (leans to good) or ``short`` (undecided)."""
    if block.furniture:
        return "bad"
    text = block.text
    if block.linked / len(text) > LINKED:
        return "linked"
    if not block.main and len(text) < 2 * LONG and OF_RIGHTS.fullmatch(text):
        return "bad"
    stops = _stops(text)
    if block.suspect:
        return "short" if stops >= MANY_STOP and len(text) > LONG else "bad"
    if len(text) < SHORT or block.heading:
        return "short"
    if stops >= MANY_STOP:
        return "good" if len(text) > LONG else "near"
    return "near" if stops >= FEW_STOP or len(text) >= LONG else "short"


def classify(found: list[Block]) -> list[Block]:
    """Label every block ``good`` or ``bad``.

    An undecided block takes the label of the nearest decided block on either
    side, good if they are equally near; a heading looks ahead first. Page
    furniture is no neighbour. A block that leans to good is bad only between
    bad ones. What has no neighbours is good.

    Articles and mains are a prior, where they hold as much text as the good
    blocks outside: undecided blocks in them lean to good, those outside to
    bad, and a neighbour counts only if no block of the other side of that
    border stands between. Linked blocks are undecided in such an article and
    bad elsewhere; three or more in a row that are links alone are a menu,
    unless a heading of the article introduces them.
    """
    first = [_first_pass(b) for b in found]
    inside = sum(len(b.text) for b in found if b.main and not b.furniture)
    prior = inside > 0 and inside >= sum(len(b.text) for b, label in zip(found, first) if label == "good" and not b.main)
    if prior:
        for i, block in enumerate(found):
            if first[i] == "linked" and block.article and not block.suspect and not block.heading:
                first[i] = "short"
            elif block.main and not block.suspect and (first[i] == "short" or first[i] == "linked" and block.heading):
                first[i] = "near"
            elif not block.main and first[i] == "near":
                first[i] = "short"
    first = ["bad" if label == "linked" else label for label in first]
    # A row of blocks that are links alone is a menu, but for a list under a heading of the article.
    run = 0
    for i in range(len(found) + 1):
        linked = i < len(found) and found[i].linked >= 0.9 * len(found[i].text)
        if not linked and run >= MENU_ROW:
            above = found[i - run - 1] if i > run else None
            if not (prior and above and above.heading and all(b.article and not b.suspect for b in found[i - run - 1:i])):
                first[i - run:i] = ["bad"] * run
        run = run + 1 if linked else 0
    sides: list[list[tuple[int, str]]] = [[], []]
    for side, order in enumerate((range(len(found)), range(len(found) - 1, -1, -1))):
        last, region = (-1, ""), None
        for i in order:
            if prior and not found[i].furniture and found[i].main != region:
                last, region = (-1, ""), found[i].main
            sides[side].append(last)
            if first[i] in ("good", "bad") and not found[i].furniture:
                last = (i, first[i])
    sides[1].reverse()
    for i, block in enumerate(found):
        label, (left, before), (right, after) = first[i], sides[0][i], sides[1][i]
        if label == "near":
            label = "bad" if before == after == "bad" else "good"
        elif label == "short":
            if not before or not after:
                label = before or after or ("bad" if prior and not block.main else "good")
            elif block.heading:
                label = after
            else:
                label = before if i - left < right - i else after if right - i < i - left else "good" if "good" in (before, after) else "bad"
        block.label = label
    return found


def main_text(page: str | None) -> str:
    """The good blocks of a page in order, joined by line ends; null and empty pages have none."""
    return "\n".join(b.text for b in classify(blocks(page)) if b.label == "good") if page else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` (code points), one row for each input row.

    Whole pages are read. Null pages have the empty text; ids and urls pass as
    they are, null or repeated. Other columns are ignored; an empty table gives
    an empty result.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(F.col(id_col), F.col(url_col), or_empty(html_col).alias("__html"))
    kinds = [f.dataType.simpleString() for f in rows.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(p) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [id_col, url_col, "text", "n_chars"])

    return rows.mapInArrow(run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long")
