"""Main text of HTML pages by two-pass block rules.

Pass 1 classifies every block by itself: blocks of navigation, forms, notices,
adverts, comments and the like (by element, role, class or id) and blocks of
links are boilerplate; blocks in an article or main element with few links, and
long blocks with many stop-words, are text; long blocks with few links and few
stop-words, headings and short blocks are ambiguous, also short blocks of an
article with many links, unless they are list items of nothing else.

Role, class and id say nothing about html, body, main, the first article, and
what holds the first of these; "has-sidebar" or "category-social" name no part.

Pass 2 gives ambiguous blocks the label of the nearest decided neighbours: that
of both, if they agree; else that of the nearer one, where a heading looks
forward first. A page on which nothing is decided keeps its ambiguous blocks.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, pieces

LONG, LINKS, STOPS = 120, 0.35, 0.2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|select|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>", re.S | re.I)
_FOREIGN_END = re.compile(r"</(svg|math)\s*>", re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_HINT_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")

#: Elements that end a block.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6
head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul caption button""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never part of the article.
AROUND = frozenset("nav footer aside form button fieldset legend menu dialog head input label option".split())
#: Words in class, id or role that name what surrounds an article.
HINTS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies copyright
dialog disclaimer disqus footer form gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices outbrain overlay paging pager
pagination popup popups promo promos promotion recommended related reply replies respond search share sharing sidebar sidebars signin signup social sponsor
sponsored subscribe subscription taboola toolbar toc topbar widget widgets complementary alert alertdialog""".split())
INSIDE = frozenset("article main".split())
#: First words of a class or id that tell of a page or its subject, not of what the element is.
STATES = frozenset("has have with without no not is are show shows hide hides category categories tag tags tagged type status format template theme".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset("""the of and to a in is it that was for on are with as be at by this have from or an not which but they you we his her its were has had
der die das und ist in den von zu mit sich des auf für nicht ein eine einen dem als auch es an werden aus er hat dass sie nach wird bei um am sind noch wie über so zum
le la les de des du un une et est en que qui dans pour pas sur au par avec ce il elle plus se sont son sa ses ne ou mais nous vous cette
el los las del y que en un una se por con no su para es al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre""".split())

TEXT, AMBIGUOUS, AROUND_TEXT = 1, 0, -1


@dataclass
class Block:
    text: str
    linked: int
    element: str
    around: bool
    inside: bool


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order, white space collapsed, references decoded."""
    out: list[Block] = []
    open_: list[tuple[str, bool, bool]] = []  # element, surrounds the article, holds it
    places: dict[str, list[int]] = {}  # where in open_ the elements of a name stand
    block_places: list[int] = []  # where the blocks stand
    walls: list[int] = []  # where elements stand that surround the article or have a hint: an inline end tag does not reach over them
    hinted: list[list] = []  # open elements with a hint: depth, blocks they hold; a hint falls if the first article is found in its element
    found = set()
    parts: list[str] = []
    linked, links, at = 0, 0, 0
    around = inside = 0
    element = "body"

    def flush():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, min(linked, len(text)), element, around > 0 or bool(hinted), inside > 0))
            if hinted and not around:
                hinted[-1][1].append(len(out) - 1)
        parts.clear()
        linked = 0

    def add(raw: str):
        nonlocal linked
        if raw:
            text = entities.unescape(raw)
            parts.append(text)
            if links:
                linked += len(" ".join(text.split()))

    def close(upto: int):
        nonlocal around, inside, links
        while len(open_) > upto:
            name, out_, in_ = open_.pop()
            places[name].pop()
            for kept in (block_places, walls):
                if kept and kept[-1] == len(open_):
                    kept.pop()
            if hinted and hinted[-1][0] == len(open_):
                held = hinted.pop()[1]
                if hinted:
                    hinted[-1][1] += held
            around -= out_
            inside -= in_
            links -= name == "a"

    foreign: dict[str, list[tuple[int, int]]] = {"svg": [], "math": []}  # their end tags; <svg/> is empty, and one without an end tag hides nothing
    for m in _FOREIGN_END.finditer(page):
        foreign[m[1].lower()].append(m.span())
    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        add(page[at:m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in foreign and not m[2]:
            end = bisect_left(foreign[name], (at, 0))
            if not m[0].endswith("/>") and end < len(foreign[name]):
                at = foreign[name][end][1]
            continue
        if name == "br":
            parts.append("\n")
            continue
        block = name in BLOCKS
        if block:
            flush()
        if m[2]:
            if places.get(name) and (block or not walls or walls[-1] <= places[name][-1]):
                close(places[name][-1])
            element = open_[block_places[-1]][0] if block_places else "body"
        else:
            if block and block_places:  # formatting and paragraphs left open end here, as browsers have it
                last = open_[block_places[-1]][0]
                if last == "p" or (last == name and name in ("li", "dd", "dt", "tr", "td", "th", "option")):
                    close(block_places[-1])
            hint, hidden = _hints(m[4]) if m[4] and not m[4].isspace() else (False, False)
            if name not in VOID and not m[0].endswith("/>"):
                out_ = name in AROUND or hidden or (name == "header" and not inside)
                first = name in INSIDE and name not in found and not around and not out_
                if first and (name == "main" or not found):
                    for _, held in hinted:
                        for k in held:
                            out[k].around = False
                    hinted.clear()
                    walls[:] = [k for k, e in enumerate(open_) if e[1]]
                if first:
                    found.add(name)
                if hint and not out_ and name not in ("html", "body", "main") and not first:
                    hinted.append([len(open_), []])
                if out_ or (hinted and hinted[-1][0] == len(open_)):
                    walls.append(len(open_))
                if block:
                    block_places.append(len(open_))
                places.setdefault(name, []).append(len(open_))
                in_ = name in INSIDE and not around and not hinted
                open_.append((name, out_, in_))
                around += out_
                inside += in_
                links += name == "a"
            if block:
                element = name
    add(page[at:])
    flush()
    return out


def _hints(attributes: str) -> tuple[bool, bool]:
    """Whether class, id or role name a surrounding, and whether the element is hidden."""
    hint = hidden = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        name = name.lower()
        if name in ("class", "id", "role"):
            hint = hint or any(_names_surrounding(token) for token in value.split())
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            hidden = True
    return hint, hidden


def _names_surrounding(token: str) -> bool:
    """Whether the first or the last word of a class, id or role is a hint."""
    words = [w.lower() for w in _HINT_WORD.findall(token)]
    return bool(words) and words[0] not in STATES and (words[0] in HINTS or words[-1] in HINTS)


def first_pass(block: Block) -> int:
    if block.around:
        return AROUND_TEXT
    if block.linked > LINKS * len(block.text):
        bare = block.element == "li" and block.linked == len(block.text)
        return AMBIGUOUS if block.inside and len(block.text) < LONG and not bare else AROUND_TEXT
    if block.inside and block.element not in HEADINGS:
        return TEXT
    if len(block.text) >= LONG and block.element not in HEADINGS:
        words = _WORD.findall(block.text.lower())
        if words and sum(w in STOP_WORDS for w in words) >= STOPS * len(words):
            return TEXT
    return AMBIGUOUS


def second_pass(found: list[Block], labels: list[int]) -> list[int]:
    n = len(found)
    before, after = [None] * n, [None] * n
    last = None
    for k in range(n):
        before[k] = last
        last = k if labels[k] else last
    last = None
    for k in range(n - 1, -1, -1):
        after[k] = last
        last = k if labels[k] else last
    out = []
    for k, label in enumerate(labels):
        if label == AMBIGUOUS:
            b, a = before[k], after[k]
            if b is None and a is None:
                label = TEXT
            elif b is None or a is None:
                label = labels[a if b is None else b]
                if label == AROUND_TEXT and found[k].inside:
                    label = TEXT
            elif labels[a] == labels[b]:
                label = labels[a] if not found[k].inside else TEXT
            elif found[k].inside:
                label = TEXT
            elif found[k].element in HEADINGS:
                label = labels[a]
            else:
                label = labels[a] if a - k < k - b else labels[b] if k - b < a - k else AROUND_TEXT
        out.append(label)
    if TEXT not in out:  # nothing but surroundings was decided: what is ambiguous is all the text there is
        out = [TEXT if label == AMBIGUOUS else o for label, o in zip(labels, out)]
    return out


def main_text(page: str | None) -> str:
    """The article of ``page``, its blocks joined by two newlines; empty for a null or empty page."""
    if not page:
        return ""
    found = blocks(page)
    labels = second_pass(found, [first_pass(b) for b in found])
    return "\n\n".join(b.text for b, label in zip(found, labels) if label == TEXT)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of every page with ``text`` and ``n_chars`` (its code points); null html is an empty page."""
    def make():
        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in pieces(rows, "html"):
                texts = [main_text(x.as_py()) for x in part.column(0)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])
        return batch

    rows = pages.select(F.col(html_col).cast("string").alias("html"), *keep)
    return map_batches(rows, make, ", ".join([*(f"{c} {dict(rows.dtypes)[c]}" for c in keep), "text string", "n_chars long"]))
