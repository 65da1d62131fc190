"""Operator 5, main text of a page by minimum-cut labelling.

The page is cut into text blocks (runs of inline content between block-level
tags). A linear classifier over each block's place, wording and links, learned from
labelled blocks (``html_fit``), gives the cost of calling it content or boilerplate; the two costs are the capacities of
its edges from the source and to the sink. What an element's class, id or role says
against its text counts the less the more of the page's text the element holds: the
page itself is no sidebar, whatever its name. A list of links inside an article is text
like the rest, unless it reads like a menu. Blocks next to each other, and
blocks that follow each other within one parent, are joined by smoothness
edges, the stronger the nearer they lie in the tree. The minimum cut, found by
maximum flow, labels all blocks at once.

Defined results
  null, empty or tagless pages: a tagless page is one block and judged as such,
  a page without content gives an empty text; unclosed, stray and nested tags
  are read as browsers read them (a block tag ends an open paragraph, a stray end
  tag is nothing, raw text runs to its end tag); an unclosed element whose content
  is no text ends at the next block or the end tag of what holds it; character references are decoded, markup never is; repeated
  rows and equal or null ids: each row by itself; empty table: no rows; extra
  columns are ignored, whatever their names. Very long or deep pages: time and memory of
  parsing grow with their tags, those of the flow with their blocks.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import small_batches

# Elements whose content is never text of the page, and block-level elements.
RAW = "script style textarea iframe title"  # up to their end tag, whatever stands there
DROPPED = "noscript template svg object canvas audio video select button annotation annotation-xml"
NESTING = "template svg object"
BLOCK = ("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
         "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre search section summary "
         "table tbody td tfoot th thead tr ul")
VOID = "area base br col embed hr img input link meta source track wbr"
# Words of class and id names by what they say of an element.
BAD_NAMES = ("ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs byline cookie cookies consent "
             "copyright disclaimer footer gdpr hidden masthead menu modal nav navbar navigation newsletter notice notices "
             "alert overlay pager pagination paywall popup promo promoted recommended related share sharing sidebar signup "
             "social sponsor sponsored subscribe tags toolbar topbar tracking widget")
COMMENT_NAMES = "comment comments commentlist disqus discussion replies reply respond"
GOOD_NAMES = "article articlebody content entry main post story text"
# First words (has-sidebar) and last words (comments-open) of names that tell of other elements.
ABOUT_OTHERS = "has have no not non with without tag category cat overflow"
STATES = "open opened closed enabled disabled on off"
ROLES = {"navigation": "nav", "banner": "header", "contentinfo": "footer", "complementary": "aside", "search": "form",
         "form": "form", "main": "main", "article": "article", "dialog": "bad", "alert": "bad"}

FLAGS = ["article", "main", "nav", "header", "footer", "aside", "form", "bad", "comments", "good"]
BIT = {name: 1 << i for i, name in enumerate(FLAGS)}
HINTS = ("bad", "comments")
#: What elements tell of their blocks in any case; a header inside an article holds its title.
_MARKED = sum(BIT[name] for name in ("nav", "footer", "aside", "form"))
_BY_TAG = {t: BIT[t] for t in ("article", "main", "nav", "header", "footer", "aside", "form")} | {
    "menu": BIT["nav"], "search": BIT["form"], "dialog": BIT["bad"], "fieldset": BIT["form"]}
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW.split()}
_DROPPED, _NESTING, _BLOCK, _VOID = set(DROPPED.split()), set(NESTING.split()), set(BLOCK.split()), set(VOID.split())
_BAD, _COMMENT, _GOOD = set(BAD_NAMES.split()), set(COMMENT_NAMES.split()), set(GOOD_NAMES.split())
_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>)", re.S)
_ABOUT_OTHERS, _STATES = set(ABOUT_OTHERS.split()), set(STATES.split())
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[a-z]+")

#: Classifier: what each sign adds to the log odds of a block being content; learned from
#: labelled blocks (``html_fit``).
WEIGHTS = {"bias": 0.11, "words": 1.32, "links": -3.25, "ends": 0.35, "paragraph": 1.67, "heading": 0.93, "item": -0.75,
           "article": 2.86, "main": 2.0, "good": 1.5, "outside": -3.74, "nav": -7.06, "header": -6.0, "footer": -7.06,
           "aside": -7.06, "form": -7.06, "bad": -7.12, "comments": -9.02}
#: Smoothness of neighbours with the same parent, of other neighbours (falling with the
#: steps between them in the tree), and of blocks that follow each other in one parent.
SAME, APART, KIN = 0.9, 0.6, 0.4
#: A hint against an element holds in full up to the first share of the page's text and not at
#: all from the second; characters added to the page, so that a few words are not all of it; and
#: how often text of an article beside the element counts, which its comments may far exceed.
FULL, GONE, BESIDES, BESIDE_ARTICLE = 0.6, 0.9, 100, 6
#: Words that an item has on average in a list of links which is no menu.
MENU_WORDS = 4


def _names(value: str) -> set[str]:
    """The words of class or id names that tell of the element itself."""
    out: set[str] = set()
    for name in value.split():
        words = _NAME.findall(name)
        if words and words[0] not in _ABOUT_OTHERS and (len(words) == 1 or words[-1] not in _STATES):
            out.update(words)
    return out


def _flags(tag: str, attributes: str) -> int:
    out = _BY_TAG.get(tag, 0)
    if attributes:
        for m in _ATTR.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key == "role":
                out |= BIT.get(ROLES.get(value, ""), 0)
            elif key in ("hidden", "aria-hidden", "style"):
                if key == "hidden" or value == "true" or "display:none" in value.replace(" ", ""):
                    out |= BIT["bad"]
            elif key in ("class", "id"):
                names = _names(value)
                if tag not in ("body", "html"):
                    out |= BIT["comments"] if names & _COMMENT else 0
                    out |= BIT["bad"] if names & _BAD else 0
                if names & _GOOD:
                    out |= BIT["good"]
    return out


def _ended(attributes: str) -> bool:
    """Whether a start tag ends with a slash of its own, not that of an unquoted value (href=/)."""
    rest = attributes.rstrip()
    return rest.endswith("/") and (len(rest) == 1 or rest[-2] in " \t\n\r\f\"'")


def _closed(page: str) -> set[int]:
    """Where the start tags of dropped elements end that have an end tag of their own."""
    out: set[int] = set()
    open_at: dict[str, list[int]] = {}
    at = 0
    while m := _TAG.search(page, at):
        at, tag = m.end(), (m[2] or "").lower()
        if tag in _RAW and not m[1] and not _ended(m[3]):
            end = _RAW[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag in _DROPPED:
            waiting = open_at.setdefault(tag, [])
            if m[1]:
                if waiting:
                    out.add(waiting.pop())
            elif not _ended(m[3]):
                if tag not in _NESTING:
                    waiting.clear()
                waiting.append(m.end())
    return out


class Element:
    """An open element: its tag, the flags of it and all around it, its number, the nearest
    block around it (itself, if it is one), and the last hint against it or what it is in."""
    __slots__ = ("tag", "flags", "number", "holder", "around", "depth", "hint")

    def __init__(self, tag: str, flags: int, number: int, outer: Element | None, hint: int):
        self.tag, self.flags, self.number, self.hint = tag, flags, number, hint
        if outer is None or tag in _BLOCK:
            #: the next block outwards of a block, and how many there are
            self.holder, self.around, self.depth = self, outer.holder if outer else None, outer.holder.depth + 1 if outer else 0
        else:
            self.holder, self.around, self.depth = outer.holder, None, 0


class Block:
    __slots__ = ("text", "linked", "tag", "flags", "place", "hint")

    def __init__(self, text, linked, tag, flags, place, hint=-1):
        self.text, self.linked, self.tag, self.flags = text, linked, tag, flags
        self.place = place  # the block element that holds it (that around it, of a paragraph, item or heading)
        self.hint = hint  # the last of the hints against what it is in, or -1


@dataclass
class Hints:
    """The hints of a page by number: what each says, and the next one around its element (or -1).
    One opened later has the greater number, so an inner hint comes after an outer one."""
    flag: list[str]
    outer: list[int]


def blocks(page: str | None) -> tuple[list[Block], Hints]:
    """The page's text blocks in order, and the hints against them."""
    page = page or ""
    out: list[Block] = []
    hints = Hints([], [])
    stack: list[Element] = [Element("", 0, 0, None, -1)]
    opened = Counter()  # open elements by tag
    pieces: list[str] = []
    linked, number, at = 0, 0, 0
    closed: set[int] | None = None
    # open dropped element ("" for none), whether it has an end tag, and the elements opened inside it
    dropped, ends, inside = "", False, Counter()

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join(htmllib.unescape("".join(pieces)).split())
            if text:
                holder = stack[-1].holder
                tag = holder.tag
                place = holder.around if tag in ("p", "li") or tag[:1] == "h" and tag[1:].isdigit() else holder
                out.append(Block(text, min(1.0, linked / len(text)), tag, stack[-1].flags, place, stack[-1].hint))
            pieces.clear()
        linked = 0

    def close(k: int):
        for e in stack[k:]:
            opened[e.tag] -= 1
        del stack[k:]

    def holds(tag: str) -> int:
        """Place in the stack of the element that an end tag ends, or 0."""
        if not opened[tag]:
            return 0
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                return k
            if stack[k].tag in _BLOCK and tag not in _BLOCK:
                break  # an inline end tag does not end a block
        return 0

    while True:
        m = _TAG.search(page, at)
        piece = page[at:m.start()] if m else page[at:]
        if piece and not dropped:
            pieces.append(piece)
            if opened["a"]:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in _RAW and not m[1]:
            if not _ended(m[3]):
                end = _RAW[tag].search(page, at)
                at = end.end() if end else len(page)
            pieces.append(" ")
            continue
        if dropped:
            if m[1]:
                if inside[tag]:
                    inside[tag] -= 1
                    continue
                if tag == dropped:
                    dropped = ""
                    continue
                if not holds(tag):
                    continue
                dropped = ""  # the end of what holds it
            elif not ends and (tag in _BLOCK or tag == dropped and tag not in _NESTING):
                dropped = ""
            else:
                if tag not in _VOID and not _ended(m[3]):
                    inside[tag] += 1
                continue
        if m[1]:
            if tag in _BLOCK:
                flush()
            if k := holds(tag):
                close(k)
            continue
        if tag in _DROPPED:
            if not _ended(m[3]):
                closed = _closed(page) if closed is None else closed
                dropped, ends, inside = tag, at in closed, Counter()
            pieces.append(" ")
            continue
        if tag == "head":  # all it may hold is no text; anything else ends it
            continue
        if tag in _BLOCK:
            flush()
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph, an item an item
                if stack[k].tag == "p" or stack[k].tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    close(k)
                    break
                if stack[k].tag in _BLOCK:
                    break
        elif tag in ("br", "img", "input", "wbr"):
            pieces.append("" if tag == "wbr" else " ")
        if tag not in _VOID and not (tag not in _BLOCK and _ended(m[3])):
            number += 1
            flags, outer, hint = _flags(tag, m[3]), stack[-1], stack[-1].hint
            for name in HINTS:
                if flags & BIT[name]:
                    hints.flag.append(name)
                    hints.outer.append(hint)
                    hint = len(hints.flag) - 1
            stack.append(Element(tag, outer.flags | flags, number, outer, hint))
            opened[tag] += 1
    flush()
    return out, hints


def _marked(b: Block) -> bool:
    return bool(b.flags & _MARKED or b.flags & BIT["header"] and not b.flags & BIT["article"])


def hint_strengths(found: list[Block], hints: Hints) -> list[dict[str, float]]:
    """Of every hint, how far it and those around it hold, by what they say: the less, the more
    of the text that no tag marks and no other hint denies stands in the hint's element."""
    within = [0] * len(hints.flag)
    free = 0
    for b in found:
        if _marked(b):
            continue
        if b.hint < 0:
            free += len(b.text) * (BESIDE_ARTICLE if b.flags & (BIT["article"] | BIT["main"]) else 1)
        else:
            within[b.hint] += len(b.text)
    for h in range(len(within) - 1, -1, -1):  # inner ones first
        if hints.outer[h] >= 0:
            within[hints.outer[h]] += within[h]
    out: list[dict[str, float]] = []
    for h, size in enumerate(within):  # outer ones first
        share = size / (size + free + BESIDES)
        own, name = min(1.0, max(0.0, (GONE - share) / (GONE - FULL))), hints.flag[h]
        outer = out[hints.outer[h]] if hints.outer[h] >= 0 else {}
        out.append(outer if outer.get(name, 0.0) >= own else outer | {name: own})
    return out


def linked_lists(found: list[Block]) -> set[Element]:
    """The lists whose items are links to read on by, not a menu: some item is no link, or they
    have ``MENU_WORDS`` words or more on average."""
    sizes: dict[Element, list] = {}
    for b in found:
        if b.tag in ("li", "dt", "dd"):
            n = sizes.setdefault(b.place, [0, 0, 1.0])
            n[0], n[1], n[2] = n[0] + 1, n[1] + b.text.count(" ") + 1, min(n[2], b.linked)
    return {place for place, (n, words, least) in sizes.items() if words >= MENU_WORDS * n or least < 0.5}


def signs(b: Block, has_article: bool, strengths: list[dict[str, float]], lists: set[Element] = frozenset()) -> list[tuple[str, float]]:
    """What the classifier goes by: the block's signs, each with its value. An item of one of the
    ``lists`` of an article may be a link."""
    flags, text = b.flags, b.text
    out = [("bias", 1.0), ("words", min(text.count(" ") + 1, 25) / 25)]
    inside = flags & (BIT["article"] | BIT["main"])
    if b.linked and not (inside and b.tag in ("li", "dt", "dd") and b.place in lists):
        out.append(("links", b.linked))
    if text[-1] in ".!?…:;\"'”»)":
        out.append(("ends", 1.0))
    if b.tag == "p":
        out.append(("paragraph", 1.0))
    elif b.tag[:1] == "h" and b.tag[1:].isdigit():
        out.append(("heading", 1.0))
    elif b.tag in ("li", "td", "th", "dt"):
        out.append(("item", 1.0))
    for name in ("article", "main", "good", "nav", "footer", "aside", "form"):
        if flags & BIT[name] and not (name == "main" and flags & BIT["article"]):  # the nearer mark counts
            out.append((name, 1.0))
    if b.hint >= 0:
        out += strengths[b.hint].items()
    if flags & BIT["header"] and not flags & BIT["article"]:
        out.append(("header", 1.0))
    if has_article and not inside:
        out.append(("outside", 1.0))
    return out


def page_signs(found: list[Block], hints: Hints) -> list[list[tuple[str, float]]]:
    """The signs of each of a page's blocks."""
    has_article = any(b.flags & (BIT["article"] | BIT["main"]) for b in found)
    strengths, lists = hint_strengths(found, hints), linked_lists(found)
    return [signs(b, has_article, strengths, lists) for b in found]


def score(found: list[tuple[str, float]]) -> float:
    """Content score of a block by its signs: the log odds of being content."""
    return sum(WEIGHTS[name] * value for name, value in found)


def steps_between(p: Element, q: Element) -> int:
    """Steps in the tree of block elements from one to the other."""
    n = 0
    while p is not q:
        if p.depth >= q.depth:
            p = p.around
        else:
            q = q.around
        n += 1
    return n


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, and between blocks that follow each other in one parent."""
    out, last = [], {}
    for i, b in enumerate(found):
        if i:
            n = steps_between(found[i - 1].place, b.place)
            out.append((i - 1, i, APART / (n + 1) if n else SAME))
        if last.get(b.place, i - 1) != i - 1:
            out.append((last[b.place], i, KIN))
        last[b.place] = i
    return out


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side (content) of a minimum cut. Maximum flow by
    blocking flows along shortest residual paths."""
    n = len(scores)
    spare = [max(s, 0.0) for s in scores]   # left in source -> node
    need = [max(-s, 0.0) for s in scores]   # left in node -> sink
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, c in edges:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to += [b, a]
        room += [c, c]
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = [i for i in range(n) if spare[i] > tiny]
        for i in queue:
            level[i] = 0
        reached = False
        for i in queue:
            if need[i] > tiny:
                reached = True
            for e in out[i]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not reached:
            return [lv >= 0 for lv in level]
        turn = [0] * n
        for s in [i for i in range(n) if spare[i] > tiny]:
            path: list[int] = []
            i = s
            while True:
                if need[i] > tiny:
                    push = min([spare[s], need[i], *(room[e] for e in path)])
                    spare[s] -= push
                    need[i] -= push
                    for e in path:
                        room[e] -= push
                        room[e ^ 1] += push
                    path, i = [], s
                    if spare[s] <= tiny:
                        break
                    continue
                while turn[i] < len(out[i]):
                    e = out[i][turn[i]]
                    if room[e] > tiny and level[to[e]] == level[i] + 1:
                        break
                    turn[i] += 1
                if turn[i] < len(out[i]):
                    path.append(out[i][turn[i]])
                    i = to[path[-1]]
                elif path:
                    i = to[path.pop() ^ 1]
                    turn[i] += 1
                else:
                    break


def main_text(page: str | None) -> str:
    """The content blocks of a page, one to a line."""
    found, hints = blocks(page)
    if not found:
        return ""
    keep = minimum_cut([score(x) for x in page_signs(found, hints)], smoothness(found))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars for every row."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def text_of(found: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in found], dtype=object)

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("h"))
    return rows.withColumn("text", text_of("h")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
