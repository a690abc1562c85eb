"""Leaf blocks of HTML pages: runs of text between block-level tags, with their ancestors."""

from __future__ import annotations

import html
import re
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Set
from dataclasses import dataclass
from functools import lru_cache

#: Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style title textarea noscript iframe template svg math object audio video canvas select datalist noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
#: Which open elements a start tag ends, and at which ones the search for them stops.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_OPENING = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_UNENDED = re.compile(r"<(?:!--|!\[CDATA\[)")  # what needs no ">" to end
_COMMENT_END = re.compile(r"--!?>")
_TAG_END = re.compile(r"(?:[^>\"']*+(?:\"[^\"]*\"|'[^']*'))*+[^>\"']*+>")
_SIGN = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|style|aria-hidden|aria-label)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(slots=True)
class Block:
    text: str
    tag: str  # nearest block-level element
    context: frozenset[str]  # features of all ancestors; blocks may share one set
    linked: float  # share of the characters inside links


def _marks(name: str, attributes: str) -> tuple[str, ...]:
    """Features of an element: its name and what its class, id and role say."""
    return _usual_marks(name, attributes) if len(attributes) <= 200 else _usual_marks.__wrapped__(name, attributes)


@lru_cache(maxsize=4096)
def _usual_marks(name: str, attributes: str) -> tuple[str, ...]:
    out = [f"in:{name}"]
    if "=" in attributes or "hidden" in attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "style":
                out += ["hidden"] if _HIDDEN.search(value) else []
            elif key in ("hidden", "aria-hidden"):
                out += ["hidden"] if value.lower() != "false" else []
            else:
                out += [f"is:{token.lower()}" for token in _TOKEN.findall(value)]
    return tuple(dict.fromkeys(out))


class _TagEnds:
    """Ends of a page's tags: the first ``>`` outside quotes, or the first of all where quotes never close.

    Looking for it reads on to the end of the page where quotes don't close. After that has
    happened once, the answers for all places behind are laid down in one pass from the end.
    """

    def __init__(self, page: str):
        self.page = page
        self.places: array | None = None

    def after(self, at: int) -> int:
        """Where the tag ends whose name ends at ``at``; -1 if it does not."""
        if self.places is None:
            if found := _TAG_END.match(self.page, at):
                return found.end()
            self._lay_down(at)
        k = bisect_left(self.places, at)
        if k < len(self.places) and self.ends[k]:
            return self.ends[k]
        return self.page.find(">", at) + 1 or -1

    def _lay_down(self, at: int) -> None:
        self.places = array("q", (found.start() for found in _SIGN.finditer(self.page, at)))
        self.ends = array("q", bytes(8 * len(self.places)))
        plain = double = single = 0  # the end as seen outside quotes, inside double and inside single ones
        for k in range(len(self.places) - 1, -1, -1):
            sign = self.page[self.places[k]]
            if sign == ">":
                plain = self.places[k] + 1
            elif sign == '"':
                plain, double = double, plain
            else:
                plain, single = single, plain
            self.ends[k] = plain


class _Open:
    """The open elements of a page, with the places of each name, so that no search walks through them."""

    def __init__(self, known: Set[str] | None):
        self.known = known
        self.names: list[str] = []
        self.contexts: list[frozenset[str]] = [frozenset()]
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def start(self, name: str, attributes: str) -> None:
        self.places[name].append(len(self.names))
        if name in BLOCK:
            self.blocks.append(len(self.names))
        self.names.append(name)
        context, known = self.contexts[-1], self.known
        new = [mark for mark in _marks(name, attributes) if mark not in context and (known is None or mark in known)]
        self.contexts.append(context.union(new) if new else context)

    def nearest(self, names: Set[str]) -> int:
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=-1)

    def nearest_block(self) -> int:
        return self.blocks[-1] if self.blocks else -1

    def end(self, at: int, stop: int = -1) -> None:
        """End the element at this place and all inside it, unless the one at ``stop`` is nearer."""
        if at < 0 or stop > at:
            return
        for name in self.names[at:]:
            self.places[name].pop()
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()
        del self.names[at:], self.contexts[at + 1 :]


def blocks_of(page: str, known: Set[str] | None = None, deepest: int | None = None) -> list[Block]:
    """The leaf blocks with text, in page order.

    Character references are decoded and white space becomes one space. Contents of scripts,
    styles and the like are no text. Missing end tags are put in as browsers do.

    ``known`` names the features that contexts may hold, by default all; a page that has more than
    ``deepest`` elements open at once gives no blocks. Time and memory grow with the page's
    length, whatever is left open in it: contexts are shared by all blocks that have the same, and
    each holds a feature once (with ``known`` no more of them than that has).
    """
    out: list[Block] = []
    opened, ends = _Open(known), _TagEnds(page)
    pieces: list[str] = []
    context: frozenset[str] = frozenset()
    tag, linked = "", 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, tag, context, min(1.0, linked / len(text))))
            pieces.clear()
        linked = 0

    def put(raw: str) -> None:
        nonlocal context, tag, linked
        if not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if not pieces:
            if text.isspace():
                return
            context = opened.contexts[-1]
            tag = opened.names[opened.nearest_block()] if opened.blocks else ""
        pieces.append(text)
        if opened.places.get("a"):
            linked += len(text.strip())

    at, opening = 0, _OPENING
    while found := opening.search(page, at):
        start, after = found.span()
        if found[0] == "<!--":
            put(page[at:start])
            close = _COMMENT_END.search(page, after)
            at = close.end() if close else len(page)
            continue
        if found[0] == "<![CDATA[":
            put(page[at:start])
            close = page.find("]]>", after)
            put(page[after : close if close >= 0 else len(page)])
            at = close + 3 if close >= 0 else len(page)
            continue
        stop = ends.after(after) if found[2] else page.find(">", after) + 1 or -1
        if stop < 0:
            opening = _UNENDED
            continue
        put(page[at:start])
        at = stop
        if not found[2]:
            continue
        name = found[2].lower()
        if name in BLOCK:
            flush()
        if found[1]:
            if name not in VOID:
                opened.end(opened.nearest({name}), -1 if name in BLOCK else opened.nearest_block())
        elif name in SKIPPED:
            if page[stop - 2] != "/" or name not in ("svg", "math"):
                close = re.compile(rf"</{name}\b", re.I).search(page, at)
                at = (page.find(">", close.end()) + 1 or len(page)) if close else len(page)
        elif name in VOID:
            if name == "br":
                put("\n")
        else:
            if name in BLOCK:
                if (near := opened.nearest_block()) >= 0 and opened.names[near] == "p":
                    opened.end(near)
                if name in ENDS:
                    opened.end(opened.nearest(ENDS[name]), opened.nearest(STOPS[name]))
            opened.start(name, page[after:stop])
            if deepest is not None and len(opened.names) > deepest:
                return []
    put(page[at:])
    flush()
    return out
