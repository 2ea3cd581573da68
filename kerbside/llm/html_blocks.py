"""HTML pages as sequences of leaf blocks: runs of text that no block-level tag interrupts."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

# Element classes of HTML.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol option p pre search section select summary table tbody td tfoot th thead title tr "
    "ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Text inside these is never shown as text, or is not HTML.
UNSEEN = frozenset(
    "script style title template noscript textarea iframe noembed noframes svg math object xmp".split()
)
# An opening tag ends open elements of these names, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
FENCES = frozenset("body html table td th caption button dialog".split())

MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+>",
    re.S,
)
COMMENT = re.compile(r"<!--.*\Z", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|data-keep)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))", re.I)


# So many of the innermost open elements describe a block.
DEPTH = 64


@dataclass(slots=True)
class Block:
    """`path` holds (tag, attributes) of the DEPTH innermost open elements, outermost first."""

    path: tuple[tuple[str, str], ...]
    text: str
    linked: int = 0


def attributes(raw: str) -> str:
    """class, id and role of a tag as one lower-case text."""
    if "=" not in raw:
        return ""
    return " ".join(f"{m[1].lower()}={m[2] or m[3] or m[4] or ''}" for m in ATTRIBUTE.finditer(raw)).lower()


def leaf_blocks(page: str | None) -> list[Block]:
    """The blocks with text, in page order: references decoded, white space single, trimmed."""
    page = page or ""
    blocks: list[Block] = []
    path: list[tuple[str, str]] = []
    pieces: list[str] = []
    linked, in_link, start_path = 0, 0, ()
    # How many elements of a name are open: a name that is not need not be looked for.
    opened = Opened()
    at, end, last = 0, len(page), page.rfind(">")

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                blocks.append(Block(start_path, text, linked))
            pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal start_path, linked
        if not pieces:
            if text.isspace():
                return
            start_path = tuple(path[-DEPTH:])
        pieces.append(text)
        if in_link:
            linked += len(text)

    while at < end:
        # Where no ">" follows there is no tag, only a comment that may still be open.
        m = MARKUP.search(page, at) if at <= last else COMMENT.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m.re is COMMENT:
            continue
        name = m[2] or m[5]
        if name is None:
            continue
        name = name.lower()
        if m[1] or m[4]:  # a closing tag
            if name in BLOCK:
                flush()
            elif name == "br" and pieces:
                pieces.append(" ")
            for i in range(len(path) - 1, -1, -1) if opened[name] else ():
                if path[i][0] == name:
                    _cut(path, i, opened)
                    if name == "a":
                        in_link = 0
                    break
                if path[i][0] in FENCES and name not in FENCES and name not in BLOCK:
                    break
            continue
        rest = m[3] if m[2] else m[6]
        if name in UNSEEN:
            if name in BLOCK:
                flush()
            if not rest.endswith("/") or name in ("script", "style", "title", "textarea"):
                closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+>", re.I).search(page, at)
                at = closing.end() if closing else end
            continue
        if name == "br":
            if pieces:
                pieces.append(" ")
            continue
        if name in BLOCK:
            flush()
            if name not in ("option", "html", "head", "body"):
                _close(path, {"p"}, FENCES, opened, opened.paragraphs[-1])
            if name in ENDS:
                _close(path, *ENDS[name], opened)
            in_link = opened["a"] > 0
        if name in VOID:
            if name == "img" and pieces:
                pieces.append(" ")
            continue
        if name == "a":
            in_link = 1
        path.append((name, attributes(rest)))
        opened.add(name)
    flush()
    return blocks


class Opened(Counter):
    """How many elements of each name are open, and of paragraphs inside each fence that is."""

    def __init__(self):
        super().__init__()
        self.paragraphs = [0]

    def add(self, name: str) -> None:
        self[name] += 1
        if name in FENCES:
            self.paragraphs.append(0)
        elif name == "p":
            self.paragraphs[-1] += 1

    def remove(self, name: str) -> None:
        self[name] -= 1
        if name in FENCES:
            self.paragraphs.pop()
        elif name == "p":
            self.paragraphs[-1] -= 1


def _cut(path: list[tuple[str, str]], at: int, opened: Opened) -> None:
    """End the open elements from a place on."""
    for tag, _ in reversed(path[at:]):
        opened.remove(tag)
    del path[at:]


def _close(
    path: list[tuple[str, str]], names: set[str], fences, opened: Opened, most: int | None = None
) -> None:
    """End the outermost open element of these names, with all inside it, that no fence separates from here.

    `most` is how many there can be.
    """
    left = sum(opened[name] for name in names) if most is None else most
    cut, i = None, len(path)
    while left and i:
        i -= 1
        if path[i][0] in names:
            cut, left = i, left - 1
        elif path[i][0] in fences:
            break
    if cut is not None:
        _cut(path, cut, opened)
