"""Leaf blocks of an HTML page with the features that tell main text from the rest.

A leaf block is a run of text and inline elements between the borders of block
elements.  Tags may be left open: a block element ends an open paragraph, a list item
the one before it, and an inline element ends with the block that it stands in.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from html.parser import HTMLParser
from typing import NamedTuple

#: text of these is no content in any page
_SILENT = frozenset("head script style template noscript svg math iframe object canvas audio video map".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre
    search section select summary table tbody td textarea tfoot th thead tr ul""".split())
#: a start tag ends an open element of the second kind, unless one of the third stands between
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")), "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "thead": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "a": (("a",), _BLOCK),
}
#: what may stand in a head, and what keeps a paragraph outside open
_HEAD = frozenset("head title base link meta style script noscript template".split())
_SCOPE = frozenset("button td th caption table object".split())
#: so many ancestors of a block are looked at, the nearest
_DEEP = 64
#: a block of one of these belongs to the element around it
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption caption legend option summary".split())
_SECTION = frozenset("article aside details dialog figure footer form header main nav section table ul ol dl blockquote".split())
_WORDS = re.compile(r"[a-z]{2,}")
_LONG = re.compile(r"[a-z]{4,}")
_SIGNS = frozenset("©®|»«·•")
_NAMES = ("class", "id", "role", "itemprop", "aria-label")
LABEL = "data-main"


class Block(NamedTuple):
    text: str                                        # white space as in the page
    linked: int                                      # characters of it inside links
    path: tuple[tuple[str, tuple[str, ...]], ...]    # (tag, name tokens) from the outside, of block elements
    home: int                                        # number of the element that holds the paragraph, item, cell ...
    above: int                                       # and of the one around that
    label: str | None                                # innermost data-main, in labelled pages


class _Open(NamedTuple):
    """An open element, with what a block right inside it has."""
    tag: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    home: int
    above: int
    label: str | None


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.stack = [_Open("", (), 0, 0, None)]
        self.open: dict[str, int] = {}  # open elements per tag
        self.text: list[str] = []
        self.around = self.stack[0]     # where the text began
        self.linked = self.links = self.silent = self.elements = 0

    def add(self, text: str) -> None:
        if not self.silent:
            if not self.text:
                self.around = self.stack[-1]
            self.text.append(text)
            if self.links:
                self.linked += len(text)

    def flush(self) -> None:
        """A border of blocks; inside a silent element there are none."""
        if self.text and not self.silent:
            text = "".join(self.text)
            if text and not text.isspace():
                _, path, home, above, label = self.around
                self.blocks.append(Block(text, self.linked, path, home, above, label))
            self.text, self.linked = [], 0

    def pop(self, at: int) -> None:
        for tag, *_ in self.stack[at:]:
            self.open[tag] -= 1
            self.silent -= tag in _SILENT
            self.links -= tag == "a"
        del self.stack[at:]

    def end(self, tags: Collection[str], until: Collection[str] = ()) -> None:
        """Close the innermost element of ``tags`` that no element of ``until`` encloses more closely."""
        if not any(self.open.get(t) for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                self.pop(i)
                return
            if self.stack[i].tag in until:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in _HEAD:  # content begins, even if the head was left open
            self.end(("head",))
        if tag in _VOID:
            if tag == "hr":
                self.flush()
                self.end(("p",), _SCOPE)
            elif tag == "br":
                self.add("\n")
            return
        if tag in _BLOCK:
            self.flush()
            self.end(("p",), _SCOPE)
        if tag in _ENDS:
            self.end(*_ENDS[tag])
        _, path, home, above, label = self.stack[-1]
        self.elements += 1
        if tag in _BLOCK:  # names of inline elements say little and differ within a block
            path = (*path[1 - _DEEP:], (tag, _names(dict(attrs)) if attrs else ()))
            if tag not in _LEAF:
                home, above = self.elements, home
        if attrs:
            label = dict(attrs).get(LABEL, label)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.silent += tag in _SILENT
        self.links += tag == "a"
        self.stack.append(_Open(tag, path, home, above, label))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # "/>" closes nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag in _BLOCK:
            self.end((tag,))
            self.flush()
        else:  # an inline end tag reaches no further than its block
            self.end((tag,), () if tag in _SILENT else _BLOCK)

    def handle_data(self, data: str) -> None:
        self.add(data)

    def finish(self) -> list[Block]:
        self.close()
        self.pop(1)
        self.flush()
        return self.blocks


def _names(given: dict[str, str | None]) -> tuple[str, ...]:
    """The words in an element's names, and whether it is hidden."""
    names = tuple(dict.fromkeys(w for n in _NAMES if given.get(n) for w in _WORDS.findall(given[n].lower())))
    hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in (given.get("style") or "").replace(" ", "")
    return (*names, "hidden") if hidden else names


def blocks_of(html: str) -> list[Block]:
    """The leaf blocks of a page, in page order."""
    reader = _Reader()
    reader.feed(html)
    return reader.finish()


def clean(text: str) -> str:
    """White space as one space, none at the ends."""
    return " ".join(text.split())


def same_home(blocks: list[Block]) -> list[bool]:
    """Whether a block and the one before it stand in the same element (false for the first)."""
    return [i > 0 and b.home == blocks[i - 1].home for i, b in enumerate(blocks)]


def _size(n: int, *borders: int) -> int:
    return sum(n >= b for b in borders)


def path_features(path: tuple[tuple[str, tuple[str, ...]], ...]) -> set[str]:
    """What the model sees of a block's ancestors and their names."""
    own = path[-1][0] if path else ""
    tags = [t for t, _ in path]
    f, outer = {f"own {own}", "tail " + ">".join(tags[-2:]), "tail " + ">".join(tags[-3:])}, ""
    for tag, names in path:
        f.add(f"in {tag}")
        if tag in _SECTION:
            f.add(f"{outer} > {tag}")
            outer = tag
        f.update(f"named {w}" for w in names)
    f.add(f"section {outer} {own}")
    f.update(f"inner {w}" for w in next((names for _, names in reversed(path) if names), ()))
    return f


def text_features(blocks: list[Block]) -> list[list[str]]:
    """What the model sees of each block's text and of how much text its element holds."""
    held: dict[int, list[int]] = {}
    for block in blocks:
        n = held.setdefault(block.home, [0, 0, 0])
        n[0] += 1
        n[1] += len(block.text) - block.linked
        n[2] |= bool(block.path) and block.path[-1][0] == "h1"
    all_ = max(1, sum(n[1] for n in held.values()))
    out = []
    for block in blocks:
        text = block.text.strip()
        n, (mates, mass, titled) = len(text), held[block.home]
        _, around, topped = held.get(block.above, (0, 0, 0))
        f = [f"length {_size(n, 2, 8, 20, 40, 80, 160, 320, 1000)}", f"linked {_size(100 * block.linked // max(1, n), 1, 30, 60, 90)}",
             f"stop {text[-1:] in '.!?…。！？:;'}", f"commas {_size(text.count(','), 1, 3, 8)}",
             f"mates {_size(mates, 2, 3, 5, 9)}", f"mass {_size(100 * mass // all_, 3, 10, 25, 50, 75)}",
             f"titled {titled}", f"around {topped} {_size(100 * around // all_, 3, 10, 25, 50)}"]
        if n < 200:
            if not _SIGNS.isdisjoint(text):
                f.append("sign")
            words = set(_LONG.findall(text.lower())) if text.count(" ") < 12 else ()
            f.extend(f"word {w}" for w in words)
        out.append(f)
    return out


def features_of(blocks: list[Block]) -> list[set[str]]:
    """All features of each block."""
    return [path_features(b.path).union(f) for b, f in zip(blocks, text_features(blocks))]
