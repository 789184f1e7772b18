"""HTML to leaf blocks: runs of text between block-level tags, with the path of open elements.

One scan goes forward through the page and reads each character a bounded number of times, whatever the markup; the depth of nesting costs nothing either: a block
points to its innermost element, and an element to its parent.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

#: Elements whose content is never text of a page and holds no elements: up to the first end tag of that name.
RAW = frozenset("script style noscript noframes textarea iframe title xmp".split())
#: Elements whose content is never text of a page: up to their own end tag.
HIDDEN = frozenset("template select object".split())
#: HTML elements whose start tag ends an open <svg>, and the parts of an <svg> in which they don't.
BREAKS_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
HTML_IN_SVG = frozenset("foreignobject desc title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag closes an open element of these kinds, up to the nearest element of the second list.
CLOSES = {
    "li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)),
}
NAMED = frozenset(("class", "id", "role"))

#: A tag as most pages write it; whatever else stands in a tag goes through _ATTRIBUTE, piece by piece. No part of either is tried twice.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:\s++[^\s"'<>/=]++(?:=(?:"[^"]*+"|'[^']*+'|[^\s"'<>=`]++))?+)*+)\s*+(/?+)>""")
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
#: A quote opens a value only after "="; elsewhere it is part of a name.
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"?+|'[^']*+'?+|[^\s>"'][^\s>]*+|(?=>)))?+)""")
_NAMES = re.compile(r"""\s(?:class|id|role)=(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_COMMENT_END = re.compile(r"--!?>")
_PART = re.compile(r"[a-z0-9]+")


class Path:
    """The names of an element and, through its parent, of all around it."""

    __slots__ = ("parent", "names", "depth")

    def __init__(self, parent: Path | None, names: tuple[str, ...]):
        self.parent, self.names = parent, names
        self.depth = 1 + (parent.depth if parent else 0)

    def __iter__(self) -> Iterator[str]:
        levels, at = [], self
        while at is not None:
            levels.append(at.names)
            at = at.parent
        return (n for names in reversed(levels) for n in names)


class Block:
    """A run of text, where it stands, and how many of its characters are in links."""

    __slots__ = ("text", "at", "link_chars")

    def __init__(self, text: str, path: Path | tuple[str, ...], link_chars: int):
        self.text, self.link_chars = text, link_chars
        self.at = path if isinstance(path, Path) else Path(None, path)

    @property
    def path(self) -> tuple[str, ...]:
        return tuple(self.at)


def names_of(tag: str, values: list[str]) -> tuple[str, ...]:
    """The tag, and the parts of its class, id and role as ".part"."""
    return (tag, *("." + part for v in values for part in _PART.findall(v.lower())))


def _finish(source: str, at: int) -> tuple[int, list[str], bool] | None:
    """A tag's attributes from ``at``: (where it ends, values of class, id and role, does it close itself); None if it never ends."""
    values = []
    while m := _ATTRIBUTE.match(source, at):
        at = m.end()
        if m[1]:
            return at, values, at - 2 >= m.start() and source[at - 2] == "/"
        value = m[3] or ""
        if value[:1] in ("'", '"'):
            if len(value) < 2 or value[-1] != value[0]:
                return None
            value = value[1:-1]
        if m[2].lower() in NAMED:
            values.append(value)
    return None


def tokens(source: str) -> Iterator[tuple[str, int, int, list[str] | None]]:
    """(tag, start, end, values) for each tag: "name", "/name" or "name/" (one that closes itself), with None for an end tag, and ("", start, end, None) for what is not shown:
    comments, declarations, raw elements. Between them is text."""
    at, cdata = 0, 0
    while (start := source.find("<", at)) >= 0:
        if m := _TAG.match(source, start):
            end, tag, closed = m.end(), m[2].lower(), bool(m[4])
            values = ["".join(v) for v in _NAMES.findall(m[3])] if m[3] else []
        elif m := _OPEN.match(source, start):
            done = _finish(source, m.end())
            if done is None:  # the page ends inside a tag
                yield "", start, len(source), None
                return
            tag, (end, values, closed) = m[2].lower(), done
        elif source.startswith("<!--", start):
            if source.startswith((">", "->"), start + 4):
                at = source.index(">", start) + 1
            else:
                end_of = _COMMENT_END.search(source, start + 4)
                at = end_of.end() if end_of else len(source)
            yield "", start, at, None
            continue
        elif source.startswith(("<!", "<?", "</"), start):
            if start + 2 >= len(source):  # the page ends here: text
                return
            at = -1
            if cdata >= 0 and source.startswith("<![CDATA[", start):
                cdata = source.find("]]>", start)  # none from here: none later
                at = cdata + 3 if cdata >= 0 else -1
            if at < 0:
                end = source.find(">", start)
                at = end + 1 if end >= 0 else len(source)
            yield "", start, at, None
            continue
        else:
            at = start + 1
            continue
        if m[1]:
            yield "/" + tag, start, end, None
        elif tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(source, end)
            yield tag, start, end, values
            if not stop:
                yield "", end, len(source), None
                return
            yield "", end, stop.start(), None
            at = stop.start()
            continue
        else:
            yield tag + "/" * closed, start, end, values
        at = end


class _Stack:
    """Open elements; the nearest of a kind is known without a search."""

    def __init__(self) -> None:
        self.root = Path(None, ())
        self.open: list[tuple[str, Path]] = []
        self.places: dict[str, list[int]] = {}

    def path(self) -> Path:
        return self.open[-1][1] if self.open else self.root

    def push(self, tag: str, values: list[str]) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, Path(self.path(), names_of(tag, values))))

    def nearest(self, kinds: tuple[str, ...]) -> int:
        return max((self.places[k][-1] for k in kinds if self.places.get(k)), default=-1)

    def pop_to(self, kinds: tuple[str, ...], barriers: tuple[str, ...] = ()) -> None:
        place = self.nearest(kinds)
        if place > self.nearest(barriers):
            while len(self.open) > place:
                self.places[self.open.pop()[0]].pop()


class _Svg:
    """A picture: its content is not shown. It ends with its end tag or before a tag that shows that it has none."""

    def __init__(self) -> None:
        self.own, self.count, self.inside = ["svg"], {"svg": 1}, 0

    def take(self, tag: str, around: _Stack) -> bool:
        """False if the picture ended before this tag."""
        if tag.startswith("/"):
            name = tag[1:]
            if self.count.get(name):
                while True:
                    gone = self.own.pop()
                    self.count[gone] -= 1
                    self.inside -= gone in HTML_IN_SVG
                    if gone == name:
                        return True
            return bool(self.inside or not (around.places.get(name) or name in INLINE or name == "p"))
        if not self.inside and tag.rstrip("/") in BREAKS_SVG:
            return False
        if not tag.endswith("/"):
            self.own.append(tag)
            self.count[tag] = self.count.get(tag, 0) + 1
            self.inside += tag in HTML_IN_SVG
        return True


def blocks(source: str) -> list[Block]:
    """Blocks with text in page order: character references decoded, white space as single spaces, trimmed.

    Comments, raw and hidden elements, pictures and what stands in the head are left out; unclosed elements end with their parent; stray end tags are ignored.
    """
    found: list[Block] = []
    stack = _Stack()
    parts: list[str] = []
    links = depth = at = 0
    svg: _Svg | None = None
    hidden, level = "", 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Block(text, stack.path(), links))
            parts.clear()
        links = 0

    for tag, start, end, values in tokens(source):
        if start > at and svg is None and not hidden:
            parts.append(source[at:start])
            if depth:
                links += start - at
        at = end
        if not tag:
            continue
        if hidden:
            level += (tag == hidden) - (tag == "/" + hidden)
            if not level:
                hidden = ""
            continue
        if svg is not None:
            if svg.take(tag, stack):
                if not svg.own:
                    svg = None
                continue
            svg = None
        name = tag.strip("/")
        if name in RAW or name == "head":
            continue
        if name in HIDDEN:
            if tag == name:
                hidden, level = name, 1
            continue
        if name == "svg":
            if tag == name:
                svg = _Svg()
            continue
        if name in INLINE:
            if name == "a":
                depth = 0 if values is None else 1
            if name in ("br", "img", "input"):
                parts.append(" ")
            continue
        flush()
        depth = 0
        if values is None:
            stack.pop_to((name,))
            continue
        if name in CLOSES:
            stack.pop_to(*CLOSES[name])
        stack.pop_to(("p",), ("td", "th", "button", "body"))
        if name not in VOID and tag == name:
            stack.push(name, values)
    if svg is None and not hidden:
        parts.append(source[at:])
    flush()
    return found
