"""Selector rules over one page's markup: the per-page helper of the extraction job.

Supported: `tag`, `.class`, `[attr]`, `[attr="v"]`, `[attr*="v"]`, descendants (`a b`), and at the end `::text` or
`::attr(name)`. `x::text` takes the text nodes right under the match, a bare or spaced `::text` those at any depth.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape
from html.parser import HTMLParser

# Elements without an end tag, and what an opening tag closes first when it is still open.
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY = {"a": {"a"}, "li": {"li"}, "option": {"option"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}}
CLOSED_BY |= {tag: {"p"} for tag in "article div dl footer form h1 h2 h3 h4 header main nav ol p section table ul".split()}
# Fixed value: an end tag of any other element does not reach past these.
SCOPE_TAGS = frozenset("article body div footer form header html li main nav ol section table td ul".split())

# Elements whose content is text only, with character references in it.
DECODED_TEXT = ("title", "textarea")

#: Tags that the standard parser takes the same way whatever follows them: no unquoted values, references or odd characters.
_PLAIN_START = re.compile(r'<([A-Za-z][A-Za-z0-9]*)((?:[\t\n\r\f ]+[A-Za-z][A-Za-z0-9_:-]*(?:="[^"&]*")?)*)[\t\n\r\f ]*(/?)>')
_PLAIN_END = re.compile(r"</([A-Za-z][A-Za-z0-9]*)>")
_PLAIN_ATTR = re.compile(r'([A-Za-z][A-Za-z0-9_:-]*)(?:="([^"]*)")?')
# Elements that change how the parser reads on.
MODE_TAGS = frozenset("iframe math noembed noframes noscript plaintext script style svg textarea title xmp".split())
#: Start tags kept by their text per rule, for pages repeat them; longer ones are read each time.
KEPT_TAGS, KEPT_TAG_LENGTH = 4096, 300

_PART = re.compile(r"""(?P<tag>[A-Za-z][\w-]*)|\.(?P<cls>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>\*?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)')\s*)?\]""")
_TAKES = re.compile(r"(\s*)::(?:(text)|attr\(\s*([\w:-]+)\s*\))\s*$")


@dataclass(frozen=True, slots=True)
class Step:
    """One element test: a tag name and tests of attributes as (name, kind, value)."""

    tag: str | None
    tests: tuple[tuple[str, str, str], ...]

    def accepts(self, tag: str, attrs: dict[str, str]) -> bool:
        if self.tag is not None and self.tag != tag:
            return False
        for name, kind, want in self.tests:
            have = attrs.get(name)
            if have is None or kind == "=" and have != want or kind == "*=" and (not want or want not in have):
                return False
            if kind == "class" and want not in have.split():
                return False
        return True


@dataclass(frozen=True, slots=True)
class Selector:
    """Parsed selector. `attr` or `text` say what it takes; `deep` is text at any depth below the match."""

    steps: tuple[Step, ...]
    attr: str | None = None
    text: bool = False
    deep: bool = False


def _step(source: str) -> Step:
    tag, tests, at = None, [], 0
    while at < len(source):
        part = _PART.match(source, at)
        if not part or part["tag"] and at:
            raise ValueError(f"unsupported selector: {source!r}")
        if part["tag"]:
            tag = part["tag"].lower()
        elif part["cls"]:
            tests.append(("class", "class", part["cls"]))
        else:
            value = part["dq"] if part["dq"] is not None else part["sq"] or ""
            tests.append((part["attr"].lower(), part["op"] or "", value))
        at = part.end()
    return Step(tag, tuple(tests))


def parse_selector(source: str) -> Selector:
    body, attr, text, deep = source.strip(), None, False, False
    if takes := _TAKES.search(body):
        body = body[: takes.start()]
        attr, text = takes[3] and takes[3].lower(), takes[2] is not None
        deep = text and (bool(takes[1]) or not body)
    # white space inside brackets belongs to its step
    steps = tuple(_step(part) for part in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+|\[", body))
    if not steps and not takes:
        raise ValueError("empty selector")
    return Selector(steps, attr, text, deep)


class _Element:
    """An open element, and the value lists that take its text: right under it, or at any depth."""

    __slots__ = ("tag", "attrs", "near", "deep")

    def __init__(self, tag: str, attrs: dict[str, str], deep: tuple):
        self.tag, self.attrs, self.near, self.deep = tag, attrs, (), deep


class _Rule:
    """Parsed selectors, and for start tags met before what is in them and which selectors may end there."""

    def __init__(self, item: Selector, fields: list[Selector]):
        self.item, self.fields = item, fields
        self.kept: dict[str, tuple] = {}

    def ends(self, tag: str, attrs: dict[str, str]) -> tuple[bool, tuple[int, ...]]:
        """Whether the last step of the item accepts an element, and the fields whose last step does."""
        fields = (at for at, field in enumerate(self.fields) if not field.steps or field.steps[-1].accepts(tag, attrs))
        return self.item.steps[-1].accepts(tag, attrs), tuple(fields)

    def plain(self, found: re.Match) -> tuple:
        """Tag, attributes and `ends` of a plain start tag, and whether it ends itself."""
        text = found[0]
        if text in self.kept:
            return self.kept[text]
        tag, attrs = found[1].lower(), {}
        for name, value in _PLAIN_ATTR.findall(found[2]):
            attrs.setdefault(name.lower(), value)
        known = tag, attrs, self.ends(tag, attrs), bool(found[3])
        if len(text) <= KEPT_TAG_LENGTH:
            if len(self.kept) >= KEPT_TAGS:
                self.kept.clear()
            self.kept[text] = known
        return known


class _Page(HTMLParser):
    """Reads a page once, keeping the open elements and the values of every item; builds no tree."""

    CDATA_CONTENT_ELEMENTS = ("script", "style", *DECODED_TEXT)

    def __init__(self, rule: _Rule):
        super().__init__(convert_charrefs=True)
        self.items: list[list[list[str]]] = []
        self._rule = rule
        self._path: list[_Element] = []
        self._open: list[tuple[int, list[list[str]]]] = []
        self._open_tags: Counter[str] = Counter()
        self._text: list[str] = []

    def read(self, html: str) -> list[list[list[str]]]:
        self.feed(html)
        self.close()
        self._flush()
        return self.items

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not needed

    def handle_data(self, data: str) -> None:
        if self._open:
            decoded = self._path[-1].tag in DECODED_TEXT if self._path else False
            self._text.append(unescape(data) if decoded else data)

    def parse_starttag(self, i: int) -> int:
        found = _PLAIN_START.match(self.rawdata, i)
        if not found or found[1].lower() in MODE_TAGS:
            return super().parse_starttag(i)
        tag, attrs, ends, closed = self._rule.plain(found)
        self.lasttag = tag
        self._start(tag, attrs, ends)
        if closed and tag not in VOID_TAGS:
            self._pop()
        return found.end()

    def parse_endtag(self, i: int) -> int:
        found = _PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if not found:
            return super().parse_endtag(i)
        self.handle_endtag(found[1].lower())
        return found.end()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        first: dict[str, str] = {}
        for name, value in attrs:
            first.setdefault(name, value or "")
        self._start(tag, first, self._rule.ends(tag, first))

    def _start(self, tag: str, attrs: dict[str, str], ends: tuple[bool, tuple[int, ...]]) -> None:
        self._flush()
        closes = CLOSED_BY.get(tag, ())
        while self._path and self._path[-1].tag in closes:
            self._pop()
        element = _Element(tag, attrs, self._path[-1].deep if self._path else ())
        self._path.append(element)
        self._open_tags[tag] += 1
        item, own = ends
        if item and self._fits(self._rule.item.steps, 0):
            self.items.append([[] for _ in self._rule.fields])
            self._open.append((len(self._path) - 1, self.items[-1]))
        for floor, found in self._open if own else ():
            for at in own:
                field = self._rule.fields[at]
                if not field.steps or self._fits(field.steps, floor):
                    self._take(field, element, found[at])
        if tag in VOID_TAGS:
            self._pop()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        if not self._open_tags[tag]:
            return
        for at in range(len(self._path) - 1, -1, -1):
            if self._path[at].tag == tag:
                self._flush()
                while len(self._path) > at:
                    self._pop()
                return
            if self._path[at].tag in SCOPE_TAGS and tag not in SCOPE_TAGS:
                return

    def _fits(self, steps: tuple[Step, ...], floor: int) -> bool:
        """Whether the innermost element, which the last step accepts, fits the others, looking no higher than `floor`."""
        path = self._path
        at = len(path) - 2
        for step in steps[-2::-1]:
            while at >= floor and not step.accepts(path[at].tag, path[at].attrs):
                at -= 1
            if at < floor:
                return False
            at -= 1
        return True

    @staticmethod
    def _take(field: Selector, element: _Element, values: list[str]) -> None:
        if field.attr is not None:
            if field.attr in element.attrs:
                values.append(element.attrs[field.attr])
        elif not field.deep:
            element.near += (values,)
        elif not any(values is known for known in element.deep):
            element.deep += (values,)

    def _flush(self) -> None:
        if self._text:
            text = "".join(self._text)
            self._text.clear()
            if self._path:
                for values in (*self._path[-1].near, *self._path[-1].deep):
                    values.append(text)

    def _pop(self) -> None:
        self._open_tags[self._path.pop().tag] -= 1
        while self._open and self._open[-1][0] >= len(self._path):
            self._open.pop()


class PageReader:
    """Reads pages with their rules; keeps the parsed selectors of the rules it has met."""

    def __init__(self):
        self._rules: dict[tuple[str, ...], _Rule] = {}

    def items(self, html: str, item_selector: str, field_selectors: list[str]) -> list[list[list[str]]]:
        """Per item in document order, per field, all values the field's selector takes inside that item."""
        key = (item_selector, *field_selectors)
        if key not in self._rules:
            self._rules[key] = _Rule(parse_selector(item_selector), [parse_selector(source) for source in field_selectors])
        return _Page(self._rules[key]).read(html)
