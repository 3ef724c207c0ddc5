"""One page's markup -> one page's rows, inside a Spark task.

This is the only step Catalyst cannot express.  It is kept small: a regular
expression cuts tags, a stack of open elements assigns the numbers described
in ``webgrove.schema``, and everything is appended to flat columns that become
Arrow arrays without an object per node.

What the stack does: void and raw-text elements, implied ``html``, ``head``,
``body``, ``tbody``, ``tr`` and ``colgroup``, implied ends of ``p``, list items,
headings, options and table parts, stray end tags ignored, unclosed formatting
elements reopened in later blocks, everything closed at the end of input.

What it does not do: the adoption agency's moving of nodes, foster parenting
out of tables, frameset documents, the name tables of foreign content (an
``<x/>`` inside ``svg`` or ``math`` does close), and separate ``template`` trees.
"""

from __future__ import annotations

import html
import html.entities
import re

# Element categories of the HTML standard.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RCDATA = frozenset("title textarea".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header"
    " hgroup hr li dd dt listing main menu nav ol p plaintext pre search section summary table ul xmp".split()
) | HEADINGS
SPECIAL = CLOSES_P | VOID | RAW | RCDATA | frozenset(
    "applet body button caption colgroup head html marquee noscript object optgroup option select tbody td template"
    " tfoot th thead tr".split()
)
SCOPE = frozenset("applet caption html marquee object table td template th".split())
BUTTON_SCOPE = SCOPE | {"button"}
LIST_SCOPE = SCOPE | {"ol", "ul"}
TABLE_SCOPE = frozenset("html table template".split())
MARKERS = frozenset("applet caption marquee object td template th".split())
NO_REOPEN = SPECIAL - frozenset("area br button embed img input keygen select wbr applet marquee object xmp".split())

_VOID, _RAW, _CLOSES_P, _FORMATTING, _MARKER, _REOPENS, _PLACED = (1 << i for i in range(7))
_TABLE_PARTS = frozenset("tr td th tbody thead tfoot caption col colgroup".split())


def _kind(tag: str) -> int:
    """The categories of a tag as bits, looked up once per tag."""
    placed = CLOSES_P | _TABLE_PARTS | {"a", "nobr", "button", "option", "optgroup", "frame"}
    members = ((VOID, _VOID), (RAW | RCDATA, _RAW), (CLOSES_P, _CLOSES_P), (FORMATTING, _FORMATTING), (MARKERS, _MARKER), (placed, _PLACED))
    return sum(bit for tags, bit in members if tag in tags) + (0 if tag in NO_REOPEN else _REOPENS)


_KINDS = {tag: _kind(tag) for tag in SPECIAL | FORMATTING | NO_REOPEN | MARKERS | _TABLE_PARTS}
_OTHER = _kind("")

_S = r"[\t\n\f\r ]"
_TAG = re.compile(
    rf"<(/?)([A-Za-z][^\t\n\f\r />]*+)"
    rf"((?:[\t\n\f\r /]++"
    rf"|[^\t\n\f\r />][^\t\n\f\r />=]*+(?:{_S}*+={_S}*+"
    rf"(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\t\n\f\r \"'>][^\t\n\f\r >]*+)?+)?+)*+)>"
)
_ATTR = re.compile(
    rf"([^\t\n\f\r />][^\t\n\f\r />=]*+)"
    rf"(?:{_S}*+(=){_S}*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\t\n\f\r \"'>][^\t\n\f\r >]*+))?+)?+"
)
_COMMENT_END = re.compile(r"--!?>")
# In an attribute an unterminated name before "=" or a letter or digit stays text.
_ATTR_REF = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*+(?:;|(?!=)))")
_BLANK = "\t\n\f\r "


def _attributes(source: str) -> list[tuple[str, str | None]]:
    """Names in source order, lower case, the first of equal names kept."""
    found: dict[str, str | None] = {}
    for name, eq, double, single, bare in _ATTR.findall(source):
        name = name.lower()
        if name in found:
            continue
        value = double or single or bare
        if "&" in value:
            value = _ATTR_REF.sub(_attribute_reference, value)
        found[name] = value if eq else None
    return list(found.items())


def _attribute_reference(match: re.Match[str]) -> str:
    text = match.group()
    if text[1] != "#" and text[1:] not in html.entities.html5:
        return text
    return html.unescape(text)


def _escape_text(text: str) -> str:
    if "&" in text or "<" in text or ">" in text or "\xa0" in text:
        return text.replace("&", "&amp;").replace("\xa0", "&nbsp;").replace("<", "&lt;").replace(">", "&gt;")
    return text


def _start_tag(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    if not attrs:
        return f"<{tag}>"
    out = [f"<{tag}"]
    for name, value in attrs:
        value = value or ""
        if "&" in value or '"' in value or "\xa0" in value:
            value = value.replace("&", "&amp;").replace("\xa0", "&nbsp;").replace('"', "&quot;")
        out.append(f' {name}="{value}"')
    out.append(">")
    return "".join(out)


INT_FIELDS = ("pre", "last", "parent", "depth", "sib", "nsib", "kids", "t0", "t1", "h0", "h1")
_PRE, _LAST, _PARENT, _DEPTH, _SIB, _NSIB, _KIDS, _T0, _T1, _H0, _H1 = range(11)


class PageColumns:
    """Flat columns of a batch of parsed pages; ``add`` appends one page."""

    def __init__(self, *, markup: bool = True, only_tags: frozenset[str] | None = None) -> None:
        self.want_markup = markup
        self.only_tags = only_tags
        self.base_href: list[str | None] = []
        self.texts: list[str] = []
        self.text_offsets = [0]
        self.markup: list[str] = []
        self.markup_offsets = [0]
        self.numbers: list[list[int]] = []      # one INT_FIELDS row per node
        self.tags: list[str] = []
        self.node_offsets = [0]
        self.attr_names: list[str] = []
        self.attr_values: list[str | None] = []
        self.attr_offsets = [0]

    def __len__(self) -> int:
        return len(self.base_href)

    def add(self, source: str | None) -> None:
        page = _Page(self.want_markup)
        if source is not None:
            page.read(source)
        self.base_href.append(page.base_href)
        self.texts += page.texts
        self.text_offsets.append(len(self.texts))
        self.markup += page.markup
        self.markup_offsets.append(len(self.markup))
        rows, tags, attrs = page.rows, page.tag, page.attrs
        if self.only_tags is not None:
            kept = [i for i, tag in enumerate(tags) if tag in self.only_tags]
            rows, tags, attrs = [rows[i] for i in kept], [tags[i] for i in kept], [attrs[i] for i in kept]
        self.numbers += rows
        self.tags += tags
        self.node_offsets.append(len(self.tags))
        at = len(self.attr_names)
        for pairs in attrs:
            if pairs:
                for name, value in pairs:
                    self.attr_names.append(name)
                    self.attr_values.append(value)
                at += len(pairs)
            self.attr_offsets.append(at)


class _Page:
    """The open-element stack of one page."""

    def __init__(self, want_markup: bool = True) -> None:
        self.want_markup = want_markup
        self.texts: list[str] = []
        self.markup: list[str] = []
        self.rows: list[list[int]] = []
        self.tag: list[str] = []
        self.attrs: list[list[tuple[str, str | None]]] = []
        self.kids: list[int] = []
        self.names: list[str] = []      # open elements, outermost first
        self.ids: list[int] = []
        self.opened: dict[str, int] = {}    # open elements by tag
        self.closed = bytearray()           # per element, 1 once closed
        self.formatting: list[tuple[str, list, int] | None] = []   # None is a marker
        self.alike: dict[tuple, int] = {}       # entries by tag and attributes, and by tag
        self.listed: dict[str, int] = {}
        self.head = self.body = -1
        self.foreign = 0
        self.base_href: str | None = None

    # -- reading -----------------------------------------------------------

    def read(self, src: str) -> None:
        if "\r" in src:
            src = src.replace("\r\n", "\n").replace("\r", "\n")
        if "\x00" in src:
            src = src.replace("\x00", "")
        find, tag_at, end = src.find, _TAG.match, len(src)
        start = at = 0
        while True:
            at = find("<", at)
            if at < 0:
                self.text(src[start:])
                break
            match = tag_at(src, at)
            if match:
                if at > start:
                    self.text(src[start:at])
                slash, name, attrs = match.groups()
                at = match.end()
                name = name.lower()
                if slash:
                    self.end(name)
                else:
                    at = self.start(name, attrs, src, at)
                start = at
                continue
            following = src[at + 1:at + 2]
            closing = following == "/"
            letter = src[at + 2:at + 3] if closing else following
            if letter.isascii() and letter.isalpha():       # a tag the input ends in
                self.text(src[start:at])
                break
            if following in ("!", "?") or (closing and letter):
                self.text(src[start:at])
                at = self.comment(src, at, end)
                start = at
            else:
                at += 1
        self.finish()

    def comment(self, src: str, at: int, end: int) -> int:
        """Keep a comment in the markup; return the place after it."""
        if src.startswith("<!--", at):
            body = at + 4
            if src.startswith(">", body) or src.startswith("->", body):
                content, after = "", src.index(">", body) + 1
            else:
                close = _COMMENT_END.search(src, body)
                content = src[body:close.start()] if close else src[body:]
                after = close.end() if close else end
        else:
            close_at = src.find(">", at)
            after = end if close_at < 0 else close_at + 1
            content = src[at + (1 if src[at + 1] == "?" else 2):end if close_at < 0 else close_at]
            if src[at + 1:at + 3] == "/>" or src[at + 2:at + 9].lower() == "doctype":
                return after
        if self.ids and self.want_markup:
            self.markup.append(f"<!--{content}-->")
        return after

    # -- tree --------------------------------------------------------------

    def open(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        node, text_at, markup_at = len(self.tag), len(self.texts), len(self.markup)
        place, parent = 1, -1
        if self.ids:
            parent = self.ids[-1]
            place = self.kids[parent] = self.kids[parent] + 1
        self.rows.append([node, node, parent, len(self.ids), place, 1, 0, text_at, text_at, markup_at, markup_at + 1])
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.kids.append(0)
        if self.want_markup:
            self.markup.append(_start_tag(tag, attrs) if attrs else f"<{tag}>")
        kind = _KINDS.get(tag, _OTHER)
        if kind & _VOID:
            self.closed.append(1)
            if tag == "base" and self.base_href is None:
                self.base_href = dict(attrs).get("href")
            return node
        self.closed.append(0)
        self.names.append(tag)
        self.ids.append(node)
        self.opened[tag] = self.opened.get(tag, 0) + 1
        if kind & _MARKER:
            self.formatting.append(None)
        elif tag == "svg" or tag == "math":
            self.foreign += 1
        return node

    def close(self) -> str:
        """Close the innermost open element."""
        tag, node = self.names.pop(), self.ids.pop()
        if self.want_markup:
            self.markup.append(f"</{tag}>")
        row = self.rows[node]
        row[_LAST] = len(self.tag) - 1
        row[_T1] = len(self.texts)
        row[_H1] = len(self.markup)
        self.closed[node] = 1
        self.opened[tag] -= 1
        if tag in MARKERS:
            while self.formatting and (entry := self.formatting.pop()) is not None:
                self.forget(entry)
        elif tag == "svg" or tag == "math":
            self.foreign -= 1
        return tag

    def close_through(self, tags) -> None:
        while self.close() not in tags:
            pass

    def in_scope(self, tags, boundary=SCOPE) -> bool:
        if not any(map(self.opened.get, tags)):
            return False
        for name in reversed(self.names):
            if name in tags:
                return True
            if name in boundary:
                return False
        return False

    def close_to(self, boundary) -> None:
        """Close elements until the innermost open one is in ``boundary``."""
        while self.names[-1] not in boundary:
            self.close()

    def merge(self, node: int, attrs: list[tuple[str, str | None]]) -> None:
        """A repeated html or body tag only adds the attributes still missing."""
        have = {name for name, _ in self.attrs[node]}
        self.attrs[node] = self.attrs[node] + [a for a in attrs if a[0] not in have]
        if self.want_markup:
            self.markup[self.rows[node][_H0]] = _start_tag(self.tag[node], self.attrs[node])

    def need_root(self) -> None:
        if not self.ids:
            self.open("html", [])

    def need_head(self) -> None:
        """Open the head, again if it was closed: it still takes its own elements."""
        if self.head < 0:
            self.head = self.open("head", [])
        elif self.closed[self.head]:
            if self.want_markup:
                del self.markup[self.rows[self.head][_H1] - 1]
            self.closed[self.head] = 0
            self.names.append("head")
            self.ids.append(self.head)
            self.opened["head"] = 1

    def need_body(self) -> None:
        if self.body >= 0:
            return
        self.need_root()
        if self.head < 0:
            self.head = self.open("head", [])
        while len(self.ids) > 1:
            self.close()
        self.body = self.open("body", [])

    def reopen_formatting(self) -> None:
        entries, closed = self.formatting, self.closed
        if entries[-1] is None or not closed[entries[-1][2]]:
            return
        at = len(entries)
        while at and entries[at - 1] is not None and closed[entries[at - 1][2]]:
            at -= 1
        for i in range(at, len(entries)):
            tag, attrs, _ = entries[i]
            entries[i] = (tag, attrs, self.open(tag, attrs))

    def note_formatting(self, tag: str, attrs: list, node: int) -> None:
        """Remember an element to reopen, three alike at most."""
        entries, key = self.formatting, (tag, *attrs)
        if self.alike.get(key, 0) > 2:
            self.forget(entries.pop(next(i for i, e in enumerate(entries) if e and e[0] == tag and e[1] == attrs)))
        entries.append((tag, attrs, node))
        self.alike[key] = self.alike.get(key, 0) + 1
        self.listed[tag] = self.listed.get(tag, 0) + 1

    def forget(self, entry: tuple[str, list, int]) -> None:
        """Count an entry that has left the list."""
        self.alike[entry[0], *entry[1]] -= 1
        self.listed[entry[0]] -= 1

    # -- tokens ------------------------------------------------------------

    def text(self, raw: str, decode: bool = True) -> None:
        if not raw:
            return
        text = html.unescape(raw) if decode and "&" in raw else raw
        if self.body < 0 and not self.opened.get("template"):
            rest = text.lstrip(_BLANK)
            blank = text[:len(text) - len(rest)]
            if blank and self.head >= 0:
                self.put(blank)
            if not rest:
                return
            text = rest
            self.need_body()
        if self.formatting:
            self.reopen_formatting()
        self.put(text)

    def put(self, text: str, escape: bool = True) -> None:
        self.texts.append(text)
        if self.want_markup:
            self.markup.append(_escape_text(text) if escape else text)

    def start(self, tag: str, source: str, src: str, at: int) -> int:
        """Handle a start tag; return where reading goes on (after raw text)."""
        attrs = _attributes(source) if source else []
        if tag == "html":
            if self.ids:
                self.merge(0, attrs)
            else:
                self.open("html", attrs)
            return at
        self.need_root()
        if tag == "head":
            if self.head < 0 and self.body < 0:
                self.head = self.open("head", attrs)
            return at
        if tag == "body":
            if self.body >= 0:
                self.merge(self.body, attrs)
            else:
                self.need_body()
                self.merge(self.body, attrs)
            return at
        kind = _KINDS.get(tag, _OTHER)
        if self.body < 0 and not self.opened.get("template"):
            if tag in HEAD_ONLY:
                self.need_head()
            else:
                self.need_body()
        if kind & _PLACED and self.body >= 0 and not self.place(tag):
            return at
        if tag == "image":
            tag, kind = "img", _KINDS["img"]
        if self.formatting and kind & _REOPENS and self.body >= 0:
            self.reopen_formatting()
        node = self.open(tag, attrs)
        if kind & _FORMATTING:
            self.note_formatting(tag, attrs, node)
        elif kind & _RAW:
            return self.raw_text(tag, src, at)
        elif tag == "plaintext":
            self.put(src[at:])
            return len(src)
        elif (tag == "pre" or tag == "listing") and src.startswith("\n", at):
            return at + 1
        elif self.foreign and not kind & _VOID and source.endswith("/"):
            self.close()
        return at

    def raw_text(self, tag: str, src: str, at: int) -> int:
        """Text up to the matching end tag; no tags are read inside."""
        if self.foreign:
            return at
        close = _raw_end(tag).search(src, at)
        stop = close.start() if close else len(src)
        if tag == "textarea" and src.startswith("\n", at):
            at += 1
        content = src[at:stop]
        if content:
            if tag in RCDATA:
                self.put(html.unescape(content) if "&" in content else content)
            else:
                self.put(content, escape=False)
        self.close()
        return close.end() if close else len(src)

    def place(self, tag: str) -> bool:
        """Close what the new element implies closed; False ignores the tag."""
        names, opened = self.names, self.opened
        if tag in CLOSES_P:
            if tag == "li":
                if opened.get("li"):
                    self.close_item(("li",))
            elif tag == "dd" or tag == "dt":
                self.close_item(("dd", "dt"))
            elif tag == "form" and opened.get("form") and not opened.get("template"):
                return False
            if opened.get("p") and self.in_scope(("p",), BUTTON_SCOPE):
                self.close_through(("p",))
            if tag in HEADINGS and names[-1] in HEADINGS:
                self.close()
        elif tag in _TABLE_PARTS:
            return self.place_table_part(tag)
        elif tag == "option" or tag == "optgroup":
            if names[-1] == "option":
                self.close()
            if tag == "optgroup" and names[-1] == "optgroup":
                self.close()
        elif tag != "frame":            # a, nobr, button
            if opened.get(tag) and self.in_scope((tag,)):
                self.end(tag)
            if tag == "a":
                for i in range(len(self.formatting) - 1, -1, -1):
                    if not self.listed.get(tag):
                        break
                    if self.formatting[i] and self.formatting[i][0] == tag:
                        self.forget(self.formatting.pop(i))
        return tag != "frame"

    def close_item(self, tags) -> None:
        for name in reversed(self.names):
            if name in tags:
                self.close_through((name,))
                return
            if name in SPECIAL and name not in ("address", "div", "p"):
                return

    def place_table_part(self, tag: str) -> bool:
        names = self.names
        if not self.in_scope(("table",), ("html", "template")):
            return bool(self.opened.get("template"))
        if tag in ("td", "th"):
            self.close_to(("tr", "tbody", "thead", "tfoot", "table", "template"))
            if names[-1] == "table":
                self.open("tbody", [])
            if names[-1] in ("tbody", "thead", "tfoot"):
                self.open("tr", [])
        elif tag == "tr":
            self.close_to(("tbody", "thead", "tfoot", "table", "template"))
            if names[-1] == "table":
                self.open("tbody", [])
        elif tag == "col":
            self.close_to(("colgroup", "table", "template"))
            if names[-1] == "table":
                self.open("colgroup", [])
        else:
            self.close_to(("table", "template"))
        return True

    def end(self, tag: str) -> None:
        if tag in FORMATTING:
            self.end_formatting(tag)
        elif tag == "br":
            self.start("br", "", "", 0)
        elif tag == "p" and self.body >= 0:
            if not self.in_scope(("p",), BUTTON_SCOPE):
                self.open("p", [])
            self.close_through(("p",))
        elif tag in HEADINGS:
            if self.in_scope(HEADINGS):
                self.close_through(HEADINGS)
        elif not self.opened.get(tag) or tag == "html" or tag == "body":
            pass        # what follows still belongs to the open elements
        elif tag == "head":
            if self.body < 0:
                self.close_through(("head",))
        elif tag == "table" or tag in _TABLE_PARTS:
            if self.in_scope((tag,), TABLE_SCOPE):
                self.close_through((tag,))
        elif tag in SPECIAL:
            if self.in_scope((tag,), LIST_SCOPE if tag == "li" else SCOPE):
                self.close_through((tag,))
        else:
            self.end_inline(tag)

    def end_inline(self, tag: str) -> None:
        for name in reversed(self.names):
            if name == tag:
                self.close_through((tag,))
                return
            if name in SPECIAL:
                return

    def end_formatting(self, tag: str) -> None:
        entries = self.formatting
        for i in range(len(entries) - 1 if self.listed.get(tag) else -1, -1, -1):
            if entries[i] is None:
                break
            if entries[i][0] == tag:
                self.forget(entries[i])
                node = entries.pop(i)[2]
                if not self.closed[node]:
                    self.end_inline(tag)
                return
        if self.opened.get(tag):
            self.end_inline(tag)

    def finish(self) -> None:
        self.need_body()
        while self.ids:
            self.close()
        for row in self.rows:
            row[_KIDS] = self.kids[row[_PRE]]
            if row[_PARENT] >= 0:
                row[_NSIB] = self.kids[row[_PARENT]]


_RAW_ENDS: dict[str, re.Pattern[str]] = {}


def _raw_end(tag: str) -> re.Pattern[str]:
    if tag not in _RAW_ENDS:
        _RAW_ENDS[tag] = re.compile(rf"</{tag}(?:[\t\n\f\r /][^>]*+)?+>", re.IGNORECASE)
    return _RAW_ENDS[tag]
