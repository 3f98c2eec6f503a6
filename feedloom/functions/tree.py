"""A minimal element tree for irregular HTML, used inside Arrow tasks only.

Unclosed elements end with their parent or where a start tag implies it, as a list item ends the
one before; stray end tags are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import escape, unescape
from html.parser import HTMLParser

# Elements without content, and elements whose text is never shown.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link meta param source track wbr".split()
)
UNSHOWN_TAGS = frozenset(("script", "style", "template"))

# What a start tag ends, and up to which elements it looks for that.
_BLOCKS = frozenset((
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section "
    "summary table ul"
).split())
_BARRIERS = {*_BLOCKS, "button", "caption", "object", "select", "tbody", "td", "template", "th", "tr"}
_BARRIERS -= {"address", "div", "p"}
_ENDED_BY = {
    "li": ({"li"}, _BARRIERS - {"li"}),
    "dt": ({"dt", "dd"}, _BARRIERS - {"dt", "dd"}),
    "dd": ({"dt", "dd"}, _BARRIERS - {"dt", "dd"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
_KEEPS_PARAGRAPH = {"button", "table", "td", "th", "caption", "object", "template", "applet", "marquee"}


# Regular markup: texts, tags whose attributes are plain names with quoted values, and the document type. What comes
# after the start tag of an element with its own rules for content is left to the parser of the library.
_REGULAR = re.compile(
    r"([^<]+)"
    r'|<([a-zA-Z][a-zA-Z0-9]*)((?: +[a-zA-Z][-a-zA-Z0-9_]*="[^"<>]*")*) *>'
    r"|</([a-zA-Z][a-zA-Z0-9]*)>"
    r"|<!([dD][oO][cC][tT][yY][pP][eE][^<>]*)>"
)
_ATTRIBUTE = re.compile(r'([a-zA-Z][-a-zA-Z0-9_]*)="([^"<>]*)"')
_OWN_RULES = frozenset(
    "script style title textarea template xmp iframe noembed noframes noscript plaintext svg math".split()
)
_TEXT, _START, _END, _DOCTYPE = 1, 3, 4, 5


# The references that texts mostly have; '&amp;' has to be the last.
_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\xa0"), ("&amp;", "&"))


def _decoded(text):
    """``unescape``, by plain replacing where there are no other references."""
    if "&" not in text:
        return text
    if text.count("&") != sum(text.count(code) for code, _ in _REFERENCES):
        return unescape(text)
    for code, char in _REFERENCES:
        text = text.replace(code, char)
    return text


@lru_cache(maxsize=4096)
def _attributes(source):
    """The attributes of a regular start tag, which are the same for every tag written like it; not to be changed."""
    attrs = {}
    for name, value in _ATTRIBUTE.findall(source):
        attrs.setdefault(name.lower(), unescape(value))
    return attrs


class Comment:
    """A comment, declaration or processing instruction; never shown, but it divides texts."""

    __slots__ = ("markup",)

    def __init__(self, markup):
        self.markup = markup


class Element:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag = tag
        self.attrs = attrs
        self.children = []
        self.parent = parent

    def walk(self):
        """All elements below this one, in document order."""
        pending = [iter(self.children)]
        while pending:
            child = next(pending[-1], None)
            if child is None:
                pending.pop()
            elif isinstance(child, Element):
                yield child
                pending.append(iter(child.children))

    def strings(self, skip=None):
        """The shown text nodes below this element, in document order."""
        pending = [iter(self.children)]
        while pending:
            child = next(pending[-1], None)
            if child is None:
                pending.pop()
            elif isinstance(child, str):
                yield child
            elif isinstance(child, Element):
                if child.tag not in UNSHOWN_TAGS and not (skip and skip(child)):
                    pending.append(iter(child.children))

    def sole_string(self):
        """The text, if one text node is all there is, looking through single elements."""
        node = self
        while isinstance(node, Element):
            if len(node.children) != 1:
                return None
            node = node.children[0]
        return node

    def joined_text(self, separator, skip=None):
        return separator.join(s for s in (t.strip() for t in self.strings(skip)) if s)

    def inner_html(self):
        out = []
        pending = [(iter(self.children), "")]
        while pending:
            child = next(pending[-1][0], None)
            if child is None:
                out.append(pending.pop()[1])
            elif isinstance(child, Element):
                attrs = "".join(f' {k}="{escape(v or "")}"' for k, v in child.attrs.items())
                out.append(f"<{child.tag}{attrs}>")
                end = "" if child.tag in VOID_TAGS else f"</{child.tag}>"
                pending.append((iter(child.children), end))
            elif isinstance(child, Comment):
                out.append(child.markup)
            elif pending[-1][1] in ("</script>", "</style>"):
                out.append(child)
            else:
                out.append(escape(child, quote=False))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.current = Element("", {}, None)
        self.pieces = []  # of the text node that is being read

    def end_text(self):
        if self.pieces:
            self.current.children.append("".join(self.pieces))
            self.pieces = []

    def handle_data(self, data):
        self.pieces.append(data)

    def handle_starttag(self, tag, attrs):
        self.end_text()
        self.end_implied(tag)
        first_wins = {}
        for name, value in attrs:
            first_wins.setdefault(name, value or "")
        self.open(tag, first_wins)

    def open(self, tag, attrs):
        element = Element(tag, attrs, self.current)
        self.current.children.append(element)
        if tag not in VOID_TAGS:
            self.current = element

    def end_open(self, ended, scope):
        """End the outermost open element of ``ended`` below the nearest one of ``scope``."""
        node, last = self.current, None
        while node is not self.root and node.tag not in scope:
            if node.tag in ended:
                last = node
            node = node.parent
        if last is not None:
            self.current = last.parent

    def end_implied(self, tag):
        if tag in _BLOCKS:
            self.end_open({"p"}, _KEEPS_PARAGRAPH)
        if tag in _ENDED_BY:
            self.end_open(*_ENDED_BY[tag])

    def handle_startendtag(self, tag, attrs):
        parent = self.current
        self.handle_starttag(tag, attrs)
        self.current = parent

    def handle_endtag(self, tag):
        self.end_text()
        node = self.current
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.current = node.parent

    def add_comment(self, markup):
        self.end_text()
        self.current.children.append(Comment(markup))

    def handle_comment(self, data):
        self.add_comment(f"<!--{data}-->")

    def handle_decl(self, decl):
        self.add_comment(f"<!{decl}>")

    def handle_pi(self, data):
        self.add_comment(f"<?{data}>")

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self.end_text()
            self.handle_data(data[len("CDATA["):])
            self.end_text()
        else:
            self.add_comment(f"<![{data}]>")

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def read_regular(self, html):
        """Read as far as markup is regular, which the library's parser would read alike but slowly; return how far."""
        at, following = 0, _REGULAR.scanner(html).match
        while (found := following()) is not None:
            kind = found.lastindex
            if kind == _TEXT:
                self.pieces.append(_decoded(found[1]))
            elif kind == _START:
                tag = found[2].lower()
                if tag in _OWN_RULES:
                    break
                self.end_text()
                if tag in _BLOCKS or tag in _ENDED_BY:
                    self.end_implied(tag)
                self.open(tag, _attributes(found[3]))
            elif kind == _END:
                self.handle_endtag(found[4].lower())
            else:
                self.handle_decl(found[5])
            at = found.end()
        return at

    def close(self):
        super().close()
        self.end_text()


def parse(html):
    builder = _Builder()
    builder.feed(html[builder.read_regular(html) :])
    builder.close()
    return builder.root


def has_class(element, token):
    names = element.attrs.get("class")
    return bool(names) and token in names and token in names.split()


def spaced_text(root, hidden_class=None, hidden_label=None):
    """Text on single spaces, without the elements that only hold the hidden label."""

    def hidden(element):
        return (
            element.tag == "span"
            and has_class(element, hidden_class)
            and element.sole_string() == hidden_label
        )

    return " ".join(root.joined_text(" ", hidden if hidden_class else None).split())


def compact_text(root):
    """Text nodes stripped and put together without a separator."""
    return root.joined_text("")
