"""Minimal DOM over the standard-library HTML tokenizer.

This is the per-page helper the extraction walk calls inside Spark tasks; it
only builds a tree and answers "first/all descendants with this tag and class"
and "text of this node".  Typing, JSON decoding, number parsing and filtering
happen afterwards in Spark.

Matching rules that the extraction specs rely on:

* a class given as one word matches a *token* of the class list, so
  ``product`` does not match ``product-tile``;
* a class given with a blank must equal the whole attribute string;
* ``find`` is the first match in document order, ``find_all`` every match,
  nested ones included;
* void elements (``img``, ``br``…) never hold children; an end tag closes the
  nearest open element of that name and is ignored when none is open.
"""

from __future__ import annotations

from html.parser import HTMLParser

# HTML void elements (never have an end tag or children).
VOID_TAGS = frozenset([
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "param", "source", "track", "wbr", "basefont", "bgsound", "frame", "keygen",
    "menuitem", "spacer",
])


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "_by_tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: "Node | None"):
        self.tag = tag
        self.attrs = attrs
        self.children: list = []
        self.parent = parent
        self._by_tag = None

    # -- matching ---------------------------------------------------------
    def matches(self, tag: str | None, cls: str | None = None,
                attr: str | None = None) -> bool:
        if tag is not None and self.tag != tag:
            return False
        if attr is not None and attr not in self.attrs:
            return False
        if cls is not None:
            value = self.attrs.get("class")
            if value is None:
                return False
            if " " in cls:
                return value == cls or " ".join(value.split()) == cls
            return cls in value.split()
        return True

    def iter_descendants(self):
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, Node):
                yield n
                stack.extend(reversed(n.children))

    def _descendants_with(self, tag: str | None):
        """Descendants (document order), by tag from an index built on first
        use: several lookups under one node cost one walk of its subtree."""
        if tag is None:
            return self.iter_descendants()
        idx = self._by_tag
        if idx is None:
            idx = {}
            for n in self.iter_descendants():
                lst = idx.get(n.tag)
                if lst is None:
                    idx[n.tag] = [n]
                else:
                    lst.append(n)
            self._by_tag = idx
        return idx.get(tag, ())

    def find(self, tag: str | None, cls: str | None = None, attr: str | None = None):
        for n in self._descendants_with(tag):
            if n.matches(None, cls, attr):
                return n
        return None

    def find_all(self, tag: str | None, cls: str | None = None,
                 attr: str | None = None) -> list["Node"]:
        return [n for n in self._descendants_with(tag) if n.matches(None, cls, attr)]

    def next_sibling(self, tag: str) -> "Node | None":
        if self.parent is None:
            return None
        sibs = self.parent.children
        seen = False
        for s in sibs:
            if s is self:
                seen = True
            elif seen and isinstance(s, Node) and s.tag == tag:
                return s
        return None

    # -- text ---------------------------------------------------------------
    def strings(self):
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                yield n
            elif n.tag not in ("script", "style", "template"):
                stack.extend(reversed(n.children))

    def text(self) -> str:
        """All text joined, then stripped at the ends."""
        return "".join(self.strings()).strip()

    def text_tight(self) -> str:
        """Every text fragment stripped, empty ones dropped, joined with ''."""
        return "".join(s.strip() for s in self.strings() if s.strip())

    def get(self, attr: str):
        return self.attrs.get(attr)


def _attr_dict(attrs):
    """Attributes as a dict (last duplicate wins); a valueless attribute reads
    as the empty string, an absent one as ``None``."""
    d = dict(attrs)
    if None in d.values():
        d = {k: ("" if v is None else v) for k, v in d.items()}
    return d


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#document", {}, None)
        self.open: list[Node] = [self.root]

    def handle_starttag(self, tag, attrs):
        parent = self.open[-1]
        node = Node(tag, _attr_dict(attrs), parent)
        parent.children.append(node)
        if tag not in VOID_TAGS:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        parent = self.open[-1]
        parent.children.append(Node(tag, _attr_dict(attrs), parent))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


class BadMarkup(ValueError):
    """The tokenizer failed on a page."""


def parse(html: str | None) -> Node:
    """Parse markup into a tree; ``None`` gives an empty document."""
    b = _TreeBuilder()
    if html:
        try:
            b.feed(html)
            b.close()
        except Exception as e:  # the tokenizer raises many kinds, assertions among them
            raise BadMarkup(f"{type(e).__name__}: {e}") from e
    return b.root
