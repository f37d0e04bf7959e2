"""A light element tree for one page, used inside tasks where regular expressions cannot
decide nesting. Built on the standard library parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

# Elements without content, and elements that end at a sibling of their own kind (HTML standard).
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_SELF_CLOSING_KIND = {"li", "p", "option", "tr", "td", "th", "dt", "dd"}
_LIST_LIKE = {"ul", "ol", "table", "select", "dl", "div", "section", "article", "body"}
_NOT_TEXT = {"script", "style", "template"}


class Node:
    __slots__ = ("tag", "attrs", "parts")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.parts = tag, attrs, []

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def walk(self) -> Iterator["Node"]:
        """Descendants in document order; any depth."""
        return (part for part in self._below(lambda n: True) if isinstance(part, Node))

    def _below(self, enter) -> Iterator["Node | str"]:
        stack = [iter(self.parts)]
        while stack:
            part = next(stack[-1], None)
            if part is None:
                stack.pop()
                continue
            yield part
            if isinstance(part, Node) and enter(part):
                stack.append(iter(part.parts))

    def first(self, test) -> "Node | None":
        return next((n for n in self.walk() if test(n)), None)

    def _strings(self) -> Iterator[str]:
        return (part for part in self._below(lambda n: n.tag not in _NOT_TEXT) if isinstance(part, str))

    def text(self) -> str:
        """Stripped text pieces joined by one space."""
        return " ".join(s for s in (p.strip() for p in self._strings()) if s)


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in _SELF_CLOSING_KIND:
            for depth in range(len(self.open) - 1, 0, -1):
                above = self.open[depth].tag
                if above == tag:
                    del self.open[depth:]
                    break
                if above in _LIST_LIKE:
                    break
        known: dict = {}
        for name, value in attrs:
            known.setdefault(name, value or "")
        node = Node(tag, known)
        self.open[-1].parts.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def tree(html: str | None) -> Node:
    """Tree of a page; of one that the parser gives up on, what it had read."""
    builder = _TreeBuilder()
    try:
        builder.feed(html or "")
        builder.close()
    except AssertionError:  # the parser's answer to a broken declaration
        pass
    return builder.root


def _with_class(name: str):
    return lambda n: name in n.classes


def listing(html: str):
    """(pos, name, grade, price, stock, closed, image) of the items of a listing page."""
    root = tree(html)
    boxes = (root.first(lambda n, i=wanted: n.attrs.get("id") == i) for wanted in ("cardList", "listView"))
    box = next((b for b in boxes if b is not None), None)
    items = (n for n in box.walk() if n.tag == "li" and "item" in n.classes) if box else ()
    for pos, item in enumerate(items):
        fields = [item.first(_with_class(c)) for c in ("name", "tag", "price", "stock")]
        # the item itself may be the .card that holds the image
        cards = (n for n in (item, *item.walk()) if "card" in n.classes)
        image = next((i for card in cards for i in card.walk() if i.tag == "img"), None)
        yield (pos, *[n.text() if n else "" for n in fields], "closed" in item.classes,
               image.attrs.get("src", "") if image else "")


def anchors_inside(list_class: str):
    """(pos, href, text) of the links inside any element whose class contains ``list_class``."""
    def expand(html: str):
        root = tree(html)  # held: nodes are told apart by identity
        seen: set[int] = set()
        boxes = (n for n in root.walk() if list_class in (n.attrs.get("class") or ""))
        for n in (a for box in boxes for a in box.walk()):
            if n.tag == "a" and n.attrs.get("href") and id(n) not in seen:
                seen.add(id(n))
                yield len(seen) - 1, n.attrs["href"], n.text()
    return expand


def first_anchors(classes):
    """Per class part the href of the first link inside any element whose class contains it ("" without one), in one row."""
    def expand(html: str):
        root = tree(html)
        found = []
        for part in classes:
            boxes = (n for n in root.walk() if part in (n.attrs.get("class") or ""))
            # a box begins before all that begin later, so the first box with a link has the first link
            links = (a for box in boxes for a in [box.first(lambda n: n.tag == "a" and "href" in n.attrs)] if a)
            link = next(links, None)
            found.append(link.attrs["href"] if link else "")
        yield (found,)
    return expand


def first_texts(tests):
    """Text of the first element per (attribute, token) test, in one row."""
    def expand(html: str):
        root = tree(html)
        firsts = [root.first(lambda n, a=attr, t=token: t in (n.attrs.get(a) or "")) for attr, token in tests]
        yield ([n.text() if n else "" for n in firsts],)
    return expand
