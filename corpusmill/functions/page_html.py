"""One tolerant parse of an HTML page, for the parts regexes cannot find."""

from __future__ import annotations

import html
from html.parser import HTMLParser
from urllib.parse import urljoin

from corpusmill.constants import CONTENT_ID, WIKI_MARKER

_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}


class Node:
    __slots__ = ("attrs", "children", "name")

    def __init__(self, name: str, attrs=()):
        self.name = name
        self.attrs = {k: v or "" for k, v in attrs}
        self.children: list = []

    def walk(self):
        todo = list(reversed(self.children))
        while todo:
            child = todo.pop()
            if isinstance(child, Node):
                yield child
                todo.extend(reversed(child.children))

    def all(self, *names: str):
        return (n for n in self.walk() if n.name in names)

    def first(self, name: str):
        return next(self.all(name), None)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def text(self) -> str:
        parts, todo = [], list(reversed(self.children))
        while todo:
            child = todo.pop()
            if isinstance(child, str):
                parts.append(child.strip())
            elif isinstance(child, Node) and child.name not in ("script", "style", "template"):
                todo.extend(reversed(child.children))
        return "".join(parts)

    def markup(self) -> str:
        """Serialised element without its tables."""
        out, todo = [], [self]
        while todo:
            item = todo.pop()
            if isinstance(item, tuple):
                out.append(item[0])
            elif isinstance(item, str):
                out.append(html.escape(item, quote=False))
            elif item.name != "table":
                attrs = "".join(f' {k}="{html.escape(v)}"' for k, v in item.attrs.items())
                if item.name in _VOID:
                    out.append(f"<{item.name}{attrs}/>")
                    continue
                out.append(f"<{item.name}{attrs}>")
                todo.append((f"</{item.name}>",))
                raw = item.name in ("script", "style")
                todo.extend((c,) if raw and isinstance(c, str) else c for c in reversed(item.children))
        return "".join(out)


class _Builder(HTMLParser):
    """Elements nest as written; an end tag closes back to the nearest open element of its name."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, attrs))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)

    def handle_comment(self, data):
        self.open[-1].children.append((f"<!--{data}-->",))


def parse(text: str) -> Node:
    builder = _Builder()
    builder.feed(text)
    builder.close()
    return builder.root


def links(page: Node, base: str, marker: str = WIKI_MARKER) -> list[str]:
    hrefs = (a.attrs["href"] for a in page.all("a") if "href" in a.attrs)
    return [urljoin(base, h) for h in hrefs if marker in h]


def infobox(page: Node) -> dict[str, str]:
    box = next((t for t in page.all("table") if "infobox" in t.attrs.get("class", "")), None)
    pairs = [(row.first("th"), row.first("td")) for row in box.all("tr")] if box else []
    return {head.text(): cell.text() for head, cell in pairs if head and cell}


def tables(page: Node) -> list[list[list[str]]]:
    found = [
        [cells for row in table.all("tr") if (cells := [c.text() for c in row.all("th", "td")])]
        for table in page.all("table")
    ]
    return [rows for rows in found if rows]


def images(page: Node) -> list[dict[str, str]]:
    thumbs = [
        (d, next((n for n in d.walk() if "thumbcaption" in n.classes()), None))
        for d in page.all("div") if "thumb" in d.classes()
    ]
    figures = [(f, f.first("figcaption")) for f in page.all("figure")]
    out = []
    for frame, caption in thumbs + figures:
        img = frame.first("img")
        src = img.attrs.get("src", "") if img else ""
        if src:
            url = "https:" + src if src.startswith("//") else src
            out.append({"image_url": url, "caption": caption.text() if caption else ""})
    return out


def main_content(page: Node, source: str, content_id: str = CONTENT_ID) -> str:
    """The content element without tables; the page as it came when there is none outside tables."""
    todo = list(reversed(page.children))
    while todo:
        child = todo.pop()
        if isinstance(child, Node) and child.name != "table":
            if child.name == "div" and child.attrs.get("id") == content_id:
                return child.markup()
            todo.extend(reversed(child.children))
    return source
