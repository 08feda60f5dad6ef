"""Layout-aware HTML rendering.

A forgiving tree builder keeps the stack of open elements with the usual implied end tags (paragraphs, list items, table
parts, options), and visibility rules (``hidden``, ``display:none``, ``visibility:hidden``, ``aria-hidden``, elements
that browsers do not show, and ``iframe``, ``embed``, ``canvas``, ``audio``, ``video``, ``noscript``, ``template`` and
``datalist``, whose content is not text of the page in a browser that shows them). Text in ``svg`` and ``math`` is shown
without titles, descriptions, metadata, annotations, definitions and phantoms; ``object`` shows its fallback; ``select``
shows its chosen option, a list box all of them. All visible text is emitted: blocks apart by blank lines, line breaks, list items with
bullets or numbers and indentation, quoted blocks, preformatted text as it is, and table rows with their cells aligned
in columns.

One pass per page without recursion, in place, nothing is shuffled. Defined results: null and empty pages give the empty
text; unclosed and stray tags, unfinished comments and deep nesting are taken as they come.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Element classes of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("head script style template noscript title meta link iframe embed audio video canvas datalist".split())
# Hidden within drawings and formulas; names in lower case.
UNSEEN_WITHIN = {
    "svg": set("desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter".split()),
    "math": set("annotation annotation-xml mphantom".split()),
}
# Children of these stand apart from each other.
APART = set("mfrac mroot mtr mtable munder mover munderover".split())
# A slash at the end, unless it belongs to a value without quotes.
SELF_CLOSED = re.compile(r"(?<![^\s\"'])/$|^/$")
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "xmp"}
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table ul".split()
)
# Blocks that a blank line sets apart; the others only begin a line.
SPACED = set("address article aside blockquote dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header main nav ol p pre section table ul".split())
CLOSES_P = BLOCK - {"body", "html", "li", "dd", "dt", "legend", "summary", "figcaption"} | {"p"}
# Opening one of these ends an open one of those, up to the border.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
}
SCOPE = {"table", "td", "th", "caption", "html", "button", "object"}

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"[ \t\n\r\f]+")
MAX_INDENT = 24  # levels of lists and quotes that indent
HIDING = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")


class Block:
    """Lines written so far in one flow: the page, a table cell or a caption."""

    __slots__ = ("lines", "line", "gap")

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.gap = False

    def text(self, words: str, lead: str) -> None:
        if not self.line:
            words = words.lstrip(" ")
            if not words:
                return
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.line = lead
        elif self.line.endswith(" ") and words.startswith(" "):
            words = words[1:]
        self.line += words

    def end_line(self) -> None:
        if self.line.strip():
            self.lines.append(self.line.rstrip())
        self.line = ""

    def finish(self) -> list[str]:
        self.end_line()
        return self.lines


class Renderer:
    def __init__(self):
        self.stack: list[tuple[str, bool]] = []  # open elements and whether they hide their content
        self.hidden = 0
        self.pre = 0
        self.lists: list[list] = []  # kind and count of open lists
        self.quotes = 0
        self.mark: str | None = None  # bullet of the item that has not begun yet
        self.flow = Block()
        self.tables: list[dict] = []
        self.selects: list[dict] = []
        self.foreign: list[str] = []  # open svg and math elements
        self.counts = {"blocks": 0, "lists": 0, "tables": 0}

    def lead(self) -> str:
        # Deeper levels are written like the deepest one shown, so that a line's indent is bounded.
        depth = min(MAX_INDENT, max(0, len(self.lists) - 1))
        out = "> " * min(MAX_INDENT, self.quotes) + "  " * depth
        if self.mark is not None:
            out, self.mark = out + self.mark, None
        elif self.lists:
            out += "  "
        return out

    def text(self, data: str) -> None:
        if self.hidden or not data:
            return
        data = entities.unescape(data) if "&" in data else data
        if self.tables and self.flow is self.tables[-1]["outer"] and not data.strip():
            return
        if self.pre:
            for i, part in enumerate(data.split("\n")):
                if i:
                    self.flow.lines.append(self.flow.line.rstrip())
                    self.flow.line = ""
                if part:
                    if self.flow.gap and self.flow.lines:
                        self.flow.lines.append("")
                    self.flow.gap = False
                    self.flow.line += part
            return
        words = SPACE.sub(" ", data)
        if words == " " and not self.flow.line:
            return
        self.flow.text(words, "" if self.flow.line else self.lead() if words.strip() else "")

    def start(self, name: str, attributes: str) -> None:
        if name in CLOSES_P:
            self.close_up_to({"p"}, SCOPE)
        if name in IMPLIED:
            self.close_up_to(*IMPLIED[name])
        if self.selects and name in ("select", "input", "textarea"):
            self.close_up_to({"select"}, {"table"})
        within = self.foreign[-1] if self.foreign else ""
        if (within or name in ("svg", "math")) and SELF_CLOSED.search(attributes):
            return
        hides = name in UNSEEN or (bool(attributes) and is_hidden(attributes))
        if within:
            hides = hides or name in UNSEEN_WITHIN[within] or attribute(attributes, "display").lower() == "none"
            hides = hides or within == "svg" and attribute(attributes, "visibility").lower() in ("hidden", "collapse")
        if name == "option" and self.selects and not self.hidden:
            # The chosen option is shown even where the list does not have it.
            select = self.selects[-1]
            select["options"].append([attribute(attributes, "label"), has(attributes, "selected"), select["disabled"] or has(attributes, "disabled"), hides, None])
            hides = False
        if name in VOID:
            if not self.hidden and not hides:
                self.void(name, attributes)
            return
        self.stack.append((name, hides))
        if hides:
            self.hidden += 1
        if self.hidden:
            return
        if name in ("svg", "math"):
            self.foreign.append(name)
        elif name == "text" and within == "svg":
            self.text(" ")
        elif name == "select":
            size = attribute(attributes, "size")
            box = has(attributes, "multiple") or size.isdigit() and int(size) > 1
            self.selects.append({"options": [], "disabled": False, "box": box, "outer": self.flow, "state": (self.lists, self.quotes, self.mark, self.pre)})
            self.flow = Block()
            self.lists, self.quotes, self.mark, self.pre = [], 0, None, 0
        elif name == "optgroup" and self.selects:
            self.selects[-1]["disabled"] = has(attributes, "disabled")
        elif name == "option" and self.selects:
            self.flow = Block()
        if name in BLOCK:
            self.flow.end_line()
            self.flow.gap |= name in SPACED and not (self.lists and name in ("ul", "ol"))
            self.counts["blocks"] += 1
        if name in ("ul", "ol", "menu", "dir"):
            start = attribute(attributes, "start") if name == "ol" else ""
            self.lists.append([name, int(start) - 1 if re.fullmatch(r"-?\d{1,9}", start) else 0])
            self.counts["lists"] += 1
        elif name == "li":
            if self.lists and self.lists[-1][0] == "ol":
                self.lists[-1][1] += 1
                self.mark = f"{self.lists[-1][1]}. "
            else:
                self.mark = "- "
        elif name == "blockquote":
            self.quotes += 1
        elif name == "pre":
            self.pre += 1
        elif name == "table":
            self.tables.append({"rows": [], "outer": self.flow, "state": (self.lists, self.quotes, self.mark)})
            self.lists, self.quotes, self.mark = [], 0, None
            self.counts["tables"] += 1
        elif self.tables and name == "tr":
            self.tables[-1]["rows"].append([])
        elif self.tables and name in ("td", "th", "caption"):
            self.flow = Block()

    def void(self, name: str, attributes: str) -> None:
        if name == "br":
            if self.flow.line.strip():
                self.flow.end_line()
        elif name == "hr":
            self.flow.end_line()
            self.flow.gap = True
        elif name == "img":
            self.text(attribute(attributes, "alt"))
        elif name == "input" and attribute(attributes, "type").lower() in ("submit", "button", "reset"):
            self.text(attribute(attributes, "value"))

    def end(self, name: str) -> None:
        if name == "p" and not any(n == "p" for n, _ in self.stack):
            self.start("p", "")
        border = {"table"} if name in ("li", "td", "th", "tr", "p", "dd", "dt") or name in BLOCK and name != "table" else set()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == name:
                while len(self.stack) > i:
                    self.pop()
                return
            if self.stack[i][0] in border:
                return

    def close_up_to(self, names: set[str], border: set[str]) -> None:
        """Close the outermost open element of ``names`` above the nearest border, and what is in it."""
        found = None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in border:
                break
            if self.stack[i][0] in names:
                found = i
        while found is not None and len(self.stack) > found:
            self.pop()

    def pop(self) -> None:
        name, hides = self.stack.pop()
        was_hidden = self.hidden
        self.hidden -= hides
        if was_hidden:
            return
        if name in ("svg", "math") and self.foreign:
            self.foreign.pop()
        elif name == "text" and self.foreign[-1:] == ["svg"] or self.stack and self.stack[-1][0] in APART and self.foreign[-1:] == ["math"]:
            self.text(" ")
        elif name == "optgroup" and self.selects:
            self.selects[-1]["disabled"] = False
        elif name == "option" and self.selects and self.selects[-1]["options"]:
            self.selects[-1]["options"][-1][-1] = " ".join(" ".join(self.flow.finish()).split())
            self.flow = Block()
        elif name == "select" and self.selects:
            select = self.selects.pop()
            self.flow = select["outer"]
            self.lists, self.quotes, self.mark, self.pre = select["state"]
            for shown in chosen(select["options"], select["box"]):
                if shown:
                    self.flow.text(shown, "" if self.flow.line else self.lead())
                if select["box"]:
                    self.flow.end_line()
        if name in BLOCK and not (name == "table"):
            self.flow.end_line()
            self.flow.gap |= name in SPACED and not (self.lists and name in ("ul", "ol"))
        if name in ("ul", "ol", "menu", "dir") and self.lists:
            self.lists.pop()
            self.mark = None
            self.flow.gap |= not self.lists
        elif name == "li":
            self.mark = None
        elif name == "blockquote":
            self.quotes = max(0, self.quotes - 1)
        elif name == "pre":
            self.pre = max(0, self.pre - 1)
        elif self.tables and name in ("td", "th", "caption") and self.flow is not self.tables[-1]["outer"]:
            cell = self.flow.finish()
            self.flow = self.tables[-1]["outer"]
            rows = self.tables[-1]["rows"]
            if name == "caption":
                self.flow.end_line()
                if self.flow.gap and self.flow.lines:
                    self.flow.lines.append("")
                self.flow.gap = False
                self.flow.lines += cell
            else:
                if not rows:
                    rows.append([])
                rows[-1].append([line for line in cell if line])
        elif name == "table" and self.tables:
            table = self.tables.pop()
            self.flow = table["outer"]
            self.lists, self.quotes, self.mark = table["state"]
            self.flow.end_line()
            lines = aligned(table["rows"])
            if lines:
                lead = self.lead()
                if self.flow.gap and self.flow.lines:
                    self.flow.lines.append("")
                self.flow.lines += [lead + line for line in lines]
            self.flow.gap = True

    def page(self, source: str) -> str:
        at, size = 0, len(source)
        stop = source.rfind(">") + 1  # no tag ends beyond
        while at < size:
            m = TOKEN.search(source, at, stop) if at < stop else None
            if m is None:
                # An unfinished comment hides the rest.
                self.text(source[at:].partition("<!--")[0])
                break
            if m.start() > at:
                self.text(source[at : m.start()])
            at = m.end()
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                break
            slash, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                continue
            name = name.lower()
            if slash:
                self.end(name)
                continue
            self.start(name, attributes)
            if name in RAW and not (self.foreign and SELF_CLOSED.search(attributes)):
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", re.I).search(source, at)
                if name == "textarea" or name == "xmp":
                    self.text(source[at : close.start()])
                at = close.end()
                self.end(name)
        while self.stack:
            self.pop()
        return "\n".join(self.flow.finish()).strip("\n")


def attribute(attributes: str, name: str) -> str:
    for m in ATTRIBUTE.finditer(attributes):
        if m[1].lower() == name:
            return entities.unescape(m[2] or m[3] or m[4] or "")
    return ""


def has(attributes: str, name: str) -> bool:
    return any(m[1].lower() == name for m in ATTRIBUTE.finditer(attributes))


def chosen(options: list[list], box: bool) -> list[str]:
    """What a closed select shows: the last selected option, else the first that is not disabled; a list box shows all."""
    texts = [label or text or "" for label, _, _, _, text in options]
    if box:
        return [t for t, o in zip(texts, options) if not o[3]]
    selected = [t for t, o in zip(texts, options) if o[1]][-1:]
    return selected or [t for t, o in zip(texts, options) if not o[2]][:1]


def is_hidden(attributes: str) -> bool:
    low = attributes.lower()
    if "hid" not in low and "none" not in low:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "style" and HIDING.search(value) or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "type" and value.lower() == "hidden":
            return True
    return False


def aligned(rows: list[list[list[str]]]) -> list[str]:
    """Rows of cells as lines, columns as wide as their widest cell; several lines of a cell stay below each other."""
    rows = [r for r in rows if any(r)]
    widths: list[int] = []
    for row in rows:
        for k, cell in enumerate(row):
            if k == len(widths):
                widths.append(0)
            widths[k] = max([widths[k], *map(len, cell)])
    out = []
    for row in rows:
        for i in range(max(map(len, row))):
            cells = [(cell[i] if i < len(cell) else "").ljust(widths[k]) for k, cell in enumerate(row)]
            out.append("  ".join(cells).rstrip())
    return out


def render(source: str | None) -> tuple[str, dict[str, int]]:
    """Visible text of a page, and how many blocks, lists and tables were shown."""
    renderer = Renderer()
    return renderer.page(source or ""), renderer.counts


def render_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col``, visible ``text`` and the numbers of shown blocks, lists and tables of every page."""
    counts = ["blocks", "lists", "tables"]
    schema = T.StructType([
        T.StructField(id_col, pages.schema[id_col].dataType), T.StructField("text", T.StringType()), *(T.StructField(f"n_{c}", T.LongType()) for c in counts)
    ])

    def run(batches):
        for batch in batches:
            sources = batch.column(1)
            for lo in range(0, len(sources), 500):
                shown = [render(x.as_py()) for x in sources.slice(lo, 500)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, 500), pa.array([t for t, _ in shown], pa.string()), *(pa.array([c[k] for _, c in shown], pa.int64()) for k in counts)],
                    [id_col, "text", *(f"n_{c}" for c in counts)],
                )

    return pages.select(id_col, html_col).mapInArrow(run, schema)
