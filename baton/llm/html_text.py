"""HTML extraction: all visible text of a page, laid out by its elements.

A tree builder turns the page into balanced open and close events: end tags that HTML lets
authors leave out are implied, stray end tags are dropped, and everything still open is
closed at the end.  The renderer walks the events with a stack: hidden elements give nothing,
blocks start on their own line, paragraphs and the like are set apart by a blank line, list
items carry a bullet or their number under their list's indent, preformatted text keeps its
white space, and the cells of a table line up in columns.  Nothing recurses, so depth is
bounded by memory alone.

Defined results: a null page gives a null text; an empty one, or one without visible text,
the empty text; any string is accepted, well formed or not.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template title noscript iframe noembed noframes object svg math audio video canvas datalist select textarea "
                   "input link meta base param source track area embed".split())
BLOCK = frozenset("address article aside body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
                  "hr html legend li main menu nav ol p pre section summary table caption tr td th thead tbody tfoot ul blockquote option optgroup".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset".split())
#: A start tag closes an open element of these names, up to a boundary of the second set.
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                     "hgroup hr main menu nav ol p pre section summary table ul".split())
IMPLIED = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tr": (frozenset({"tr", "caption", "colgroup"}), frozenset({"table"})),
    "thead": (frozenset({"thead", "tbody", "tfoot", "caption", "colgroup"}), frozenset({"table"})),
    "tbody": (frozenset({"thead", "tbody", "tfoot", "caption", "colgroup"}), frozenset({"table"})),
    "tfoot": (frozenset({"thead", "tbody", "tfoot", "caption", "colgroup"}), frozenset({"table"})),
    "body": (frozenset({"head"}), frozenset({"html"})),
}
#: End tags do not reach out of these.
SCOPE = frozenset("table td th caption html template".split())
CELLS = frozenset("td th caption".split())
TABLE_PARTS = frozenset("tr thead tbody tfoot table".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BODY_STARTS = BLOCK - {"html", "body"}

_TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|(?P<skip>[!?][^>]*(?:>|\Z))|(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>"'=]|=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))?|["'])*)(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_CONCEAL = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(source):
        out.setdefault(name.lower(), a or b or c)
    return out


def _conceals(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element's own markup keeps it from view."""
    if tag in HIDDEN or "hidden" in attrs or tag == "dialog" and "open" not in attrs:
        return True
    return attrs.get("aria-hidden", "").lower() == "true" or bool(_CONCEAL.search(attrs.get("style", "")))


def events(html: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """("open", tag, attributes), ("text", characters, {}) and ("close", tag, {}), balanced."""
    stack: list[str] = []
    where: dict[str, list[int]] = {}  # the places of each open element, so that no search walks the stack
    at, n = 0, len(html)

    def last(names: Iterable[str]) -> int:
        return max((where[x][-1] for x in names if where.get(x)), default=-1)

    def push(tag: str) -> None:
        where.setdefault(tag, []).append(len(stack))
        stack.append(tag)

    def close_to(depth: int):
        while len(stack) > depth:
            tag = stack.pop()
            where[tag].pop()
            yield "close", tag, {}

    def imply(names: frozenset[str], bounds: frozenset[str]):
        i = last(names)
        if i > last(bounds):
            yield from close_to(i)

    while at < n:
        m = _TAG.search(html, at)
        begin = m.start() if m else n
        if begin > at:
            yield "text", unescape(html[at:begin]), {}
        if not m:
            break
        at = m.end()
        if m["cdata"] is not None:
            yield "text", m["cdata"], {}
        if m["name"] is None:
            continue
        tag = m["name"].lower()
        if m["end"]:
            if tag == "br":
                yield "open", "br", {}
                yield "close", "br", {}
            else:
                names = HEADINGS if tag in HEADINGS else (tag,)
                bounds = () if tag in ("html", "body") else SCOPE - CELLS - {tag} if tag in TABLE_PARTS else SCOPE - {tag}
                i = last(names)
                if i > last(bounds):
                    yield from close_to(i)
            continue
        attrs = _attributes(m["attrs"]) if m["attrs"] and not m["attrs"].isspace() else {}
        if tag in BODY_STARTS:
            yield from imply(frozenset({"head"}), frozenset())
        if tag in CLOSES_P:
            yield from imply(frozenset({"p"}), SCOPE | {"button"})
        if tag in HEADINGS and stack and stack[-1] in HEADINGS:
            yield from close_to(len(stack) - 1)
        if tag in IMPLIED:
            yield from imply(*IMPLIED[tag])
        yield "open", tag, attrs
        if tag in VOID or m["attrs"].endswith("/") and tag in ("svg", "path"):
            yield "close", tag, {}
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            inner = html[at:end.start() if end else n]
            if inner:
                yield "text", unescape(inner) if tag in ("title", "textarea") else inner, {}
            at = end.end() if end else n
            yield "close", tag, {}
        else:
            push(tag)
    yield from close_to(0)


class _Flow:
    """Lines of text under construction: collapses white space, sets blocks apart."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False  # a blank is due before the next characters
        self.gap = 0  # blank lines due before the next line
        self.first = ""  # the next line's bullet
        self.indent = ""

    def words(self, text: str) -> None:
        if not text:
            return
        flat = _SPACE.sub(" ", text)
        if flat == " ":
            self.space = self.space or bool(self.now)
            return
        if (flat[0] == " " or self.space) and self.now:
            self.now.append(" ")
        self.now.append(flat.strip(" "))
        self.space = flat[-1] == " "

    def exact(self, text: str) -> None:
        parts = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        for i, part in enumerate(parts):
            if i:
                self.end(keep=True)
            if part:
                self.now.append(part)

    def end(self, keep: bool = False) -> None:
        """End the line; an empty one only counts if ``keep``."""
        line = "".join(self.now)
        self.now, self.space = [], False
        if not line and not keep:
            return
        if self.gap and self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        if line:
            lead = self.first or self.indent
            self.first = ""
            line = lead + line
        self.lines.append(line.rstrip())

    def apart(self, lines: int) -> None:
        self.end()
        if self.lines:
            self.gap = max(self.gap, lines)


def _table(rows: list[list[list[str]]]) -> list[str]:
    """Rows of cells, each a list of lines, with the columns aligned."""
    wide: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            if i == len(wide):
                wide.append(0)
            wide[i] = max([wide[i], *(len(x) for x in cell)])
    out = []
    for row in rows:
        for k in range(max((len(c) for c in row), default=0)):
            line = [(c[k] if k < len(c) else "").ljust(wide[i]) for i, c in enumerate(row)]
            out.append(" | ".join(line).rstrip())
    return out


def render(html: str) -> str:
    """The visible text of a page."""
    flow = _Flow()
    outer: list[tuple[_Flow, list]] = []  # flows that wait for a table's cell
    tables: list[list[list[list[str]]]] = []
    lists: list[list] = []  # [ordered, next number]
    hidden = pre = 0
    before: list[tuple[str, str]] = []  # indents around list items and the like
    for kind, what, attrs in events(html):
        if kind == "text":
            if not hidden and (not tables or outer and len(outer) >= len(tables) or what.strip()):
                if pre:
                    flow.exact(what)
                else:
                    flow.words(what)
            continue
        if kind == "open":
            if hidden or _conceals(what, attrs):
                hidden += 1
                continue
            if what == "br":
                flow.end(keep=True)
            elif what == "table":
                flow.apart(1)
                tables.append([])
            elif what == "tr" and tables:
                tables[-1].append([])
            elif what in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append([])
                outer.append((flow, lists))
                flow, lists = _Flow(), []
            elif what in BLOCK:
                flow.apart(1 if what in APART and not (what in ("ul", "ol") and lists) else 0)
                if what in ("ul", "ol", "menu"):
                    number = attrs.get("start", "1")
                    lists.append([what == "ol", int(number) if re.fullmatch(r"-?\d{1,9}", number) else 1])
                elif what == "li":
                    mark = "- "
                    if lists and lists[-1][0]:
                        mark = f"{lists[-1][1]}. "
                        lists[-1][1] += 1
                    before.append((flow.indent, ""))
                    flow.first, flow.indent = flow.indent + mark, flow.indent + " " * len(mark)
                elif what in ("dd", "blockquote"):
                    before.append((flow.indent, ""))
                    flow.indent += "  "
                elif what == "hr":
                    flow.now.append("---")
                    flow.end()
                pre += what == "pre"
            continue
        if hidden:
            hidden -= 1
        elif what == "table" and tables:
            rows = tables.pop()
            flow.end()
            for line in _table([r for r in rows if r]):
                flow.now.append(line)
                flow.end(keep=True)
            flow.apart(1)
        elif what in ("td", "th") and outer:
            flow.end()
            cell = flow.lines
            flow, lists = outer.pop()
            tables[-1][-1].append(cell)
        elif what in BLOCK:
            flow.apart(1 if what in APART and not (what in ("ul", "ol") and len(lists) > 1) else 0)
            if what in ("ul", "ol", "menu") and lists:
                lists.pop()
            elif what in ("li", "dd", "blockquote") and before:
                flow.first = ""
                flow.indent = before.pop()[0]
            pre -= what == "pre"
    flow.end()
    return "\n".join(flow.lines).strip("\n")


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """The input's columns, with the page's visible text in ``out_col`` instead of the page."""
    names = [c for c in pages.columns if c not in (html_col, out_col)]
    rest = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]) if names else F.struct(F.lit(None).cast("string").alias("c"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                piece = batch.slice(a, 256)
                text = [None if h is None else render(h) for h in piece.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(text, pa.string())], names=["rest", "text"])

    read = pages.select(F.col(f"`{html_col}`").cast("string").alias("html"), rest.alias("rest"))
    out = read.mapInArrow(work, T.StructType([read.schema["rest"], T.StructField("text", T.StringType())]))
    return out.select(*[F.col(f"rest.c{i}").alias(c) for i, c in enumerate(names)], F.col("text").alias(out_col))
