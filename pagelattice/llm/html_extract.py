"""Layout-aware HTML to text.

A tokenizer feeds a tree builder that supplies what authors leave out (paragraphs, list items, table
sections and rows, options end where HTML says they do; head and body are implied). Visibility rules then
hide what a browser wouldn't show: scripts, styles, templates and the like, ``hidden``, ``display:none``
(inline, or by a simple tag, class or id rule of the page's own style sheets that holds on a screen of ``SCREEN``
pixels), ``visibility:hidden`` until a descendant is visible again, closed ``details`` but for their summary. All
other text is put out: white space collapsed but in ``pre``, blocks on lines of their own with a blank line around
paragraphs, headings, lists and tables, list items with bullets or numbers and indented by level, table cells padded
to the width of their column and joined by `` | ``. Cells that span columns or rows keep the others in their place, and
a cell of several blocks or items takes as many lines. Of form controls what they show counts: the chosen option (all
of a list box), the value or placeholder of a field, the caption of a button; of pictures in SVG their ``text``.

Reading is linear in the page: a ``<`` whose tag never ends is text, and what was scanned in vain isn't scanned again.

Defined cases: null HTML gives an empty text; broken markup never fails (a ``<`` that opens no tag is
text; what is left open is closed at the end); elements nested deeper than ``DEPTH`` are attached flat, as
browsers do, their text kept; repeated rows each return a row; further columns are ignored.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

DEPTH = 300
#: Element classes of the public HTML standard (fixed values).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = set("head script style title template noscript iframe noembed noframes video audio canvas datalist param link meta base area annotation annotation-xml".split())
#: Parts of SVG that hold no shown text, form fields that show none, and at-rules whose blocks hold (fixed values).
SVG_HIDDEN = set("defs title desc metadata style script symbol clippath mask pattern marker".split())
SILENT = set("hidden checkbox radio file color range password".split())
GROUPS = set("supports layer container".split())
SCREEN = 1280
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section summary table tbody td tfoot th thead tr ul xmp caption".split()
)
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure".split())
HEAD_ONLY = set("base basefont bgsound link meta title style script template noscript".split())
#: A start tag ends these open elements, unless one of the fences stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
CLOSES_P = BLOCK - {"body", "html", "li", "dt", "dd", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend", "summary"} | {"li", "dt", "dd"}
P_FENCES = {"td", "th", "caption", "button", "table", "body", "html", "template", "object"}
_OPEN = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_DISPLAY = re.compile(r"display\s*:\s*([\w\-]+)\s*(!\s*important)?", re.I)


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.kids = tag, attrs, []


def tag_ends(source: str) -> Callable[[int], int]:
    """A function from a place within a tag to the end of the tag, -1 if it has none.

    A quote begins a value only behind ``=`` and if it is closed later. Stretches that a vain search went through
    outside of quotes are remembered: a search that comes there ends in vain as well.
    """
    last = source.rfind(">")
    unclosed = {'"': len(source) + 1, "'": len(source) + 1}  # no quote of the kind closes one from here on
    vain = bytearray()

    def end(at: int) -> int:
        nonlocal vain
        if at > last or vain and vain[at]:
            return -1
        i, passed = at, []
        while (m := _STOP.search(source, i)) and not (vain and vain[m.start()]):
            if m[0] == ">":
                return m.end()
            passed.append((i, m.end()))
            i, k = m.end(), m.start() - 1
            while k >= at and source[k].isspace():
                k -= 1
            if k >= at and source[k] == "=" and i < unclosed[m[0]]:
                j = source.find(m[0], i)
                if j < 0:
                    unclosed[m[0]] = i
                else:
                    i = j + 1
        vain = vain or bytearray(len(source) + 1)
        for lo, hi in [*passed, (i, m.end() if m else len(source))]:
            vain[lo:hi] = b"\1" * (hi - lo)
        return -1

    return end


def build(source: str) -> tuple[Node, list[str]]:
    """Tree of a page, and the texts of its style sheets."""
    root = Node("html", {})
    stack, styles, at, flat, text_at = [root], [], 0, [], 0
    end_of = tag_ends(source)

    def add_text(text: str) -> None:
        if stack[-1].tag == "head" and text.strip():
            stack.pop()
        stack[-1].kids.append(html.unescape(text))

    def close(tags: set, fences: set) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                # the outermost of the run: a row that ends also ends its cell
                while k > 1 and stack[k - 1].tag in tags:
                    k -= 1
                del stack[k:]
                return
            if stack[k].tag in fences:
                return

    while True:
        m = _OPEN.search(source, at)
        if m is None:
            if text_at < len(source):
                add_text(source[text_at:])
            return root, styles
        begin, opened = m.start(), m[0]
        if opened in ("<!--", "<![CDATA[", "<!", "<?"):
            mark = {"<!--": "-->", "<![CDATA[": "]]>"}.get(opened, ">")
            stop = source.find(mark, m.end())
            tag, after = None, stop + len(mark) if stop >= 0 else len(source)
        else:
            name = _NAME.match(source, begin + 1)
            end, tag, after = name[1], name[2], end_of(name.end())
            if after < 0:  # a tag that never ends is text
                at = m.end()
                continue
            rest = source[name.end() : after - 1]
        if begin > text_at:
            add_text(source[text_at:begin])
        at = text_at = after
        if tag is None:
            continue
        tag = tag.lower()
        if end:
            if tag == "p" and not any(n.tag == "p" for n in stack):
                stack[-1].kids.append(Node("p", {}))
            elif tag == "br":
                stack[-1].kids.append(Node("br", {}))
            elif flat and flat[-1] == tag:
                flat.pop()
            else:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
                    if stack[k].tag in ("td", "th", "table", "template") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                        break
            continue
        attrs = {}
        if rest:
            for name, a, b, c in _ATTR.findall(rest):
                attrs.setdefault(name.lower(), html.unescape(a or b or c))
        if tag == "html":
            root.attrs = {**attrs, **root.attrs}
            continue
        if stack[-1].tag == "head" and tag not in HEAD_ONLY:
            stack.pop()
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in CLOSES_P:
            close({"p"}, P_FENCES)
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            stack[-1].kids.append(row := Node("tr", {}))
            stack.append(row)
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            body = source[at : stop.start() if stop else len(source)]
            close_at = source.find(">", stop.end()) if stop else -1
            at = text_at = close_at + 1 if close_at >= 0 else len(source)
            if tag == "style":
                styles.append(body)
            if tag == "textarea":
                node = Node("pre", attrs)
                node.kids.append(html.unescape(body))
                stack[-1].kids.append(node)
            continue
        node = Node(tag, attrs)
        stack[-1].kids.append(node)
        if tag in VOID or rest.endswith("/") and tag not in BLOCK:
            continue
        if len(stack) < DEPTH:
            stack.append(node)
        else:
            flat.append(tag)


def _holds(prelude: str) -> bool:
    """Whether the block of an at-rule holds on the screen."""
    kind, _, query = prelude[1:].partition(" ")
    kind = kind.lower().split("(")[0]
    if kind != "media":
        return kind in GROUPS
    for part in query.lower().split(","):
        part = part.strip()
        negated, part = part.startswith("not "), part.removeprefix("not ").removeprefix("only ").strip()
        medium = re.match(r"[a-z\-]+", part)
        good = medium is None or medium[0] in ("all", "screen", "and")
        for side, width in re.findall(r"\((min|max)-width\s*:\s*(\d+)px\s*\)", part):
            good = good and (int(width) <= SCREEN if side == "min" else int(width) >= SCREEN)
        if good != negated:
            return True
    return False


def _rules(sheet: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of a style sheet that hold on the screen, blocks within blocks included."""
    stack, last = [], 0  # (holds, selectors or None, where the declarations begin)
    for m in re.finditer(r"[{};]", sheet):
        if m[0] == "{":
            prelude, holds = sheet[last : m.start()].strip(), not stack or stack[-1][0]
            if prelude.startswith("@"):
                stack.append((holds and _holds(prelude), None, m.end()))
            else:
                stack.append((holds, prelude, m.end()))
        elif m[0] == "}" and stack:
            holds, selectors, begin = stack.pop()
            if holds and selectors is not None:
                yield selectors, sheet[begin : m.start()]
        elif stack and stack[-1][1] is not None:
            continue  # a semicolon between declarations
        last = m.end()


def hidden_by_styles(styles: list[str]) -> set[str]:
    """Simple selectors (tag, .class, #id) that a page's style sheets take off the display; the last rule counts, or the
    last important one."""
    found: dict[str, tuple[bool, bool]] = {}
    for sheet in styles:
        for selectors, body in _rules(re.sub(r"/\*.*?(?:\*/|\Z)", "", sheet, flags=re.S)):
            told = _DISPLAY.findall(body)
            if not told:
                continue
            value, important = next((t for t in reversed(told) if t[1]), told[-1])
            for x in (x.strip() for x in selectors.split(",")):
                if re.fullmatch(r"[.#]?[\w\-]+", x) and (important or not found.get(x, (False, False))[0]):
                    found[x] = bool(important), value.lower() == "none"
    return {x for x, (_, hidden) in found.items() if hidden}


class _Text:
    """Lines under construction: words flow, blocks break, and blank lines never double."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the line that grows
        self.pending = False
        self.gap = 0
        self.prefix: list[str] = []
        self.marker: str | None = None

    def flow(self, text: str) -> None:
        body = _SPACE.sub(" ", text)
        if not body:
            return
        if body[0] == " ":
            self.pending = True
        body = body.strip(" ")
        if body:
            if not self.parts:
                self._open()
            elif self.pending and not self.parts[-1].endswith((" ", "\n")):
                self.parts.append(" ")
            self.parts.append(body)
            self.pending = text[-1] in " \t\n\r\f"

    def keep(self, text: str) -> None:
        """Text as it stands, within a line."""
        if text:
            if not self.parts:
                self._open()
            self.parts.append(text)

    def _open(self) -> None:
        if self.gap and self.lines and self.lines[-1] != "":
            self.lines.append("")
        self.gap = 0
        indent = "".join(self.prefix)
        if self.marker is not None:
            indent = indent[: len(indent) - len(self.marker)] + self.marker
            self.marker = None
        self.parts, self.pending = [indent] if indent else [], False

    def break_line(self, forced: bool = False) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip())
        elif forced and self.lines:
            self.lines.append("")
        self.parts, self.pending = [], False

    def raw(self, line: str) -> None:
        self._open()
        self.lines.append(("".join(self.parts) + line).rstrip())
        self.parts = []

    def space(self) -> None:
        self.gap = 1

    def text(self) -> str:
        self.break_line()
        out = "\n".join(self.lines)
        return re.sub(r"\n{3,}", "\n\n", out).strip("\n")


def _shown(node: Node, hidden: set[str]) -> bool:
    a = node.attrs
    if node.tag in HIDDEN or "hidden" in a or node.tag == "dialog" and "open" not in a or node.tag == "object" and "data" in a:
        return False
    if a and re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
        return False
    return not hidden or not (node.tag in hidden or "#" + a.get("id", "") in hidden or any("." + c in hidden for c in a.get("class", "").split()))


def _visible(node: Node, now: bool) -> bool:
    if m := re.search(r"visibility\s*:\s*(\w+)", node.attrs.get("style", ""), re.I):
        return m[1].lower() == "visible"
    return now


def _control(node: Node, hidden: set[str]) -> list[str]:
    """What an input or a select shows, in lines."""
    a = node.attrs
    if node.tag == "input":
        kind = a.get("type", "text").lower()
        if kind in SILENT:
            return []
        own = {"submit": a.get("value", "Submit"), "reset": a.get("value", "Reset"), "button": a.get("value", ""), "image": a.get("alt", "")}
        return [own[kind] if kind in own else a.get("value") or a.get("placeholder", "")]
    options, todo = [], [node]
    while todo:
        for kid in reversed(todo.pop().kids):
            if isinstance(kid, Node) and _shown(kid, hidden):
                (options if kid.tag == "option" else todo).append(kid)
    options.reverse()
    told = [" ".join((o.attrs.get("label") or render(o, hidden)).split()) for o in options]
    size = a.get("size", "1")
    if "multiple" in a or size.isdigit() and int(size) > 1:
        return told
    chosen = [t for t, o in zip(told, options, strict=True) if "selected" in o.attrs] or [t for t, o in zip(told, options, strict=True) if "disabled" not in o.attrs][:1] or told[:1]
    return chosen[-1:]


def _spanned(cell: Node, name: str, most: int) -> int:
    value = cell.attrs.get(name, "1").strip()
    return min(most, int(value)) if value.isdigit() and len(value) < 10 else 1


def _cells(table: Node, hidden: set[str], visible: bool) -> tuple[list[str], list[list[tuple[list[str], int, int]]]]:
    """Captions, and the rows of a table: (lines, columns spanned, rows spanned) of each cell."""
    captions, rows = [], []
    todo = [table]
    while todo:
        node = todo.pop(0)
        loose = []
        for kid in node.kids:
            if isinstance(kid, str):
                if kid.strip():
                    loose.append(kid)
            elif not _shown(kid, hidden):
                continue
            elif kid.tag in ("thead", "tbody", "tfoot"):
                rows += _cells(kid, hidden, _visible(kid, visible))[1]
            elif kid.tag == "tr":
                row = []
                for cell in kid.kids:
                    if isinstance(cell, str):
                        if cell.strip():
                            loose.append(cell)
                    elif _shown(cell, hidden):
                        lines = render(cell, hidden, _visible(cell, _visible(kid, visible))).split("\n")
                        row.append((lines, max(1, _spanned(cell, "colspan", 1000)), _spanned(cell, "rowspan", 65534) or 65534))
                if row:
                    rows.append(row)
            else:
                captions.append(" ".join(render(kid, hidden, _visible(kid, visible)).split()))
        if loose and visible:
            captions.append(" ".join(" ".join(loose).split()))
    return [c for c in captions if c], rows


def _table(node: Node, out: _Text, hidden: set[str], visible: bool) -> None:
    captions, rows = _cells(node, hidden, visible)
    width: list[int] = []
    placed, taken = [], {}  # cells of each row as (column, lines, span); columns that cells above still reach into
    for row in rows:
        at, cells, below = 0, [], {c: n - 1 for c, n in taken.items() if n > 1}
        for lines, span, deep in row:
            while at in taken:
                cells.append((at, [""], 1))
                at += 1
            cells.append((at, lines, span))
            width += [0] * (at + 1 - len(width))
            if span == 1:
                width[at] = max(width[at], *map(len, lines))
            if deep > 1:
                below.update(dict.fromkeys(range(at, at + span), deep - 1))
            at += span
        placed.append(cells)
        taken = below
    for caption in captions:
        out.raw(caption)
    for cells in placed:
        for k in range(max((len(lines) for _, lines, _ in cells), default=0)):
            parts = []
            for at, lines, span in cells:
                room = sum(width[at : at + span]) + 3 * (min(span, max(1, len(width) - at)) - 1)
                parts.append((lines[k] if k < len(lines) else "").ljust(room))
            if any(p.strip() for p in parts):
                out.raw(" | ".join(parts))
            elif k:
                out.raw("")


def _svg(node: Node, out: _Text, hidden: set[str], visible: bool) -> None:
    """The texts of a picture, each apart from the others."""
    for kid in node.kids:
        if isinstance(kid, str) or kid.tag in SVG_HIDDEN or not _shown(kid, hidden):
            continue
        seen = _visible(kid, visible)
        if kid.tag in ("text", "foreignobject"):
            out.flow(" ")
            _walk(kid, out, hidden, seen, [], False)
            out.flow(" ")
        else:
            _svg(kid, out, hidden, seen)


def render(node: Node, hidden: set[str], visible: bool = True, out: _Text | None = None) -> str:
    """Text of a node's children."""
    own = out is None
    out = out or _Text()
    _walk(node, out, hidden, visible, [], False)
    return out.text() if own else ""


def _walk(node: Node, out: _Text, hidden: set[str], visible: bool, lists: list, pre: bool) -> None:
    closed = node.tag == "details" and "open" not in node.attrs
    for kid in node.kids:
        if isinstance(kid, str):
            if not visible or closed:
                continue
            if pre:
                for k, line in enumerate(kid.split("\n")):
                    if k:
                        out.break_line(forced=True)
                    out.keep(line)
            else:
                out.flow(kid)
            continue
        if not _shown(kid, hidden):
            continue
        tag, seen = kid.tag, _visible(kid, visible)
        if tag == "br":
            out.break_line(forced=True)
            continue
        if tag in ("input", "select", "svg"):
            if tag == "svg" and not closed:
                _svg(kid, out, hidden, seen)
            elif seen and not closed:
                shown = _control(kid, hidden)
                for k, line in enumerate(shown):
                    out.flow(f" {line} ")
                    if len(shown) > 1 and k < len(shown) - 1:
                        out.break_line()
            continue
        if closed and tag != "summary":
            continue
        block = tag in BLOCK
        if block:
            out.break_line()
            if tag in SPACED and not (tag in ("ul", "ol") and lists):
                out.space()
        if tag == "hr":
            continue
        if tag == "table":
            _table(kid, out, hidden, seen)
        elif tag in ("ul", "ol", "menu", "dir"):
            start = kid.attrs.get("start", "1")
            _walk(kid, out, hidden, seen, [*lists, [tag, int(start) - 1 if re.fullmatch(r"-?\d{1,9}", start) else 0]], pre)
        elif tag == "li":
            kind = lists[-1] if lists else ["ul", 0]
            kind[1] += 1
            marker = f"{kind[1]}. " if kind[0] == "ol" else "- "
            out.prefix.append(" " * len(marker))
            out.marker = marker
            _walk(kid, out, hidden, seen, lists, pre)
            out.break_line()
            out.prefix.pop()
            out.marker = None
        elif tag in ("dd", "blockquote"):
            out.prefix.append("  ")
            _walk(kid, out, hidden, seen, lists, pre)
            out.break_line()
            out.prefix.pop()
        else:
            if tag == "pre" and kid.kids and isinstance(kid.kids[0], str) and kid.kids[0].startswith("\n"):
                kid.kids[0] = kid.kids[0][1:]
            _walk(kid, out, hidden, seen, lists, pre or tag in ("pre", "listing", "plaintext"))
            if tag in ("mfrac", "mtd"):
                out.flow(" ")
        if block:
            out.break_line()
            if tag in SPACED and not (tag in ("ul", "ol") and lists):
                out.space()


def extract(source: str | None) -> str:
    """Visible text of one page."""
    if not source:
        return ""
    if sys.getrecursionlimit() < 12 * DEPTH:
        sys.setrecursionlimit(12 * DEPTH)
    root, styles = build(source.replace("\r\n", "\n").replace("\r", "\n").replace("\x00", ""))
    return render(root, hidden_by_styles(styles))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, "html"):
        texts = [extract(h) for h in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, text, n_chars)``: one row for each row of ``pages``."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id bigint, text string, n_chars bigint")
