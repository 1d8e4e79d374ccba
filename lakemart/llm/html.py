"""Visible text of HTML pages, laid out as a reader sees it.

Three steps, free of recursion and linear in the page (indentation beyond 80
columns and tables nested more than 50 deep are not laid out, their text is kept):

1. A scanner cuts the page into tags, comments and text; the content of
   script-like elements is skipped as a whole.
2. A tree builder opens and closes elements with the implied tags of HTML
   (``</p>`` before a block, ``</li>`` before the next item, cells and rows,
   the head's end) and decides visibility: elements that never show, the
   ``hidden`` attribute, inline ``display`` and ``visibility``, and simple
   selectors (tag, class, id) of the page's own style sheets, wherever they
   stand; rules for media other than a wide screen do not hold.
3. A renderer writes block after block: paragraphs and headings stand between
   blank lines, other blocks on lines of their own, list items carry markers
   and indentation, ``pre`` keeps its spaces, and table cells are padded so
   that columns line up.

Defined results: a null or empty page gives an empty text; unclosed or stray
tags never fail; repeated rows are rendered alike; empty tables give no rows;
other columns pass through unchanged.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import short_batches

WIDEST = 60                     # cells wider than this do not widen their column

# --- fixed values: element classes of HTML ------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset("""head title style script template noscript noembed noframes iframe object audio video canvas svg math
datalist link meta base param source track map area dialog""".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset form article section menu".split())
BLOCK = SPACED | frozenset("""html body div header footer main nav aside address hgroup li dt dd details summary legend
figcaption caption tr thead tbody tfoot center hr option optgroup select""".split())
CLOSES_P = frozenset("""address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2
h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul""".split())
CELLS = frozenset(("td", "th"))
TABLE_PARTS = frozenset("tr thead tbody tfoot caption colgroup td th".split())
HEAD_PARTS = frozenset("head title style script meta link base template noscript".split())
# ------------------------------------------------------------------------------------
# start tag -> open elements it closes, and the elements beyond which it does not look
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": (CELLS, {"tr", "table"}), "th": (CELLS, {"tr", "table"}), "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
} | {t: ({"thead", "tbody", "tfoot", "tr", "caption", "colgroup"}, {"table"}) for t in ("thead", "tbody", "tfoot")}
_P_SCOPE = CELLS | {"table", "caption", "button", "html", "object"}
_END_SCOPE = CELLS | {"caption"}

_START = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
_ENDS = re.compile(r"""[>"']""")
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_SIMPLE = re.compile(r"^([a-z][a-z0-9]*|)((?:[.#][\w-]+)*)$")
_SPACE = re.compile(r"[ \t\n\r\f]+")
SCREEN_PX = 1280                # width of the screen that media conditions are tested for
INDENT = 80                     # columns of indentation, at most
NESTED = 50                     # tables within tables whose cells are aligned; deeper ones are plain blocks


def declared(css: str) -> dict[str, str]:
    """The display and visibility declarations of a style."""
    out = {}
    for part in css.lower().split(";"):
        k, _, v = part.partition(":")
        if k.strip() in ("display", "visibility"):
            out[k.strip()] = v.replace("!important", "").strip()
    return out


def on_screen(media: str) -> bool:
    """Does a list of media queries hold on a wide screen?  A query with a
    condition that is not about the width does not: text is shown rather than
    hidden by mistake."""
    def holds(query: str) -> bool:
        kind, *conditions = re.split(r"\band\b", query)
        kind = kind.replace("only", "").strip()
        if kind.startswith("("):
            conditions.insert(0, kind)
        elif kind not in ("", "all", "screen"):
            return kind.startswith("not") and kind[3:].strip() not in ("all", "screen") and not conditions
        for c in conditions:
            m = re.fullmatch(r"\s*\(\s*(min|max)-width\s*:\s*([0-9.]{1,9})\s*(px|r?em)\s*\)\s*", c)
            if not m or not re.fullmatch(r"[0-9]*\.?[0-9]+|[0-9]+\.", m[2]):
                return False
            width = float(m[2]) * (1 if m[3] == "px" else 16)
            if (width > SCREEN_PX) if m[1] == "min" else (width < SCREEN_PX):
                return False
        return True

    return any(holds(q) for q in media.lower().split(","))


def css_rules(css: str):
    """(selectors, body) of the rules of a style sheet that hold on a screen,
    in one pass."""
    parts, pos = [], 0
    while (at := css.find("/*", pos)) >= 0:
        parts.append(css[pos:at])
        pos = css.find("*/", at + 2)
        if pos < 0:
            pos = len(css)
            break
        pos += 2
    css = "".join([*parts, css[pos:]])
    start, open_blocks = 0, []                          # (selectors or None for an at-rule, holds)
    for m in re.finditer(r"[{};]", css):
        holds = not open_blocks or open_blocks[-1][1]
        in_rule = bool(open_blocks) and open_blocks[-1][0] is not None
        if m[0] == "{":
            prelude = css[start:m.start()].strip()
            name, _, rest = prelude.partition(" ") if prelude.startswith("@") else ("", "", "")
            if not name:
                open_blocks.append((prelude, holds and not in_rule))
            elif name.lower().startswith("@media"):
                open_blocks.append((None, holds and on_screen(prelude[6:])))
            else:
                open_blocks.append((None, holds and name.lower() in ("@supports", "@layer")))
        elif m[0] == "}" and open_blocks:
            selectors, holds = open_blocks.pop()
            if selectors is not None and holds:
                yield selectors, css[start:m.start()]
        elif m[0] == ";" and in_rule:
            continue
        start = m.end()


class Styles:
    """Rules of a page's style sheets that hide elements, for selectors of a
    tag, classes and an id; found by one of their parts."""

    def __init__(self):
        self.rules, self.count = {}, 0

    def add(self, css: str, media: str = "") -> None:
        if "display" not in css and "visibility" not in css or not on_screen(media):
            return
        for selectors, body in css_rules(css):
            style = declared(body)
            for s in selectors.lower().split(",") if style else ():
                if (m := _SIMPLE.match(s.strip())) and (m[1] or m[2]):
                    parts = frozenset(re.findall(r"[.#][\w-]+", m[2]))
                    self.count += 1
                    self.rules.setdefault(min(parts, default=m[1]), {}).setdefault((m[1], parts), []).append((self.count, style))

    def of(self, tag: str, attrs: dict) -> dict:
        out = {}
        if self.rules:
            own = {"." + c for c in attrs.get("class", "").lower().split()} | {"#" + attrs.get("id", "").lower()}
            found = [x for key in (own | {tag}) & self.rules.keys() for (t, parts), styles in self.rules[key].items()
                     if t in ("", tag) and parts <= own for x in styles]
            for _, style in sorted(found, key=lambda x: x[0]):
                out |= style
        return out


def attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    out = {}
    for name, a, b, c in _ATTR.findall(text):
        out.setdefault(name.lower(), entities.unescape(a or b or c))
    return out


# ------------------------------------------------------------- tokens

def tokens(page: str):
    """Yields ('text', string), ('end', tag), ('start', tag, attributes) and
    ('raw', tag, attributes, content), in one pass over the page."""
    n, pos, begin = len(page), 0, 0
    last = {c: page.rfind(c) for c in ">\"'"}
    dead: set[int] = set()                              # places outside quotes from which no tag ends
    lower = None

    def tag_end(at: int) -> int:
        """After the ``>`` that ends a tag: outside quotes, or else the next."""
        seen, p = [], at
        while p not in dead and (m := _ENDS.search(page, p)):
            if m[0] == ">":
                return m.end()
            close = page.find(m[0], m.end()) if m.start() < last[m[0]] else -1
            if close < 0:
                break
            p = close + 1
            seen.append(p)
        dead.update(seen)
        return page.find(">", at) + 1

    while m := _START.search(page, pos):
        at, closing, tag = m.start(), m[2], (m[3] or "").lower()
        if m[1]:                                        # a comment
            end = re.compile(r"--!?>").search(page, m.end()) if m.end() <= last[">"] else None
            end = end.end() if end else n
        elif m.end() > last[">"]:                       # nothing ends here any more
            break
        else:
            end = tag_end(m.end()) if tag else page.find(">", m.end()) + 1
        if at > begin:
            yield ("text", page[begin:at])
        pos = begin = end
        if not tag:
            continue
        if closing:
            yield ("end", tag)
            continue
        attrs = attributes(page[m.end():end - 1])
        if tag not in RAW:
            yield ("start", tag, attrs)
            continue
        if lower is None:
            lower = page.lower()
            if len(lower) != n:                         # a few letters change length
                lower = re.sub(r"[A-Z]", lambda x: x[0].lower(), page)
            gone: set[str] = set()                      # raw elements that no end tag follows
        stop = -1 if tag in gone else lower.find(f"</{tag}", pos)
        if stop < 0:
            gone.add(tag)
        stop = n if stop < 0 else stop
        yield ("raw", tag, attrs, page[pos:stop])
        after = page.find(">", stop)
        pos = begin = n if after < 0 else after + 1
    if begin < n:
        yield ("text", page[begin:])


# ------------------------------------------------------------- tree builder

class _Open:
    """The open elements, and the places of each name among them."""

    def __init__(self):
        self.all, self.places, self.blocks = [], {}, []

    def push(self, name: str, hidden: bool, invisible: bool) -> None:
        at = len(self.all)
        self.all.append((name, hidden, invisible))
        self.places.setdefault(name, []).append(at)
        if name in BLOCK:
            self.blocks.append(at)

    def pop(self):
        name, hidden, _ = self.all.pop()
        self.places[name].pop()
        if name in BLOCK:
            self.blocks.pop()
        return [] if hidden else [("close", name)]

    def pop_to(self, i: int):
        out = []
        while len(self.all) > i:
            out += self.pop()
        return out

    def top(self, names) -> int:
        """Place of the innermost open element of ``names``, -1 without any."""
        return max((self.places[x][-1] for x in names if self.places.get(x)), default=-1)

    def close(self, targets, beyond):
        """Close the outermost of ``targets`` inside the nearest ``beyond``."""
        limit, found = self.top(beyond), len(self.all)
        for x in targets:
            own = self.places.get(x, ())
            i = bisect_left(own, limit)
            if i < len(own):
                found = min(found, own[i])
        return self.pop_to(found)


def events(page: str):
    """Yields ('open', tag, attrs), ('close', tag) and ('text', string) of the
    page's tree, every open with its close, hidden subtrees left out.  All style
    sheets of the page hold for the whole page."""
    styles, stack = Styles(), _Open()
    if re.search(r"<style\b", page, re.I):
        for t in tokens(page):
            if t[0] == "raw" and t[1] == "style":
                styles.add(t[3], t[2].get("media", ""))

    def here():
        return stack.all[-1] if stack.all else ("", False, False)

    def shown():
        return not (here()[1] or here()[2])

    def push(tag, attrs):
        style = styles.of(tag, attrs) | (declared(attrs["style"]) if "style" in attrs else {})
        up = here()
        hidden = (up[1] or tag in NEVER and not (tag == "dialog" and "open" in attrs) or "hidden" in attrs
                  or style.get("display") == "none")
        if up[0] == "details*" and tag != "summary":
            hidden = True
        invisible = style["visibility"] in ("hidden", "collapse") if "visibility" in style else up[2]
        name = "details*" if tag == "details" and "open" not in attrs else tag
        stack.push(name, hidden, invisible)
        return [] if hidden else [("open", name, attrs)]

    for token in tokens(page):
        kind, tag = token[0], token[1]
        if kind == "text":
            if here()[0] == "head" and not tag.isspace():
                yield from stack.pop_to(stack.places["head"][0])
            if shown() and here()[0] != "details*":
                yield ("text", entities.unescape(tag))
            continue
        if kind == "end":
            if tag == "p" and not stack.places.get("p"):
                if shown():
                    yield ("open", "p", {})
                    yield ("close", "p")
            elif tag == "br":
                if shown():
                    yield ("br",)
            elif tag not in ("html", "body"):
                i = stack.top((tag, "details*") if tag == "details" else (tag,))
                fence = stack.top(() if tag in TABLE_PARTS or tag == "table" else _END_SCOPE)
                if tag != "table":
                    fence = max(fence, stack.top(("table",)))
                # misnested formatting: the block stays open
                if i > fence and (tag in BLOCK or not stack.blocks or stack.blocks[-1] <= i) or i == fence >= 0:
                    yield from stack.pop_to(i)
            continue
        attrs = token[2]
        if tag in ("html", "body") and stack.places.get(tag):
            continue
        if here()[0] == "head" and tag not in HEAD_PARTS:
            yield from stack.pop()
        if tag in CLOSES_P:
            yield from stack.close({"p"}, _P_SCOPE)
        if tag[0] == "h" and tag[1:].isdigit() and here()[0][:1] == "h" and here()[0][1:].isdigit():
            yield from stack.pop()
        if tag in IMPLIED:
            yield from stack.close(*IMPLIED[tag])
        if tag in CELLS and here()[0] in ("table", "thead", "tbody", "tfoot"):
            yield from push("tr", {})
        if kind == "raw":
            if tag in ("textarea", "xmp"):
                yield from push(tag, attrs)
                if shown():
                    yield ("text", entities.unescape(token[3]) if tag == "textarea" else token[3])
                yield from stack.pop()
        elif tag in VOID:
            if shown() and "hidden" not in attrs:
                if tag in ("br", "hr"):
                    yield (tag,)
                elif tag == "input" and attrs.get("type", "").lower() in ("submit", "button", "reset"):
                    yield ("text", attrs.get("value", ""))
        else:
            yield from push(tag, attrs)
    yield from stack.pop_to(0)


# ------------------------------------------------------------- renderer

class Flow:
    """Lines of a block container."""

    def __init__(self):
        self.lines, self.line, self.gap, self.space = [], [], 0, False
        self.indent, self.marker = 0, ""

    def text(self, s: str, pre: bool) -> None:
        if pre:
            first, *rest = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._put(first)
            for x in rest:
                self.end(keep=True)
                self._put(x)
            return
        s = _SPACE.sub(" ", s)
        if s[:1] == " ":
            self.space, s = bool(self.line), s[1:]
        if s:
            if self.space:
                self.line.append(" ")
            self.space = s[-1] == " "
            self.line.append(s.rstrip(" ") if self.space else s)

    def _put(self, s: str) -> None:
        if s:
            self.line.append(s)

    def end(self, keep: bool = False) -> None:
        """Finish the current line; ``keep``: also an empty one."""
        if self.line or keep:
            if self.lines and self.gap:
                self.lines.append("")
            self.gap = 0
            s = "".join(self.line)
            indent = min(self.indent, INDENT)
            if self.marker:
                at = max(0, indent - len(self.marker))
                s, self.marker = " " * at + self.marker + s, ""
            elif s:
                s = " " * indent + s
            self.lines.append(s.rstrip())
            self.line = []
        self.space = False

    def blank(self) -> None:
        self.end()
        self.gap = 1

    def add(self, lines: list[str]) -> None:
        self.end()
        for x in lines:
            self.line = [x] if x else []
            self.end(keep=True)


def span(attrs: dict, name: str) -> int:
    v = attrs.get(name, "1")
    return min(max(int(v), 1), 100) if v.isdigit() and len(v) < 5 else 1


class Table:
    """Cells of a table by row, with their columns."""

    def __init__(self):
        self.rows, self.taken, self.caption = [], {}, []

    def row(self) -> None:
        self.rows.append([])
        self.taken = {c: k - 1 for c, k in self.taken.items() if k > 1}
        self.at = 0

    def cell(self, lines: list[str], attrs: dict) -> None:
        if not self.rows:
            self.row()
        while self.at in self.taken:
            self.at += 1
        wide, high = span(attrs, "colspan"), span(attrs, "rowspan")
        self.rows[-1].append((self.at, wide, lines))
        for c in range(self.at, self.at + wide):
            if high > 1:
                self.taken[c] = high
        self.at += wide

    def lines(self) -> list[str]:
        width: dict[int, int] = {}
        for row in self.rows:
            for at, wide, lines in row:
                if wide == 1:
                    fit = [len(x) for x in lines if len(x) <= WIDEST]
                    width[at] = max(width.get(at, 0), max(fit, default=0))
                else:
                    for c in range(at, at + wide):
                        width.setdefault(c, 0)
        starts, left = {}, 0
        for c in sorted(width):
            starts[c] = left
            left += width[c] + 2 if width[c] else 0
        out = list(self.caption)
        for row in self.rows:
            for i in range(max((len(x[2]) for x in row), default=0)):
                line = ""
                for at, _, lines in row:
                    if i < len(lines) and lines[i]:
                        gap = starts.get(at, 0) - len(line)
                        line += " " * max(gap, 2 if line else 0) + lines[i]
                out.append(line.rstrip())
        return out


def render(page: str | None) -> str:
    """Visible text of a page."""
    flows, lists, tables, cells = [Flow()], [], [], []
    pre = 0
    for e in events(page or ""):
        kind, flow = e[0], flows[-1]
        if kind == "text":
            flow.text(e[1], pre > 0)
        elif kind == "br":
            flow.end(keep=True)
        elif kind == "hr":
            flow.blank()
        elif kind == "open":
            tag, attrs = e[1], e[2]
            if tag not in BLOCK and tag not in CELLS and tag != "details*":
                continue
            nested = tag in ("ul", "ol", "menu") and bool(lists)
            (flow.blank if tag in SPACED and not nested and not flow.marker else flow.end)()
            if tag in ("ul", "ol", "menu"):
                start = attrs.get("start", "1")
                lists.append([tag, int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
            elif tag == "li":
                mark = "- "
                if lists and lists[-1][0] == "ol":
                    value = attrs.get("value", "")
                    lists[-1][1] = int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else lists[-1][1]
                    mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                flow.indent += len(mark)
                cells.append(("li", len(mark)))
                flow.marker = mark
            elif tag in ("blockquote", "dd"):
                flow.indent += 2
            elif tag == "pre":
                pre += 1
            elif tag == "table":
                tables.append(Table() if len(tables) < NESTED else None)
            elif tag == "tr" and tables and tables[-1]:
                tables[-1].row()
            elif (tag in CELLS or tag == "caption") and tables and tables[-1]:
                flows.append(Flow())
                cells.append((tag, attrs, pre))
                pre = 0
        else:
            tag = e[1]
            if tag not in BLOCK and tag not in CELLS and tag != "details*":
                continue
            flow.end()
            if tag in ("ul", "ol", "menu"):
                if lists:
                    lists.pop()
                if not lists:
                    flow.blank()
            elif tag == "li":
                if cells and cells[-1][0] == "li":
                    flow.indent = max(0, flow.indent - cells.pop()[1])
                if flow.marker:                                       # an item without text
                    flow.marker = ""
            elif tag in ("blockquote", "dd"):
                flow.indent = max(0, flow.indent - 2)
            elif tag == "pre":
                pre = max(0, pre - 1)
            elif tag == "table" and tables:
                done = tables.pop()
                flow.add(done.lines() if done else [])
            elif (tag in CELLS or tag == "caption") and tables and tables[-1] and len(flows) > 1:
                done = flows.pop()
                name, attrs, pre = cells.pop()
                if name == "caption":
                    tables[-1].caption += done.lines
                else:
                    tables[-1].cell(done.lines, attrs)
            if tag in SPACED and not (tag in ("ul", "ol", "menu") and lists):
                flows[-1].blank()
    flows[0].end()
    lines = flows[0].lines
    while lines and not lines[-1]:
        lines.pop()
    while lines and not lines[0]:
        lines.pop(0)
    return "\n".join(lines)


def visible_text(html: str) -> Column:
    """Visible text of an HTML column."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([render(p) for p in pages.to_pylist()], pa.string())

    return run(F.col(html))


def extract(df: DataFrame, html: str, out: str = "text") -> DataFrame:
    """Add the visible text of column ``html`` as ``out``."""
    short_batches(df.sparkSession)
    return df.withColumn(out, visible_text(html))
