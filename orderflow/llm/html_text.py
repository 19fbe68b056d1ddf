"""Operator 2: visible text of HTML pages by layout-aware rendering.

A tokenizer and a tree builder (void elements, raw text, implied start and end tags) give the
page's tree.  Visibility rules drop what a reader doesn't see: elements without a rendering, the
``hidden`` attribute, ``display:none`` and ``visibility:hidden`` from ``style`` attributes and from
simple selectors of style sheets (by importance, specificity and order; of ``@`` blocks only those
that hold on ``SCREEN``), closed details and dialogs.  The renderer collapses white space,
sets blocks on lines of their own with blank lines where their margins are, keeps preformatted
text, and marks list items by depth and number (``start``, ``value``, ``reversed``, ``type``).  Tables
are laid out on a grid: cells take the columns and rows that they span, columns are padded to one
width, and blocks, lists and tables inside a cell keep their lines there.  Of a form a reader sees the
text of text areas and the options that a closed select shows, of a drawing its ``text`` elements.

Defined cases: a null or empty page has the empty text; broken markup is read as it stands (an
unclosed tag at the end is text); any depth of nesting is walked without recursion, but for cells,
whose content below ``DEEPEST`` tables in each other is set on one line; repeated rows give equal
results; an empty table gives no rows; other columns pass through where asked for.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.words import slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text up to their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that are not rendered.
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes datalist object audio video "
                   "canvas".split())
#: Of a drawing, what is not drawn where it stands.
UNDRAWN = frozenset("defs symbol clippath mask pattern marker title desc metadata".split())
#: Tables in each other whose cells are laid out as blocks; rows that a cell can span.
DEEPEST, MOST_ROWS = 16, 65_534
#: Elements on lines of their own; those with a margin have a blank line around them.
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search "
                  "section summary table ul caption tr xmp".split())
MARGIN = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul xmp".split())
#: Elements that a head can hold; anything else but white space ends an open head.
HEAD_PARTS = frozenset("head base basefont bgsound link meta title noframes style script noscript template".split())
#: A start tag of the key ends open elements of the value, up to a border element.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_P = BLOCK - frozenset("body html li dd dt caption tr legend".split())
IMPLIED_ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tr": (frozenset({"tr", "td", "th", "caption", "colgroup"}), frozenset({"table", "tbody", "thead", "tfoot"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
} | {t: (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}), frozenset({"table"}))
     for t in ("tbody", "thead", "tfoot")}
#: End tags don't reach out of these.
BORDER = frozenset({"table", "td", "th", "caption", "template", "html"})

_TAG = re.compile(r"<!--.*?(?:--!?>|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|"
                  r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_PIECE = re.compile(r"/\*.*?(?:\*/|$)|\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*'|<!--|-->|[{};]", re.S)
_DECLARATION = re.compile(r"\s*(display|visibility)\s*:\s*([\w-]+)[^!]*?(!\s*important)?\s*$", re.I)
_SIMPLE = re.compile(r"([A-Za-z][\w-]*)?([.#][^\s.#:>+~*\[,]+)?")
_QUERY = re.compile(r"(?:(not|only)\s+)?(?!(?:not|only|and|or)\b)([a-z][\w-]*)(?:\s+and\b\s*(.*))?", re.S)
_LENGTH = re.compile(r"([+-]?(?:\d+\.?\d*|\.\d+))([a-z]*)(?:\s*/\s*(\d+\.?\d*))?")
_COMPARED = re.compile(r"(<=|>=|<|>|=)")
#: The screen that ``@media`` rules are held against: numbers in CSS pixels (or as they are), and words.
SCREEN = {"width": 1280.0, "height": 720.0, "device-width": 1280.0, "device-height": 720.0, "aspect-ratio": 16 / 9,
          "device-aspect-ratio": 16 / 9, "resolution": 1.0, "-webkit-device-pixel-ratio": 1.0, "color": 8.0,
          "monochrome": 0.0, "grid": 0.0, "orientation": "landscape", "hover": "hover", "any-hover": "hover",
          "pointer": "fine", "any-pointer": "fine", "scripting": "enabled", "update": "fast",
          "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference",
          "prefers-contrast": "no-preference", "forced-colors": "none"}
UNITS = {"": 1, "px": 1, "em": 16, "rem": 16, "pt": 4 / 3, "in": 96, "cm": 96 / 2.54, "mm": 9.6 / 2.54,
         "dppx": 1, "x": 1, "dpi": 1 / 96}
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []


class Open(list):
    """The open elements, with how many there are of each tag, so that a deep stack isn't walked in vain."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.counts = Counter({root.tag: 1})

    def push(self, node: Node) -> None:
        self.append(node)
        self.counts[node.tag] += 1

    def cut(self, at: int) -> None:
        for node in self[at:]:
            self.counts[node.tag] -= 1
        del self[at:]


class Rules(dict):
    """Selector -> property -> (rank, value) of its strongest declaration."""

    read = 0  # declarations so far


def _number(text: str) -> float | None:
    found = _LENGTH.fullmatch(text.strip())
    if not found or found[2] not in UNITS or found[3] and not float(found[3]):
        return None
    return float(found[1]) * UNITS[found[2]] / float(found[3] or 1)


def _feature(text: str) -> bool | None:
    """Whether a media feature holds on the screen; None where it isn't known."""
    name, colon, value = (x.strip() for x in text.partition(":"))
    if colon:
        least = re.sub(r"^(-webkit-)?(min|max)-", r"\1", name)
        have = SCREEN.get(least)
        if have is None or isinstance(have, str):
            return None if have is None or least != name else have == value
        want = _number(value)
        if want is None:
            return None
        return have == want if least == name else have >= want if "min-" in name else have <= want
    parts = [x.strip() for x in _COMPARED.split(text)]
    if len(parts) == 1:
        have = SCREEN.get(name)
        return None if have is None else bool(have) and have not in ("none", "no-preference")
    sides = [SCREEN[x] if isinstance(SCREEN.get(x), float) else _number(x) for x in parts[::2]]
    if None in sides:
        return None
    return all({"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b, "=": a == b}[how]
               for a, how, b in zip(sides, parts[1::2], sides[1:]))


def _condition(text: str) -> bool | None:
    """A media condition: features in parentheses joined by not, and, or."""
    known = {"yes": True, "no": False, "unknown": None}

    def joined(part: str) -> bool | None:
        names = part.split()
        turned = names[:1] == ["not"]
        values = [known[x] for x in names if x in known]
        if not values or any(x not in known and x not in ("not", "and", "or") for x in names):
            return None
        if "or" in names:
            value = True if True in values else None if None in values else False
        else:
            value = False if False in values else None if None in values else True
        return not value if turned and value is not None else value

    open_parts = [""]
    for piece in re.split(r"([()])", text):
        if piece == "(":
            open_parts.append("")
        elif piece == ")" and len(open_parts) > 1:
            part = open_parts.pop()
            value = joined(part) if re.search(r"\b(yes|no|unknown)\b(?!-)", part) and ":" not in part else _feature(part)
            open_parts[-1] += " " + {True: "yes", False: "no", None: "unknown"}[value] + " "
        else:
            open_parts[-1] += piece
    return joined(open_parts[0])


def on_screen(media: str) -> bool:
    """Whether a media query list holds on ``SCREEN``; what isn't known doesn't."""
    for query in media.lower().split(","):
        query = query.strip()
        found = _QUERY.fullmatch(query)
        if not found:
            value = _condition(query) if query else not media.strip()
        else:
            value = found[2] in ("all", "screen") and (_condition(found[3]) if found[3] else True)
            if found[1] == "not" and value is not None:
                value = not value
        if value:
            return True
    return False


def _declared(text: str) -> tuple[str, str, bool] | None:
    """Property, value and importance of a declaration of display or visibility."""
    found = _DECLARATION.match(text)
    return (found[1].lower(), found[2].lower(), bool(found[3])) if found else None


def read_sheet(css: str, rules: Rules) -> None:
    """Add a style sheet's display and visibility to ``rules``."""
    # open blocks: the selectors whose declarations they hold (None outside of rules), whether they
    # apply, whether in a layer
    blocks: list[tuple[list[str] | None, bool, bool]] = [(None, True, False)]
    said: list[str] = []

    def declaration() -> None:
        selectors, applies, layered = blocks[-1]
        found = _declared("".join(said)) if selectors and applies else None
        said.clear()
        for selector in selectors if found else ():
            name, value, important = found
            rules.read += 1
            rank = (important, layered == important, "#" in selector, "." in selector, selector[0] not in ".#", rules.read)
            held = rules.setdefault(selector, {})
            held[name] = max(held.get(name, ((), "")), (rank, value))

    at = 0
    for piece in _PIECE.finditer(css):
        said.append(css[at:piece.start()])
        at = piece.end()
        if piece[0] in (";", "}"):
            declaration()
            if piece[0] == "}" and len(blocks) > 1:
                blocks.pop()
        elif piece[0] == "{":
            selectors, applies, layered = blocks[-1]
            prelude = "".join(said).strip()
            said.clear()
            if prelude[:1] == "@":
                name, condition = re.fullmatch(r"@([\w-]*)(.*)", prelude, re.S).groups()
                name = name.lower()
                holds = {"media": lambda: on_screen(condition), "layer": lambda: True,
                         "supports": lambda: not re.match(r"\s*not\b", condition, re.I)}.get(name, lambda: False)()
                blocks.append((selectors, applies and holds, layered or name == "layer"))
            else:  # a rule inside a rule is about descendants, which isn't a simple selector
                names = [_SIMPLE.fullmatch(x.strip()) for x in prelude.split(",")] if selectors is None else []
                blocks.append(([(m[1] or "").lower() + (m[2] or "") for m in names if m and m[0]], applies, layered))
        elif piece[0][0] in "\"'":
            said.append(piece[0])
    said.append(css[at:])
    declaration()


def parse(html: str) -> tuple[Node, Rules]:
    """The page's tree and what its style sheets say of display and visibility."""
    root = Node("html")
    stack = Open(root)
    rules = Rules()
    at, size = 0, len(html)

    def text(part: str) -> None:
        if part:
            if stack[-1].tag == "head" and part.strip(" \t\n\r\f"):
                stack.cut(len(stack) - 1)
            stack[-1].children.append(unescape(part) if "&" in part else part)

    while at < size:
        match = _TAG.search(html, at)
        if not match:
            text(html[at:])
            break
        text(html[at:match.start()])
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if match[1]:
            _close(stack, tag)
            continue
        attributes = {}
        if match[3] and not match[3].isspace():
            for name, double, single, bare in _ATTRIBUTE.findall(match[3]):
                attributes.setdefault(name.lower(), unescape(double or single or bare))
        if tag in ("html", "body", "head") and stack.counts[tag]:
            continue
        _imply(stack, tag)
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|</{re.escape(tag)}$", re.I).search(html, at)
            content = html[at:end.start() if end else size]
            at = end.end() if end else size
            if (tag == "style" and not stack.counts["noscript"] and not stack.counts["template"]
                    and on_screen(attributes.get("media", ""))):
                read_sheet(content, rules)
            node.children.append(content if tag in ("script", "style", "xmp") else unescape(content))
        elif tag not in VOID and not match[3].endswith("/") or tag in BLOCK - {"hr"}:
            stack.push(node)
    return root, rules


def _close(stack: Open, tag: str) -> None:
    """An end tag closes the nearest such element, not beyond a border; a stray ``</p>`` is a paragraph."""
    if stack[-1].tag == "head" and tag in ("body", "html", "br"):
        stack.cut(len(stack) - 1)
    some = any(stack.counts[t] for t in (HEADINGS if tag in HEADINGS else (tag,)))
    for i in range(len(stack) - 1, 0, -1) if some else ():
        if stack[i].tag == tag or tag in HEADINGS and stack[i].tag in HEADINGS:
            stack.cut(i)
            return
        if stack[i].tag in BORDER and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
            break
        if stack[i].tag == "table" and tag != "table":
            break
    if tag == "p":
        stack[-1].children.append(Node("p"))
    elif tag == "br":
        stack[-1].children.append(Node("br"))


def _imply(stack: Open, tag: str) -> None:
    """End tags and table parts that a start tag implies."""
    if stack[-1].tag == "head" and tag not in HEAD_PARTS:
        stack.cut(len(stack) - 1)
    if tag in ENDS_P:
        _end(stack, frozenset({"p"}) | (HEADINGS if tag in HEADINGS else frozenset()), BORDER | {"button", "li"})
    if tag == "body":
        _end(stack, frozenset({"head"}), frozenset())
    if tag in IMPLIED_ENDS:
        closed, border = IMPLIED_ENDS[tag]
        _end(stack, closed, border)
    if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
        row = Node("tr")
        stack[-1].children.append(row)
        stack.push(row)


def _end(stack: Open, closed: frozenset, border: frozenset) -> None:
    """Close the outermost open element of ``closed`` that lies inside the nearest border element."""
    found = None
    for i in range(len(stack) - 1, 0, -1) if any(stack.counts[t] for t in closed) else ():
        if stack[i].tag in border:
            break
        if stack[i].tag in closed:
            found = i
    if found is not None:
        stack.cut(found)


def _style(node: Node, rules: Rules, name: str) -> str:
    """The value of display or visibility that an element's sheets and ``style`` give; empty if none."""
    best: tuple[tuple, str] = ((), "")
    if rules:
        names = {node.tag, *(f".{c}" for c in node.attributes.get("class", "").split()),
                 *([f"#{node.attributes['id']}"] if node.attributes.get("id") else [])}
        names |= {node.tag + n for n in names if n[:1] in (".", "#")}
        best = max((rules[n][name] for n in names if name in rules.get(n, ())), default=best)
    if "style" in node.attributes:
        own = [d for d in map(_declared, node.attributes["style"].split(";")) if d and d[0] == name]
        own = [d for d in own if d[2]] or own
        if own and (own[-1][2] or not best[0] or not best[0][0]):
            return own[-1][1]
    return best[1]


def rendered_at_all(node: Node, rules: Rules) -> bool:
    """Whether an element has a rendering (its visibility property aside)."""
    a = node.attributes
    if node.tag in UNSEEN or "hidden" in a or node.tag == "dialog" and "open" not in a:
        return False
    return node.tag != "input" and _style(node, rules, "display") != "none"


def shown(node: Node, rules: Rules, visible: bool) -> bool:
    """Whether an element's own text is visible, inside an element that is ``visible`` or not."""
    value = _style(node, rules, "visibility")
    return value == "visible" if value in ("visible", "hidden", "collapse") else visible


class Layout:
    """Lines of text under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.blank = self.gap = False  # a blank to set before the next word; a blank line before the next line
        self.prefix: list[str] = []  # per open list item: the indent of its lines
        self.marker = ""

    def words(self, text: str) -> None:
        for i, part in enumerate(_BLANKS.split(text)):
            if i:
                self.blank = True
            if part:
                if not self.line:
                    self.blank = False
                self.line += (" " if self.blank else "") + part
                self.blank = False

    def end_line(self, always: bool = False) -> None:
        if self.line or always:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            indent = "".join(self.prefix)
            if self.marker:
                indent = indent[:len(indent) - len(self.marker)] + self.marker
                self.marker = ""
            self.lines.append((indent + self.line).rstrip())
        self.line, self.blank = "", False

    def margin(self) -> None:
        self.end_line()
        self.gap = True

    def as_they_are(self, text: str) -> None:
        parts = text.split("\n")
        for part in parts[:-1]:
            self.line += part
            self.end_line(always=True)
        self.line += parts[-1]


def number_of(text: str) -> int | None:
    return int(text) if re.fullmatch(r"\s*[+-]?\d{1,9}\s*", text) else None


def list_marker(kind: str, number: int) -> str:
    """The marker of a list's item: a number, or by the list's ``type`` letters or Roman numerals."""
    text = str(number)
    if kind in ("a", "A") and number > 0:
        text, left = "", number
        while left:
            left, letter = divmod(left - 1, 26)
            text = chr(ord(kind) + letter) + text
    elif kind in ("i", "I") and 0 < number < 4000:
        text = ""
        for value, sign in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1),
                               "m cm d cd c xc l xl x ix v iv i".split(), strict=True):
            text += sign * (number // value)
            number %= value
        text = text.upper() if kind == "I" else text
    return f"{text}. "


def below(node: Node, tags: frozenset, leave: frozenset = frozenset()) -> list[Node]:
    """The outermost elements of ``tags`` under a node, in order, not looking into ``leave``."""
    found, work = [], [c for c in reversed(node.children) if isinstance(c, Node)]
    while work:
        part = work.pop()
        if part.tag in tags:
            found.append(part)
        elif part.tag not in leave:
            work += [c for c in reversed(part.children) if isinstance(c, Node)]
    return found


def seen_children(node: Node) -> list:
    """What of an element's content has a place on the page: of closed details the summary, of a closed
    select the chosen option, of a drawing its texts."""
    if node.tag == "details" and "open" not in node.attributes:
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    if node.tag == "select":
        options = below(node, frozenset({"option"}))
        rows = number_of(node.attributes.get("size", "")) or 1
        if "multiple" not in node.attributes and rows < 2:
            chosen = [o for o in options if "selected" in o.attributes][-1:]
            options = chosen or [o for o in options if "disabled" not in o.attributes][:1]
        return [part for option in options for part in (" ", option)] + [" "]
    if node.tag == "svg":
        return [part for text in below(node, frozenset({"text"}), UNDRAWN) for part in (" ", text)] + [" "]
    return node.children


def render(root: Node, rules: Rules, visible: bool = True, level: int = 0) -> str:
    """The visible text of a tree, which lies in ``level`` tables."""
    out = Layout()
    # work items: (node or text, visible, preformatted, list depth), or a function to call at an element's end
    work: list = [(root, visible, False, 0)]
    while work:
        item = work.pop()
        if callable(item):
            item()
            continue
        node, visible, kept, depth = item
        if isinstance(node, str):
            if visible:
                out.as_they_are(node) if kept else out.words(node)
            continue
        if not rendered_at_all(node, rules):
            continue
        visible = shown(node, rules, visible)
        tag = node.tag
        if tag == "br":
            out.end_line(always=True)
            continue
        if tag == "hr":
            out.margin()
            continue
        if tag == "table":
            out.margin()
            for line in table_lines(node, visible, rules, level):
                out.line = line
                out.end_line(always=True)
            out.margin()
            continue
        children = seen_children(node)
        if tag in ("ul", "ol", "menu", "dir"):
            out.end_line() if depth else out.margin()
            listed = [c for c in children if isinstance(c, Node) and c.tag == "li" and rendered_at_all(c, rules)]
            back = tag == "ol" and "reversed" in node.attributes
            number = number_of(node.attributes.get("start", ""))
            number = number if number is not None else len(listed) if back else 1
            work.append(out.end_line if depth else out.margin)
            items = []
            for child in children:
                if isinstance(child, Node) and child.tag == "li":
                    if rendered_at_all(child, rules):
                        own = number_of(child.attributes.get("value", ""))
                        number = own if own is not None and tag == "ol" else number
                        kind = child.attributes.get("type", node.attributes.get("type", ""))
                        items.append((child, list_marker(kind, number) if tag == "ol" else "- "))
                        number += -1 if back else 1
                else:
                    items.append((child, None))
            for child, marker in reversed(items):
                if marker is None:
                    work.append((child, visible, kept, depth + 1))
                else:
                    work.append(_item_end(out))
                    seen = shown(child, rules, visible)
                    work += [(c, seen, kept, depth + 1) for c in reversed(child.children)]
                    work.append(_item_start(out, marker, seen))
            continue
        if tag in BLOCK:
            margin = tag in MARGIN and not (tag == "p" and out.marker)
            (out.margin if margin else out.end_line)()
            work.append(out.margin if margin else out.end_line)
            if tag == "dd":
                out.prefix.append("  ")
                work[-1] = _indent_end(out)
        kept = kept or tag in ("pre", "xmp")
        if tag in ("td", "th"):  # a cell outside any table
            work.append((" ", visible, False, depth))
        work += [(c, visible, kept, depth) for c in reversed(children)]
    out.end_line()
    return "\n".join(out.lines).strip("\n")


def _item_start(out: Layout, marker: str, seen: bool):
    def run() -> None:
        out.end_line()
        out.prefix.append(" " * len(marker))
        out.marker = marker if seen else ""
    return run


def _item_end(out: Layout):
    def run() -> None:
        out.end_line()
        out.prefix.pop()
        out.marker = ""
    return run


def _indent_end(out: Layout):
    def run() -> None:
        out.end_line()
        out.prefix.pop()
    return run


def has_lines(cell: Node) -> bool:
    """Whether a cell holds something that makes lines of its own."""
    work = [cell]
    while work:
        node = work.pop()
        for child in node.children:
            if isinstance(child, Node):
                if child.tag in BLOCK or child.tag == "br":
                    return True
                work.append(child)
    return False


def cell_lines(cell: Node, visible: bool, rules: Rules, level: int) -> list[str]:
    holder = Node("")
    holder.children = cell.children
    if level < DEEPEST and has_lines(holder):
        return render(holder, rules, visible, level + 1).split("\n")
    return [flat(holder, visible, rules)]


def spanned(cell: Node, name: str, most: int) -> int:
    """How many columns or rows a cell takes; 0 rows are all that follow."""
    n = number_of(cell.attributes.get(name, ""))
    if n == 0 and name == "rowspan":
        return most
    return min(n, most) if n and n > 0 else 1


def grid_lines(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of cells (lines, columns, rows) as text: cells beside, below and across each other."""
    placed: list[list[tuple[int, int, int, list[str]]]] = []  # by row: (column, columns, rows, lines)
    taken: dict[int, int] = {}  # column -> rows that a cell above still takes of it
    for cells in rows:
        here, column = [], 0
        for lines, columns, down in cells:
            while taken.get(column):
                column += 1
            here.append((column, columns, min(down, len(rows) - len(placed)), lines))
            for c in range(column, column + columns):
                taken[c] = max(taken.get(c, 0), down)
            column += columns
        placed.append(here)
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
    widths: dict[int, int] = {}
    heights = [0] * len(rows)
    for r, here in enumerate(placed):
        for column, columns, down, lines in here:
            if columns == 1:
                widths[column] = max(widths.get(column, 0), *map(len, lines))
            if down == 1 and any(lines):
                heights[r] = max(heights[r], len(lines))
    for r, here in enumerate(placed):  # what doesn't fit into the rows that a cell spans makes the last one higher
        for _, _, down, lines in here:
            if down > 1 and any(lines):
                heights[r + down - 1] += max(0, len(lines) - sum(heights[r:r + down]))
    edges = [0]
    for c in range(max((c + n for here in placed for c, n, _, _ in here), default=0)):
        edges.append(edges[-1] + widths.get(c, 0) + 2)
    out: list[str] = []
    open_cells: list[tuple[int, int, int, list[str]]] = []  # (column, columns, last row, lines left)
    for r, here in enumerate(placed):
        open_cells = sorted([c for c in open_cells if c[2] >= r] + [(c, n, r + down - 1, lines) for c, n, down, lines in here],
                            key=lambda c: c[0])
        for k in range(heights[r]):
            line = ""
            for column, columns, _, lines in open_cells:
                line = line.ljust(edges[column]) + (lines[k] if k < len(lines) else "")
                edge = edges[column + columns]
                line = line.ljust(edge) if len(line) < edge else line + "  "
            out.append(line.rstrip())
        open_cells = [(c, n, last, lines[heights[r]:]) for c, n, last, lines in open_cells]
    return out


def table_lines(table: Node, visible: bool, rules: Rules, level: int = 0) -> list[str]:
    """A table's caption and rows, the cells of a column padded to one width."""
    caption, rows = [], []
    work = [(c, visible) for c in reversed(table.children)]
    while work:
        node, visible = work.pop()
        if isinstance(node, str):
            if visible and node.strip():
                caption.append(" ".join(node.split()))
            continue
        if not rendered_at_all(node, rules):
            continue
        seen = shown(node, rules, visible)
        if node.tag == "tr":
            cells = []
            for cell in node.children:
                if isinstance(cell, Node) and rendered_at_all(cell, rules):
                    cells.append((cell_lines(cell, shown(cell, rules, seen), rules, level),
                                  spanned(cell, "colspan", 999), spanned(cell, "rowspan", MOST_ROWS)))
                elif isinstance(cell, str) and seen and cell.strip():
                    caption.append(" ".join(cell.split()))
            if cells:
                rows.append(cells)
        elif node.tag in ("tbody", "thead", "tfoot"):
            work += [(c, seen) for c in reversed(node.children)]
        elif node.tag not in ("colgroup", "col"):
            part = flat(node, visible, rules)
            if part:
                caption.append(part)
    return caption + grid_lines(rows)


def flat(node: Node, visible: bool, rules: Rules) -> str:
    """The visible text of an element on one line (tables inside it included, cell by cell)."""
    parts: list[str] = []
    work: list = [(node, visible)]
    while work:
        item, seen = work.pop()
        if isinstance(item, str):
            if seen:
                parts.append(item)
            continue
        if not rendered_at_all(item, rules):
            continue
        seen = shown(item, rules, seen)
        apart = item.tag in BLOCK or item.tag in ("br", "td", "th", "tr")
        if apart:
            parts.append(" ")
            work.append((" ", True))
        work += [(c, seen) for c in reversed(seen_children(item))]
    return _BLANKS.sub(" ", "".join(parts)).strip()


def page_text(html: str | None) -> str:
    """The visible text of one page."""
    return render(*parse(html)) if html else ""


def texts(keep: list[str], column: str):
    """``mapInArrow`` function: the columns ``keep`` and the visible text of ``column``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            found = [page_text(x) for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found, pa.string())],
                                             names=[*keep, "visible_text"])
    return run


def extracted(pages: DataFrame, keep: list[str], column: str = "html") -> DataFrame:
    """The columns ``keep`` of every page and ``visible_text``."""
    fields = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in keep), "visible_text string"])
    return pages.select(*dict.fromkeys([*keep, column])).mapInArrow(texts(keep, column), schema)


def op2(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page row."""
    return extracted(pages, ["page_id", "url"]).select(
        "page_id", "url", F.col("visible_text").alias("text"), F.length("visible_text").cast("long").alias("n_chars"))
