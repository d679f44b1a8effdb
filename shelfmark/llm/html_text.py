"""Visible text of HTML pages, laid out: blocks, lists and tables as a reader would see them."""

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Elements by what they do, after the public HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript title datalist audio video canvas object iframe noframes "
                   "noembed rp map".split())
#: Blocks with a blank line around them, and blocks with a line of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre listing ul ol menu dl table hr figure fieldset".split())
LINED = frozenset("address article aside body center details dialog dd div dt figcaption footer form header hgroup "
                  "html legend li main nav option optgroup search section summary caption tr td th".split())
#: For a start tag: open elements that it ends, and those beyond which it ends none.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    **{part: ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}) for part in ("thead", "tbody", "tfoot")},
}
ENDS_P = (SPACED | LINED) - {"body", "html", "option", "optgroup", "td", "th", "tr", "caption", "legend"}
P_SCOPE = {"td", "th", "caption", "table", "button", "object"}
TABLE_PARTS = frozenset("td th tr thead tbody tfoot caption colgroup table".split())

#: A cell wider than this does not widen its column.
WIDEST = 60
SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """Builds the tree of a page, closing what later tags imply is closed and opening rows left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.counts = Counter()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("html", "body"):
            return
        if tag in ENDS_P:
            self.end({"p"}, P_SCOPE)
        if tag in ENDS:
            self.end(*ENDS[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.push("tr", {})
        if re.fullmatch("h[1-6]", tag) and re.fullmatch("h[1-6]", self.open[-1].tag):
            self.pop()
        if tag not in HIDDEN and tag not in ("meta", "link", "base") and self.counts["head"]:
            self.end({"head"}, set())       # anything else begins the body
        self.push(tag, {name: value or "" for name, value in attrs})
        if tag in VOID:
            self.pop()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)    # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag not in ("html", "body"):
            self.end({tag}, set() if tag in TABLE_PARTS else {"td", "th", "caption", "table"} - {tag})

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self.end({"head"}, set())
        self.open[-1].children.append(data)

    def parse_html_declaration(self, i: int) -> int:
        """A marked section, known or not, is a comment up to the next >."""
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def push(self, tag: str, attrs: dict) -> None:
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        self.open.append(node)
        self.counts[tag] += 1

    def pop(self) -> None:
        self.counts[self.open.pop().tag] -= 1

    def end(self, tags: set[str], beyond: set[str]) -> None:
        """Close the innermost open element of ``tags``, and all within it, unless one of ``beyond`` is met first."""
        if not any(self.counts[t] for t in tags):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in tags:
                while len(self.open) > depth:
                    self.pop()
                return
            if self.open[depth].tag in beyond:
                return


# ------------------------------------------------------------------------------- styles

_SIMPLE = re.compile(r"([a-z][a-z0-9]*)?([.#][\w-]+)?\Z", re.I)
#: Comments and the marks that hide a style from old browsers; strings, and what ends or opens a part of a style.
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
_MARK = re.compile(r""""(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'|[{};]""", re.S)
#: Properties that take an element off the page, with the values that do.
TAKES_OFF = {"display": {"none"}, "visibility": {"hidden", "collapse"}, "content-visibility": {"hidden"}}
#: The screen that pages are laid out for, in CSS pixels, and what else it is.
SCREEN = {"width": 1920.0, "height": 1080.0}
FEATURES = {"orientation": "landscape", "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference",
            "prefers-contrast": "no-preference", "hover": "hover", "any-hover": "hover", "pointer": "fine",
            "any-pointer": "fine", "scripting": "enabled", "update": "fast", "display-mode": "browser",
            "forced-colors": "none"}
UNITS = {"": 1, "px": 1, "em": 16, "rem": 16, "pt": 4 / 3, "in": 96, "cm": 96 / 2.54, "mm": 96 / 25.4}
_LENGTH = r"([0-9]*\.?[0-9]+)(px|r?em|pt|in|cm|mm|)"
_BOUND = re.compile(rf"(min|max)-(?:device-)?(width|height)\s*:\s*{_LENGTH}\Z")
_BOUNDS = re.compile(rf"(?:{_LENGTH}\s*([<>]=?)\s*)?(width|height)(?:\s*([<>]=?|=)\s*{_LENGTH})?\Z")
COMPARE = {"<": float.__lt__, "<=": float.__le__, ">": float.__gt__, ">=": float.__ge__, "=": float.__eq__}

#: For each selector and property the rule that wins: (important, specificity, order, value).
Rules = dict[str, dict[str, tuple[bool, int, int, str]]]


def media_holds(media: str) -> bool:
    """Whether a list of media queries holds on ``SCREEN``; one of unknown features does not."""
    return not media.strip() or any(_query_holds(query.strip()) for query in media.lower().split(","))


def _query_holds(query: str) -> bool:
    start = re.match(r"(not|only)\s+", query)
    query = query[start.end():] if start else query
    holds = False
    for one in re.split(r"\s+or\s+", query):
        parts = [_part_holds(part.strip()) for part in re.split(r"\s+and\b", one)]
        if False not in parts:
            holds = None if None in parts else True
        if holds:
            break
    return holds is False if start and start[1] == "not" else holds is True


def _part_holds(part: str) -> bool | None:
    """A media type, or a feature in brackets; None if it is not known."""
    if not part.startswith("("):
        return part in ("all", "screen")
    part = part[1:-1].strip()
    if bound := _BOUND.match(part):
        of, length = SCREEN[bound[2]], float(bound[3]) * UNITS[bound[4]]
        return of >= length if bound[1] == "min" else of <= length
    if bounds := _BOUNDS.match(part):
        low, low_unit, low_sign, name, sign, high, unit = bounds.groups()
        return ((low is None or COMPARE[low_sign](float(low) * UNITS[low_unit], SCREEN[name]))
                and (high is None or COMPARE[sign](SCREEN[name], float(high) * UNITS[unit])))
    name, _, value = (piece.strip() for piece in part.partition(":"))
    if name not in FEATURES:
        return None
    return FEATURES[name] == value if value else FEATURES[name] not in ("none", "no-preference")


def _group_holds(prelude: str) -> bool:
    """Whether the rules within an at-rule are rules of the page."""
    name = re.match(r"@([\w-]*)", prelude)[1].lower()
    inner = prelude[len(name) + 1:].strip()
    if name == "media":
        return media_holds(inner)
    return name == "layer" or name == "supports" and not re.match(r"not\b", inner, re.I)


def _blocks(css: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the rules that hold, whatever blocks they are nested in."""
    css = _COMMENT.sub(" ", css)
    open_blocks: list[tuple[str | None, bool, list[str]]] = []      # selectors, whether it holds, declarations
    start = 0
    for mark in [*_MARK.finditer(css), None]:
        sign, end, after = (mark[0], mark.start(), mark.end()) if mark else ("}", len(css), len(css))
        if sign[0] in "\"'":
            continue
        if sign == "{":
            prelude = css[start:end].strip()
            outer, holds, _ = open_blocks[-1] if open_blocks else (None, True, None)
            if prelude.startswith("@"):
                open_blocks.append((outer, holds and _group_holds(prelude), []))
            else:       # a rule within a rule is for descendants: no plain selector
                nested = any(selectors is not None for selectors, _, _ in open_blocks)
                open_blocks.append(("" if nested else prelude, holds, []))
        elif open_blocks:
            open_blocks[-1][2].append(css[start:end])
            while sign == "}" and open_blocks:
                selectors, holds, declarations = open_blocks.pop()
                if selectors and holds:
                    yield selectors, ";".join(declarations)
                if mark:
                    break       # the end of the style closes what is left open
        start = after


def _declared(style: str) -> dict[str, tuple[bool, str]]:
    """(important, value) of the properties of ``TAKES_OFF`` that a style sets."""
    found: dict[str, tuple[bool, str]] = {}
    for declaration in style.split(";"):
        name, _, value = declaration.partition(":")
        name = name.strip().lower()
        if name in TAKES_OFF:
            value, mark, _ = value.lower().partition("!")
            value, important = value.strip(), bool(mark)
            if re.fullmatch(r"[a-z][a-z -]*", value) and (important or not found.get(name, (False,))[0]):
                found[name] = important, value
    return found


def style_rules(*sheets: str) -> Rules:
    """What the rules of plain selectors (tag, .class, #id, or a tag with one of them) say of ``TAKES_OFF``."""
    rules: Rules = {}
    for order, (selectors, style) in enumerate(block for css in sheets for block in _blocks(css)):
        declared = _declared(style)
        for selector in selectors.lower().split(",") if declared else ():
            selector = selector.strip()
            plain = _SIMPLE.match(selector)
            if not selector or not plain:
                continue
            specificity = (100 if "#" in selector else 10 if "." in selector else 0) + bool(plain[1])
            of = rules.setdefault(selector, {})
            for name, (important, value) in declared.items():
                of[name] = max(of.get(name, (False, -1, -1, "")), (important, specificity, order, value))
    return rules


def shown(node: Node, rules: Rules) -> tuple[bool, bool | None]:
    """Whether an element is on the page, and whether it is visible there (None: as its parent is).

    Of what rules and the element's own style say, the important wins, then the own style,
    the more specific and the later rule. Attributes give way to any of them.
    """
    attrs = node.attrs
    if node.tag in HIDDEN:
        return False, None
    off = "hidden" in attrs or node.tag == "dialog" and "open" not in attrs
    if not rules and "style" not in attrs:
        return not off, None
    said: dict[str, tuple[bool, int, int, str]] = {}
    if rules:
        names = [f".{c}" for c in attrs.get("class", "").lower().split()] + [f"#{attrs.get('id', '').lower()}"]
        for selector in [node.tag, *names, *[node.tag + n for n in names]]:
            for name, rule in rules.get(selector, {}).items():
                said[name] = max(said.get(name, rule), rule)
    for name, (important, value) in _declared(attrs.get("style", "")).items():
        own = (important, 1000, 0, value)
        said[name] = max(said.get(name, own), own)
    values = {name: rule[3] for name, rule in said.items()}
    if "display" in values:
        off = values["display"] in TAKES_OFF["display"]
    off = off or values.get("content-visibility") in TAKES_OFF["content-visibility"]
    visibility = values.get("visibility", "inherit")
    if visibility in TAKES_OFF["visibility"]:
        return not off, False
    return not off, True if visibility in ("visible", "initial") else None


# ------------------------------------------------------------------------------- layout

#: Levels of list items, quotes and tables that are set apart within each other.
DEEPEST = 32


class Lines:
    """Text being set: finished lines, the line at hand, and the blank lines owed before more text."""

    def __init__(self):
        self.done: list[str] = []
        self.parts: list[str] = []
        self.owed = 0
        self.space = False

    def words(self, text: str) -> None:
        """Running text: white space collapses, also over the borders of elements."""
        inner = SPACES.sub(" ", text)
        if inner.strip(" "):
            lead = (self.space or inner[0] == " ") and bool(self.parts)
            self.parts.append(" " * lead + inner.strip(" "))
            self.space = inner[-1] == " "
        else:
            self.space = self.space or bool(inner)

    def exactly(self, text: str) -> None:
        """Preformatted text."""
        for number, line in enumerate(text.expandtabs(8).split("\n")):
            if number:
                self.line_end(True)
            if line:
                self.parts.append(line)

    def line_end(self, forced: bool = False) -> None:
        line = "".join(self.parts).rstrip()
        if line or forced:
            self.settle()
            self.done.append(line)
        self.parts, self.space = [], False

    def settle(self) -> None:
        if self.done:
            self.done += [""] * self.owed
        self.owed = 0

    def block(self, blank: int) -> None:
        self.line_end()
        self.owed = max(self.owed, blank)

    def insert(self, lines: list[str]) -> None:
        if lines:
            self.settle()
            self.done += lines

    def finished(self) -> list[str]:
        self.line_end()
        first, last = 0, len(self.done)
        while first < last and not self.done[first].strip():
            first += 1
        while last > first and not self.done[last - 1].strip():
            last -= 1
        return self.done[first:last]


def _number(text: str, least: int, most: int, default: int) -> int:
    found = re.match(r"\s*(-?[0-9]{1,9})", text)
    return min(max(int(found[1]), least), most) if found else default


class Table:
    """Rows of cells, set in columns as wide as their widest cell up to ``WIDEST``."""

    def __init__(self):
        self.rows: list[list[tuple[int, list[str]]]] = []
        self.taken: dict[int, int] = {}     # columns that a cell of an earlier row reaches down into
        self.column = 0

    def row(self) -> None:
        self.rows.append([])
        self.taken = {c: left - 1 for c, left in self.taken.items() if left > 1}
        self.column = 0

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        while self.column in self.taken:
            self.column += 1
        self.rows[-1].append((self.column, lines))
        if down > 1:
            self.taken |= {c: down for c in range(self.column, self.column + across)}
        self.column += across

    def lines(self) -> list[str]:
        widths: dict[int, int] = {}
        for row in self.rows:
            for column, lines in row:
                width = max(map(len, lines), default=0)
                widths[column] = max(widths.get(column, 0), width if width <= WIDEST else 0)
        starts, at = {}, 0
        for column in sorted(widths):
            starts[column] = at
            at += widths[column] + 2 if widths[column] else 0
        made = []
        for row in self.rows:
            for number in range(max((len(lines) for _, lines in row), default=0)):
                line = ""
                for column, lines in row:
                    if number < len(lines) and lines[number]:
                        gap = starts[column] - len(line)
                        line += (" " * gap if gap > 0 else "  " if line else "") + lines[number]
                made.append(line.rstrip())
        return made


def _steps(root: Node, rules: Rules) -> Iterator[tuple[str, Node | str, Node | None]]:
    """Enter, text and leave steps over what is visible, without recursion: pages nest as deep as they like."""
    stack: list[tuple[Node, Iterator, bool]] = [(root, iter(root.children), True)]
    while stack:
        node, children, visible = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if stack:
                yield "leave", node, None
        elif isinstance(child, str):
            if visible:
                yield "text", child, node
        elif not (node.tag == "details" and "open" not in node.attrs and child.tag != "summary"):
            there, seen = shown(child, rules)
            seen = visible if seen is None else seen
            if there and (seen or child.tag != "input"):
                yield "enter", child, node
                stack.append((child, iter(child.children), seen))


def _mark(item: Node, lists: list[list]) -> str:
    """What stands before a list item, which counts on in an ordered list."""
    if not lists or lists[-1][0] != "ol":
        return "- "
    number = _number(item.attrs.get("value", ""), -10 ** 9, 10 ** 9, lists[-1][1])
    lists[-1][1] = number + lists[-1][2]
    return f"{number}. "


def render(root: Node, rules: Rules = {}) -> str:
    """All visible text of a tree, laid out in lines.

    List items, quotes and cells are set apart down to ``DEEPEST`` levels; within these,
    deeper ones are blocks of their own that are indented no further.
    """
    setting = [Lines()]
    tables: list[Table | None] = []
    lists: list[list] = []      # tag and next number of each open list
    own: list[bool] = []        # whether each open item, quote, cell or table is set apart
    verbatim = 0
    for step, node, parent in _steps(root, rules):
        out = setting[-1]
        if step == "text":
            if parent.tag == "details" and "open" not in parent.attrs:
                continue
            if verbatim:
                out.exactly(node)
            elif parent.tag not in ("table", "thead", "tbody", "tfoot", "tr") or node.strip():
                out.words(node)
            continue
        tag, entering = node.tag, step == "enter"
        if tag == "br" and entering:
            out.line_end(forced=True)
        elif tag == "hr" and entering:
            out.block(1)
        elif tag == "input" and entering and node.attrs.get("type", "").lower() in ("submit", "button", "reset"):
            out.words(f" {node.attrs.get('value', '')} ")
        elif tag in ("pre", "listing", "textarea"):
            out.block(1)
            verbatim += 1 if entering else -1
        elif tag in ("ul", "ol", "menu"):
            if entering:
                out.block(0 if lists else 1)
                step_on = -1 if "reversed" in node.attrs else 1
                count = sum(isinstance(c, Node) and c.tag == "li" for c in node.children)
                lists.append([tag, _number(node.attrs.get("start", ""), -10 ** 9, 10 ** 9,
                                           count if step_on < 0 else 1), step_on])
            else:
                lists.pop()
                out.block(0 if lists else 1)
        elif tag in ("li", "blockquote", "dd"):
            if entering:
                out.block(1 if tag == "blockquote" else 0)
                own.append(len(setting) <= DEEPEST)
                if own[-1]:
                    setting.append(Lines())
                elif tag == "li":
                    out.words(_mark(node, lists))
            elif not own.pop():
                out.block(1 if tag == "blockquote" else 0)
            else:
                lines = setting.pop().finished()
                mark = _mark(node, lists) if tag == "li" else "  " if tag == "blockquote" else "    "
                first = mark if tag == "li" else " " * len(mark)
                setting[-1].insert([((first if i == 0 else " " * len(mark)) + line).rstrip()
                                    for i, line in enumerate(lines)])
                setting[-1].block(1 if tag == "blockquote" else 0)
        elif tag == "table":
            if entering:
                out.block(1)
                own.append(len(setting) <= DEEPEST)
                tables.append(Table() if own[-1] else None)
            elif not own.pop():
                tables.pop()
                out.block(1)
            else:
                out.line_end()
                out.insert(tables.pop().lines())
                out.block(1)
        elif tag in ("tr", "td", "th") and tables and not tables[-1]:
            out.block(0)
        elif tag == "tr" and tables:
            if entering:
                tables[-1].row()
        elif tag in ("td", "th") and tables:
            if entering:
                setting.append(Lines())
            else:
                tables[-1].cell(setting.pop().finished(), _number(node.attrs.get("colspan", ""), 1, 1000, 1),
                                _number(node.attrs.get("rowspan", ""), 1, 65534, 1))
        elif tag in SPACED:
            out.block(1)
        elif tag in LINED:
            out.block(0)
    return "\n".join(setting[0].finished())


def _find(root: Node, tag: str) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        if node.tag == tag:
            yield node
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]


#: A tag that the page ends within.
_UNCLOSED = re.compile(r"<[A-Za-z/!][^<>]*\Z")


def extract(html: str | None) -> tuple[str | None, str]:
    """(title, text) of a page; the title is None where there is none."""
    if not html:
        return None, ""
    builder = TreeBuilder()
    builder.feed(_UNCLOSED.sub("", html))
    builder.close()
    sheets = ["".join(c for c in node.children if isinstance(c, str)) for node in _find(builder.root, "style")
              if media_holds(node.attrs.get("media", ""))]
    title = next((SPACES.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip()
                  for node in _find(builder.root, "title")), None)
    return title, render(builder.root, style_rules(*sheets))


def page_texts(pages: DataFrame, html: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, url, title, text): the visible text of every page, blocks apart, lists marked, tables aligned.

    A NULL or empty page has an empty text and no title; broken markup is closed as the
    following tags imply. Pages are worked on each by itself, so ids may repeat or be
    NULL, and an empty table gives no rows. Pages may be of any length and nest as deeply
    as they like: nothing is left out, see ``render`` for how deep levels are set.
    """
    @F.pandas_udf("title string, text string")
    def extracted(sources: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([extract(source) for source in sources], columns=["title", "text"])

    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                        extracted(F.col(html)).alias("page")).select("page_id", "url", "page.title", "page.text")
