"""A small tolerant HTML tree: elements, their own text in order, and nothing else."""

from __future__ import annotations

import html
import re

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math canvas object textarea select title xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body html article section div nav footer header aside main form td th".split())
DEEPEST = 150  # elements nested deeper hang on the last level, so that no text is lost

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
DIGITS = re.compile(r"\d+")
SPACES = re.compile(r"\s+")


class Node:
    """An element: ``sig`` (tag, role, classes and id without digits) and its texts and child elements in order."""

    __slots__ = ("items", "sig", "tag")

    def __init__(self, tag: str, sig: str):
        self.tag, self.sig, self.items = tag, sig, []


def signature(tag: str, attributes: str) -> str:
    if not attributes or "=" not in attributes:
        return tag
    found = {}
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), (a or b or c).strip().lower())
    marks = [found.get("role", ""), " ".join(sorted(found.get("class", "").split())), found.get("id", "")]
    return DIGITS.sub("0", "|".join([tag, *marks])) if any(marks) else tag


def parse(page: str | None) -> Node:
    """The element tree of a page; scripts, styles, comments and the like leave nothing. Never fails."""
    root = Node("#", "#")
    stack = [root]
    at, page = 0, page or ""

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            stack[-1].items.append(html.unescape(raw))
        elif raw:
            stack[-1].items.append(" ")

    search = TAG.search
    while True:
        m = search(page, at)
        if m is None:
            text(page[at:])
            return root
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        tag = name.lower()
        if m[1] or m[4]:  # an end tag closes its element and all inside it, if it is open
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag not in BLOCKS and stack[i].tag in SCOPES:
                    break  # an inline end tag does not reach past its block
            continue
        attributes = m[3] or m[6] or ""
        if tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in BLOCKS:
            _close(stack, {"p"}, SCOPES)
        if tag in CLOSED_BY:
            _close(stack, CLOSED_BY[tag], {"ul", "ol", "dl", "table", "select"} - CLOSED_BY[tag])
        node = Node(tag, signature(tag, attributes))
        stack[-1].items.append(node)
        if tag not in VOID and not attributes.endswith("/") and len(stack) < DEEPEST:
            stack.append(node)


def _close(stack: list[Node], tags: set[str], scopes) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in scopes:
            return


def blocks(root: Node, wanted) -> list[str]:
    """Texts of the blocks in page order: white space as one space, trimmed, empty ones left out.

    ``wanted(node)``: None to skip a subtree, else whether the node's own texts count.
    """
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        if line:
            joined = SPACES.sub(" ", "".join(line)).strip()
            if joined:
                out.append(joined)
            line.clear()

    def walk(node: Node) -> None:
        mine = wanted(node)
        if mine is None:
            return
        block = node.tag in BLOCKS
        if block:
            end()
        for item in node.items:
            if isinstance(item, str):
                if mine:
                    line.append(item)
            elif item.tag in VOID:
                if item.tag in BLOCKS:
                    end()
                else:
                    line.append(" ")
            else:
                walk(item)
        if block:
            end()

    walk(root)
    end()
    return out
