"""A forgiving reader of HTML: events in page order, visible text in blocks, and a tree of elements."""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

# Elements of HTML.
BLOCKS = frozenset("""
address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form frameset
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table
tbody td tfoot th thead title tr ul caption
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style head title noscript template iframe noembed noframes svg math object audio video canvas select datalist".split())
# An opening element of the first kind ends an open one of the second.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
    "body": {"head"},
}
ENDS_P = BLOCKS - {"body", "html", "head", "title", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "caption", "legend"}
FENCES = frozenset("table ul ol dl select div section article aside nav footer header main form body html td th blockquote".split())

# Each sign is taken in one way only, so a tag that is never closed costs one pass. A quote that hides the end
# of its tag counts as a plain sign then.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


def events(html: str) -> Iterator[tuple[str, str, str]]:
    """("text", raw, ""), ("open", tag, attributes) and ("close", tag, ""). What is not closed at the end is dropped."""
    at, end = 0, len(html)
    while at < end:
        start = html.find("<", at)
        if start < 0:
            yield "text", html[at:], ""
            return
        if start > at:
            yield "text", html[at:start], ""
        after = html[start + 1:start + 2]
        if html.startswith("<!--", start):
            stop = html.find("-->", start + 4)
            at = end if stop < 0 else stop + 3
        elif after and after in "!?":
            stop = html.find(">", start)
            at = end if stop < 0 else stop + 1
        elif after.isascii() and after.isalpha() or after == "/":
            tag = _TAG.match(html, start) or _PLAIN_TAG.match(html, start)
            if not tag:
                stop = html.find(">", start)
                at = end if stop < 0 else stop + 1
                continue
            at, name = tag.end(), tag[2].lower()
            yield ("close" if tag[1] else "open"), name, tag[3]
            if not tag[1] and name in RAW:
                close = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                stop = close.start() if close else end
                if stop > at:
                    yield "text", html[at:stop], ""
                at = stop
        else:
            yield "text", "<", ""
            at = start + 1


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if raw.strip() else {}


def blocks_text(parts: list[tuple[int, str]]) -> str:
    """Pieces of text with the number of their block: one line per block, white space as one blank."""
    lines, block = [], None
    for number, text in parts:
        if number != block:
            lines.append([])
            block = number
        lines[-1].append(text)
    return "\n".join(line for line in (" ".join("".join(pieces).split()) for pieces in lines) if line)


def plain_text(html: str) -> str:
    """All visible text of a page."""
    parts, block, hidden = [], 0, []
    for kind, value, _ in events(html):
        if kind == "text":
            if not hidden:
                parts.append((block, unescape(value)))
            continue
        if value in HIDDEN and not (kind == "open" and value in VOID):
            if kind == "open":
                hidden.append(value)
            elif value in hidden:
                del hidden[len(hidden) - 1 - hidden[::-1].index(value):]
        if value == "body" and kind == "open":
            hidden.clear()
        if value in BLOCKS:
            block += 1
        elif value == "br":
            parts.append((block, " "))
    return blocks_text(parts)


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    parent: int
    depth: int
    children: list[int] = field(default_factory=list)
    own: list[str] = field(default_factory=list)  # text directly inside


@dataclass
class Page:
    nodes: list[Node]
    parts: list[tuple[int, int, str]]  # node, block, text: all text in page order


def parse(html: str) -> Page:
    """The tree; node 0 is the page itself. Elements that their parent or the next element ends are ended."""
    nodes, parts, stack, block = [Node("#page", {}, -1, 0)], [], [0], 0
    for kind, value, raw in events(html):
        if kind == "text":
            top = stack[-1]
            text = unescape(value) if nodes[top].tag not in ("script", "style") else value
            nodes[top].own.append(text)
            parts.append((top, block, text))
        elif kind == "open":
            if value in ("html", "body") and any(n.tag == value for n in nodes[:4]):
                continue
            ends = CLOSES.get(value, frozenset()) | ({"p"} if value in ENDS_P else frozenset())
            cut = len(stack)
            for k in range(len(stack) - 1, 0, -1):
                tag = nodes[stack[k]].tag
                if tag in ends:
                    cut = k
                elif tag in FENCES:
                    break
            del stack[cut:]
            if value in BLOCKS:
                block += 1
            elif value == "br":
                parts.append((stack[-1], block, " "))
            node = Node(value, attributes(raw), stack[-1], len(stack))
            nodes[stack[-1]].children.append(len(nodes))
            nodes.append(node)
            if value not in VOID and not raw.rstrip().endswith("/") or value in RAW:
                stack.append(len(nodes) - 1)
        else:
            if value in BLOCKS:
                block += 1
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == value:
                    del stack[k:]
                    break
    return Page(nodes, parts)
