"""A light DOM of block elements, for main-text extraction.

Only block elements become nodes; inline elements and line breaks add to
the text of the block around them.  Text of ``head``, scripts, styles,
templates, controls, graphics and comments is no text.  Unclosed and stray
tags are handled the way browsers do for the cases that matter: a new block
closes an open paragraph, list items and table cells close their like, an
end tag closes up to its element.  A control or graphic ends with its
parent at the latest, or at the next block if it has no end tag of its own.
"""

from __future__ import annotations

import html
import re

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|(?=<)|\Z)|<[!?][^>]*(?:>|\Z)",
                    re.S)
_ATTRIBUTE = re.compile(r"""(?:class|id|role|aria-label|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Element names of HTML.
BLOCKS = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul caption").split())
RAW = frozenset("script style noscript iframe textarea title".split())
HIDDEN = frozenset("template object svg select datalist optgroup option button canvas audio video".split())
_NESTING = frozenset("template object svg".split())
#: an element that starts ends an open one of these
_ENDS = {"option": {"option"}, "optgroup": {"option", "optgroup"}, "select": {"select"}, "datalist": {"datalist"}, "button": {"button"},
         "canvas": {"canvas"}, "audio": {"audio"}, "video": {"video"}}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}


_BIT = {tag: 1 << i for i, tag in enumerate(sorted(BLOCKS))}


class Node:
    """A block element: its own text runs are those of no deeper block."""

    __slots__ = ("tag", "words", "parent", "children", "depth", "chars", "linked", "runs", "open_tags")

    def __init__(self, tag: str, words: list[str], parent: int, depth: int):
        self.tag, self.words, self.parent, self.depth = tag, words, parent, depth
        self.children: list[int] = []
        self.chars = self.linked = self.runs = 0
        self.open_tags = 0  # a bit for its own element name and those above it


def attribute_words(attributes: str) -> list[str]:
    """Lower-case words of class, id, role, label and itemprop."""
    if "=" not in attributes:
        return []
    return [w for v in _ATTRIBUTE.findall(attributes) for w in _WORD.findall(_CAMEL.sub(" ", html.unescape(v)).lower())]


def _ended(text: str, tag: str) -> set[int]:
    """Positions of the start tags that have an end tag of their own."""
    out, waiting = set(), []
    for m in re.finditer(rf"<(/?){tag}(?![A-Za-z0-9:-])", text, re.I):
        if m[1]:
            if waiting:
                out.add(waiting.pop())
        elif tag in _NESTING:
            waiting.append(m.start())
        else:
            waiting = [m.start()]
    return out


def parse(text: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in page order (the root first) and the page's ``(node, text run)`` blocks."""
    nodes, runs = [Node("html", [], -1, 0)], []
    at, links, open_text = 0, 0, []
    end, size = 0, len(text)
    hidden: list[tuple[str, bool]] = []  # open elements from the outermost without text on; whether they have an end tag
    ended: dict[str, set[int]] = {}

    def flush():
        if open_text:
            words = " ".join(html.unescape("".join(open_text)).split())
            open_text.clear()
            if words:
                runs.append((at, words))
                nodes[at].runs += 1

    def add(raw):
        if hidden:
            return
        open_text.append(raw)
        n = len(raw) - raw.count(" ")
        nodes[at].chars += n
        if links:
            nodes[at].linked += n

    def above(tags, scope=()):
        """The nearest open node of ``tags`` within ``scope``, 0 if there is none."""
        up = at
        while up > 0 and nodes[up].tag not in tags:
            if nodes[up].tag in scope:
                return 0
            up = nodes[up].parent
        return up

    def still_hidden(tag, closing):
        """Whether the tag stays within the hidden elements; ends those that it closes."""
        if tag not in HIDDEN and tag not in BLOCKS and tag not in ("html", "body", "foreignobject"):
            return True
        if closing:
            last = next((i for i in range(len(hidden) - 1, -1, -1) if hidden[i][0] == tag), None)
            if last is not None:
                del hidden[last:]
                return True
            if tag in ("html", "body") or tag in BLOCKS and above({tag}):
                hidden.clear()
            return bool(hidden)
        if tag in HIDDEN:
            while hidden and hidden[-1][0] in _ENDS.get(tag, ()):
                hidden.pop()
            return True
        if tag in BLOCKS:
            while hidden and hidden[-1][0] == "svg":  # no block is inside a graphic
                hidden.pop()
            like = tag in _CLOSED_BY and not any(t in _SCOPE[tag] for t, _ in hidden) and above(_CLOSED_BY[tag], _SCOPE[tag])
            if like or not any(own for t, own in hidden if t in HIDDEN):
                hidden.clear()
            if hidden and tag not in VOID:
                hidden.append((tag, True))
        elif tag == "foreignobject":
            hidden.append((tag, True))
        return bool(hidden)

    while end < size:
        m = _TOKEN.search(text, end)
        if m is None:
            add(text[end:])
            break
        if m.start() > end:
            add(text[end:m.start()])
        end = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(m[1])
        if tag == "title" and any(t == "svg" for t, _ in hidden):
            continue
        if hidden and tag not in RAW and tag != "head":
            inside = still_hidden(tag, closing)
            if inside and (closing or tag not in HIDDEN):
                if tag == "a" and closing:
                    links = 0
                continue
        if tag in HIDDEN:
            if not closing and not m[3].endswith("/"):
                if tag not in ended:
                    ended[tag] = _ended(text, tag)
                hidden.append((tag, m.start() in ended[tag]))
                open_text.append(" ")
        elif tag in RAW or tag == "head":
            if not closing and not m[3].endswith("/"):
                stop = re.compile(rf"</{tag}\b[^>]*>" + (r"|(?=<body\b)" if tag == "head" else ""), re.I).search(text, end)
                end = stop.end() if stop else (size if tag not in ("head", "noscript") else end)
                open_text.append(" ")
        elif tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            open_text.append(" ")
        elif tag in ("html", "body"):
            if not closing:
                nodes[0].words += attribute_words(m[3])
        elif tag in BLOCKS:
            flush()
            links = 0
            if closing:
                if nodes[at].open_tags & _BIT[tag]:  # an end tag without an open element costs nothing
                    up = at
                    while nodes[up].tag != tag:
                        up = nodes[up].parent
                    at = nodes[up].parent
            else:
                if nodes[at].tag == "p":  # no block is inside a paragraph
                    at = nodes[at].parent
                if tag in _CLOSED_BY:
                    up = at
                    while up > 0 and nodes[up].tag not in _CLOSED_BY[tag] and nodes[up].tag not in _SCOPE[tag]:
                        up = nodes[up].parent
                    if up > 0 and nodes[up].tag in _CLOSED_BY[tag]:
                        at = nodes[up].parent
                        if tag == "tr" and nodes[at].tag == "tr":
                            at = nodes[at].parent
                elif tag[0] == "h" and tag[1:].isdigit() and nodes[at].tag[0] == "h" and nodes[at].tag[1:].isdigit():
                    at = nodes[at].parent
                if tag not in VOID:
                    nodes.append(Node(tag, attribute_words(m[3]), at, nodes[at].depth + 1))
                    nodes[at].children.append(len(nodes) - 1)
                    nodes[-1].open_tags = nodes[at].open_tags | _BIT[tag]
                    at = len(nodes) - 1
    flush()
    return nodes, runs
