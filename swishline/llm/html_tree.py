"""Pages as trees of blocks: tags that break text, with the text between them."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|iframe)\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</\1\s*>|\Z)"
    # these end where they close themselves (svg), and are read on if nothing ends them
    r"|<(noscript|template|object|canvas|video|audio"
    r"|svg(?=\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*(?<!/)>))\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?</\2\s*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

BLOCKS = set(
    "html head title body div article section main nav header footer aside h1 h2 h3 h4 h5 h6 p "
    "ul ol li dl dt dd table thead tbody tfoot tr td th caption form fieldset blockquote pre "
    "figure figcaption address hr details summary dialog menu select option button center".split()
)
_EMPTY = {"hr"}
_VOID = set("img input meta link source wbr area base col embed param track".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# an open tag on the left ends before one of the tags on the right begins
_ENDS_BEFORE = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "option": {"option"},
    "head": BLOCKS - {"head", "title", "html"},
}
_SCOPES = set("ul ol dl table div article section main body html select".split())

#: tags that hold no text of a page's own
SKIP_TAGS = set("head title nav footer aside form menu dialog select button".split())
#: words in class, id or role which hint that a block holds none; a hint says nothing of a
#: heading, a paragraph or the page as a whole, and does not count if nothing is left
HINT_WORDS = set(
    "ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored "
    "cookie cookies consent gdpr notice notices alert popup modal overlay sidebar aside menu "
    "nav navbar navigation navigational breadcrumb breadcrumbs footer masthead comment "
    "comments discussion respond disqus share sharing social related recommended recommendations "
    "newsletter subscribe signup login search widget pagination pager contentinfo "
    "complementary form".split()
)
NEVER_HINTED = HEADINGS | {"p", "html", "body", "main", "article"}
_DENIED = {"no", "not", "has", "with", "without"}  # a name that begins so tells of another block


@dataclass
class Node:
    label: str
    tag: str
    skip: bool
    main: bool = False
    hint: bool = False
    header: bool = False  # of it only headings are the page's own
    parts: list = field(default_factory=list)  # nodes, and text with references still in it


def _node(tag: str, attributes: str) -> Node:
    if not attributes.strip():
        return Node(tag, tag, tag in SKIP_TAGS, header=tag == "header")
    found = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), "".join(values))
    own = f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}".lower()
    tokens = [re.split(r"[^a-z]+", token) for token in own.split()]
    words = {word for token in tokens if token[0] not in _DENIED for word in token}
    hidden = "display:none" in found.get("style", "").replace(" ", "").lower()
    hidden |= found.get("aria-hidden") == "true"
    hidden |= re.search(r"(?:^|\s)hidden(?:\s|$)", attributes) is not None
    names = " ".join(sorted(set(re.sub(r"\d+", "0", own).split())))
    named = tag not in NEVER_HINTED
    return Node(
        f"{tag}.{names}" if names else tag,
        tag,
        tag in SKIP_TAGS or hidden,
        main=found.get("role") == "main",
        hint=named and bool(words & HINT_WORDS),
        header=tag == "header" or named and "header" in words,
    )


def parse(page: str) -> Node:
    """The tree of a page; never fails: unknown ends are ignored, missing ones are supplied.
    Blocks may be nested as deep as a page likes."""
    root = Node("", "", False)
    open_ = [root]
    tags: Counter = Counter()  # of the open blocks

    def close(first: int) -> None:
        for block in open_[first:]:
            tags[block.tag] -= 1
        del open_[first:]

    def text(part: str) -> None:
        if part:
            own = open_[-1].parts
            if own and isinstance(own[-1], str):
                own[-1] += part
            else:
                own.append(part)

    at = 0
    for token in _TOKEN.finditer(page):
        text(page[at : token.start()])
        at = token.end()
        tag = (token[4] or "").lower()
        if not tag:
            continue
        ends, attributes = token[3], token[5] or ""
        if tag == "br":
            text(" ")
            continue
        node = None if ends else _node(tag, attributes)
        if tag in _VOID:
            continue
        if tag not in BLOCKS:
            # of inline elements only those that are skipped count, and what is inside them
            dropped = node is not None and (node.skip or node.hint)
            if not tags[tag] and (ends or not dropped or attributes.endswith("/")):
                continue
        if ends:
            for i in range(len(open_) - 1, 0, -1) if tags[tag] else ():
                if open_[i].tag == tag:
                    close(i)
                    break
                if open_[i].tag in ("body", "html") and tag not in ("html",):
                    break
            continue
        if tag in BLOCKS:
            close(_ends_before(open_, tag))
        open_[-1].parts.append(node)
        if tag not in _EMPTY and not attributes.endswith("/"):
            open_.append(node)
            tags[tag] += 1
    text(page[at:])
    return root


def _ends_before(open_: list[Node], tag: str) -> int:
    """The first of the open blocks that end before a block of that tag begins."""
    first = len(open_)
    for i in range(len(open_) - 1, 0, -1):
        own = open_[i].tag
        if own == "p" or tag in _ENDS_BEFORE.get(own, ()):
            first = i
        elif own in _SCOPES:
            break
    return first


def plain(part: str) -> str:
    """Character references decoded, white space as single spaces, trimmed."""
    return " ".join(html.unescape(part).split())
