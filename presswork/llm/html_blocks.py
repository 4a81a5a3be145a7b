"""Leaf text blocks of a page, with what their ancestors say about them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# --- fixed values: element kinds of HTML ---------------------------------------------------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template textarea title iframe svg object head".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp "
    "small span strike strong sub sup time tt u var".split()
)
ENDS_PARAGRAPH = set(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol p pre section table ul".split()
)
MARKED = set(
    "article main nav footer header aside form ul ol table figure blockquote button select label dialog h1 h2 h3 "
    "details p li td".split()
)
#: Words in class, id or role that tell what an element is for.
CUES = set(
    "ad ads advert advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert warning menu nav navigation navbar breadcrumb breadcrumbs sidebar side related recommended "
    "more share sharing social comment comments reply replies disqus discussion footer header masthead copyright "
    "legal newsletter subscribe signup login search popup modal overlay widget tags pagination paywall teaser "
    "content article post entry body story text main".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_CUED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_LETTERS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    marks: frozenset
    in_links: int


def _marks(tag: str, attributes: str) -> set:
    found = {f"in={tag}"} if tag in MARKED else set()
    if "=" in attributes:
        for groups in _CUED.findall(attributes):
            for word in _LETTERS.findall(" ".join(groups).lower()):
                if word in CUES:
                    found.add(f"cue={word}")
    return found


def blocks(page: str | None) -> list[Block]:
    """Blocks of text in page order; nothing inside scripts, styles and other hidden elements.

    A block ends where a block element starts or ends. References are decoded, white space is
    made one space and trimmed; empty blocks are left out. Broken markup never fails: an end
    tag without its start is ignored, and what is left open runs to the end.
    """
    out: list[Block] = []
    stack: list[tuple[str, frozenset, bool]] = []  # tag, marks so far, inside a link
    marks: frozenset = frozenset()
    pieces: list[str] = []
    linked, in_link = 0, False
    page = page or ""

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            out.append(Block(text, marks, linked))
        pieces.clear()
        linked = 0

    at = 0
    while True:
        match = _TAG.search(page, at)
        text = page[at : match.start() if match else len(page)]
        if text:
            pieces.append(text)
            if in_link:
                linked += len(text)
        if match is None:
            break
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        ending, attributes = bool(match[1] or match[4]), match[3] or match[6] or ""
        if tag in HIDDEN:
            if not ending and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                if end is None and tag == "head":
                    continue
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag not in INLINE:
            close()
        if tag in VOID or (attributes.endswith("/") and tag in INLINE):
            continue
        if ending:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is not None:
                del stack[depth:]
        else:
            if tag in ENDS_PARAGRAPH:
                depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] not in INLINE), None)
                if depth is not None and stack[depth][0] == "p":
                    del stack[depth:]
            _, above, within = stack[-1] if stack else ("", frozenset(), False)
            own = _marks(tag, attributes)
            stack.append((tag, above | own if own else above, within or tag == "a"))
        _, marks, in_link = stack[-1] if stack else ("", frozenset(), False)
    close()
    return out
