"""Labelled pages, built from layout rules, on which the block labeller is trained.

Texts are random syllables, so that only layout and the shape of a text can be learned.
"""

from __future__ import annotations

import random

from presswork.llm.html_blocks import Block, blocks

PAGES = 240
_SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi wo xu ya ze".split()
_CONTAINERS = [
    ("<article>", "</article>"),
    ("<main><article>", "</article></main>"),
    ("<main>", "</main>"),
    ('<div class="content">', "</div>"),
    ('<div id="main"><div class="post-body">', "</div></div>"),
    ('<section class="story entry-content">', "</section>"),
    ('<article class="post" id="article">', "</article>"),
]


class _Writer:
    def __init__(self, seed: int):
        self.draw = random.Random(seed)
        self.content: set[str] = set()

    def words(self, low: int, high: int) -> str:
        d = self.draw
        count = d.randint(low, high)
        words = ["".join(d.choice(_SYLLABLES) for _ in range(d.randint(1, 5))) for _ in range(count)]
        for k in range(7, count, d.randint(6, 14)):
            words[k] += d.choice(",.")
        return " ".join(words).capitalize()

    def kept(self, low: int, high: int, end: str = ".") -> str:
        text = self.words(low, high) + (" © " + self.words(1, 3) if self.draw.random() < 0.04 else "") + end
        self.content.add(text)
        if self.draw.random() < 0.15:
            first, _, rest = text.partition(" ")
            return f'<a href="/y">{first}</a> {rest}' if rest else text
        return text

    def links(self, tag: str) -> str:
        items = "".join(f'<li><a href="/x">{self.words(1, 3)}</a></li>' for _ in range(self.draw.randint(3, 8)))
        return f"<{tag}><ul>{items}</ul></{tag}>" if tag else f"<ul>{items}</ul>"

    def clutter(self) -> str:
        """Something inside or beside the article that is not part of it."""
        d = self.draw
        name = d.choice(["ad", "ads", "advert", "sponsored", "promo banner"])
        kinds = [
            f'<div class="{name}">{self.words(2, 25)}.</div>',
            f'<div class="{d.choice(["cookie-notice", "notice", "consent", "alert"])}"><p>{self.words(4, 20)}.</p></div>',
            f'<aside><h3>{self.words(1, 3)}</h3>{self.links("")}</aside>',
            f'<aside class="sidebar"><p>{self.words(4, 30)}.</p></aside>',
            f'<div class="{d.choice(["related", "share social", "recommended", "tags"])}">{self.links("")}</div>',
            f'<form class="newsletter"><label>{self.words(1, 4)}</label><button>{self.words(1, 2)}</button></form>',
            f'<form><p>{self.words(3, 12)}.</p><select><option>{self.words(1, 1)}</option></select></form>',
        ]
        return d.choice(kinds)

    def comments(self) -> str:
        d = self.draw
        each = "".join(
            f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.words(2, 40)}.</p></div>' for _ in range(d.randint(1, 5))
        )
        return d.choice(['<section class="comments">{}</section>', '<div id="comments">{}</div>', "<div>{}</div>"]).format(each)

    def article(self) -> str:
        d = self.draw
        parts = [f"<{h}>{self.kept(1, 14, d.choice(['', '.']))}</{h}>" for h in d.choice([["h1"], ["h1"], ["h1", "h2"], []])]
        for _ in range(d.randint(1, 12)):
            kind = d.random()
            long = d.choice([(1, 6), (10, 40), (30, 120)])
            if kind < 0.75:
                parts.append(f"<p>{self.kept(*long)}</p>")
            elif kind < 0.8:
                parts.append(f"<p><b>{self.kept(*long)}<br>")
            elif kind < 0.85:
                parts.append(f"<h2>{self.kept(1, 8, '')}</h2>")
            elif kind < 0.9:
                parts.append("<ul>" + "".join(f"<li>{self.kept(2, 20)}</li>" for _ in range(d.randint(2, 4))) + "</ul>")
            elif kind < 0.95:
                parts.append(f"<blockquote><p>{self.kept(4, 30)}</p></blockquote>")
            else:
                parts.append(f"<table><tr><td>{self.kept(1, 5, '')}</td><td>{self.kept(1, 5, '')}</td></tr></table>")
            if d.random() < 0.12:
                parts.append(self.clutter())
        if d.random() < 0.2:
            parts.append(self.comments())
        return "".join(parts)

    def page(self) -> str:
        d = self.draw
        opened, closed = d.choice(_CONTAINERS)
        before = [self.links("nav")] if d.random() < 0.8 else [f'<div class="menu">{self.links("")}</div>']
        if d.random() < 0.5:
            before.insert(0, f"<header><p>{self.words(1, 8)}</p></header>")
        before += [self.clutter() for _ in range(d.randint(0, 2))]
        after = [self.clutter() for _ in range(d.randint(0, 2))]
        if d.random() < 0.3:
            after.append(self.comments())
        foot = f"&copy; {self.words(2, 20)}."
        after.append(f"<footer>{foot}</footer>" if d.random() < 0.8 else f'<div class="footer"><p>{foot}</p></div>')
        head = f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title></head><body>"
        return head + "".join(before) + opened + self.article() + closed + "".join(after) + "</body></html>"


def labelled_pages(pages: int = PAGES, seed: int = 1) -> list[tuple[list[Block], list[int]]]:
    """Blocks of each page with 1 for the article's and 0 for all others."""
    out = []
    for k in range(pages):
        writer = _Writer(seed * 100_003 + k)
        found = blocks(writer.page())
        out.append((found, [int(block.text in writer.content) for block in found]))
    return out
