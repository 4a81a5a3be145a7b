"""Field extraction from HTML, driven by a list of rules.

A rule names a tag and, if needed, an attribute with one of its values. The element body is
found by walking the nested tags of the same name, so an inner ``div`` does not end an outer
one. All of it runs as Spark expressions inside the scan stage.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork import settings as S
from presswork.functions.once import let
from presswork.functions.text import clean_byline, clean_content, strip


@dataclass(frozen=True)
class Rule:
    """``tag`` with ``attribute`` holding ``value``; ``joined`` trims and joins the text nodes."""

    tag: str
    attribute: str | None = None
    value: str | None = None
    joined: bool = False

    def opening(self) -> str:
        """Pattern of the start tag; a class value may be one of several words."""
        name = self.tag if self.tag != "*" else "[a-zA-Z][a-zA-Z0-9]*"
        if self.attribute is None:
            return f"<{name}\\b[^>]*>"
        inner = re.escape(self.value)
        if self.attribute == "class":
            body = f"(?:\"(?:[^\"]*\\s)?{inner}(?:\\s[^\"]*)?\"|'(?:[^']*\\s)?{inner}(?:\\s[^']*)?')"
        else:
            body = f"(?:\"{inner}\"|'{inner}')"
        return f"<{name}\\b[^>]*?\\s{self.attribute}\\s*=\\s*{body}[^>]*>"


# --- fixed values: where the news site keeps each field, in order of preference -----------
TITLE_RULES = [Rule("h2", "id", "title_area"), Rule("h2", "class", "media_end_head_headline")]
PUBLISHER_RULES = [
    Rule("span", "class", "media_end_head_top_logo_text"),
    Rule("em", "class", "media_end_linked_more_point"),
]
CARD_RULE = Rule("div", "class", "media_journalistcard_item_inner")
CARD_NAME_RULE = Rule("em", "class", "media_journalistcard_summary_name_text")
BYLINE_RULE = Rule("span", "class", "byline_s")
CONTENT_RULES = [
    Rule("article", "class", "_article_content"),
    Rule("div", "id", "newsct_article"),
    Rule("div", "id", "newsEndContents"),
    Rule("*", "id", "dic_area", joined=True),
    Rule("*", "class", "se-main-container", joined=True),
    Rule("*", "class", "se-component-content", joined=True),
    Rule("*", "class", "news_end", joined=True),
    Rule("*", "id", "articleBodyContents", joined=True),
]

# All named references of HTML 5, the frequent ones first because a map is searched in order. Only
# the names that HTML 5 lists without a semicolon may lack it: "&Andes" and "&And" stay as they are.
_FREQUENT = ["amp;", "nbsp;", "quot;", "lt;", "gt;", "apos;", "middot;", "hellip;", "copy;"]
_ENTITIES = "\u0002".join(
    f"{name}\u0001{html5[name]}" for name in [*_FREQUENT, *(n for n in html5 if n not in _FREQUENT)]
)
_TAG = "<(?:/?[a-zA-Z]|[!?])[^>]*>"
_NODE_BREAK = "\u0000"


def visible_markup(html: Column) -> Column:
    """Drop comments, scripts and styles, whose text is never part of a field."""
    return F.regexp_replace(
        html, "(?is)<(?:!--.*?-->|script\\b[^>]*>.*?</script\\s*>|style\\b[^>]*>.*?</style\\s*>)", ""
    )


def decode_entities(text: Column) -> Column:
    """Decode named, decimal and hexadecimal character references in a single pass.

    The closing semicolon may be missing where HTML 5 allows it and no letter, digit or ``_``
    follows; unknown references stay as they are.
    """
    names = F.str_to_map(F.lit(_ENTITIES), F.lit("\u0002"), F.lit("\u0001"))
    reference = "^(?:#[xX][0-9a-fA-F]+|#[0-9]+|[A-Za-z]\\w*);?"

    def number(ref: Column) -> Column:
        digits = F.regexp_replace(ref, "^#[xX]?0*|;$", "")
        return (
            F.when(~ref.startswith("#") | ~F.length(digits).between(1, 7), None)
            .when(ref.startswith("#x") | ref.startswith("#X"), F.conv(digits, 16, 10))
            .otherwise(digits)
            .cast("int")
        )

    def sign(code: Column, ref: Column) -> Column:
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        numeric = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(valid, numeric).when(ref != "", F.try_element_at(names, ref))

    def piece(part: Column) -> Column:
        def rebuilt(ref: Column) -> Column:
            return let(
                let(number(ref), lambda code: sign(code, ref)),
                lambda text: F.when(text.isNull(), F.concat(F.lit("&"), part)).otherwise(
                    F.concat(text, F.regexp_replace(part, reference, ""))
                ),
            )

        return let(F.regexp_extract(part, reference, 0), rebuilt)

    return F.array_join(
        F.transform(F.split(text, "&"), lambda part, i: F.when(i == 0, part).otherwise(piece(part))), ""
    )


def _element_end(start: Column, tag: Column) -> Column:
    """The element that ``start`` begins with: up to the end tag that closes it."""
    closing = F.concat(F.lit("(?i)^</"), tag, F.lit("\\b"))
    opening = F.concat(F.lit("(?i)^<"), tag, F.lit("\\b"))

    def level(step: Column) -> Column:
        return F.when(F.regexp_like(step, opening), 1).when(F.regexp_like(step, closing), -1).otherwise(0)

    def walk(state: Column, change: Column) -> Column:
        return F.when(state.closed, state).otherwise(
            F.struct(
                (state.depth + change).alias("depth"),
                (state.taken + (state.depth + change > 0).cast("int")).alias("taken"),
                (state.depth + change <= 0).alias("closed"),
            )
        )

    def inside(steps: Column) -> Column:
        begin = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("taken"), F.lit(False).alias("closed"))
        taken = F.aggregate(F.transform(steps, level), begin, walk, lambda state: state.taken)
        return F.array_join(F.slice(steps, F.lit(1), taken), "")

    return let(F.split(start, F.concat(F.lit("(?i)(?=</?"), tag, F.lit("\\b)"))), inside)


def _inner(start: Column) -> Column:
    """Inner markup of the element that ``start`` begins with.

    Most elements hold no other of their kind: then they end at the first end tag and the
    rest of the page is not looked at.
    """

    def first_end(start: Column, tag: Column) -> Column:
        return F.call_function("substring_index", start, F.concat(F.lit("</"), tag), F.lit(1))

    def ended(tag: Column) -> Column:
        def simple_or_nested(head: Column) -> Column:
            kin = F.regexp_count(head, F.concat(F.lit("(?i)</?"), tag, F.lit("\\b")))
            is_simple = (kin == 1) & (F.octet_length(head) < F.octet_length(start))
            return F.when(is_simple, head).otherwise(_element_end(start, tag))

        return let(first_end(start, tag), simple_or_nested)

    element = let(F.regexp_extract(start, "^<([a-zA-Z][a-zA-Z0-9]*)", 1), ended)
    return F.regexp_replace(element, "^<[^>]*>", "")


def _from(html: Column, start_tag: Column) -> Column:
    return F.substr(html, F.position(start_tag, html))


def start_tags(html: Column, rules: Sequence[Rule]) -> Column:
    """Every start tag that one of ``rules`` may want, in page order, found in one pass.

    A cheap pattern on tag names and wanted values picks the candidates; each rule then looks
    at these few short texts instead of the page.
    """
    names = "|".join(sorted({r.tag for r in rules if r.tag != "*"})) or "[a-zA-Z][a-zA-Z0-9]*"
    if any(r.tag == "*" for r in rules):
        names = "[a-zA-Z][a-zA-Z0-9]*"
    wanted = ""
    if all(r.attribute for r in rules):
        values = "|".join(sorted({re.escape(r.value) for r in rules}))
        wanted = f"\\s[^>]*?(?:{values})"
    return F.regexp_extract_all(html, F.lit(f"(?is)<(?:{names})\\b{wanted}[^>]*>"), F.lit(0))


def _tags_of(tags: Column, rule: Rule) -> Column:
    return F.filter(tags, lambda tag: F.regexp_like(tag, F.lit(f"(?is)^{rule.opening()}$")))


def element(html: Column, rule: Rule, tags: Column | None = None) -> Column:
    """Inner markup of the first element that matches ``rule``; null when there is none."""
    tags = start_tags(html, [rule]) if tags is None else tags
    return let(F.get(_tags_of(tags, rule), F.lit(0)), lambda tag: let(_from(html, tag), _inner))


def elements(html: Column, rule: Rule) -> Column:
    """Inner markup of every matching element."""
    marked = F.regexp_replace(html, f"(?is){rule.opening()}", f"{_NODE_BREAK}$0")
    parts = F.split(marked, _NODE_BREAK)
    return F.transform(F.filter(parts, lambda part, i: i > 0), _inner)


def text_of(markup: Column) -> Column:
    return decode_entities(F.regexp_replace(markup, _TAG, ""))


def first_text(html: Column, rules: Sequence[Rule], tags: Column | None = None) -> Column:
    """Trimmed text of the first rule whose element exists, else ''; null without a page.

    A joined rule keeps a mark between the text nodes, so that each is trimmed; without
    marks the whole text is the only node.
    """
    tags = start_tags(html, rules) if tags is None else tags

    def chosen(found: Column) -> Column:
        options = []
        for rule in rules:
            tag = F.get(_tags_of(found, rule), F.lit(0))
            options.append(F.concat(F.lit(_NODE_BREAK), tag) if rule.joined else tag)
        return F.coalesce(*options)

    def nodes(tag: Column) -> Column:
        mark = F.when(tag.startswith(_NODE_BREAK), F.lit(_NODE_BREAK)).otherwise(F.lit(""))
        inner = let(_from(html, F.ltrim(tag, F.lit(_NODE_BREAK))), _inner)
        return F.split(decode_entities(F.regexp_replace(inner, F.lit(_TAG), mark)), _NODE_BREAK)

    text = F.array_join(F.transform(let(let(tags, chosen), nodes), strip), "")
    return F.coalesce(text, F.when(html.isNotNull(), F.lit("")))


def extract_title(html: Column, rules: Sequence[Rule] = TITLE_RULES, tags: Column | None = None) -> Column:
    return first_text(html, rules, tags)


def extract_publisher(
    html: Column, rules: Sequence[Rule] = PUBLISHER_RULES, tags: Column | None = None
) -> Column:
    return first_text(html, rules, tags)


def extract_content(
    html: Column,
    rules: Sequence[Rule] = CONTENT_RULES,
    tags: Column | None = None,
    limit: int | None = S.MAX_CONTENT_LENGTH,
) -> Column:
    return clean_content(first_text(html, rules, tags), limit)


def reporter_cards(
    html: Column,
    card: Rule = CARD_RULE,
    name: Rule = CARD_NAME_RULE,
    suffix: str = S.REPORTER_SUFFIX,
    tags: Column | None = None,
) -> Column:
    """Names on the reporter cards joined with ','; null when no card carries a name."""
    tags = start_tags(html, [card]) if tags is None else tags
    found = F.filter(
        F.transform(elements(html, card), lambda c: element(c, name)), lambda n: n.isNotNull()
    )
    names = F.transform(found, lambda n: strip(F.replace(text_of(n), F.lit(suffix), F.lit(""))))
    joined = let(names, lambda n: F.when(F.size(n) > 0, F.array_join(n, ",")))
    return F.when(F.size(_tags_of(tags, card)) > 0, joined)


def extract_reporter(html: Column, tags: Column | None = None) -> Column:
    """Reporter cards, else the first byline, else ''."""
    byline = clean_byline(text_of(element(html, BYLINE_RULE, tags)))
    return F.coalesce(reporter_cards(html, tags=tags), byline, F.lit(""))
