"""Text and URL expressions."""

from __future__ import annotations

import re
from urllib.parse import uses_params

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork import settings as S

# Every character Python's str.strip() removes. Trimming by set only looks at both ends of
# the text, where a regular expression would walk all of it.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(text: Column) -> Column:
    """Trim Unicode whitespace from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def normalize_url(
    url: Column,
    default_scheme: str = "https",
    mobile_path: str = S.MOBILE_PATH,
    canonical_path: str = S.CANONICAL_PATH,
) -> Column:
    """One form per article: no query, fragment or params, desktop path, no closing slash."""
    trimmed = strip(F.regexp_replace(url, "[\\t\\r\\n]", ""))
    address = F.regexp_extract(trimmed, "^[^?#]*", 0)
    scheme_pattern = "^([a-zA-Z][a-zA-Z0-9+.-]*):"
    scheme = F.lower(F.regexp_extract(address, scheme_pattern, 1))
    rest = F.regexp_replace(address, scheme_pattern, "")
    host = F.regexp_extract(rest, "^//([^/]*)", 1)
    path = F.regexp_replace(rest, "^//[^/]*", "")
    path = F.when(scheme.isin(uses_params), F.regexp_replace(path, ";[^/]*$", "")).otherwise(path)
    path = F.replace(path, F.lit(mobile_path), F.lit(canonical_path))
    path = F.regexp_replace(path, "(?s)(?<=.)/$", "")
    full = F.concat(F.coalesce(blank_to_null(scheme), F.lit(default_scheme)), F.lit("://"), host, path)
    return F.when(trimmed.isNull() | (trimmed == ""), F.lit("")).otherwise(full)


def normalize_publisher(publisher: Column, default: str = S.DEFAULT_PUBLISHER) -> Column:
    clean = F.coalesce(strip(publisher), F.lit(""))
    return F.when(F.length(clean) < S.MIN_PUBLISHER_LENGTH, F.lit(default)).otherwise(clean)


def normalize_name(
    name: Column,
    publisher: Column,
    invalid: list[str] | None = None,
    prefix: str = S.ANONYMOUS_PREFIX,
) -> Column:
    """Reporter name, or one anonymous name per publisher. ``publisher`` must be normalised."""
    clean = F.coalesce(strip(name), F.lit(""))
    unusable = (F.length(clean) < S.MIN_NAME_LENGTH) | clean.isin(
        S.INVALID_NAMES if invalid is None else invalid
    )
    return F.when(unusable, F.concat(F.lit(prefix), publisher)).otherwise(clean)


def clean_content(text: Column, limit: int | None = S.MAX_CONTENT_LENGTH) -> Column:
    """Collapse blank lines, trim, keep the first ``limit`` characters (a rule of the data model).

    Without a limit the whole text is kept.
    """
    clean = strip(F.regexp_replace(text, "\n{2,}", "\n"))
    return clean if limit is None else F.substring(clean, 1, limit)


def drop_tags(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)<(?:!--.*?-->|(?:/?[a-zA-Z]|[!?])[^>]*>)", "")


def strip_entities(text: Column) -> Column:
    """Delete (not decode) character references, then remove tags and keep their text."""
    return drop_tags(F.regexp_replace(text, "&[^;]+;", ""))


def clean_byline(text: Column, titles: list[str] | None = None) -> Column:
    """Drop a closing mail address, mail addresses in brackets and a closing job title."""
    words = "|".join(re.escape(word) for word in (S.JOB_TITLES if titles is None else titles))
    text = F.regexp_replace(text, "(?Ud)\\s+\\S+@\\S+\\.\\S+$", "")
    text = F.regexp_replace(text, "(?Ud)\\s*\\(\\S+@\\S+\\.\\S+\\)", "")
    text = F.regexp_replace(text, f"(?Ud)\\s+(?:{words})$", "")
    return strip(text)


def render_prompt(
    title: Column,
    content: Column,
    template: str = S.PROMPT_TEMPLATE,
    limit: int | None = S.MAX_CONTENT_LENGTH,
) -> Column:
    """Fill ``{title}`` and ``{content}``; a longer body is cut at ``limit`` and marked ``...``.

    Without a limit nothing is cut.
    """
    title = strip(F.coalesce(title, F.lit("")))
    content = strip(F.coalesce(content, F.lit("")))
    shown = content
    if limit is not None:
        cut = F.when(F.length(content) > limit, F.lit("...")).otherwise(F.lit(""))
        shown = F.concat(F.substring(content, 1, limit), cut)
    fields = {"{title}": title, "{content}": shown}
    pieces = [p for p in re.split(r"(\{title\}|\{content\})", template) if p]
    return F.concat(*[fields[p] if p in fields else F.lit(p) for p in pieces])


def score_band(score: Column, bands: list[tuple[int, int]] | None = None) -> Column:
    """Label such as ``21-40``; null for an unscored row."""
    label = F.lit(None).cast("string")
    for low, high in S.SCORE_BANDS if bands is None else bands:
        label = F.when(score.between(low, high), F.lit(f"{low}-{high}")).otherwise(label)
    return label


def cue_count(text: Column, words: list[str]) -> Column:
    """Number of occurrences of any of ``words``."""
    pattern = "|".join(re.escape(word) for word in sorted(words, key=len, reverse=True))
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def allowed_keyword(text: Column, punctuation: str = S.KEYWORD_PUNCTUATION) -> Column:
    """True when every character is Hangul, Latin, a digit, a space or listed punctuation."""
    signs = "".join("\\" + sign for sign in punctuation if not sign.isalnum() and sign != "_")
    return text.rlike(f"(?Ud)^[가-힣a-zA-Z0-9_\\s{signs}]+$")


def matching_keywords(text: Column, keywords: list[str]) -> Column:
    """Array of the keywords that occur in ``text``."""
    return F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(text, k))
